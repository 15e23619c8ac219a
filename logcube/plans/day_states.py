"""Stored, mergeable states of log days, from which cubes and growth are exact.

A log day's state holds, per (event day, kind, package, title, site, source), the
number of its events and the set of its users, as bitmaps over a dictionary that
numbers the users: one row per 32,768 numbers of which the group has any.

States are taken *before* the catalog join, so a report joins today's catalog; and
they merge: counts add up, bitmaps unite.  A late event is in the state of the log
day that brought it, and a log day that is ingested again replaces its own state
alone.  A night thus reads its facts of one log day, and a growth report the
states of three event days, which have no more rows than their groups, whatever
the number of events.

Layout::

    <root>/states/...            one snapshot per log day (``sinks``: committed in one step)
    <root>/users/run=<run>/      the dictionary: custom_uuid, user_no
    <root>/_users/users.<v>.json what of it counts, and the next number
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.functions.scalar import safe_ratio
from logcube.operators.cube import grouping_number, plan_lattice
from logcube.operators.enrich import enrich
from logcube.operators.growth import LAGS, growth_report
from logcube.plans.reports import as_date, restrict_days
from logcube.plans.specs import GrowthSpec
from logcube.sources import facts as fact_table
from logcube.sources import sinks, store

#: What a state's rows are grouped by, beside the bucket of user numbers.
GROUP = ("date", "dt", "kind", "package_id", "title", "site", "source")
USERS = "custom_uuid string, user_no bigint"


def _users(spark: SparkSession, root: str) -> DataFrame:
    _, content = store.current(spark, f"{root}/_users", "users")
    if not content or not content["runs"]:
        return spark.createDataFrame([], USERS)
    return spark.read.schema(USERS).parquet(*[f"{root}/users/run={run}" for run in content["runs"]])


def number_users(rows: DataFrame, root: str) -> DataFrame:
    """The dictionary (custom_uuid, user_no) with a number for every user of
    ``rows``: those it has keep theirs, new ones follow without gaps.

    If another writer numbers users at the same time, who commits later numbers
    what is still new again."""
    spark, root = rows.sparkSession, root.rstrip("/")
    new = rows.where("custom_uuid is not null").select("custom_uuid").distinct()
    while True:
        version, content = store.current(spark, f"{root}/_users", "users")
        content = content or {"runs": [], "next": 0}
        run = uuid.uuid4().hex
        unknown = new.join(_users(spark, root), "custom_uuid", "left_anti")
        numbered = f"{root}/users/unnumbered={run}"
        at = F.monotonically_increasing_id()
        unknown.select("custom_uuid", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")).write.parquet(numbered)
        found = spark.read.schema("custom_uuid string, part bigint, place bigint").parquet(numbered)
        sizes = sorted(tuple(r) for r in found.groupBy("part").count().collect())  # one row per partition
        if not sizes:
            return _users(spark, root)
        starts, following = [], content["next"]
        for part, n in sizes:
            starts.append((part, following))
            following += n
        first = F.broadcast(spark.createDataFrame(starts, "part bigint, first bigint"))
        found.join(first, "part").select("custom_uuid", (F.col("first") + F.col("place")).alias("user_no")).write.parquet(f"{root}/users/run={run}")
        text = store.json.dumps({"runs": [*content["runs"], run], "next": following})
        if store.put_new(spark, store.version_path(f"{root}/_users", "users", version + 1), text):
            return _users(spark, root)


def states_of(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Fact rows as states: the group, bucket, n (events of known users) and users
    (bitmap; NULL with bucket for rows without a user, so that their group is there)."""
    numbered = rows.join(users, "custom_uuid", "left").withColumn("bucket", F.bitmap_bucket_number("user_no"))
    found = numbered.groupBy("log_day", *GROUP, "bucket").agg(F.count("custom_uuid").alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position("user_no")).alias("users"))
    return found.withColumn("users", F.when(F.col("bucket").isNotNull(), F.col("users")))


def update_states(spark: SparkSession, fact_root: str, root: str, log_days: Iterable, fmt: str = "orc") -> None:
    """Take the states of log days from the fact table, in the place of those that
    they have; a day without facts has an empty one.  Call it after an ingest."""
    days = [str(d) for d in log_days]
    rows = fact_table.read_facts(spark, fact_root, log_days=days, fmt=fmt)
    states = states_of(rows, number_users(rows, root))
    sinks.write_report_files(states, f"{root.rstrip('/')}/states", date_col="log_day", days=days, plain=False)


def read_states(spark: SparkSession, root: str, days: Iterable | None = None, kinds: Iterable[str] | None = None) -> DataFrame:
    """The states of all log days, of event ``days`` and ``kinds``."""
    found = sinks.read_report_files(spark, f"{root.rstrip('/')}/states", date_col="log_day")
    if days is not None:
        found = restrict_days(found, days)
    return found if kinds is None else found.where(F.col("kind").isin(list(kinds)))


def cube_of_states(states: DataFrame, catalog: DataFrame, spec: GrowthSpec, **how) -> DataFrame:
    """``operators.cube.rollup_counts`` of the events behind ``states``, joined
    to ``catalog`` by the spec's rules.

    Along the lattice of the sets: a set's bitmaps are those of a finer set,
    united.  ``how`` is that of ``operators.enrich.enrich``."""
    rich = enrich(states.where(F.col("kind").isin(list(spec.kinds))), catalog, spec.title_rule, spec.category, **how)
    keys, sets = spec.keys, [tuple(k for k in spec.keys if k in s) for s in spec.grouping_sets]
    types = {f.name: f.dataType for f in rich.schema}

    def united(rows: DataFrame, grouped: tuple[str, ...]) -> DataFrame:
        found = rows.groupBy("date", *grouped, "bucket").agg(F.sum("n").alias("n"), F.bitmap_or_agg("users").alias("users"))
        return found.withColumn("users", F.when(F.col("bucket").isNotNull(), F.col("users")))

    def counted(rows: DataFrame, grouped: tuple[str, ...]) -> DataFrame:
        users = F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).cast("bigint")
        found = rows.groupBy("date", *grouped).agg(F.sum("n").cast("bigint").alias("playNum"), users.alias("users"))
        missing = [F.lit(None).cast(types[k]).alias(k) for k in keys if k not in grouped]
        number = F.lit(grouping_number(grouped, keys)).cast("bigint").alias("id_1")
        return found.select("*", *missing, number).select("date", *keys, "id_1", "playNum", "users")

    detail = united(rich, keys)
    out = [counted(detail, keys)] if keys in sets else []
    for top, members in plan_lattice(sets, keys).items():
        finest = united(detail, top)
        out += [counted(finest if s == top else united(finest, s), s) for s in members]
    cube = out[0]
    for more in out[1:]:
        cube = cube.unionAll(more)
    return cube.withColumn("avgPlayNum", safe_ratio(F.col("playNum"), F.col("users"), 2))


def growth_from_states(spark: SparkSession, root: str, catalog: DataFrame, spec: GrowthSpec, days: Iterable, fmt: str = "percent", **how) -> DataFrame:
    """R1 / R2 of ``days`` from the states of these days and of those 1 and 7 days
    before: what ``plans.reports.growth`` gives from their facts."""
    days = sorted({as_date(d) for d in days})
    found = sinks.read_report_files(spark, f"{root.rstrip('/')}/states", date_col="log_day")
    states = restrict_days(found, days, lookback=LAGS)
    report = growth_report(cube_of_states(states, catalog, spec, **how), spec.keys, spec.key_names, fmt=fmt)
    return report.where(F.col("_day").isin(days)).drop("_day")
