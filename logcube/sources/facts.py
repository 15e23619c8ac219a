"""The fact table of parsed events, for several writers.

Layout::

    <root>/run=<run>/log_day=<day>/kind=<event kind>/dt=<event day>/   rows
    <root>/_days/<day>.<version>.json     what counts: the day's runs and their folders
    <root>/_files/<day>.<run>.json        the log files that the run has parsed
    <root>/bad_lines/run=<run>/log_day=<day>/                          lines no run could read

A log day belongs to the runs that the last version of its ``_days`` file names.
A writer first writes its rows as a run that nobody reads, and then commits it day
by day: it makes the next version of the day's file, from the one that it has
read.  If another writer has made that version meanwhile, it looks at the day
again, so that no run is lost:

* An ingest *replaces* the runs it found when it began.  Runs that came since stay,
  unless it has parsed all their files itself; if one has some of them and others,
  that day is ingested again, as rows cannot be told apart by file.
* A streaming batch *adds* a run with files that no run of the day has parsed.  If
  another writer has parsed some of them meanwhile, that day's part of the run is
  dropped and parsed again without them.
* Compaction puts one run in the place of several, with all their files; if one
  of them has gone meanwhile, it is given up.

So neither a replayed batch, a renewed checkpoint nor a stream beside the nightly
ingest counts a file twice.  Readers take the folders of the days and kinds
asked for from the ``_days`` files; no other folder is listed, and file names
are only read by writers, for the days that they write.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logcube.sources import store

FACT_SCHEMA = T.StructType(
    [
        T.StructField("custom_uuid", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("log_date", T.DateType()),
        T.StructField("device_name", T.StringType()),
        T.StructField("vercode", T.StringType()),
        T.StructField("vername", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("package_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("source", T.IntegerType()),
        T.StructField("run", T.StringType()),
        T.StructField("log_day", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)
PARTITIONS = ("log_day", "kind", "dt")
DATA_COLUMNS = tuple(f.name for f in FACT_SCHEMA.fields if f.name not in ("run", *PARTITIONS))
#: A ``_days`` file.
DAY_SCHEMA = "log_day string, runs array<struct<run:string,parts:array<struct<kind:string,dt:string>>,bad:array<string>>>"
#: Spark's folder name of a NULL partition value (an event without a day).
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class Overtaken(RuntimeError):
    """Another writer has parsed some of the same files, and others, meanwhile."""


@dataclass
class Run:
    """A written run: its folders by log day, and the days with bad lines of it."""

    name: str
    parts: dict[str, list[dict]]
    bad_days: set[str] = field(default_factory=set)

    def entry(self, day: str) -> dict:
        return {"run": self.name, "parts": sorted(self.parts.get(day, []), key=str), "bad": [self.name] if day in self.bad_days else []}


def _day(d) -> str:
    return d.isoformat() if isinstance(d, _dt.date) else str(d)


def _days_folder(path: str) -> str:
    return f"{path.rstrip('/')}/_days"


def _files_path(path: str, day: str, run: str) -> str:
    return f"{path.rstrip('/')}/_files/{day}.{run}.json"


def _runs(content: dict | None) -> list[dict]:
    return content["runs"] if content else []


def day_runs(spark: SparkSession, path: str, days: Iterable) -> dict[str, list[dict]]:
    """The runs in force of each given log day: run, parts, bad (the runs whose bad
    lines still count) and, of a compacted run, the runs that it stands for (of)."""
    found, last = {}, store.versions(spark, _days_folder(path))
    for day in map(_day, days):
        if last.get(day):
            found[day] = _runs(store.current(spark, _days_folder(path), day, last[day])[1])
    return found


def parsed_files(spark: SparkSession, path: str, day: str, runs: Iterable[str]) -> set[str]:
    """The log files of a day that the given runs have parsed."""
    return {f for run in runs for f in json.loads(store.get_text(spark, _files_path(path, day, run)))}


def write_run(facts: DataFrame, path: str, fmt: str = "orc", rebalance: bool = True) -> Run:
    """Write rows as a run that is not in force yet.

    ``rebalance`` adds a REBALANCE on the partition columns: with AQE it
    coalesces small shuffle partitions and splits skewed ones, so a folder gets
    a few large files, and a hot (kind, day) is still written by many tasks."""
    spark, root = facts.sparkSession, path.rstrip("/")
    run = Run(uuid.uuid4().hex, {})
    cols = [F.col(c) if c in facts.columns else F.lit(None).cast(FACT_SCHEMA[c].dataType).alias(c) for c in DATA_COLUMNS]
    rows = facts.select(*cols, F.col("log_date").cast("string").alias("log_day"), "kind", "dt")
    if rebalance:
        rows = rows.hint("rebalance", *PARTITIONS)
    rows.write.partitionBy(*PARTITIONS).format(fmt).save(f"{root}/run={run.name}")
    written = spark.read.schema(FACT_SCHEMA).format(fmt).option("basePath", root).load(f"{root}/run={run.name}")
    for r in written.select(*PARTITIONS).distinct().collect():  # one row per folder of the run
        run.parts.setdefault(r.log_day, []).append({"kind": r.kind, "dt": r.dt})
    return run


def put_files(spark: SparkSession, path: str, run: Run, files: Mapping[str, Iterable[str]]) -> None:
    """Note the log files of a run, before any of its days is committed."""
    for day, parsed in files.items():
        store.put_text(spark, _files_path(path, day, run.name), json.dumps(sorted(parsed)))


def replace_days(spark: SparkSession, path: str, run: Run, files: Mapping[str, Iterable[str]], found: Mapping[str, Iterable[str]]) -> list[str]:
    """Put ``run`` in force for the days of ``files``, in the place of the runs
    ``found`` there before its logs were listed; returns the days that were
    overtaken: another run has parsed some of the files, and others, meanwhile."""
    put_files(spark, path, run, files)
    overtaken = []
    for day, parsed in files.items():
        gone, own = set(found.get(day, ())), set(parsed)

        def change(content: dict | None, day=day, gone=gone, own=own) -> dict | None:
            left = []
            for r in _runs(content):
                theirs = parsed_files(spark, path, day, [r["run"]]) if r["run"] not in gone else set()
                if theirs & own and theirs - own:
                    return None
                if theirs - own:
                    left.append(r)
            return {"log_day": day, "runs": [*left, run.entry(day)]}

        if store.update(spark, _days_folder(path), day, change) is None:
            overtaken.append(day)
    return overtaken


def add_days(spark: SparkSession, path: str, run: Run, files: Mapping[str, Iterable[str]]) -> dict[str, set[str]]:
    """Add ``run`` to the days of ``files``, but for those of whose files another
    writer has parsed some meanwhile: these days, with the files that are left."""
    put_files(spark, path, run, files)
    left: dict[str, set[str]] = {}
    for day, parsed in files.items():
        own = set(parsed)

        def change(content: dict | None, day=day, own=own) -> dict | None:
            known = parsed_files(spark, path, day, [r["run"] for r in _runs(content)])
            if known & own:
                left[day] = own - known
                return None
            left.pop(day, None)
            return {"log_day": day, "runs": [*_runs(content), run.entry(day)]}

        store.update(spark, _days_folder(path), day, change)
    return left


def write_facts(
    facts: DataFrame,
    path: str,
    files: Mapping[str, Sequence[str]],
    replace: bool = True,
    fmt: str = "orc",
    rebalance: bool = True,
) -> str:
    """K1: write the rows of one ingest run and put it in force; returns the run.

    ``files`` has the parsed log files of every log day that the run covers;
    ``replace`` puts the run in the place of the days' present ones, else it is
    added to them.  Raises ``Overtaken`` if another run has parsed some of the
    files meanwhile."""
    spark = facts.sparkSession
    found = {day: [r["run"] for r in runs] for day, runs in day_runs(spark, path, files).items()}
    run = write_run(facts, path, fmt, rebalance)
    if replace_days(spark, path, run, files, found) if replace else add_days(spark, path, run, files):
        raise Overtaken(f"run {run.name}: other runs have parsed some of its files")
    return run.name


def compact(spark: SparkSession, path: str, days: Iterable, fmt: str = "orc", least_runs: int = 2) -> list[str]:
    """Rewrite the runs of closed log days, of those with ``least_runs`` at least,
    into one run, in one job; the days that were committed.

    The new run has all log files of the old ones, so a batch that is replayed
    later still adds nothing, and their bad lines still count.  A run that came
    meanwhile stays beside it; a day of which a run has been replaced meanwhile is
    left as it is.  The old runs' folders become unreferenced."""
    before = {day: runs for day, runs in day_runs(spark, path, days).items() if len(runs) >= least_runs}
    if not before:
        return []
    rows = read_facts(spark, path, log_days=list(before), runs={r["run"] for runs in before.values() for r in runs}, fmt=fmt)
    run = write_run(rows.drop("run"), path, fmt)
    put_files(spark, path, run, {day: parsed_files(spark, path, day, [r["run"] for r in runs]) for day, runs in before.items()})
    done = []
    for day, runs in before.items():
        old = [r["run"] for r in runs]
        bad = sorted({b for r in runs for b in r["bad"]})
        of = sorted({name for r in runs for name in r.get("of") or [r["run"]]})

        def change(content: dict | None, day=day, old=old, bad=bad, of=of) -> dict | None:
            present = [r["run"] for r in _runs(content)]
            if not set(old) <= set(present):
                return None
            kept = [r for r in _runs(content) if r["run"] not in old]
            return {"log_day": day, "runs": [run.entry(day) | {"bad": bad, "of": of}, *kept]}

        if store.update(spark, _days_folder(path), day, change):
            done.append(day)
    return done


def _entries(spark: SparkSession, path: str, days: Iterable | None = None) -> DataFrame | None:
    """The last ``_days`` file of every log day, or of the given ones."""
    last = store.versions(spark, _days_folder(path))
    wanted = sorted(last) if days is None else sorted({_day(d) for d in days} & last.keys())
    if not wanted:
        return None
    return spark.read.schema(DAY_SCHEMA).json([store.version_path(_days_folder(path), day, last[day]) for day in wanted])


def read_bad_lines(spark: SparkSession, path: str, log_days: Iterable | None = None) -> DataFrame:
    """The stored bad lines of the runs in force: run, log_day, log_date, log_file,
    reason, line."""
    entries = _entries(spark, path, log_days)
    schema = "log_date date, log_file string, reason string, line string, run string, log_day string"
    folders = []
    if entries is not None:
        bad = entries.select("log_day", F.explode("runs.bad").alias("bad")).select("log_day", F.explode("bad").alias("run"))
        folders = sorted({f"{path.rstrip('/')}/bad_lines/run={r.run}/log_day={r.log_day}" for r in bad.collect()})  # one per day and run
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/bad_lines").parquet(*folders)


def write_bad_lines(bad: DataFrame, path: str, run: Run) -> None:
    """Store the bad lines (log_date, log_file, reason, line) of a run, before it
    is committed."""
    where = f"{path.rstrip('/')}/bad_lines/run={run.name}"
    bad.withColumn("log_day", F.col("log_date").cast("string")).write.partitionBy("log_day").parquet(where)
    run.bad_days |= {n.split("=", 1)[1] for n in store.names(bad.sparkSession, where) if n.startswith("log_day=")}


def read_facts(
    spark: SparkSession,
    path: str,
    days: Iterable | None = None,
    start=None,
    end=None,
    kinds: Iterable[str] | None = None,
    log_days: Iterable | None = None,
    fmt: str = "orc",
    runs: Iterable[str] | None = None,
) -> DataFrame:
    """Fact rows with ``dt`` in ``days`` or in ``[start, end]``, of ``kinds``,
    and ingested from the folders of ``log_days`` by ``runs``; each is optional.

    Only folders that can hold such rows are listed and read; the predicates
    stay on the partition columns."""
    root = path.rstrip("/")
    empty = spark.createDataFrame([], FACT_SCHEMA)
    entries = _entries(spark, root, log_days)
    if entries is None:
        return empty
    parts = entries.select("log_day", F.explode("runs").alias("r")).select("log_day", "r.run", F.explode("r.parts").alias("p"))
    parts = parts.select("run", "log_day", "p.kind", "p.dt")
    asked = F.lit(True)
    if runs is not None:
        asked &= F.col("run").isin(list(runs))
    if kinds is not None:
        asked &= F.col("kind").isin(list(kinds))
    if days is not None:
        asked &= F.col("dt").isin([_day(d) for d in days])
    if start is not None:
        asked &= F.col("dt") >= _day(start)
    if end is not None:
        asked &= F.col("dt") <= _day(end)
    folders = [
        f"{root}/run={r.run}/log_day={r.log_day}/kind={r.kind}/dt={NO_DAY if r.dt is None else r.dt}"
        for r in parts.where(asked).collect()  # one row per folder to read
    ]
    if not folders:
        return empty
    return spark.read.schema(FACT_SCHEMA).format(fmt).option("basePath", root).load(folders).where(asked)


def publish_table(spark: SparkSession, path: str, table: str, fmt: str = "orc") -> None:
    """The fact table under a name in the session's catalog, with exactly the
    folders in force as its partitions, so that SQL users need no path.  Call
    it after an ingest."""
    root = path.rstrip("/")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING {fmt} PARTITIONED BY (run, log_day, kind, dt) LOCATION '{root}'")
    now, entries = set(), _entries(spark, root)
    if entries is not None:
        parts = entries.select("log_day", F.explode("runs").alias("r")).select("log_day", "r.run", F.explode("r.parts").alias("p"))
        parts = parts.select("run", "log_day", "p.kind", F.coalesce("p.dt", F.lit(NO_DAY)).alias("dt"))
        now = {(r.run, r.log_day, r.kind, r.dt) for r in parts.collect()}  # one row per folder in force
    known = {tuple(x.split("=", 1)[1] for x in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def spec(part: tuple[str, ...]) -> str:
        return "PARTITION (" + ", ".join(f"{c}='{v}'" for c, v in zip(("run", *PARTITIONS), part, strict=True)) + ")"

    for kind, chosen in (("DROP IF EXISTS", sorted(known - now)), ("ADD IF NOT EXISTS", sorted(now - known))):
        for i in range(0, len(chosen), 500):
            separator = ", " if kind.startswith("DROP") else " "
            spark.sql(f"ALTER TABLE {table} {kind} {separator.join(map(spec, chosen[i : i + 500]))}")


def unreferenced_runs(spark: SparkSession, path: str) -> list[str]:
    """Run folders that no log day names any more (replaced, or of a failed
    ingest): safe to remove while no ingest and no older reader is running."""
    root = path.rstrip("/")
    present = {name for name in store.names(spark, root) if name.startswith("run=")}
    entries = _entries(spark, root)
    used = set() if entries is None else {f"run={r[0]}" for r in entries.select(F.explode("runs.run")).distinct().collect()}
    return sorted(f"{root}/{name}" for name in present - used)
