"""Enrich fact rows with the application catalog.

LEFT OUTER join on ``package_id <=> fsk_pid``: a fact row is kept when the
catalog lacks its package, NULL matches NULL, and a package listed twice
multiplies its rows (counts grow, distinct users do not).  ``dedupe=True``
keeps one deterministic catalog row per package instead.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.operators.broadcast import DEFAULT_MAX_ROWS, fits

TITLE_RULES = ("log", "catalog", "conditional")
#: A heavy package of a shuffle join is spread over so many reducers at most.
DEFAULT_SALT_BUCKETS = 1024
#: Heavy packages that are asked for, and items that their sketch tracks.
HEAVY_ITEMS, TRACKED_ITEMS = 128, 10_000
CATEGORIES = ("fsk_cid", "fsk_catalog")


def prepare_catalog(catalog: DataFrame, category: str, dedupe: bool = False) -> DataFrame:
    """Project the catalog to the join key, title and chosen category."""
    if category not in CATEGORIES:
        raise ValueError(f"category must be one of {CATEGORIES}, not {category!r}")
    cat = catalog.select("fsk_pid", "fsk_title", category)
    if dedupe:
        # One row per package, chosen deterministically (smallest title, category).
        best = F.min(F.struct(F.col("fsk_title"), F.col(category))).alias("_best")
        cat = cat.groupBy("fsk_pid").agg(best).select("fsk_pid", "_best.fsk_title", f"_best.{category}")
    return cat


def title_column(rule: str):
    """The report title under a title rule."""
    if rule == "log":
        return F.col("title")
    if rule == "catalog":
        return F.col("fsk_title")
    if rule == "conditional":
        return F.when(F.col("package_id").isNotNull(), F.col("fsk_title")).otherwise(F.col("title"))
    raise ValueError(f"title rule must be one of {TITLE_RULES}, not {rule!r}")


def enrich(
    facts: DataFrame,
    catalog: DataFrame,
    title_rule: str = "log",
    category: str = "fsk_cid",
    dedupe: bool = False,
    broadcast_max_rows: int | None = DEFAULT_MAX_ROWS,
    broadcast: bool | None = None,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """Fact rows LEFT JOIN catalog; ``title`` is replaced per ``title_rule``
    and the chosen category column is appended.

    ``broadcast=None`` measures the projected catalog against
    ``broadcast_max_rows`` (see ``operators.broadcast``); ``True`` / ``False``
    is a decision the caller already proved (e.g. measured once for many
    reports).  Without a broadcast it is a shuffle join in which heavy packages
    are spread over up to ``salt_buckets`` reducers (see ``_salted_join``)."""
    cat = prepare_catalog(catalog, category, dedupe)
    if broadcast is None:
        broadcast = fits(cat, broadcast_max_rows) if broadcast_max_rows else False
    keep = [F.col(c) for c in facts.columns if c != "title"]
    if broadcast:
        cat = F.broadcast(cat)
        joined = facts.join(cat, facts["package_id"].eqNullSafe(cat["fsk_pid"]), "left")
    else:
        joined = _salted_join(facts, cat, salt_buckets)
    return joined.select(*keep, title_column(title_rule).alias("title"), F.col(category))


def heavy_hitters(rows: DataFrame, key: str, least_share: float) -> dict:
    """Values of ``key`` (NULL as None) with more than about ``least_share`` of
    the rows, and their shares.

    One pass with a frequent-items sketch of bounded size, which tasks build and
    the aggregation merges; the driver gets ``HEAVY_ITEMS`` values at most.  A value
    whose share is far above 1 / ``TRACKED_ITEMS`` is never missed."""
    found = rows.agg(F.expr(f"approx_top_k(`{key}`, {HEAVY_ITEMS}, {TRACKED_ITEMS})").alias("top"), F.count("*").alias("n")).first()
    return {r["item"]: r["count"] / found["n"] for r in found["top"] or [] if r["count"] > least_share * found["n"]}


def salt_ways(shares: dict, partitions: int, most: int) -> dict:
    """Reducers for each heavy value: so many that a part of it is about half of
    what a reducer has on average."""
    return {value: max(2, min(most, math.ceil(2 * share * partitions))) for value, share in shares.items()}


def _salted_join(facts: DataFrame, cat: DataFrame, buckets: int) -> DataFrame:
    """Shuffle LEFT JOIN whose heavy packages are split ``buckets`` ways at most.

    The heavy packages are found first (``heavy_hitters``: more than half of an
    average reducer's rows).  A fact row of one takes a salt from a hash of its
    columns (any salt is correct: the package's catalog rows are present under
    every one), and only the catalog rows of heavy packages are replicated, once
    per salt; all others are joined as they are.  So a package with a third of all
    fact rows, or the NULL package, is spread over as many reducers as it needs,
    and a large catalog moves once.  The salt is deterministic, so a map task
    recomputed after an executor loss routes every row exactly as before; runs of
    identical rows share a salt and are left to AQE's skew-join split.
    """
    plain = facts["package_id"].eqNullSafe(cat["fsk_pid"])
    if buckets <= 1:
        return facts.join(cat, plain, "left")
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ways = salt_ways(heavy_hitters(facts, "package_id", 1 / (2 * partitions)), partitions, buckets)
    if not ways:
        return facts.join(cat, plain, "left")
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    f = facts.withColumn("_salt", F.pmod(row_hash, _ways_of("package_id", ways)))
    c = cat.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), _ways_of("fsk_pid", ways) - 1)))
    cond = f["package_id"].eqNullSafe(c["fsk_pid"]) & (f["_salt"] == c["_salt"])
    return f.join(c, cond, "left").drop(f["_salt"]).drop(c["_salt"])


def _ways_of(key: str, ways: dict):
    """Ways of a row by its key: one unless it is heavy."""
    known = {k: w for k, w in ways.items() if k is not None}
    entries = [x for k, w in known.items() for x in (F.lit(k), F.lit(w).cast("bigint"))]
    found = F.try_element_at(F.create_map(*entries), F.col(key)) if entries else F.lit(None).cast("bigint")
    one = F.when(F.col(key).isNull(), F.lit(ways.get(None, 1)).cast("bigint"))
    return F.coalesce(one, found, F.lit(1).cast("bigint"))
