"""Bridge from the driver's test tables to the reference's data shape.

The reference reads app-store logs and a catalog that are not public.  The
test tables stand in for them: every row of ``events`` becomes one raw log
line (one event in the array of its kind) and ``part`` becomes the catalog.
Edge cases are planted on purpose: NULL user ids, NULL packages, packages
the catalog lacks, packages listed twice, unmapped and NULL site codes.
``__spark_entry__.oracle_sql`` repeats the same mapping in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.functions.scalar import epoch_ms_of
from logcube.operators.events import parse_events
from logcube.schemas import EVENT_KINDS
from logcube.sources.catalog import union_lists
from logcube.sources.spread import spread

# Driver event_type -> log event kind (anything else -> game_open).
KIND_OF_EVENT_TYPE = {
    "click": "download_onclick",
    "signup": "download_fin",
    "purchase": "install_fin",
    "view": "app_open",
}
OTHER_KIND = "game_open"
# Part types on the app list and on the game list.  ECONOMY is
# on both (duplicate catalog rows), PROMO on neither (packages missing).
APP_LIST_EXCLUDES = ("PROMO", "SMALL")
GAME_LIST_TYPES = ("ECONOMY", "SMALL")
# Packages are the props number k when k < 90, else NULL.
PACKAGE_LIMIT = 90
# One event in 50 (by event_id) has a NULL user id.
NULL_UUID_EVERY = 50
DEVICE_MODELS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat log rows: event_id, custom_uuid, rectime, kind, device_name,
    site (raw code), package_id, title, time."""
    # Like the raw-log reader: spread a source with fewer splits than cores
    # (the test files are single row groups); a no-op on large inputs.
    ev = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props"))
    k = F.regexp_extract(F.col("props"), "[0-9]+", 0).cast("int")
    kind = None
    for etype, name in KIND_OF_EVENT_TYPE.items():
        kind = (F.when if kind is None else kind.when)(F.col("event_type") == etype, F.lit(name))
    site = (
        F.when(k % 4 == 0, "ALI")
        .when(k % 4 == 1, "IQIYI")
        .when(k % 4 == 2, "BESTV")
        .when(k % 8 == 3, "OTHER")
    )
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % NULL_UUID_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("custom_uuid"),
        epoch_ms_of(F.col("ts")).alias("rectime"),
        kind.otherwise(F.lit(OTHER_KIND)).alias("kind"),
        F.concat(F.lit("dev_"), (F.col("user_id") % DEVICE_MODELS).cast("string")).alias("device_name"),
        site.alias("site"),
        F.when(k < PACKAGE_LIMIT, k.cast("string")).alias("package_id"),
        F.concat(F.lit("raw_"), k.cast("string")).alias("title"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("time"),
    )


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested raw log line per event (schema of ``schemas.RAW_LOG`` plus
    ``event_id``): the event sits in a one-element array under its kind,
    every other kind's array is NULL."""
    log = app_log(spark, sf_dir)
    element = F.array(F.struct("time", "package_id", "title"))
    data = F.struct(*[F.when(F.col("kind") == k, element).alias(k) for k in EVENT_KINDS])
    none = F.lit(None).cast("string")
    return log.select(
        "event_id",
        "custom_uuid",
        none.alias("account"),
        "rectime",
        "device_name",
        none.alias("vercode"),
        none.alias("vername"),
        "site",
        data.alias("data"),
    )


def facts(spark: SparkSession, sf_dir: str, kinds=EVENT_KINDS) -> DataFrame:
    """Parsed fact rows (P1-P7, UTC days) of ``kinds``, with ``event_id``."""
    return parse_events(raw_logs(spark, sf_dir), kinds, tz="UTC", passthrough=["event_id"])


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog: app list UNION ALL game list, both drawn from ``part``."""
    part = table(spark, sf_dir, "part")
    cols = [
        F.col("p_partkey").cast("string").alias("fsk_pid"),
        F.col("p_name").alias("fsk_title"),
        F.col("p_brand").alias("fsk_cid"),
        F.col("p_type").alias("fsk_catalog"),
    ]
    apps = part.where(~F.col("p_type").isin(list(APP_LIST_EXCLUDES))).select(*cols)
    games = part.where(F.col("p_type").isin(list(GAME_LIST_TYPES))).select(*cols)
    return union_lists([apps, games])
