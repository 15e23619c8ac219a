"""Explicit schemas.  Raw logs are never read with schema inference: a day
without one event kind would otherwise fail analysis instead of giving 0 rows."""

from pyspark.sql import types as T

# The event kinds that can appear under `data` in a raw log line.
EVENT_KINDS = (
    "download_fin",
    "install_fin",
    "app_open",
    "game_open",
    "download_onclick",
    "appstore_onclick",
    "game_onclick",
)

EVENT = T.StructType(
    [
        T.StructField("time", T.StringType()),
        T.StructField("package_id", T.StringType()),
        T.StructField("title", T.StringType()),
    ]
)


def raw_log_schema(kinds=EVENT_KINDS, extra_fields=()) -> T.StructType:
    """Schema of one JSON log line; ``extra_fields`` are appended top-level fields."""
    data = T.StructType([T.StructField(k, T.ArrayType(EVENT)) for k in kinds])
    fields = [
        T.StructField("custom_uuid", T.StringType()),
        T.StructField("account", T.StringType()),
        T.StructField("rectime", T.LongType()),
        T.StructField("device_name", T.StringType()),
        T.StructField("vercode", T.StringType()),
        T.StructField("vername", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("data", data),
    ]
    return T.StructType(fields + list(extra_fields))


RAW_LOG = raw_log_schema()

CATALOG = T.StructType(
    [
        T.StructField("fsk_pid", T.StringType()),
        T.StructField("fsk_title", T.StringType()),
        T.StructField("fsk_cid", T.StringType()),
        T.StructField("fsk_catalog", T.StringType()),
    ]
)
