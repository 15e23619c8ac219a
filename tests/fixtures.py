"""Small reference-shaped frames holding the edge rows of FIXTURES.md §2."""

import datetime as dt

from pyspark.sql import types as T

from logcube.schemas import CATALOG, RAW_LOG

D0 = dt.date(2024, 1, 10)


def ms(day: dt.date, hour=12, minute=0) -> int:
    return int(dt.datetime(day.year, day.month, day.day, hour, minute, tzinfo=dt.timezone.utc).timestamp() * 1000)


def ev(time="t", package_id="p1", title="T1"):
    return (time, package_id, title)


def raw_line(uuid, rectime, site, **arrays):
    data = tuple(arrays.get(k) for k in [f.name for f in RAW_LOG["data"].dataType.fields])
    return (uuid, None, rectime, "dev", None, None, site, data)


def raw_frame(spark, lines):
    return spark.createDataFrame(lines, RAW_LOG)


FACT_SCHEMA = T.StructType(
    [
        T.StructField("custom_uuid", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("device_name", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("package_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("source", T.IntegerType()),
    ]
)


def fact(uuid, day, pkg="p1", title="T1", site="youku", kind="download_fin", device="dev"):
    return (uuid, day, device, site, pkg, title, kind, 1 if pkg is not None else 0)


def facts_frame(spark, rows):
    return spark.createDataFrame(rows, FACT_SCHEMA)


def catalog_frame(spark, rows=None):
    rows = rows or [
        ("p1", "Cat One", "c1", "games"),
        ("p2", "Cat Two", "c2", "tools"),
        ("p2", "Cat Two bis", "c2", "tools"),  # duplicate key
        (None, "No Id", "c0", "none"),  # NULL key
    ]
    return spark.createDataFrame(rows, CATALOG)
