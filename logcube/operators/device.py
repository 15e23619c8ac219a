"""Downloads per device model, plain and rolled up by
channel and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.functions.scalar import date_key


def device_counts(facts: DataFrame, uid: str = "custom_uuid") -> DataFrame:
    """``date`` (yyyymmdd int), ``device_name``, ``totalPlayCount``."""
    out = facts.groupBy("date", "device_name").agg(F.count(uid).alias("totalPlayCount"))
    return out.select(date_key(F.col("date")).alias("date"), "device_name", "totalPlayCount")


def device_rollup(enriched: DataFrame, category: str = "fsk_catalog", uid: str = "custom_uuid") -> DataFrame:
    """A10: (date, device) x {(site, category), (site), (category), ()};
    ``id_1`` = 0, 1, 2, 3."""
    keys = ["date", "device_name", "site", category]
    sets = [keys, keys[:3], keys[:2] + [category], keys[:2]]
    out = enriched.select(*keys, uid).groupingSets(sets, *keys).agg(
        F.grouping_id().alias("id_1"), F.count(uid).alias("totalPlayCount")
    )
    return out.select(
        date_key(F.col("date")).alias("date"),
        "device_name",
        F.col("site").alias("channelName"),
        F.col(category).alias("typeName"),
        "id_1",
        "totalPlayCount",
    )
