"""The install funnel.

A stage is a named set of event kinds.  Stage rows of every stage come from
one filtered scan of the facts (U3 without re-reading), are enriched once
(J4: one join after the union) and counted per (date, stage).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.functions.scalar import date_key

# The live funnel stages (stage name, event kinds), in order.
LIVE_STAGES = (
    ("download_onclick", ("download_onclick",)),
    ("download_fin", ("download_fin",)),
    ("install_fin", ("install_fin",)),
)
# The optional detail-page stage (two event kinds united).
DETAIL_STAGE = ("appstore_game_onclick", ("appstore_onclick", "game_onclick"))


def stage_rows(facts: DataFrame, stages: Sequence[tuple[str, Sequence[str]]] = LIVE_STAGES) -> DataFrame:
    """Fact rows of the stages' kinds, tagged with ``featureName``.

    A kind listed under two stages yields its rows once per stage.
    """
    by_kind: dict[str, list[str]] = {}
    for name, kinds in stages:
        for k in kinds:
            by_kind.setdefault(k, []).append(name)
    rows = facts.where(F.col("kind").isin(list(by_kind)))
    if all(len(v) == 1 for v in by_kind.values()):
        feature = None
        for k, (name,) in by_kind.items():
            feature = (F.when if feature is None else feature.when)(F.col("kind") == k, F.lit(name))
        return rows.withColumn("featureName", feature)
    names = None
    for k, v in by_kind.items():
        arr = F.array(*[F.lit(n) for n in v])
        names = (F.when if names is None else names.when)(F.col("kind") == k, arr)
    return rows.withColumn("featureName", F.explode(names))


def funnel_counts(rows: DataFrame, uid: str = "custom_uuid") -> DataFrame:
    """``date`` (int), ``featureName``, ``totalPlayCount``."""
    out = rows.groupBy("date", "featureName").agg(F.count(uid).alias("totalPlayCount"))
    return out.select(date_key(F.col("date")).alias("date"), "featureName", "totalPlayCount")


def funnel_macro(enriched: DataFrame, category: str = "fsk_catalog", uid: str = "custom_uuid") -> DataFrame:
    """(date, stage) x {(site, category), (site), (category), ()}."""
    keys = ["date", "featureName", "site", category]
    sets = [keys, keys[:3], keys[:2] + [category], keys[:2]]
    out = enriched.select(*keys, uid).groupingSets(sets, *keys).agg(
        F.grouping_id().alias("id_1"), F.count(uid).alias("totalPlayCount")
    )
    return out.select(
        date_key(F.col("date")).alias("date"),
        "featureName",
        F.col("site").alias("channelName"),
        F.col(category).alias("typeName"),
        "id_1",
        "totalPlayCount",
    )


def funnel_micro(enriched: DataFrame, uid: str = "custom_uuid") -> DataFrame:
    """Counts per (date, package, title, stage)."""
    out = enriched.groupBy("date", "package_id", "title", "featureName").agg(F.count(uid).alias("totalPlayCount"))
    return out.select(
        date_key(F.col("date")).alias("date"),
        F.col("package_id").alias("appId"),
        F.col("title").alias("appName"),
        "featureName",
        "totalPlayCount",
    )
