"""Spread a source that yields fewer splits than the cluster can run.

Unsplittable inputs (a few large gzip files, a single-row-group parquet file)
give one task per file, and everything up to the first shuffle (parse,
explode, join, grouping-set expansion, partial aggregation) then runs on
those few cores.  ``spread`` adds a round-robin repartition only in that
case; a source with at least ``spark.default.parallelism`` splits (any
large input) is returned unchanged, so no shuffle is added at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()  # planning only, no job
    except Exception:  # no RDD view (e.g. Spark Connect): leave the plan as is
        return df
    return df.repartition(target) if 1 < target and current < target else df
