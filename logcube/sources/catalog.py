"""S3, U4: the application catalog (app list UNION ALL game list).

Connection options always come from the caller; nothing is hard-wired.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from logcube.schemas import CATALOG

CATALOG_COLUMNS = tuple(f.name for f in CATALOG.fields)


def read_catalog_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    options: Mapping[str, str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """S3: run ``query`` in the database (e.g. the UNION ALL of both lists)
    and return its rows.  One partition by default, as the catalog is a small
    dimension; ``partition`` (numeric column, lower and upper bound, number)
    reads a large one by as many tasks."""
    reader = spark.read.format("jdbc").option("url", url).options(**jdbc_source(query, partition))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def jdbc_source(query: str, partition: tuple[str, int, int, int] | None = None) -> dict[str, str]:
    """Reader options of a sub-query; a partitioned read takes it as a table,
    as Spark does not combine ``query`` with ``partitionColumn``."""
    if partition is None:
        return {"query": query}
    column, lower, upper, number = partition
    return {
        "dbtable": f"({query}) catalog",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(number),
    }


def union_lists(lists: Sequence[DataFrame], columns: Sequence[str] = CATALOG_COLUMNS) -> DataFrame:
    """U4 on the Spark side: UNION ALL by name, duplicates kept."""
    if not lists:
        raise ValueError("need at least one list")
    out = lists[0].select(*columns)
    for other in lists[1:]:
        out = out.unionByName(other.select(*columns))
    return out
