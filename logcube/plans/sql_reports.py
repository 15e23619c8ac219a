"""K3 and the SQL-text form of A1-A8: the same cube as ``operators.cube``,
written as Spark SQL.

The reference registered every frame under one shared view name
(``v_df``), so two reports could not be built at once.  Here the frame is
bound to the statement itself (``spark.sql(text, rich=df)``): no global
name, safe to use concurrently, and Catalyst plans it exactly like the
DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logcube.operators.growth import REPORT_MEASURES
from logcube.plans.specs import GrowthSpec


def cube_sql_text(spec: GrowthSpec) -> str:
    keys = ", ".join(spec.keys)
    sets = ", ".join("(" + ", ".join(["date", *s]) + ")" for s in spec.grouping_sets)
    return (
        f"SELECT date, {keys}, grouping_id() AS id_1, "
        "count(custom_uuid) AS playNum, count(DISTINCT custom_uuid) AS users, "
        "round(try_divide(count(custom_uuid), count(DISTINCT custom_uuid)), 2) AS avgPlayNum "
        f"FROM {{rich}} GROUP BY GROUPING SETS ({sets})"
    )


def cube_sql(spark: SparkSession, enriched: DataFrame, spec: GrowthSpec) -> DataFrame:
    """A1-A8 for ``spec`` over enriched fact rows, through Spark SQL."""
    return spark.sql(cube_sql_text(spec), rich=enriched)


def growth_sql_text(spec: GrowthSpec, fmt: str = "percent") -> str:
    """R1/R2 as one Spark SQL statement: the cube, then growth by RANGE
    windows over the day number (1 and 7 days back) per key combination."""
    keys = ", ".join(spec.keys)
    window = f"PARTITION BY {keys}, id_1 ORDER BY unix_date(date)"

    def lag(m: str, n: int) -> str:
        return f"max({m}) OVER ({window} RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"

    def change(m: str, n: int) -> str:
        if fmt == "ratio":
            return f"round(try_divide({m}, {lag(m, n)}) - 1, 4)"
        if fmt != "percent":
            raise ValueError(f"fmt must be 'percent' or 'ratio', not {fmt!r}")
        return f"concat(cast(round((try_divide({m}, {lag(m, n)}) - 1) * 100, 2) AS STRING), '%')"

    names = ", ".join(f"{k} AS {n}" for k, n in zip(spec.keys, spec.key_names))
    cols = [
        "CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INT) AS date",
        names,
        "id_1",
    ]
    for m, total, day_name, week_name in REPORT_MEASURES:
        cols += [f"{m} AS {total}", f"{change(m, 1)} AS {day_name}", f"{change(m, 7)} AS {week_name}"]
    cube = cube_sql_text(spec)
    return "SELECT " + ", ".join(cols) + f" FROM ({cube}) AS cube"


def growth_sql(spark: SparkSession, enriched: DataFrame, spec: GrowthSpec, fmt: str = "percent") -> DataFrame:
    """R1/R2 for ``spec`` over enriched fact rows (all days), through Spark SQL."""
    return spark.sql(growth_sql_text(spec, fmt), rich=enriched)
