"""Day-over-day and week-over-week growth of a cube.

Instead of joining the cube of day d to the cubes of d-1 and d-7, each cube
row looks back along its own key combination with a RANGE frame over the
day number: one shuffle on (keys, id_1), one sort, one window pass, for any
number of days.  Window partitions hold at most one row per day, so a hot key
cannot grow a partition.  NULL keys are grouped like any value (same as
``<=>``) and ``id_1`` keeps a rolled-up NULL apart from a real NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logcube.functions.scalar import date_key, pct_change_text, ratio_change

MEASURES = ("playNum", "users", "avgPlayNum")
LAGS = (1, 7)

# Report column names of the measures and their comparisons.
REPORT_MEASURES = (
    ("playNum", "totalPlayCount", "playCountCompareDay", "playCountCompareWeek"),
    ("users", "totalUserCount", "userCountCompareDay", "userCountCompareWeek"),
    ("avgPlayNum", "averagePlayCount", "avgPlayCountCompareDay", "avgPlayCountCompareWeek"),
)


def lag_name(measure: str, days: int) -> str:
    return f"{measure}_prev{days}"


def with_lags(
    cube: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
    lags: Sequence[int] = LAGS,
    date_col: str = "date",
) -> DataFrame:
    """Append ``<measure>_prev<n>``: the measure of the same key combination
    and ``id_1`` exactly n days earlier, NULL if that row does not exist."""
    spec = Window.partitionBy(*keys, "id_1").orderBy(F.unix_date(F.col(date_col)))
    cols = [
        F.max(F.col(m)).over(spec.rangeBetween(-n, -n)).alias(lag_name(m, n))
        for m in measures
        for n in lags
    ]
    return cube.select("*", *cols)


def growth_columns(fmt: str = "percent") -> list[Column]:
    """The 9 measure columns of a report from a frame made by ``with_lags``."""
    if fmt == "percent":
        change = pct_change_text
    elif fmt == "ratio":
        change = ratio_change
    else:
        raise ValueError(f"fmt must be 'percent' or 'ratio', not {fmt!r}")
    cols: list[Column] = []
    for measure, total, day_name, week_name in REPORT_MEASURES:
        cur = F.col(measure)
        cols += [
            cur.alias(total),
            change(cur, F.col(lag_name(measure, 1))).alias(day_name),
            change(cur, F.col(lag_name(measure, 7))).alias(week_name),
        ]
    return cols


def growth_report(
    cube: DataFrame,
    keys: Sequence[str],
    key_names: Sequence[str],
    fmt: str = "percent",
    date_col: str = "date",
) -> DataFrame:
    """``date`` (yyyymmdd int), renamed keys, ``id_1``, measures and
    their growth.  ``fmt="percent"`` gives text like '25.0%'; ``"ratio"``
    gives round(cur/prev - 1, 4).  Growth of the average is taken from the
    already rounded averages."""
    lagged = with_lags(cube, keys, date_col=date_col)
    renamed = [F.col(k).alias(n) for k, n in zip(keys, key_names)]
    return lagged.select(
        date_key(F.col(date_col)).alias("date"),
        *renamed,
        F.col("id_1"),
        *growth_columns(fmt),
        F.col(date_col).alias("_day"),
    )
