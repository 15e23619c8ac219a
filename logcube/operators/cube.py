"""Counts, exact distinct users and events per user over grouping
sets, with ``date`` in every set so that all days are computed in one pass.

``id_1`` is ``grouping_id()`` over ``(date, *keys)``; ``date`` is always
grouped, so its (highest) bit is 0 and the ids equal those of a one-day
query grouped by ``keys`` alone.

Distinct users of a set follow from the distinct (set, user) rows of any finer
set, so the sets form a lattice (``plan_lattice``) and the events are reduced
once, to distinct (detail keys, user) rows with their number of events:

1. The detail rows are counted from those; a *top*, a set with no finer one but
   the detail, gets its distinct (top, user) rows from them.  Both shuffle on
   their full tuple, combined on the map side: a user or an app with a third of
   all events is a few rows per map task, dealt out by the other keys.
2. A top's rows move once more, by (date, user).  A user has at most one row per
   combination of the top's keys there (channels, categories), whatever the
   number of events or apps.  All coarser sets below the top are then distinct
   rows of that partition alone: no further shuffle of users, for any number of
   sets.  Only counts per group follow.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.functions.scalar import safe_ratio


def plan_lattice(sets: Sequence[Sequence[str]], keys: Sequence[str]) -> dict[tuple[str, ...], list[tuple[str, ...]]]:
    """Each top with itself (if asked for) and the coarser sets that follow from
    it, every set in the order of ``keys``.  The set of all keys, the detail, is
    no top; a set below several tops goes to the one with the fewest keys."""
    ordered = list(dict.fromkeys(tuple(k for k in keys if k in s) for s in sets))
    coarse = [s for s in ordered if len(s) < len(keys)]
    tops = [s for s in coarse if not any(set(s) < set(t) for t in coarse)]
    plan: dict[tuple[str, ...], list[tuple[str, ...]]] = {t: [] for t in tops}
    for s in coarse:
        finest = min((t for t in tops if set(s) <= set(t)), key=len)
        plan[finest].append(s)
    return plan


def grouping_number(grouped: Sequence[str], keys: Sequence[str]) -> int:
    """What ``grouping_id()`` over ``keys`` gives for a set: a bit per key that
    is not in it, the first key's the highest."""
    return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in grouped)


def rollup_counts(
    df: DataFrame,
    keys: Sequence[str],
    sets: Sequence[Sequence[str]],
    date_col: str = "date",
    uid: str = "custom_uuid",
    pre_aggregate: bool = False,
    weight: str | None = None,
    lattice: bool | None = None,
) -> DataFrame:
    """Output: ``date, *keys, id_1, playNum, users, avgPlayNum``.

    ``playNum`` counts non-NULL ids (A1), ``users`` counts them distinctly
    (A2), ``avgPlayNum = round(playNum / users, 2)``, NULL when users is 0 (A3).

    ``pre_aggregate=True`` first collapses rows to one per (date, keys, id)
    with their count, so the grouping-set expansion runs on that smaller
    frame; results are identical.  ``weight`` names a column with the number
    of events that a row stands for (rows summed before a join).

    ``lattice`` derives coarser sets from finer ones (above) instead of
    expanding every row by all sets; by default from three sets on, as with
    {detail, total} the expansion only doubles the rows.  Results are identical.
    """
    bad = [k for s in sets for k in s if k not in keys]
    if bad:
        raise ValueError(f"grouping set columns {bad} are not among keys {list(keys)}")
    lattice = len({frozenset(s) for s in sets}) > 2 if lattice is None else lattice
    if lattice:
        out = _lattice_counts(df, keys, sets, date_col, uid, weight)
        return out.withColumn("avgPlayNum", safe_ratio(F.col("playNum"), F.col("users"), 2))
    full_sets = [[date_col, *s] for s in sets]
    if weight is not None:
        base = df.select(date_col, *keys, uid, F.when(F.col(uid).isNotNull(), F.col(weight)).alias("_n"))
        play = F.coalesce(F.sum("_n"), F.lit(0))
    elif pre_aggregate:
        base = df.groupBy(date_col, *keys, uid).agg(F.count(uid).alias("_n"))
        play = F.coalesce(F.sum("_n"), F.lit(0))
    else:
        base = df.select(date_col, *keys, uid)
        play = F.count(uid)
    out = base.groupingSets(full_sets, date_col, *keys).agg(
        F.grouping_id().alias("id_1"),
        play.cast("bigint").alias("playNum"),
        F.count_distinct(uid).alias("users"),
    )
    return out.withColumn("avgPlayNum", safe_ratio(F.col("playNum"), F.col("users"), 2))


def _lattice_counts(df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], date_col: str, uid: str, weight: str | None) -> DataFrame:
    """``date, *keys, id_1, playNum, users`` by the lattice of the sets."""
    events = F.count(uid) if weight is None else F.coalesce(F.sum(F.when(F.col(uid).isNotNull(), F.col(weight))), F.lit(0))
    counts = [F.sum("_n").cast("bigint").alias("playNum"), F.count(uid).alias("users")]
    detail = df.groupBy(date_col, *keys, uid).agg(events.cast("bigint").alias("_n"))
    types = {f.name: f.dataType for f in detail.schema}
    number = {s: grouping_number(s, keys) for s in (tuple(k for k in keys if k in s) for s in sets)}
    out = []
    if tuple(keys) in number:
        found = detail.groupBy(date_col, *keys).agg(*counts)
        out.append(found.select(date_col, *keys, F.lit(0).cast("bigint").alias("id_1"), "playNum", "users"))
    for top, members in plan_lattice(sets, keys).items():
        finest = detail.groupBy(date_col, *top, uid).agg(F.sum("_n").alias("_n"))
        if members == [top]:
            found = finest.groupBy(date_col, *top).agg(*counts).withColumn("id_1", F.lit(number[top]).cast("bigint"))
        else:
            if top:  # without keys, a row per (date, user) is what it is already
                finest = finest.repartition(date_col, uid)
            rows = [F.struct(F.lit(number[s]).cast("bigint").alias("id_1"), *[(F.col(k) if k in s else F.lit(None).cast(types[k])).alias(k) for k in top]) for s in members]
            each = finest.select(date_col, uid, "_n", F.explode(F.array(*rows)).alias("_set")).select(date_col, uid, "_n", "_set.*")
            # Rows of a user lie in one partition: distinct there, then counted.
            each = each.groupBy(date_col, uid, "id_1", *top).agg(F.sum("_n").alias("_n"))
            found = each.groupBy(date_col, "id_1", *top).agg(*counts)
        missing = [F.lit(None).cast(types[k]).alias(k) for k in keys if k not in top]
        out.append(found.select("*", *missing).select(date_col, *keys, "id_1", "playNum", "users"))
    return reduce(DataFrame.unionAll, out)
