"""Report plans over fact rows (any number of days, one pass).

``facts`` is any frame with the fact columns (``sources.facts.read_facts``,
``operators.events.parse_events`` or the test bridge).  Day selection:

* ``days``: report exactly these days; the scan is limited to them and to
  the days 1 and 7 earlier that their growth needs.
* ``start``/``end``: report a range; the scan starts 7 days before ``start``.
* neither: report every day present.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.functions.scalar import date_key
from logcube.operators.broadcast import DEFAULT_MAX_ROWS
from logcube.operators.cube import rollup_counts
from logcube.operators.device import device_counts, device_rollup
from logcube.operators.enrich import DEFAULT_SALT_BUCKETS, enrich
from logcube.operators.funnel import LIVE_STAGES, funnel_counts, funnel_macro, funnel_micro, stage_rows
from logcube.operators.growth import LAGS, growth_report
from logcube.plans.specs import GrowthSpec


def as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def _day_filter(col, days, start, end):
    cond = F.lit(True)
    if days is not None:
        cond = cond & col.isin([d.isoformat() for d in days])
    if start is not None:
        cond = cond & (col >= start.isoformat())
    if end is not None:
        cond = cond & (col <= end.isoformat())
    return cond


def restrict_days(
    facts: DataFrame,
    days: Iterable | None = None,
    start=None,
    end=None,
    lookback: Sequence[int] = (),
) -> DataFrame:
    """Keep the fact rows of the requested days and of ``lookback`` days
    before them.  Filters ``dt`` when present (partition pruning), else
    ``date``."""
    if days is None and start is None and end is None:
        return facts
    back = (0, *lookback)
    need_days = None if days is None else sorted({as_date(d) - _dt.timedelta(n) for d in days for n in back})
    lo = None if start is None else as_date(start) - _dt.timedelta(max(back))
    hi = None if end is None else as_date(end)
    col = F.col("dt") if "dt" in facts.columns else F.col("date").cast("string")
    return facts.where(_day_filter(col, need_days, lo, hi))


def _keep_report_days(df: DataFrame, days, start, end) -> DataFrame:
    if days is None and start is None and end is None:
        return df.drop("_day")
    ds = None if days is None else [as_date(d) for d in days]
    lo = None if start is None else as_date(start)
    hi = None if end is None else as_date(end)
    return df.where(_day_filter(F.col("_day").cast("string"), ds, lo, hi)).drop("_day")


def enriched_for(
    facts: DataFrame,
    catalog: DataFrame,
    spec: GrowthSpec,
    broadcast_max_rows: int | None = DEFAULT_MAX_ROWS,
    dedupe: bool = False,
    broadcast: bool | None = None,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
    pre_aggregate: bool = False,
) -> DataFrame:
    """The spec's rows joined to the catalog.  ``pre_aggregate`` sums them per
    (day, app, title, source, site, user) before the join: one row with its
    number of events, ``events``."""
    rows = facts.where(F.col("kind").isin(list(spec.kinds)))
    if pre_aggregate:
        rows = rows.groupBy("date", "package_id", "title", "source", "site", "custom_uuid").agg(F.count("*").alias("events"))
    return enrich(
        rows, catalog, spec.title_rule, spec.category, dedupe=dedupe,
        broadcast_max_rows=broadcast_max_rows, broadcast=broadcast, salt_buckets=salt_buckets,
    )


def cube(
    facts: DataFrame,
    catalog: DataFrame,
    spec: GrowthSpec,
    days=None,
    start=None,
    end=None,
    pre_aggregate: bool = False,
    **how,
) -> DataFrame:
    """A1-A8 for a spec: ``date`` (int), keys, ``id_1``, ``playNum``,
    ``users``, ``avgPlayNum``.  ``how`` is that of ``enriched_for``."""
    scoped = restrict_days(facts, days, start, end)
    rich = enriched_for(scoped, catalog, spec, pre_aggregate=pre_aggregate, **how)
    out = rollup_counts(rich, spec.keys, spec.grouping_sets, weight="events" if pre_aggregate else None)
    return out.select(date_key(F.col("date")).alias("date"), *spec.keys, "id_1", "playNum", "users", "avgPlayNum")


def growth(
    facts: DataFrame,
    catalog: DataFrame,
    spec: GrowthSpec,
    days=None,
    start=None,
    end=None,
    fmt: str = "percent",
    pre_aggregate: bool = False,
    enriched: DataFrame | None = None,
    **how,
) -> DataFrame:
    """R1 (``fmt="percent"``) / R2 (``fmt="ratio"``) for a spec.  ``enriched``
    holds rows that are joined by the spec's rules already, of any kinds and
    days; ``how`` is that of ``enriched_for``."""
    if enriched is None:
        scoped = restrict_days(facts, days, start, end, lookback=LAGS)
        rich = enriched_for(scoped, catalog, spec, pre_aggregate=pre_aggregate, **how)
    else:
        rich = restrict_days(enriched, days, start, end, lookback=LAGS).where(F.col("kind").isin(list(spec.kinds)))
    weight = "events" if pre_aggregate and enriched is None else None
    cubed = rollup_counts(rich, spec.keys, spec.grouping_sets, weight=weight)
    report = growth_report(cubed, spec.keys, spec.key_names, fmt=fmt)
    return _keep_report_days(report, days, start, end)


def devices(facts: DataFrame, days=None, start=None, end=None) -> DataFrame:
    """R3 plain: downloads per device model and day."""
    rows = restrict_days(facts, days, start, end).where(F.col("kind") == "download_fin")
    return device_counts(rows)


def devices_rollup(
    facts: DataFrame,
    catalog: DataFrame,
    days=None,
    start=None,
    end=None,
    category: str = "fsk_catalog",
    broadcast_max_rows: int | None = DEFAULT_MAX_ROWS,
    broadcast: bool | None = None,
    dedupe: bool = False,
    enriched: DataFrame | None = None,
) -> DataFrame:
    """R3 rolled up: on the v2-enriched download rows (``enriched``, if they
    are joined already)."""
    if enriched is not None:
        return device_rollup(restrict_days(enriched, days, start, end).where(F.col("kind") == "download_fin"), category)
    rows = restrict_days(facts, days, start, end).where(F.col("kind") == "download_fin")
    rich = enrich(
        rows, catalog, "catalog", category, dedupe=dedupe, broadcast_max_rows=broadcast_max_rows, broadcast=broadcast
    )
    return device_rollup(rich, category)


def funnel(facts: DataFrame, stages=LIVE_STAGES, days=None, start=None, end=None) -> DataFrame:
    """R4 (and R6 with the detail stage added): counts per day and stage."""
    return funnel_counts(stage_rows(restrict_days(facts, days, start, end), stages))


def funnel_enriched(
    facts: DataFrame,
    catalog: DataFrame,
    stages=LIVE_STAGES,
    days=None,
    start=None,
    end=None,
    category: str = "fsk_catalog",
    broadcast_max_rows: int | None = DEFAULT_MAX_ROWS,
    broadcast: bool | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """U3 + J4: stage rows of all stages, joined to the catalog once."""
    rows = stage_rows(restrict_days(facts, days, start, end), stages)
    return enrich(
        rows, catalog, "catalog", category, dedupe=dedupe, broadcast_max_rows=broadcast_max_rows, broadcast=broadcast
    )


def funnel_macro_micro(enriched: DataFrame, category: str = "fsk_catalog") -> tuple[DataFrame, DataFrame]:
    """The macro and micro funnel from one enriched stage frame.  Both
    read ``enriched``; persist or checkpoint it when writing both."""
    return funnel_macro(enriched, category), funnel_micro(enriched)
