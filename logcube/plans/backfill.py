"""Backfill of any report over a date range as one set-based job.

The reference looped over days, one full set of jobs per day.  Here the
range is a key: facts from ``start - 7`` to ``end`` are scanned once, every
day's cube is built in the same aggregation, growth reads earlier days
through the window, and the lead-in days are dropped at the end.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from logcube.plans import reports
from logcube.plans.specs import GrowthSpec


def run_days_to_report_days(first_run_day, last_run_day) -> tuple[_dt.date, _dt.date]:
    """A run on day r reports day r - 1 (the reference's begin/end are run days)."""
    one = _dt.timedelta(days=1)
    return reports.as_date(first_run_day) - one, reports.as_date(last_run_day) - one


def backfill_growth(
    facts: DataFrame,
    catalog: DataFrame,
    spec: GrowthSpec,
    start=None,
    end=None,
    fmt: str = "percent",
    **kw,
) -> DataFrame:
    """Growth report of ``spec`` for every report day in ``[start, end]``
    (open ends: every day present)."""
    return reports.growth(facts, catalog, spec, start=start, end=end, fmt=fmt, **kw)
