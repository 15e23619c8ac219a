"""The nightly job of the reference, for one run day or many.

``ingest_days``: raw logs of log days -> fact table (one scan of the logs for
every event kind; the days then hold these logs' rows and no others).
``report_days``: every report of the three families for the report day(s),
handed to a sink callback.  A run on day r reports day r - 1; ``run_range`` does
a backfill as one job per stage instead of one job per day.
"""

from __future__ import annotations

import datetime as _dt
from collections import Counter
from collections.abc import Callable, Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.operators.broadcast import DEFAULT_MAX_ROWS, fits
from logcube.operators.enrich import DEFAULT_SALT_BUCKETS, enrich
from logcube.operators.funnel import LIVE_STAGES, stage_rows
from logcube.plans import reports
from logcube.plans.backfill import run_days_to_report_days
from logcube.plans.checkpoints import materialize
from logcube.plans.ingest import write_lines
from logcube.plans.specs import DOWNLOAD_V2, INSTALL_V2, OPEN_V2, GrowthSpec
from logcube.schemas import EVENT_KINDS
from logcube.sources.facts import Overtaken, day_runs, read_facts, replace_days
from logcube.sources.raw_logs import DEFAULT_LAYOUT, read_raw_logs, require_input

Sink = Callable[[str, DataFrame, list], None]

# Report names of the reference's targets.  The present versions
# have the live names; "_" behind a name marks the twin of a trial run.
GROWTH_TARGETS = {
    "download_v1": "app_download_report_v1",
    "download_v2": "app_download_report",
    "install_v1": "app_install_report_v1",
    "install_v2": "app_install_report",
    "open_v1": "app_open_report_v1",
    "open_v2": "app_open_report",
    "open_hybrid": "app_open_report_hybrid",
}
TRIAL = "_"
#: An ingest that a stream has overtaken starts again, so many times.
ATTEMPTS = 5


def growth_targets(specs: Sequence[GrowthSpec], trial: bool = False) -> dict[str, str]:
    """Target of each spec; ValueError if two specs would write one."""
    targets = {s.name: GROWTH_TARGETS[s.name] + (TRIAL if trial else "") for s in specs}
    twice = [t for t, n in Counter(GROWTH_TARGETS[s.name] for s in specs).items() if n > 1]
    if twice:
        raise ValueError(f"several specs write {twice}; give each spec once")
    return targets


def ingest_day(spark: SparkSession, log_root: str, fact_root: str, day, tz: str, **kw) -> dict[str, int]:
    """Parse one log directory day into the fact table."""
    return ingest_days(spark, log_root, fact_root, [day], tz, **kw)


def ingest_days(
    spark: SparkSession,
    log_root: str,
    fact_root: str,
    days: Iterable,
    tz: str,
    kinds: Sequence[str] = EVENT_KINDS,
    fmt: str = "orc",
    layout: str = DEFAULT_LAYOUT,
) -> dict[str, int]:
    """S1, S2, P1-P7, K1 for a range of log days in one job.

    The days hold the rows of their present logs afterwards, and of no earlier
    ingest; runs that a stream adds meanwhile stay (see ``sources.facts``).
    Returns the number of lines, of ``corrupt`` and of ``undated`` ones (counted
    while writing); if there are such, they are stored with the run
    (``facts.read_bad_lines``: log_date, log_file, reason, line)."""
    days = [str(d) for d in days]
    total = {"lines": 0, "corrupt": 0, "undated": 0}
    for _ in range(ATTEMPTS):
        if not days:
            return total
        # First what is in force, then the logs: a run that comes in between is not lost.
        found = {day: [r["run"] for r in runs] for day, runs in day_runs(spark, fact_root, days).items()}
        files = require_input(spark, log_root, days, layout)
        raw = read_raw_logs(spark, log_root, days, layout=layout, check_input=False)
        run, counts = write_lines(raw, fact_root, files, kinds, tz, fmt)
        total = {k: total[k] + counts[k] for k in total}
        days = replace_days(spark, fact_root, run, files, found)  # those overtaken, once more
    raise Overtaken(f"{days}: other writers were first {ATTEMPTS} times")


def stage_facts(spark: SparkSession, fact_root: str, days: Iterable, event_days: Iterable | None = None, fmt: str = "orc") -> DataFrame:
    """Rows of the live funnel stages as the reference counts them: clicks on
    the day of their log folder in ``days`` (every click of that folder, however
    old), the others on their own day in ``event_days`` (default: ``days``)."""
    days = list(days)
    own = read_facts(spark, fact_root, days=event_days or days, kinds=["download_fin", "install_fin"], fmt=fmt)
    clicks = read_facts(spark, fact_root, kinds=["download_onclick"], log_days=days, fmt=fmt)
    return own.unionByName(clicks.withColumn("date", F.col("log_date")).withColumn("dt", F.col("log_day")))


def report_days(
    spark: SparkSession,
    fact_root: str,
    catalog: DataFrame,
    days: Iterable,
    sink: Sink,
    specs: Sequence[GrowthSpec] = (DOWNLOAD_V2, INSTALL_V2, OPEN_V2),
    fmt: str = "orc",
    dedupe: bool = False,
    trial: bool = False,
    pre_aggregate: bool = False,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> None:
    """R1, R3, R4, R5 for ``days``; each report goes to ``sink(name, df, days)``,
    which replaces those days.  ``dedupe`` keeps one catalog row per package
    (H7; default: duplicates multiply counts, as in the reference); ``trial``
    writes growth to the reports' twins; ``pre_aggregate`` sums events per
    (day, app, user) before the catalog join; ``salt_buckets`` spreads a catalog
    too large to broadcast.

    The catalog is materialized once (one database read, one consistent
    snapshot), and so are the download, install and click rows joined to it:
    growth, device rollup, macro and micro funnel read that one frame.
    """
    days = sorted({reports.as_date(d) for d in days})
    targets = growth_targets(specs, trial)
    lookback = sorted({d - _dt.timedelta(n) for d in days for n in (0, 1, 7)})
    facts = read_facts(spark, fact_root, days=lookback, fmt=fmt)
    staged = stage_facts(spark, fact_root, days, lookback, fmt)
    cat = materialize(catalog.select("fsk_pid", "fsk_title", "fsk_cid", "fsk_catalog"))
    small = fits(cat, DEFAULT_MAX_ROWS)  # measured once for every report below
    how = {"broadcast": small, "dedupe": dedupe, "salt_buckets": salt_buckets}
    rich = enrich(staged, cat, "catalog", "fsk_catalog", **how).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for spec in specs:
            shared = (spec.title_rule, spec.category) == ("catalog", "fsk_catalog") and not pre_aggregate
            more = {"enriched": rich} if shared else {"pre_aggregate": pre_aggregate, **how}
            sink(targets[spec.name], reports.growth(facts, cat, spec, days=days, **more), days)
        sink("device_app_download_report", reports.devices(facts, days=days), days)
        sink("device_app_download_report_", reports.devices_rollup(facts, cat, days=days, enriched=rich), days)
        stages = stage_rows(reports.restrict_days(rich, days), LIVE_STAGES)
        sink("funnel_app_install_report", reports.funnel(staged, days=days), days)
        macro, micro = reports.funnel_macro_micro(stages)
        sink("funnel_app_install_report_macro", macro, days)
        sink("funnel_app_install_report_micro", micro, days)
    finally:
        rich.unpersist()
        cat.unpersist()


def run_range(
    spark: SparkSession,
    log_root: str,
    fact_root: str,
    catalog: DataFrame,
    first_run_day,
    last_run_day,
    tz: str,
    sink: Sink,
    ingest: bool = True,
    layout: str = DEFAULT_LAYOUT,
    **kw,
) -> None:
    """Run days ``[first, last]`` -> report days ``[first-1, last-1]``."""
    first, last = run_days_to_report_days(first_run_day, last_run_day)
    days = [first + _dt.timedelta(i) for i in range((last - first).days + 1)]
    if not days:
        raise ValueError(f"empty run-day range: {first_run_day} .. {last_run_day}")
    if ingest:
        ingest_days(spark, log_root, fact_root, days, tz, fmt=kw.get("fmt", "orc"), layout=layout)
    report_days(spark, fact_root, catalog, days, sink, **kw)
