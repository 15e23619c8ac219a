"""R7 without recomputing everything: rebuild the report days that depend on log
days which have changed.

For every log day, ``<reports>/_built`` notes the runs with which reports were last
built from it, and the (kind, event day) folders of each.  A run that is not among
them, or no longer in force, has changed its folders; a compacted run stands for
the runs that it replaced, so compaction changes nothing.  From a changed folder of
event day t follow the report days t, t + 1 and t + 7 of growth (each is compared
with the day and the week before), t of the device report, and for clicks, which
count on their log folder's day, that day of the funnels.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from logcube.operators.broadcast import DEFAULT_MAX_ROWS, fits
from logcube.operators.funnel import LIVE_STAGES
from logcube.operators.growth import LAGS
from logcube.plans import daily, reports
from logcube.plans.checkpoints import materialize
from logcube.plans.specs import DOWNLOAD_V2, INSTALL_V2, OPEN_V2, GrowthSpec
from logcube.sources import facts as fact_table
from logcube.sources import sinks, store

DEVICES = "device_app_download_report"
FUNNEL = "funnel_app_install_report"
#: Clicks count on their log folder's day, the other stages on the event's day.
CLICKS = "download_onclick"
STAGE_KINDS = frozenset(k for _, kinds in LIVE_STAGES for k in kinds)


def _standing(runs: list[dict]) -> dict[str, list]:
    """{run: [kind, dt] of its folders}; a compacted run under the names of all that it replaced."""
    return {"+".join(sorted(r.get("of") or [r["run"]])): [[p["kind"], p["dt"]] for p in r["parts"]] for r in runs}


def _same(a: dict[str, list], b: dict[str, list]) -> bool:
    """The same runs, whether compacted or not."""
    return {x for name in a for x in name.split("+")} == {x for name in b for x in name.split("+")}


def changed_folders(before: dict[str, dict], now: dict[str, dict]) -> set[tuple[str, str, str | None]]:
    """(log day, kind, event day) of all folders that came or went."""
    changed = set()
    for day in before.keys() | now.keys():
        old, new = before.get(day, {}), now.get(day, {})
        if not _same(old, new):
            gone_or_new = [parts for name, parts in [*old.items(), *new.items()] if name not in old or name not in new]
            changed |= {(day, kind, dt) for parts in gone_or_new for kind, dt in parts}
    return changed


def dirty_days(changed: set[tuple[str, str, str | None]], specs: Sequence[GrowthSpec], first: _dt.date, last: _dt.date) -> dict[str, list[_dt.date]]:
    """Report days from ``first`` to ``last`` to rebuild, by report."""
    targets = daily.growth_targets(specs)
    out: dict[str, set[_dt.date]] = {targets[s.name]: set() for s in specs} | {DEVICES: set(), FUNNEL: set()}
    for log_day, kind, dt in changed:
        day = None if dt is None else reports.as_date(dt)
        if kind == CLICKS:
            out[FUNNEL].add(reports.as_date(log_day))
        elif day and kind in STAGE_KINDS:
            out[FUNNEL].add(day)
        if day and kind == "download_fin":
            out[DEVICES].add(day)
        for spec in specs:
            if day and kind in spec.kinds:
                out[targets[spec.name]] |= {day + _dt.timedelta(n) for n in (0, *LAGS)}
    return {name: sorted(d for d in days if first <= d <= last) for name, days in out.items()}


def refresh_reports(
    spark: SparkSession,
    fact_root: str,
    catalog: DataFrame,
    report_root: str,
    first,
    last,
    specs: Sequence[GrowthSpec] = (DOWNLOAD_V2, INSTALL_V2, OPEN_V2),
    fmt: str = "orc",
) -> dict[str, list[_dt.date]]:
    """Bring the growth, device and funnel reports of ``first`` to ``last`` under
    ``report_root`` (``sinks``) up to date with the fact table; the days rebuilt, by
    report.  The first call builds all.  A change of the catalog is not looked for:
    rebuild all days then (``plans.backfill``).

    What was built is noted after the reports are committed, from what was in force
    before: a crash, or a run that comes meanwhile, makes days be built again."""
    root, first, last = report_root.rstrip("/"), reports.as_date(first), reports.as_date(last)
    log_days = sorted(store.versions(spark, f"{fact_root.rstrip('/')}/_days"))
    now = {day: _standing(runs) for day, runs in fact_table.day_runs(spark, fact_root, log_days).items()}
    noted = store.versions(spark, f"{root}/_built")
    before = {day: store.current(spark, f"{root}/_built", day, version)[1] for day, version in noted.items()}
    changed = changed_folders(before, now)
    days = dirty_days(changed, specs, first, last)
    cat = materialize(catalog.select("fsk_pid", "fsk_title", "fsk_cid", "fsk_catalog"))
    small = fits(cat, DEFAULT_MAX_ROWS)
    targets = daily.growth_targets(specs)
    for spec in specs:
        own = days[targets[spec.name]]
        if own:
            need = sorted({d - _dt.timedelta(n) for d in own for n in (0, *LAGS)})
            rows = fact_table.read_facts(spark, fact_root, days=need, kinds=spec.kinds, fmt=fmt)
            sinks.write_report_files(reports.growth(rows, cat, spec, days=own, broadcast=small), f"{root}/{targets[spec.name]}", days=own)
    if days[DEVICES]:
        rows = fact_table.read_facts(spark, fact_root, days=days[DEVICES], kinds=["download_fin"], fmt=fmt)
        sinks.write_report_files(reports.devices(rows, days=days[DEVICES]), f"{root}/{DEVICES}", days=days[DEVICES])
    if days[FUNNEL]:
        rows = daily.stage_facts(spark, fact_root, days[FUNNEL], fmt=fmt)
        sinks.write_report_files(reports.funnel(rows, days=days[FUNNEL]), f"{root}/{FUNNEL}", days=days[FUNNEL])
    cat.unpersist()
    for day in sorted(before.keys() | now.keys()):
        if before.get(day) != now.get(day):
            store.update(spark, f"{root}/_built", day, lambda _, day=day: now.get(day, {}))
    return days
