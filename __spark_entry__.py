"""

``entry(spark)`` runs the flagship report (install v2 growth, all days in one
pass) on sf0.001.  ``queries()`` maps every covered operator / report to a
callable ``(spark, sf_dir) -> DataFrame`` over the whole test tables, and
``oracle_sql()`` gives each one an independent DuckDB formulation on the same
tables (growth by self-joins with ``IS NOT DISTINCT FROM`` where the Spark
side uses a window; ``nullif`` where it uses ``try_divide``).

The test tables are mapped to the reference's log / catalog shape by
``logcube.sources.bridge``; ``_BRIDGE`` below is the same mapping in SQL.
"""

from __future__ import annotations

import datetime as dt
import logging
import os
import sys
from collections.abc import Callable
from functools import reduce

# The package sits next to this file; make it importable however the file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.functions.scalar import channel_of, date_key, dt_string, local_date
from logcube.operators.enrich import enrich
from logcube.operators.events import explode_kinds
from logcube.operators.funnel import DETAIL_STAGE, LIVE_STAGES
from logcube.operators.growth import REPORT_MEASURES
from logcube.plans import backfill, daily, day_states, refresh, reports, sql_reports
from logcube.plans.checkpoints import scratch_dir
from logcube.plans.ingest import replay_bad_lines, write_lines
from logcube.plans.specs import SPECS, GrowthSpec
from logcube.schemas import EVENT_KINDS
from logcube.sources import bridge
from logcube.sources.facts import add_days, compact, read_bad_lines, read_facts, replace_days
from logcube.sources.raw_logs import NoInputError, read_raw_logs, require_input
from logcube.sources.sinks import read_report_files, write_report_files
from logcube.streaming.ingest import start_ingest

# The training-data operators and their pipeline are an optional part: without
# them, or without a library that only they need, the reports remain.
try:
    import corpus_pipeline
    from logcube.llm import queries as llm
except ImportError as missing:
    logging.getLogger(__name__).warning("training-data operators left out: %s", missing)
    corpus_pipeline = llm = None

FLAGSHIP_SF = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: install v2 growth report over every day of sf0.001."""
    return queries()["install_growth_v2"](spark, FLAGSHIP_SF)


# ---------------------------------------------------------------- Spark side


def _facts(spark, sf):
    return bridge.facts(spark, sf)


def q_explode_events(spark, sf):
    rows = explode_kinds(bridge.raw_logs(spark, sf), bridge.EVENT_KINDS, passthrough=["event_id"])
    return rows.select("event_id", "custom_uuid", "rectime", "device_name", "site", "kind", "time", "package_id", "title")


def q_channel_map(spark, sf):
    log = bridge.app_log(spark, sf)
    return log.select("event_id", "site", channel_of(F.col("site")).alias("channelName"))


def q_event_date_int(spark, sf):
    log = bridge.app_log(spark, sf)
    day = local_date(F.col("rectime"), "UTC")
    return log.select(
        "event_id",
        "rectime",
        day.alias("event_day"),
        dt_string(day).alias("dt"),
        date_key(day).alias("date"),
    )


def q_open_source_flag(spark, sf):
    f = _facts(spark, sf).where(F.col("kind").isin("app_open", "game_open"))
    return f.select("event_id", "kind", "package_id", "source")


def q_catalog_union(spark, sf):
    return bridge.catalog(spark, sf)


def _enrich_query(rule, category):
    def q(spark, sf):
        rich = enrich(_facts(spark, sf), bridge.catalog(spark, sf), rule, category)
        return rich.select("event_id", "custom_uuid", "date", "kind", "site", "package_id", "title", category)

    return q


def q_three_day_scan(spark, sf):
    """What a report of the last day reads of the fact table: that day, the day
    before and the day a week before, as partition predicates."""
    root, days = _fact_files(spark, sf)
    last = dt.date.fromisoformat(max(days))
    rows = read_facts(spark, root, days=[last - dt.timedelta(n) for n in (0, 1, 7)], kinds=["download_fin"])
    return rows.select(
        F.date_diff(F.lit(last), F.col("date")).alias("lag"),
        "custom_uuid",
        date_key(F.col("date")).alias("date"),
        "package_id",
        "title",
        "site",
    )


def _cube_query(spec: GrowthSpec):
    def q(spark, sf):
        return reports.cube(_facts(spark, sf), bridge.catalog(spark, sf), spec)

    return q


def _growth_query(spec: GrowthSpec, fmt="percent"):
    def q(spark, sf):
        return reports.growth(_facts(spark, sf), bridge.catalog(spark, sf), spec, fmt=fmt)

    return q


def q_open_growth_as_sql(spark, sf):
    """K3: the report as one Spark SQL statement over a frame bound to it."""
    spec = SPECS["open_v2"]
    rich = reports.enriched_for(_facts(spark, sf), bridge.catalog(spark, sf), spec)
    return sql_reports.growth_sql(spark, rich, spec)


def q_device_downloads(spark, sf):
    return reports.devices(_facts(spark, sf))


def q_device_downloads_rollup(spark, sf):
    return reports.devices_rollup(_facts(spark, sf), bridge.catalog(spark, sf))


def q_funnel(spark, sf):
    return reports.funnel(_facts(spark, sf))


def q_funnel_macro(spark, sf):
    rich = reports.funnel_enriched(_facts(spark, sf), bridge.catalog(spark, sf))
    return reports.funnel_macro_micro(rich)[0]


def q_funnel_micro(spark, sf):
    rich = reports.funnel_enriched(_facts(spark, sf), bridge.catalog(spark, sf))
    return reports.funnel_macro_micro(rich)[1]


def q_funnel_four_stages(spark, sf):
    """The opens stand for the detail-page clicks, under those kinds' names."""
    facts = _facts(spark, sf)
    kind = F.when(F.col("kind") == "app_open", "appstore_onclick").when(F.col("kind") == "game_open", "game_onclick")
    facts = facts.withColumn("kind", F.coalesce(kind, F.col("kind")))
    return reports.funnel(facts, stages=(DETAIL_STAGE, *LIVE_STAGES))


def _first_and_last_day(facts):
    row = facts.agg(F.min("date"), F.max("date")).first()
    return row[0], row[1]


def q_backfill_install_growth(spark, sf):
    """A range inside the data: its lead-in days are read but not reported."""
    facts = _facts(spark, sf)
    first, last = _first_and_last_day(facts)
    start, end = first + dt.timedelta(8), last - dt.timedelta(2)
    return backfill.backfill_growth(facts, bridge.catalog(spark, sf), SPECS["install_v2"], start=start, end=end)


FACT_OUTPUT = ("custom_uuid", "date", "log_date", "device_name", "site", "package_id", "title", "source", "kind", "dt")
BRIDGE_LAYOUT = "day={day}/*.gz"


def _bridge_lines(spark, sf):
    """The bridge's log lines with the folder day (their event day)."""
    raw = bridge.raw_logs(spark, sf)
    return raw.withColumn("day", local_date(F.col("rectime"), "UTC").cast("string"))


def _write_logs(lines, logs: str) -> list[str]:
    """Lines as gzip JSON day folders (``day=<yyyy-MM-dd>``), beside what is there; the days."""
    lines.drop("event_id").write.mode("append").partitionBy("day").option("compression", "gzip").json(logs)
    return sorted(r[0] for r in lines.select("day").distinct().collect())  # one row per calendar day


def _fact_files(spark, sf):
    """S1, S2, P1-P7, K1 on real files: the bridge's log lines written as gzip
    JSON day folders and parsed into the ORC fact table in one job; the
    table's root and the days."""
    root = scratch_dir(spark, "bridge")
    days = _write_logs(_bridge_lines(spark, sf), f"{root}/logs")
    daily.ingest_days(spark, f"{root}/logs", f"{root}/facts", days, tz="UTC", layout=BRIDGE_LAYOUT)
    return f"{root}/facts", days


def q_ingest_json_facts(spark, sf):
    return read_facts(spark, _fact_files(spark, sf)[0]).select(*FACT_OUTPUT)


def q_stream_ingest_facts(spark, sf):
    """The same logs through the Structured Streaming ingest (availableNow
    trigger, foreachBatch adding one run per micro-batch)."""
    root = scratch_dir(spark, "stream")
    _write_logs(_bridge_lines(spark, sf), f"{root}/logs")
    start_ingest(spark, f"{root}/logs", f"{root}/facts", f"{root}/checkpoint", tz="UTC").awaitTermination()
    return read_facts(spark, f"{root}/facts").select(*FACT_OUTPUT)


def q_growth_from_fact_files(spark, sf):
    facts = read_facts(spark, _fact_files(spark, sf)[0])
    return reports.growth(facts, bridge.catalog(spark, sf), SPECS["install_v2"])


def q_reingest_facts(spark, sf):
    """Logs ingested with a wrong zone, then replaced by corrected, fewer logs:
    by the range ingest, then twice by a stream with a new checkpoint each.
    Only the corrected logs count, once."""
    root = scratch_dir(spark, "reingest")
    lines, facts = _bridge_lines(spark, sf), f"{root}/facts"
    days = _write_logs(lines, f"{root}/logs")
    daily.ingest_days(spark, f"{root}/logs", facts, days, tz="Asia/Shanghai", layout=BRIDGE_LAYOUT)
    days = _write_logs(lines.where("event_id % 3 <> 0"), f"{root}/corrected")
    daily.ingest_days(spark, f"{root}/corrected", facts, days, tz="UTC", layout=BRIDGE_LAYOUT)
    for n in range(2):
        start_ingest(spark, f"{root}/corrected", facts, f"{root}/checkpoint{n}", tz="UTC").awaitTermination()
    return read_facts(spark, facts).select(*FACT_OUTPUT)


def q_funnel_folder_day(spark, sf):
    """Every fifth event is logged a day late: clicks count on the day of their
    log folder, the other stages on the event's day."""
    root = scratch_dir(spark, "late")
    late = F.when(F.col("event_id") % 5 == 0, F.date_add("day", 1).cast("string")).otherwise(F.col("day"))
    days = _write_logs(_bridge_lines(spark, sf).withColumn("day", late), f"{root}/logs")
    daily.ingest_days(spark, f"{root}/logs", f"{root}/facts", days, tz="UTC", layout=BRIDGE_LAYOUT)
    return reports.funnel(daily.stage_facts(spark, f"{root}/facts", days), days=days)


def _write_bad_logs(spark, sf, logs: str, undated: str) -> list[str]:
    """Every 40th line is cut short, every 41st is ``undated`` (what stands
    instead of "rectime":<number>) and every 43rd has its rectime quoted."""
    lines, n = _bridge_lines(spark, sf), F.col("event_id")
    number = F.col("rectime").cast("string")
    rectime = F.when(n % 41 == 0, F.replace(F.lit(undated), F.lit("<number>"), number))
    rectime = rectime.when(n % 43 == 0, F.concat(F.lit('"rectime":"'), number, F.lit('"'))).otherwise(F.concat(F.lit('"rectime":'), number))
    others = F.to_json(F.struct(*[c for c in lines.columns if c not in ("event_id", "day", "rectime")]))
    text = F.concat(F.lit("{"), rectime, F.lit(","), F.expr("substring(others, 2)"))
    lines = lines.select("event_id", "day", others.alias("others"), "rectime").select("event_id", "day", text.alias("value"))
    lines = lines.withColumn("value", F.when(n % 40 == 0, F.expr("left(value, length(value) - 3)")).otherwise(F.col("value")))
    lines.select("day", "value").write.partitionBy("day").option("compression", "gzip").text(logs)
    return sorted(r[0] for r in lines.select("day").distinct().collect())  # one row per calendar day


def _good_and_bad(spark, facts_root: str):
    """Events with a day and stored bad lines by log day."""
    bad = read_bad_lines(spark, facts_root).select("log_date", "reason")
    good = read_facts(spark, facts_root).select("log_date", F.lit("fact").alias("reason")).where(F.col("log_date") == F.col("date"))
    return bad.unionByName(good).groupBy("log_date", "reason").agg(F.count("*").alias("n"))


def q_ingest_bad_lines(spark, sf):
    """Lines cut short and lines without a number as rectime are counted and
    stored; a quoted number is read like the others."""
    root = scratch_dir(spark, "bad")
    days = _write_bad_logs(spark, sf, f"{root}/logs", '"rectime":"soon"')
    daily.ingest_days(spark, f"{root}/logs", f"{root}/facts", days, tz="UTC", layout=BRIDGE_LAYOUT)
    return _good_and_bad(spark, f"{root}/facts")


def q_stream_bad_lines(spark, sf):
    """The same through the stream, and again with a new checkpoint."""
    root = scratch_dir(spark, "streambad")
    _write_bad_logs(spark, sf, f"{root}/logs", '"rectime":"soon"')
    for n in range(2):
        start_ingest(spark, f"{root}/logs", f"{root}/facts", f"{root}/checkpoint{n}", tz="UTC").awaitTermination()
    return _good_and_bad(spark, f"{root}/facts")


def q_replay_bad_lines(spark, sf):
    """Lines with another name of rectime are stored by the stream; replayed twice
    with that name mended they are events of their log day, once.  Lines cut short
    stay stored."""
    root = scratch_dir(spark, "replay")
    days = _write_bad_logs(spark, sf, f"{root}/logs", '"rec_time":<number>')
    start_ingest(spark, f"{root}/logs", f"{root}/facts", f"{root}/checkpoint", tz="UTC").awaitTermination()
    for _ in range(2):
        replay_bad_lines(spark, f"{root}/facts", days, tz="UTC", repair=lambda line: F.replace(line, F.lit('"rec_time"'), F.lit('"rectime"')))
    return _good_and_bad(spark, f"{root}/facts")


def q_facts_two_writers(spark, sf):
    """A nightly ingest has parsed its logs when a stream commits these and later
    ones; it finds itself overtaken and starts again.  Then the stream finds that
    the next ingest has parsed what it has read.  Every event counts once."""
    root = scratch_dir(spark, "writers")
    lines, logs, facts = _bridge_lines(spark, sf), f"{root}/logs", f"{root}/facts"
    days = _write_logs(lines.where("event_id % 3 = 0"), logs)
    files = require_input(spark, logs, days, BRIDGE_LAYOUT)
    run, _ = write_lines(read_raw_logs(spark, logs, days, layout=BRIDGE_LAYOUT), facts, files, EVENT_KINDS, "UTC")
    _write_logs(lines.where("event_id % 3 = 1"), logs)
    start_ingest(spark, logs, facts, f"{root}/checkpoint0", tz="UTC").awaitTermination()
    overtaken = replace_days(spark, facts, run, files, {})
    daily.ingest_days(spark, logs, facts, overtaken, tz="UTC", layout=BRIDGE_LAYOUT)
    days = _write_logs(lines.where("event_id % 3 = 2"), logs)
    files = require_input(spark, logs, days, BRIDGE_LAYOUT)
    run, _ = write_lines(read_raw_logs(spark, logs, days, layout=BRIDGE_LAYOUT), facts, files, EVENT_KINDS, "UTC")
    daily.ingest_days(spark, logs, facts, days, tz="UTC", layout=BRIDGE_LAYOUT)
    left = add_days(spark, facts, run, files)  # what a batch would parse again: nothing
    assert not any(left.values())
    start_ingest(spark, logs, facts, f"{root}/checkpoint1", tz="UTC").awaitTermination()
    return read_facts(spark, facts).select(*FACT_OUTPUT)


def q_compact_facts(spark, sf):
    """Days of many micro-batches, rewritten into a run each day, then a stream with
    a new checkpoint, which adds nothing."""
    root = scratch_dir(spark, "compact")
    facts = f"{root}/facts"
    days = _write_logs(_bridge_lines(spark, sf), f"{root}/logs")
    n_files = sum(map(len, require_input(spark, f"{root}/logs", days, BRIDGE_LAYOUT).values()))
    start_ingest(spark, f"{root}/logs", facts, f"{root}/checkpoint0", tz="UTC", max_files_per_trigger=-(-n_files // 6)).awaitTermination()
    compact(spark, facts, days)
    start_ingest(spark, f"{root}/logs", facts, f"{root}/checkpoint1", tz="UTC").awaitTermination()
    return read_facts(spark, facts).select(*FACT_OUTPUT)


def q_missing_log_day(spark, sf):
    """The logs of the third day are missing; which day stops an ingest of the
    whole range, and with which exit code."""
    root = scratch_dir(spark, "missing")
    lines = _bridge_lines(spark, sf)
    days = sorted(r[0] for r in lines.select("day").distinct().collect())  # one row per calendar day
    _write_logs(lines.where(F.col("day") != days[2]), f"{root}/logs")
    try:
        daily.ingest_days(spark, f"{root}/logs", f"{root}/facts", days, tz="UTC", layout=BRIDGE_LAYOUT)
        stopped = []
    except NoInputError as e:
        stopped = [(e.day, e.exit_code)]
    return spark.createDataFrame(stopped, "day string, exit_code int")


def q_growth_from_day_states(spark, sf):
    """States of all log days, then late events of the day before the last in the
    last log folder, whose state alone is taken again; and a report with another
    catalog before.  Growth of the last day from the states of three days."""
    root = scratch_dir(spark, "states")
    lines, logs, facts, states = _bridge_lines(spark, sf), f"{root}/logs", f"{root}/facts", f"{root}/states"
    last = lines.agg(F.max("day")).first()[0]
    late = (F.col("day") == str(dt.date.fromisoformat(last) - dt.timedelta(1))) & (F.col("event_id") % 3 == 0)
    days = _write_logs(lines.where(~late), logs)
    daily.ingest_days(spark, logs, facts, days, tz="UTC", layout=BRIDGE_LAYOUT)
    day_states.update_states(spark, facts, states, days)
    catalog, spec = bridge.catalog(spark, sf), SPECS["open_v2"]
    day_states.growth_from_states(spark, states, catalog.where("fsk_catalog <> 'ECONOMY'"), spec, [last]).write.format("noop").mode("overwrite").save()
    _write_logs(lines.where(late).withColumn("day", F.lit(last)), logs)
    daily.ingest_day(spark, logs, facts, last, tz="UTC", layout=BRIDGE_LAYOUT)
    day_states.update_states(spark, facts, states, [last])
    return day_states.growth_from_states(spark, states, catalog, spec, [last])


def _refreshed(spark, sf):
    """Reports of all days, then every third event of the tenth day withdrawn from
    its logs, and the reports refreshed; their folder and the days rebuilt."""
    root = scratch_dir(spark, "refresh")
    lines, facts, out = _bridge_lines(spark, sf), f"{root}/facts", f"{root}/reports"
    days = _write_logs(lines, f"{root}/logs")
    daily.ingest_days(spark, f"{root}/logs", facts, days, tz="UTC", layout=BRIDGE_LAYOUT)
    catalog, specs = bridge.catalog(spark, sf), [SPECS["install_v2"]]
    refresh.refresh_reports(spark, facts, catalog, out, days[0], days[-1], specs)
    _write_logs(lines.where((F.col("day") == days[9]) & (F.col("event_id") % 3 != 0)), f"{root}/corrected")
    daily.ingest_day(spark, f"{root}/corrected", facts, days[9], tz="UTC", layout=BRIDGE_LAYOUT)
    return out, refresh.refresh_reports(spark, facts, catalog, out, days[0], days[-1], specs)


def q_refresh_changed_day(spark, sf):
    """The whole growth report after it was refreshed for one changed log day."""
    return read_report_files(spark, f"{_refreshed(spark, sf)[0]}/app_install_report")


def q_refresh_rebuilt_days(spark, sf):
    """The report days that the refresh has rebuilt."""
    _, rebuilt = _refreshed(spark, sf)
    return spark.createDataFrame([(name, day) for name, own in rebuilt.items() for day in own], "report string, day date")


NIGHTLY = ("device_app_download_report", "funnel_app_install_report", "funnel_app_install_report_macro", "funnel_app_install_report_micro")


def q_nightly_reports(spark, sf):
    """K4: the nightly job of the last day from fact files, whose reports share the
    persisted join; rows and events of its device and funnel reports."""
    root, days = _fact_files(spark, sf)
    out = scratch_dir(spark, "nightly")
    daily.report_days(spark, root, bridge.catalog(spark, sf), [days[-1]], lambda name, df, d: write_report_files(df, f"{out}/{name}", days=d))
    found = [read_report_files(spark, f"{out}/{name}").select(F.lit(name).alias("report"), "totalPlayCount") for name in NIGHTLY]
    return reduce(DataFrame.unionByName, found).groupBy("report").agg(F.count("*").alias("n"), F.sum("totalPlayCount").alias("events"))


def q_report_files_replace(spark, sf):
    """K2 on files: the device report of all days, then a rerun of the last three
    after a device's events and a whole day's were withdrawn."""
    facts = _facts(spark, sf)
    path = scratch_dir(spark, "report")
    write_report_files(reports.devices(facts), path)
    last = _first_and_last_day(facts)[1]
    days = [last - dt.timedelta(n) for n in range(3)]
    left = facts.where((F.col("date") != F.lit(days[1])) & (F.col("device_name") != "dev_0"))
    write_report_files(reports.devices(left, days=days), path, days=days)
    return read_report_files(spark, path).select("date", "device_name", "totalPlayCount")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = report_queries()
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "explode_events": q_explode_events,
        "channel_map": q_channel_map,
        "event_date_int": q_event_date_int,
        "open_source_flag": q_open_source_flag,
        "catalog_union": q_catalog_union,
        "enrich_log_title": _enrich_query("log", "fsk_cid"),
        "enrich_catalog_title": _enrich_query("catalog", "fsk_catalog"),
        "enrich_conditional_title": _enrich_query("conditional", "fsk_catalog"),
        "three_day_scan": q_three_day_scan,
        "download_cube_v1": _cube_query(SPECS["download_v1"]),
        "download_cube_v2": _cube_query(SPECS["download_v2"]),
        "open_cube_v1": _cube_query(SPECS["open_v1"]),
        "open_cube_v2": _cube_query(SPECS["open_v2"]),
        "download_growth_v1": _growth_query(SPECS["download_v1"]),
        "download_growth_v2": _growth_query(SPECS["download_v2"]),
        "install_growth_v1": _growth_query(SPECS["install_v1"]),
        "install_growth_v2": _growth_query(SPECS["install_v2"]),
        "open_growth_v1": _growth_query(SPECS["open_v1"]),
        "open_growth_v2": _growth_query(SPECS["open_v2"]),
        "open_growth_hybrid": _growth_query(SPECS["open_hybrid"]),
        "open_growth_as_sql": q_open_growth_as_sql,
        "download_growth_ratio": _growth_query(SPECS["download_v1"], fmt="ratio"),
        "device_downloads": q_device_downloads,
        "device_downloads_rollup": q_device_downloads_rollup,
        "funnel": q_funnel,
        "funnel_macro": q_funnel_macro,
        "funnel_micro": q_funnel_micro,
        "funnel_four_stages": q_funnel_four_stages,
        "backfill_install_growth": q_backfill_install_growth,
        "ingest_json_facts": q_ingest_json_facts,
        "stream_ingest_facts": q_stream_ingest_facts,
        "growth_from_fact_files": q_growth_from_fact_files,
        "reingest_facts": q_reingest_facts,
        "funnel_folder_day": q_funnel_folder_day,
        "ingest_bad_lines": q_ingest_bad_lines,
        "stream_bad_lines": q_stream_bad_lines,
        "replay_bad_lines": q_replay_bad_lines,
        "facts_two_writers": q_facts_two_writers,
        "compact_facts": q_compact_facts,
        "missing_log_day": q_missing_log_day,
        "nightly_reports": q_nightly_reports,
        "growth_from_day_states": q_growth_from_day_states,
        "refresh_changed_day": q_refresh_changed_day,
        "refresh_rebuilt_days": q_refresh_rebuilt_days,
        "report_files_replace": q_report_files_replace,
    }


# --------------------------------------------------------------- DuckDB side

_BRIDGE = """
app_log AS MATERIALIZED (
  SELECT event_id,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS custom_uuid,
         epoch_us(ts) // 1000 AS rectime,
         CASE event_type WHEN 'click' THEN 'download_onclick' WHEN 'signup' THEN 'download_fin'
                         WHEN 'purchase' THEN 'install_fin' WHEN 'view' THEN 'app_open'
                         ELSE 'game_open' END AS kind,
         'dev_' || CAST(user_id % 7 AS VARCHAR) AS device_name,
         CASE WHEN k % 4 = 0 THEN 'ALI' WHEN k % 4 = 1 THEN 'IQIYI' WHEN k % 4 = 2 THEN 'BESTV'
              WHEN k % 8 = 3 THEN 'OTHER' END AS site,
         CASE WHEN k < 90 THEN CAST(k AS VARCHAR) END AS package_id,
         'raw_' || CAST(k AS VARCHAR) AS title,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
         CAST(ts AS DATE) AS date
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k FROM events) e
),
facts AS (
  SELECT event_id, custom_uuid, date, device_name,
         CASE site WHEN 'ALI' THEN 'youku' WHEN 'IQIYI' THEN 'iqiyi' WHEN 'BESTV' THEN 'bestv'
                   ELSE 'others' END AS site,
         package_id, title, kind,
         CASE WHEN package_id IS NOT NULL THEN 1 ELSE 0 END AS source
  FROM app_log
),
cms AS (
  SELECT CAST(p_partkey AS VARCHAR) AS fsk_pid, p_name AS fsk_title, p_brand AS fsk_cid, p_type AS fsk_catalog
  FROM part WHERE p_type NOT IN ('PROMO', 'SMALL')
  UNION ALL
  SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type
  FROM part WHERE p_type IN ('ECONOMY', 'SMALL')
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_BRIDGE.strip(), *ctes]) + "\n"


def _int_date(expr: str) -> str:
    return f"CAST(strftime({expr}, '%Y%m%d') AS INTEGER)"


def _round(expr: str, digits: int) -> str:
    # Spark rounds the shortest decimal text of a double half-up; do the same.
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE)"


def _title_sql(rule: str) -> str:
    return {
        "log": "f.title",
        "catalog": "c.fsk_title",
        "conditional": "CASE WHEN f.package_id IS NOT NULL THEN c.fsk_title ELSE f.title END",
    }[rule]


def _enriched_cte(name: str, rule: str, category: str, kinds) -> str:
    kind_list = ", ".join(f"'{k}'" for k in kinds)
    return f"""{name} AS (
  SELECT f.event_id, f.custom_uuid, f.date, f.kind, f.site, f.package_id, {_title_sql(rule)} AS title,
         f.source, f.device_name, c.{category}
  FROM facts f LEFT JOIN cms c ON f.package_id IS NOT DISTINCT FROM c.fsk_pid
  WHERE f.kind IN ({kind_list})
)"""


def _cube_cte(spec: GrowthSpec) -> list[str]:
    keys = ", ".join(spec.keys)
    sets = ", ".join("(" + ", ".join(["date", *s]) + ")" for s in spec.grouping_sets)
    return [
        _enriched_cte("enriched", spec.title_rule, spec.category, spec.kinds),
        f"""cube AS MATERIALIZED (
  SELECT date, {keys}, CAST(grouping({keys}) AS BIGINT) AS id_1,
         count(custom_uuid) AS playNum, count(DISTINCT custom_uuid) AS users,
         {_round("count(custom_uuid) / nullif(count(DISTINCT custom_uuid), 0)", 2)} AS avgPlayNum
  FROM enriched GROUP BY GROUPING SETS ({sets})
)""",
    ]


def _cube_sql(spec: GrowthSpec) -> str:
    keys = ", ".join(spec.keys)
    return _with(*_cube_cte(spec)) + f"SELECT {_int_date('date')} AS date, {keys}, id_1, playNum, users, avgPlayNum FROM cube"


def _growth_sql(spec: GrowthSpec, fmt: str = "percent") -> str:
    def change(cur, prev):
        ratio = f"({cur} / nullif({prev}, 0) - 1)"
        if fmt == "ratio":
            return _round(ratio, 4)
        return f"CAST({_round(ratio + ' * 100', 2)} AS VARCHAR) || '%'"

    def on(alias, days):
        conds = [f"c.{k} IS NOT DISTINCT FROM {alias}.{k}" for k in spec.keys]
        conds += [f"c.id_1 = {alias}.id_1", f"{alias}.date = c.date - {days}"]
        return " AND ".join(conds)

    renamed = ", ".join(f"c.{k} AS {n}" for k, n in zip(spec.keys, spec.key_names))
    cols = [f"{_int_date('c.date')} AS date", renamed, "c.id_1"]
    for m, total, day, week in REPORT_MEASURES:
        cols += [f"c.{m} AS {total}", f"{change('c.' + m, 'p1.' + m)} AS {day}", f"{change('c.' + m, 'p7.' + m)} AS {week}"]
    return (
        _with(*_cube_cte(spec))
        + "SELECT "
        + ",\n       ".join(cols)
        + f"\nFROM cube c LEFT JOIN cube p1 ON {on('p1', 1)}\n            LEFT JOIN cube p7 ON {on('p7', 7)}"
    )


def _enrich_sql(rule: str, category: str) -> str:
    return _with(_enriched_cte("enriched", rule, category, bridge.EVENT_KINDS)) + (
        f"SELECT event_id, custom_uuid, date, kind, site, package_id, title, {category} FROM enriched"
    )


_FUNNEL_STAGE_ROWS = """stage_rows AS (
  SELECT f.*, f.kind AS featureName FROM facts f
  WHERE f.kind IN ('download_onclick', 'download_fin', 'install_fin')
),
stage_enriched AS (
  SELECT s.custom_uuid, s.date, s.featureName, s.site, s.package_id, c.fsk_title AS title, c.fsk_catalog
  FROM stage_rows s LEFT JOIN cms c ON s.package_id IS NOT DISTINCT FROM c.fsk_pid
)"""


_FACT_ROWS = _with() + """SELECT custom_uuid, date, date AS log_date, device_name, site, package_id, title, source, kind,
       strftime(date, '%Y-%m-%d') AS dt
FROM facts"""

_BAD_LINES = _with() + """SELECT date AS log_date,
       CASE WHEN event_id % 40 = 0 THEN 'corrupt' WHEN event_id % 41 = 0 THEN 'undated' ELSE 'fact' END AS reason,
       count(*) AS n
FROM facts GROUP BY 1, 2"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "explode_events": _with()
        + "SELECT event_id, custom_uuid, rectime, device_name, site, kind, time, package_id, title FROM app_log",
        "channel_map": _with()
        + """SELECT event_id, site,
       CASE site WHEN 'ALI' THEN 'youku' WHEN 'IQIYI' THEN 'iqiyi' WHEN 'BESTV' THEN 'bestv'
                 ELSE 'others' END AS channelName
FROM app_log""",
        "event_date_int": _with()
        + f"""SELECT event_id, rectime, CAST(epoch_ms(rectime) AS DATE) AS event_day,
       strftime(CAST(epoch_ms(rectime) AS DATE), '%Y-%m-%d') AS dt,
       {_int_date('CAST(epoch_ms(rectime) AS DATE)')} AS date
FROM app_log""",
        "open_source_flag": _with()
        + "SELECT event_id, kind, package_id, source FROM facts WHERE kind IN ('app_open', 'game_open')",
        "catalog_union": _with() + "SELECT fsk_pid, fsk_title, fsk_cid, fsk_catalog FROM cms",
        "enrich_log_title": _enrich_sql("log", "fsk_cid"),
        "enrich_catalog_title": _enrich_sql("catalog", "fsk_catalog"),
        "enrich_conditional_title": _enrich_sql("conditional", "fsk_catalog"),
        "three_day_scan": _with("last AS (SELECT max(date) AS day FROM facts)")
        + f"""SELECT CAST(day - date AS INTEGER) AS lag, custom_uuid, {_int_date('date')} AS date, package_id, title, site
FROM facts, last WHERE kind = 'download_fin' AND day - date IN (0, 1, 7)""",
        "download_cube_v1": _cube_sql(SPECS["download_v1"]),
        "download_cube_v2": _cube_sql(SPECS["download_v2"]),
        "open_cube_v1": _cube_sql(SPECS["open_v1"]),
        "open_cube_v2": _cube_sql(SPECS["open_v2"]),
        "download_growth_v1": _growth_sql(SPECS["download_v1"]),
        "download_growth_v2": _growth_sql(SPECS["download_v2"]),
        "install_growth_v1": _growth_sql(SPECS["install_v1"]),
        "install_growth_v2": _growth_sql(SPECS["install_v2"]),
        "open_growth_v1": _growth_sql(SPECS["open_v1"]),
        "open_growth_v2": _growth_sql(SPECS["open_v2"]),
        "open_growth_hybrid": _growth_sql(SPECS["open_hybrid"]),
        "open_growth_as_sql": _growth_sql(SPECS["open_v2"]),
        "download_growth_ratio": _growth_sql(SPECS["download_v1"], fmt="ratio"),
        "device_downloads": _with()
        + f"""SELECT {_int_date('date')} AS date, device_name, count(custom_uuid) AS totalPlayCount
FROM facts WHERE kind = 'download_fin' GROUP BY date, device_name""",
        "device_downloads_rollup": _with(_enriched_cte("enriched", "catalog", "fsk_catalog", ["download_fin"]))
        + f"""SELECT {_int_date('date')} AS date, device_name, site AS channelName, fsk_catalog AS typeName,
       CAST(grouping(date, device_name, site, fsk_catalog) AS BIGINT) AS id_1,
       count(custom_uuid) AS totalPlayCount
FROM enriched
GROUP BY GROUPING SETS ((date, device_name, site, fsk_catalog), (date, device_name, site),
                        (date, device_name, fsk_catalog), (date, device_name))""",
        "funnel": _with()
        + f"""SELECT {_int_date('date')} AS date, kind AS featureName, count(custom_uuid) AS totalPlayCount
FROM facts WHERE kind IN ('download_onclick', 'download_fin', 'install_fin')
GROUP BY date, kind""",
        "funnel_macro": _with(_FUNNEL_STAGE_ROWS)
        + f"""SELECT {_int_date('date')} AS date, featureName, site AS channelName, fsk_catalog AS typeName,
       CAST(grouping(date, featureName, site, fsk_catalog) AS BIGINT) AS id_1,
       count(custom_uuid) AS totalPlayCount
FROM stage_enriched
GROUP BY GROUPING SETS ((date, featureName, site, fsk_catalog), (date, featureName, site),
                        (date, featureName, fsk_catalog), (date, featureName))""",
        "funnel_micro": _with(_FUNNEL_STAGE_ROWS)
        + f"""SELECT {_int_date('date')} AS date, package_id AS appId, title AS appName, featureName,
       count(custom_uuid) AS totalPlayCount
FROM stage_enriched GROUP BY date, package_id, title, featureName""",
        "funnel_four_stages": _with()
        + f"""SELECT {_int_date('date')} AS date,
       CASE WHEN kind IN ('app_open', 'game_open') THEN 'appstore_game_onclick' ELSE kind END AS featureName,
       count(custom_uuid) AS totalPlayCount
FROM facts
WHERE kind IN ('app_open', 'game_open', 'download_onclick', 'download_fin', 'install_fin')
GROUP BY 1, 2""",
        "backfill_install_growth": _growth_sql(SPECS["install_v2"])
        + "\nWHERE c.date BETWEEN (SELECT min(date) + 8 FROM facts) AND (SELECT max(date) - 2 FROM facts)",
        "ingest_json_facts": _FACT_ROWS,
        "stream_ingest_facts": _FACT_ROWS,
        "growth_from_fact_files": _growth_sql(SPECS["install_v2"]),
        "reingest_facts": _with()
        + """SELECT custom_uuid, date, date AS log_date, device_name, site, package_id, title, source, kind,
       strftime(date, '%Y-%m-%d') AS dt
FROM facts WHERE event_id % 3 <> 0""",
        "funnel_folder_day": _with(
            """logged AS (
  SELECT *, CASE WHEN event_id % 5 = 0 THEN date + 1 ELSE date END AS log_date FROM facts
), staged AS (
  SELECT CASE WHEN kind = 'download_onclick' THEN log_date ELSE date END AS day, kind, custom_uuid
  FROM logged WHERE kind IN ('download_onclick', 'download_fin', 'install_fin')
)"""
        )
        + f"""SELECT {_int_date('day')} AS date, kind AS featureName, count(custom_uuid) AS totalPlayCount
FROM staged WHERE day IN (SELECT log_date FROM logged) GROUP BY day, kind""",
        "ingest_bad_lines": _BAD_LINES,
        "stream_bad_lines": _BAD_LINES,
        "replay_bad_lines": _with()
        + """SELECT date AS log_date, CASE WHEN event_id % 40 = 0 THEN 'corrupt' ELSE 'fact' END AS reason, count(*) AS n
FROM facts GROUP BY 1, 2""",
        "facts_two_writers": _FACT_ROWS,
        "compact_facts": _FACT_ROWS,
        "missing_log_day": _with()
        + """SELECT strftime(date, '%Y-%m-%d') AS day, CAST(123 AS INTEGER) AS exit_code
FROM (SELECT DISTINCT date FROM facts) ORDER BY date LIMIT 1 OFFSET 2""",
        "growth_from_day_states": _growth_sql(SPECS["open_v2"]) + "\nWHERE c.date = (SELECT max(date) FROM facts)",
        "refresh_changed_day": _growth_sql(SPECS["install_v2"]).replace(
            "  FROM app_log\n),", "  FROM app_log WHERE event_id % 3 <> 0 OR date <> (SELECT min(date) + 9 FROM app_log)\n),"
        ),
        "refresh_rebuilt_days": _with("tenth AS (SELECT min(date) + 9 AS day FROM facts)")
        + """SELECT report, day + n AS day FROM tenth, (VALUES ('app_install_report', 0), ('app_install_report', 1),
  ('app_install_report', 7), ('device_app_download_report', 0), ('funnel_app_install_report', 0)) AS t(report, n)""",
        "nightly_reports": _with("last AS (SELECT max(date) AS day FROM facts)", _FUNNEL_STAGE_ROWS)
        + """, own AS (SELECT * FROM stage_enriched, last WHERE date = day)
SELECT 'device_app_download_report' AS report, count(*) AS n, CAST(sum(c) AS BIGINT) AS events
FROM (SELECT count(custom_uuid) AS c FROM facts, last WHERE date = day AND kind = 'download_fin' GROUP BY device_name)
UNION ALL SELECT 'funnel_app_install_report', count(*), CAST(sum(c) AS BIGINT)
FROM (SELECT count(custom_uuid) AS c FROM stage_rows, last WHERE date = day GROUP BY featureName)
UNION ALL SELECT 'funnel_app_install_report_macro', count(*), CAST(sum(c) AS BIGINT)
FROM (SELECT count(custom_uuid) AS c FROM own GROUP BY GROUPING SETS ((featureName, site, fsk_catalog), (featureName, site), (featureName, fsk_catalog), (featureName)))
UNION ALL SELECT 'funnel_app_install_report_micro', count(*), CAST(sum(c) AS BIGINT)
FROM (SELECT count(custom_uuid) AS c FROM own GROUP BY package_id, title, featureName)""",
        "report_files_replace": _with("last AS (SELECT max(date) AS day FROM facts)")
        + f"""SELECT {_int_date('date')} AS date, device_name, count(custom_uuid) AS totalPlayCount
FROM facts, last
WHERE kind = 'download_fin' AND (date < day - 2 OR (date <> day - 1 AND device_name <> 'dev_0'))
GROUP BY date, device_name""",
    }
    if llm is not None:
        sql |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
