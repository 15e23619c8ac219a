"""Plan-shape guards: the physical plans keep the shuffles and pruning the
design relies on (README, "Scale design")."""

import datetime as dt
import re
import tempfile

from pyspark.sql import functions as F

from logcube.operators.cube import rollup_counts
from logcube.operators.enrich import enrich
from logcube.plans import daily, reports
from logcube.plans.specs import SPECS
from logcube.sources import bridge
from logcube.sources.facts import read_facts
from tests.fixtures import D0, catalog_frame
from tests.test_io import ev, line, write_gz

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", plan))


def test_growth_is_three_hash_shuffles_and_a_broadcast(spark):
    df = reports.growth(bridge.facts(spark, SF), bridge.catalog(spark, SF), SPECS["open_v1"])
    plan = plan_of(df)
    # distinct phase, final aggregate, window -- for any number of days
    assert shuffles(plan) == 3
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "Window" in plan and "Expand" in plan


def test_a_lattice_of_sets_shuffles_users_three_times(spark):
    """However many sets: the detail tuples (one exchange for both that read
    them), a top's tuples, and these by user; then counts per group."""
    facts = bridge.facts(spark, SF).where(F.col("kind").isin("app_open", "game_open"))
    rich = enrich(facts, bridge.catalog(spark, SF), "conditional", "fsk_catalog")
    spec = SPECS["open_v2"]
    out = rollup_counts(rich, spec.keys, spec.grouping_sets)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    own = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    of_users = [e for e in re.findall(r"Exchange hashpartitioning\(([^)]*)", own) if "custom_uuid" in e]
    assert len(of_users) == 3 and "Expand" not in plan and "ReusedExchange" in plan
    assert sum(e.count("#") == 2 for e in of_users) == 1  # by (date, user) alone


def test_one_day_report_reads_three_fact_partitions(spark, scratch):
    root = tempfile.mkdtemp(prefix="plogs-", dir=scratch)
    facts_root = tempfile.mkdtemp(prefix="pfacts-", dir=scratch)
    days = [D0 - dt.timedelta(n) for n in range(9)]
    for d in days:
        write_gz(f"{root}/{d}/h/a.gz", [line("u1", d, download_fin=[ev("p1")], install_fin=[ev("p2")])])
        daily.ingest_day(spark, root, facts_root, d, tz="UTC", fmt="parquet")
    facts = read_facts(spark, facts_root, fmt="parquet")
    rep = reports.growth(facts, catalog_frame(spark), SPECS["install_v2"], days=[D0])
    plan = plan_of(rep)
    assert "PartitionFilters" in plan
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    for d in (D0, D0 - dt.timedelta(1), D0 - dt.timedelta(7)):
        assert str(d) in scan
    assert str(D0 - dt.timedelta(2)) not in scan
    assert "install_fin" in scan  # kind is a partition filter too
    got = rep.collect()
    assert {r["date"] for r in got} == {20240110}
    assert {r["playCountCompareDay"] for r in got} == {"0.0%"}


def test_explode_filters_kind_before_second_generate(spark):
    plan = plan_of(reports.devices(bridge.facts(spark, SF)))
    # Catalyst pushes the kind predicate between the two explodes
    assert re.search(r"Filter \(+_k#\d+\.kind = download_fin\)", plan)


def test_spread_only_below_parallelism(spark):
    from logcube.sources.spread import spread

    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert spread(many, 4) is many


def nine_days(spark, scratch):
    root = tempfile.mkdtemp(prefix="nlogs-", dir=scratch)
    facts_root = tempfile.mkdtemp(prefix="nfacts-", dir=scratch)
    days = [D0 - dt.timedelta(n) for n in range(9)]
    for d in days:
        rows = dict(download_fin=[ev("p1")], install_fin=[ev("p2")], app_open=[ev("p1")], download_onclick=[ev("p1")])
        write_gz(f"{root}/{d}/h/a.gz", [line("u1", d, **rows), line("u2", d - dt.timedelta(3), download_onclick=[ev("p1")])])
    daily.ingest_days(spark, root, facts_root, days, tz="UTC", fmt="parquet")
    return root, facts_root


def test_only_the_folders_asked_for_are_listed(spark, scratch):
    _, root = nine_days(spark, scratch)
    files = read_facts(spark, root, days=[D0], kinds=["install_fin"], fmt="parquet").inputFiles()
    assert files and all(f"/kind=install_fin/dt={D0}/" in f for f in files)
    # clicks: those of the log folder, whatever their day
    clicks = [f for f in daily.stage_facts(spark, root, [D0], fmt="parquet").inputFiles() if "onclick" in f]
    assert all(f"/log_day={D0}/" in f for f in clicks)
    assert {re.search(r"dt=([0-9-]+)", f)[1] for f in clicks} == {str(D0), str(D0 - dt.timedelta(3))}
    assert read_facts(spark, root, days=["2030-01-01"], fmt="parquet").count() == 0


def test_ingest_shuffles_once(spark, scratch):
    from logcube.operators.events import parse_events
    from logcube.sources.raw_logs import read_raw_logs

    logs, _ = nine_days(spark, scratch)
    raw = read_raw_logs(spark, logs, [D0])
    plan = plan_of(parse_events(raw, ["download_fin", "install_fin"], "UTC").hint("rebalance", "kind", "dt"))
    assert plan.count("Exchange") == 1 and "REBALANCE" in plan and "RoundRobin" not in plan


def test_reports_of_a_night_share_the_joined_rows(spark, scratch):
    _, root = nine_days(spark, scratch)
    plans = {}
    daily.report_days(spark, root, catalog_frame(spark), [D0], lambda name, df, days: plans.update({name: plan_of(df)}), fmt="parquet")
    shared = {n for n, p in plans.items() if "InMemoryTableScan" in p}
    assert shared == {
        "app_download_report", "app_install_report", "device_app_download_report_",
        "funnel_app_install_report_macro", "funnel_app_install_report_micro",
    }
