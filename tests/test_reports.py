import datetime as dt

from pyspark.sql import functions as F

from logcube.operators.funnel import DETAIL_STAGE, LIVE_STAGES
from logcube.plans import backfill, reports
from logcube.plans.specs import SPECS
from logcube.sources import bridge

SF = "/root/testdata/sf0.001"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_one_pass_backfill_equals_single_day_runs(spark):
    facts, cat = bridge.facts(spark, SF), bridge.catalog(spark, SF)
    spec = SPECS["install_v2"]
    start, end = dt.date(2024, 1, 9), dt.date(2024, 1, 13)
    one_pass = backfill.backfill_growth(facts, cat, spec, start=start, end=end)
    loop = None
    for i in range((end - start).days + 1):
        d = start + dt.timedelta(i)
        one = reports.growth(facts, cat, spec, days=[d])
        loop = one if loop is None else loop.unionByName(one)
    assert one_pass.count() > 0
    assert same(one_pass, loop)
    # and both equal the slice of the all-days report
    full = reports.growth(facts, cat, spec).where(F.col("date").between(20240109, 20240113))
    assert same(one_pass, full)


def test_restrict_days_reads_lag_days_only(spark):
    facts = bridge.facts(spark, SF)
    got = {r[0] for r in reports.restrict_days(facts, days=[dt.date(2024, 1, 20)], lookback=(1, 7)).select("date").distinct().collect()}
    assert got == {dt.date(2024, 1, 20), dt.date(2024, 1, 19), dt.date(2024, 1, 13)}


def test_run_days_to_report_days():
    assert backfill.run_days_to_report_days("2019-01-02", "2019-04-17") == (dt.date(2019, 1, 1), dt.date(2019, 4, 16))


def test_funnel_stages(spark):
    facts = bridge.facts(spark, SF)
    three = reports.funnel(facts)
    assert {r["featureName"] for r in three.collect()} == {s for s, _ in LIVE_STAGES}
    four = reports.funnel(facts, stages=((DETAIL_STAGE[0], ("app_open", "game_open")), *LIVE_STAGES))
    assert four.count() == three.count() + three.select("date").distinct().count()


def test_stage_listed_twice(spark):
    facts = bridge.facts(spark, SF)
    stages = (("a", ("download_fin",)), ("b", ("download_fin", "install_fin")))
    out = {(r["date"], r["featureName"]): r["totalPlayCount"] for r in reports.funnel(facts, stages=stages).collect()}
    base = {(r["date"], r["featureName"]): r["totalPlayCount"] for r in reports.funnel(facts).collect()}
    d = 20240105
    assert out[(d, "a")] == base[(d, "download_fin")]
    assert out[(d, "b")] == base[(d, "download_fin")] + base[(d, "install_fin")]


def test_devices(spark):
    facts = bridge.facts(spark, SF)
    plain = reports.devices(facts)
    roll = reports.devices_rollup(facts, bridge.catalog(spark, SF))
    assert {r["id_1"] for r in roll.collect()} == {0, 1, 2, 3}
    # id 3 is (date, device) only: rows multiplied by catalog duplicates
    r3 = roll.where("id_1 = 3").agg(F.sum("totalPlayCount")).first()[0]
    assert r3 >= plain.agg(F.sum("totalPlayCount")).first()[0]


def test_sql_growth_equals_dataframe_growth(spark):
    from logcube.plans.sql_reports import growth_sql

    facts, cat = bridge.facts(spark, SF), bridge.catalog(spark, SF)
    for name, fmt in (("open_v2", "percent"), ("download_v1", "ratio")):
        spec = SPECS[name]
        df = reports.growth(facts, cat, spec, fmt=fmt)
        sql = growth_sql(spark, reports.enriched_for(facts, cat, spec), spec, fmt=fmt)
        assert df.columns == sql.columns and df.dtypes == sql.dtypes
        assert same(df, sql), name
