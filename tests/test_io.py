import datetime as dt
import gzip
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from logcube.plans import daily, reports
from logcube.plans.specs import SPECS
from logcube.sources.catalog import jdbc_source, read_catalog_jdbc
from logcube.sources.facts import publish_table, read_facts, unreferenced_runs
from logcube.sources.raw_logs import NoInputError, read_raw_logs
from logcube.sources.sinks import swap_statements, write_report_files, write_report_jdbc
from tests.fixtures import D0, catalog_frame, ms


def write_gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as fh:
        for line in lines:
            fh.write(line if isinstance(line, str) else json.dumps(line))
            fh.write("\n")


def line(uuid, day, hour=12, site="ALI", **data):
    return {"custom_uuid": uuid, "rectime": ms(day, hour), "device_name": "d1", "site": site, "data": data}


def ev(pkg="p1", title="T", time="x"):
    return {"time": time, "package_id": pkg, "title": title}


@pytest.fixture()
def log_root(scratch):
    root = tempfile.mkdtemp(prefix="logs-", dir=scratch)
    prev = D0 - dt.timedelta(1)
    write_gz(
        f"{root}/{D0}/host1/a.gz",
        [
            line("u1", D0, download_fin=[ev("p1"), ev("p2", time=None)], download_onclick=[ev("p1")]),
            line("u2", D0, site=None, install_fin=[ev(None)]),
            line("u3", prev, 23, download_fin=[ev("p1")], download_onclick=[ev("p1")]),  # late row
            "{not json",
        ],
    )
    write_gz(f"{root}/{D0}/host2/b.gz", [line("u4", D0, app_open=[ev("p1")], game_open=[ev(None, "G")])])
    write_gz(f"{root}/{prev}/host1/a.gz", [line("u5", prev, download_fin=[ev("p2")], download_onclick=[ev("p2")])])
    os.makedirs(f"{root}/{D0 + dt.timedelta(1)}/host1")  # a day without .gz files
    with open(f"{root}/{D0 + dt.timedelta(1)}/host1/readme.txt", "w") as fh:
        fh.write("x")
    return root


def test_gzip_json_scan(spark, log_root):
    raw = read_raw_logs(spark, log_root, [D0])
    assert raw.count() == 5
    bad = [r for r in raw.select("rectime", "_corrupt_record").collect() if r["_corrupt_record"] is not None]
    assert len(bad) == 1 and bad[0]["rectime"] is None
    assert {r[0] for r in raw.select("log_date").distinct().collect()} == {D0}
    from logcube.operators.events import parse_events

    facts = parse_events(raw, ["download_fin", "install_fin", "app_open", "game_open", "game_onclick"], tz="UTC")
    kinds = sorted(r["kind"] for r in facts.collect())
    assert kinds == ["app_open", "download_fin", "download_fin", "game_open", "install_fin"]


def test_input_guard(spark, log_root):
    with pytest.raises(NoInputError) as e:
        read_raw_logs(spark, log_root, [D0 + dt.timedelta(1)])
    assert e.value.exit_code == 123
    with pytest.raises(NoInputError):
        read_raw_logs(spark, log_root, ["2030-01-01"])


def test_facts_rerun_is_idempotent_and_pruned(spark, log_root, scratch):
    fact_root = tempfile.mkdtemp(prefix="facts-", dir=scratch)
    for _ in range(2):
        daily.ingest_day(spark, log_root, fact_root, D0, tz="UTC", fmt="parquet")
    daily.ingest_day(spark, log_root, fact_root, D0 - dt.timedelta(1), tz="UTC", fmt="parquet")
    all_rows = read_facts(spark, fact_root, fmt="parquet")
    # D0 run: u1 fin + click, u2 install, u3 late fin + click, u4 2 opens; D0-1 run: u5 fin + click
    assert all_rows.count() == 9
    prev = read_facts(spark, fact_root, days=[D0 - dt.timedelta(1)], kinds=["download_fin"], fmt="parquet")
    assert sorted(r["custom_uuid"] for r in prev.collect()) == ["u3", "u5"]  # late row kept under its event day
    plan = prev._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "dt" in plan


def test_daily_reports_end_to_end(spark, log_root, scratch):
    fact_root = tempfile.mkdtemp(prefix="facts-", dir=scratch)
    out_root = tempfile.mkdtemp(prefix="reports-", dir=scratch)
    for d in (D0 - dt.timedelta(1), D0):
        daily.ingest_day(spark, log_root, fact_root, d, tz="UTC", fmt="parquet")
    written = {}

    def sink(name, df, days):
        written[name] = written.get(name, 0) + 1
        write_report_files(df, f"{out_root}/{name}", days=days)

    for _ in range(2):  # rerun: reports replace their day
        daily.report_days(spark, fact_root, catalog_frame(spark), [D0], sink, fmt="parquet")
    got = spark.read.parquet(f"{out_root}/app_download_report")
    assert got.select("date").distinct().collect()[0][0] == 20240110
    # u1 p1 -> 1 play.  D0-1: the late u3 p1 row and u5 p2, which the
    # catalog lists twice -> 3 plays (duplicates inflate counts, not users).
    total = got.where("id_1 = 15").first()
    assert total["totalPlayCount"] == 1 and total["playCountCompareDay"] == "-66.67%"
    assert total["userCountCompareDay"] == "-50.0%"
    funnel = {r["featureName"]: r["totalPlayCount"] for r in spark.read.parquet(f"{out_root}/funnel_app_install_report").collect()}
    # clicks count on their log day: u1 and the late u3 click; fin/install on the event day
    assert funnel == {"download_onclick": 2, "download_fin": 1, "install_fin": 1}
    assert set(written) >= {"app_download_report", "device_app_download_report", "funnel_app_install_report_micro"}


def test_report_files_replace_by_day(spark, scratch):
    path = tempfile.mkdtemp(prefix="rep-", dir=scratch) + "/r"
    a = spark.createDataFrame([(20240101, 1), (20240102, 2)], "date int, n int")
    write_report_files(a, path)
    write_report_files(spark.createDataFrame([(20240102, 5)], "date int, n int"), path)
    got = sorted((r["date"], r["n"]) for r in spark.read.parquet(path).collect())
    assert got == [(20240101, 1), (20240102, 5)]


def test_jdbc_catalog_and_report_replace(spark):
    url = "jdbc:derby:memory:logcube_test;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    cat = catalog_frame(spark)
    write_report_jdbc(cat, url, "APP_LIST", opts, mode="overwrite")
    write_report_jdbc(cat.where("fsk_pid = 'p1'"), url, "GAME_LIST", opts, mode="overwrite")
    q = "SELECT * FROM APP_LIST UNION ALL SELECT * FROM GAME_LIST"
    got = read_catalog_jdbc(spark, url, q, opts)
    assert got.count() == 5
    rep = spark.createDataFrame([(20240101, "a", 1), (20240102, "b", 2)], "date int, appId string, totalPlayCount long")
    for _ in range(2):
        write_report_jdbc(rep, url, "REPORT", opts, mode="replace")
    again = spark.createDataFrame([(20240102, "b", 7)], "date int, appId string, totalPlayCount long")
    write_report_jdbc(again, url, "REPORT", opts, mode="replace")
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "REPORT").options(**opts).load()
    assert sorted(tuple(r) for r in back.collect()) == [(20240101, "a", 1), (20240102, "b", 7)]


def test_growth_over_fact_table_days(spark, log_root, scratch):
    fact_root = tempfile.mkdtemp(prefix="facts-", dir=scratch)
    for d in (D0 - dt.timedelta(1), D0):
        daily.ingest_day(spark, log_root, fact_root, d, tz="UTC", fmt="parquet")
    facts = read_facts(spark, fact_root, fmt="parquet")
    rep = reports.growth(facts, catalog_frame(spark), SPECS["download_v1"], days=[D0])
    assert {r["date"] for r in rep.collect()} == {20240110}


def test_cli_backfill_end_to_end(spark, log_root, scratch):
    from logcube.plans import cli

    url = "jdbc:derby:memory:logcube_cli;create=true"
    props_path = os.path.join(tempfile.mkdtemp(prefix="props-", dir=scratch), "db.properties")
    with open(props_path, "w") as fh:
        fh.write("# catalog connection\ndriver=org.apache.derby.iapi.jdbc.AutoloadedDriver\n")
    write_report_jdbc(catalog_frame(spark), url, "APPS", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, mode="overwrite")
    fact_root = tempfile.mkdtemp(prefix="facts-", dir=scratch)
    out = tempfile.mkdtemp(prefix="cli-", dir=scratch)
    argv = [
        "backfill", "--first-run-day", str(D0), "--last-run-day", str(D0 + dt.timedelta(1)),
        "--log-root", log_root, "--fact-root", fact_root, "--tz", "UTC",
        "--catalog-url", url, "--catalog-query", "SELECT * FROM APPS", "--catalog-props", props_path,
        "--report-path", out, "--fact-format", "parquet", "--specs", "install_v1,download_v1",
    ]
    cli.main(argv)
    got = spark.read.parquet(f"{out}/app_download_report_v1")
    assert {r["date"] for r in got.select("date").distinct().collect()} == {20240109, 20240110}
    assert spark.read.parquet(f"{out}/funnel_app_install_report").count() > 0


def test_range_ingest_one_job_equals_daily_ingest(spark, log_root, scratch):
    a = tempfile.mkdtemp(prefix="facts-a-", dir=scratch)
    b = tempfile.mkdtemp(prefix="facts-b-", dir=scratch)
    days = [D0 - dt.timedelta(1), D0]
    for d in days:
        daily.ingest_day(spark, log_root, a, d, tz="UTC", fmt="parquet")
    for _ in range(2):  # rerun of the range replaces, does not append
        daily.ingest_days(spark, log_root, b, days, tz="UTC", fmt="parquet")
    fa, fb = read_facts(spark, a, fmt="parquet"), read_facts(spark, b, fmt="parquet")
    assert fa.count() == 9
    fa, fb = fa.drop("run"), fb.drop("run")
    assert fa.exceptAll(fb).count() == 0 and fb.exceptAll(fa).count() == 0


def test_hive_style_day_folders(spark, scratch):
    root = tempfile.mkdtemp(prefix="hlogs-", dir=scratch)
    write_gz(f"{root}/day={D0}/part-0.json.gz", [line("u1", D0, download_fin=[ev()])])
    raw = read_raw_logs(spark, root, [D0], layout="day={day}/*.gz")
    assert [r["log_date"] for r in raw.select("log_date").collect()] == [D0]


def test_cli_exits_123_without_input(spark, log_root, scratch):
    from logcube.plans import cli

    url = "jdbc:derby:memory:logcube_cli2;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    write_report_jdbc(catalog_frame(spark), url, "APPS", opts, mode="overwrite")
    props = os.path.join(tempfile.mkdtemp(prefix="props-", dir=scratch), "p.properties")
    with open(props, "w") as fh:
        fh.write("driver=org.apache.derby.iapi.jdbc.AutoloadedDriver\n")
    argv = [
        "daily", "--run-day", str(D0 + dt.timedelta(2)), "--log-root", log_root,
        "--fact-root", tempfile.mkdtemp(prefix="facts-", dir=scratch), "--tz", "UTC",
        "--catalog-url", url, "--catalog-query", "SELECT * FROM APPS", "--catalog-props", props,
        "--report-path", tempfile.mkdtemp(prefix="out-", dir=scratch),
    ]
    with pytest.raises(SystemExit) as e:
        cli.main(argv)
    assert e.value.code == 123


def test_cluster_defaults_respect_submitted_conf(spark):
    from logcube.plans import cli

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        applied = cli.apply_defaults(spark)
        # the test session was built with spark.sql.shuffle.partitions=8: kept
        assert "spark.sql.shuffle.partitions" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
        assert applied.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "256m"
    finally:
        for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.enabled",
                  "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(k)


def test_empty_ranges(spark, scratch):
    root = tempfile.mkdtemp(prefix="empty-", dir=scratch)
    daily.ingest_days(spark, root, root + "/facts", [], tz="UTC")  # nothing to do, no error
    with pytest.raises(ValueError):
        daily.run_range(spark, root, root + "/facts", catalog_frame(spark), "2024-01-05", "2024-01-01", "UTC", lambda n, d, days: None)


def test_funnel_clicks_count_on_their_folder_day(spark, scratch):
    root = tempfile.mkdtemp(prefix="clogs-", dir=scratch)
    facts_root = tempfile.mkdtemp(prefix="cfacts-", dir=scratch)
    out = tempfile.mkdtemp(prefix="cout-", dir=scratch)
    old = D0 - dt.timedelta(3)
    write_gz(f"{root}/{D0}/h/a.gz", [
        line("u1", D0, download_onclick=[ev("p1")], download_fin=[ev("p1")]),
        line("u2", old, download_onclick=[ev("p1")], download_fin=[ev("p1")]),  # very late rows
    ])
    daily.ingest_days(spark, root, facts_root, [D0], tz="UTC", fmt="parquet")
    daily.report_days(spark, facts_root, catalog_frame(spark), [D0],
                      lambda name, df, days: write_report_files(df, f"{out}/{name}", days=days), fmt="parquet")
    funnel = {r["featureName"]: r["totalPlayCount"] for r in spark.read.parquet(f"{out}/funnel_app_install_report").collect()}
    # both clicks count on the folder day; download_fin counts on its event day (the old one is not d, d-1, d-7)
    assert funnel == {"download_onclick": 2, "download_fin": 1}


def test_funnel_clicks_from_streaming_ingest(spark, scratch):
    from logcube.streaming.ingest import start_ingest

    root = tempfile.mkdtemp(prefix="slogs2-", dir=scratch)
    facts_root = tempfile.mkdtemp(prefix="sfacts2-", dir=scratch)
    out = tempfile.mkdtemp(prefix="sout2-", dir=scratch)
    write_gz(f"{root}/{D0}/h/a.gz", [
        line("u1", D0, download_onclick=[ev("p1")]),
        line("u2", D0 - dt.timedelta(3), download_onclick=[ev("p1")]),
    ])
    write_gz(f"{root}/{D0 - dt.timedelta(1)}/h/a.gz", [line("u3", D0 - dt.timedelta(1), download_onclick=[ev("p1")])])
    start_ingest(spark, root, facts_root, tempfile.mkdtemp(prefix="sck2-", dir=scratch), tz="UTC", fmt="parquet").awaitTermination(300)
    daily.report_days(spark, facts_root, catalog_frame(spark), [D0],
                      lambda name, df, days: write_report_files(df, f"{out}/{name}", days=days), fmt="parquet")
    funnel = {r["featureName"]: r["totalPlayCount"] for r in spark.read.parquet(f"{out}/funnel_app_install_report").collect()}
    assert funnel == {"download_onclick": 2}


def test_jdbc_append_duplicates_like_the_reference(spark):
    url = "jdbc:derby:memory:logcube_append;create=true"
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rep = spark.createDataFrame([(20240101, "a", 1)], "date int, appId string, totalPlayCount long")
    for _ in range(2):
        write_report_jdbc(rep, url, "APPENDED", opts, mode="append")
    back = spark.read.format("jdbc").option("url", url).option("dbtable", "APPENDED").options(**opts).load()
    assert back.count() == 2  # a rerun doubles the day (H5); mode="replace" keeps one copy


def facts_of(spark, fact_root):
    return sorted((r.custom_uuid, r.kind, str(r.date)) for r in read_facts(spark, fact_root, fmt="parquet").collect())


def test_ingesting_a_day_again_replaces_all_of_it(spark, scratch):
    root, again = (tempfile.mkdtemp(prefix="rlogs-", dir=scratch) for _ in range(2))
    fact_root = tempfile.mkdtemp(prefix="rfacts-", dir=scratch)
    nxt = D0 + dt.timedelta(1)
    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, 20, download_fin=[ev()]), line("u1", D0, 20, app_open=[ev()])])
    write_gz(f"{root}/{nxt}/h/a.gz", [line("u2", nxt, download_fin=[ev()])])
    daily.ingest_days(spark, root, fact_root, [D0, nxt], tz="UTC", fmt="parquet")
    # the corrected log has fewer kinds, and another zone moves the event's day
    write_gz(f"{again}/{D0}/h/a.gz", [line("u1", D0, 20, download_fin=[ev()])])
    daily.ingest_days(spark, again, fact_root, [D0], tz="Asia/Shanghai", fmt="parquet")
    assert facts_of(spark, fact_root) == [("u1", "download_fin", str(nxt)), ("u2", "download_fin", str(nxt))]
    # a day without events any more is empty
    write_gz(f"{again}/{nxt}/h/a.gz", [line("u2", nxt)])
    daily.ingest_day(spark, again, fact_root, nxt, tz="UTC", fmt="parquet")
    assert facts_of(spark, fact_root) == [("u1", "download_fin", str(nxt))]
    assert len(unreferenced_runs(spark, fact_root)) == 1


def test_stream_and_day_ingest_count_a_file_once(spark, scratch):
    from logcube.streaming.ingest import start_ingest

    root, fact_root = (tempfile.mkdtemp(prefix="xlogs-", dir=scratch) for _ in range(2))

    def stream():
        checkpoint = tempfile.mkdtemp(prefix="xck-", dir=scratch)  # a new one each time
        start_ingest(spark, root, fact_root, checkpoint, tz="UTC", fmt="parquet").awaitTermination(300)

    write_gz(f"{root}/{D0}/h/a.gz", [line("u1", D0, download_fin=[ev()])])
    daily.ingest_day(spark, root, fact_root, D0, tz="UTC", fmt="parquet")
    stream()
    assert facts_of(spark, fact_root) == [("u1", "download_fin", str(D0))]
    write_gz(f"{root}/{D0}/h/b.gz", [line("u2", D0, download_fin=[ev()])])
    stream()
    stream()
    both = [("u1", "download_fin", str(D0)), ("u2", "download_fin", str(D0))]
    assert facts_of(spark, fact_root) == both
    daily.ingest_day(spark, root, fact_root, D0, tz="UTC", fmt="parquet")
    assert facts_of(spark, fact_root) == both


def test_any_number_is_a_rectime_and_bad_lines_are_kept(spark, scratch):
    root, fact_root = (tempfile.mkdtemp(prefix="blogs-", dir=scratch) for _ in range(2))
    t = ms(D0)
    forms = [t, str(t), float(t), t + 0.5, "soon", None]
    lines = [{"custom_uuid": f"u{i}", "rectime": x, "data": {"app_open": [ev()]}} for i, x in enumerate(forms)]
    write_gz(f"{root}/{D0}/h/a.gz", [*lines, '{"custom_uuid": "cut'])
    counts = daily.ingest_day(spark, root, fact_root, D0, tz="UTC", fmt="parquet")
    assert counts == {"lines": 7, "corrupt": 1, "undated": 2}
    dated = read_facts(spark, fact_root, days=[D0], fmt="parquet")
    assert sorted(r.custom_uuid for r in dated.collect()) == ["u0", "u1", "u2", "u3"]
    bad = spark.read.parquet(f"{fact_root}/bad_lines").collect()
    assert sorted(r.reason for r in bad) == ["corrupt", "undated", "undated"]
    assert {r.line for r in bad if r.reason == "corrupt"} == {'{"custom_uuid": "cut'}
    assert any('"soon"' in r.line for r in bad)


def test_an_empty_rerun_empties_the_report_day(spark, scratch):
    path = tempfile.mkdtemp(prefix="rep2-", dir=scratch) + "/r"
    rows = spark.createDataFrame([(20240101, 1), (20240102, 2)], "date int, n int")
    write_report_files(rows, path)
    write_report_files(rows.where("date = 0"), path, days=[dt.date(2024, 1, 2), "2024-01-03"])
    assert [(r["date"], r["n"]) for r in spark.read.parquet(path).collect()] == [(20240101, 1)]


def test_specs_never_share_a_target():
    assert len(set(daily.GROWTH_TARGETS.values())) == len(SPECS)
    specs = [SPECS["download_v1"], SPECS["download_v2"]]
    assert daily.growth_targets(specs) == {"download_v1": "app_download_report_v1", "download_v2": "app_download_report"}
    assert daily.growth_targets(specs[1:], trial=True) == {"download_v2": "app_download_report_"}
    with pytest.raises(ValueError):
        daily.growth_targets([SPECS["open_v2"]] * 2)


def test_swap_statements_and_sub_query_source():
    statements = swap_statements("R", "R_s", ["date", "n"], "date", [20240101, 20240102], lambda c: f'"{c}"')
    assert statements == [
        'DELETE FROM R WHERE "date" IN (SELECT "date" FROM R_s)',
        'DELETE FROM R WHERE "date" IN (20240101, 20240102)',
        'INSERT INTO R ("date", "n") SELECT "date", "n" FROM R_s',
    ]
    assert len(swap_statements("R", "R_s", ["date"], "date", None, str)) == 2
    assert jdbc_source("select 1") == {"query": "select 1"}
    parted = jdbc_source("select * from a", ("id", 0, 100, 8))
    assert parted["dbtable"] == "(select * from a) catalog" and "query" not in parted and parted["numPartitions"] == "8"


def test_published_table_has_the_folders_in_force(spark, scratch, log_root):
    fact_root = tempfile.mkdtemp(prefix="pfacts-", dir=scratch)
    for _ in range(2):
        daily.ingest_day(spark, log_root, fact_root, D0, tz="UTC", fmt="parquet")
        publish_table(spark, fact_root, "published_facts", fmt="parquet")
    rows = spark.sql("SELECT kind, count(*) AS n FROM published_facts GROUP BY kind").collect()
    want = read_facts(spark, fact_root, fmt="parquet").groupBy("kind").count().collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in want}
    spark.sql("DROP TABLE published_facts")


def test_pre_aggregated_and_shared_reports_are_the_same(spark, log_root, scratch):
    fact_root = tempfile.mkdtemp(prefix="facts-", dir=scratch)
    days = [D0 - dt.timedelta(1), D0]
    daily.ingest_days(spark, log_root, fact_root, days, tz="UTC", fmt="parquet")
    got = []
    for pre in (False, True):
        found = {}
        daily.report_days(spark, fact_root, catalog_frame(spark), days, lambda name, df, _: found.update({name: sorted(map(str, df.collect()))}), fmt="parquet", pre_aggregate=pre)
        got.append(found)
    assert got[0] == got[1] and all(k in got[0] for k in ("app_open_report", "funnel_app_install_report_macro"))
