import datetime as dt

from pyspark.sql import functions as F

from logcube.operators.events import explode_kinds, parse_events
from tests.conftest import rows
from tests.fixtures import D0, ev, ms, raw_frame, raw_line


def lines(spark):
    return raw_frame(
        spark,
        [
            raw_line("u1", ms(D0), "ALI", download_fin=[ev("t1", "p1", "A"), ev(None, "p9", "dropped")]),
            raw_line("u2", ms(D0), None, download_fin=[], install_fin=[ev("t2", None, "B")]),
            raw_line("u3", ms(D0), "BESTV", download_fin=None, app_open=[ev("t3", "p3", "C")], game_open=[ev("t4", None, "D")]),
            raw_line(None, ms(D0, 0, 5), "XX", download_fin=[ev("t5", "123", "E")]),
        ],
    )


def test_explode_drops_null_empty_and_timeless(spark):
    out = explode_kinds(lines(spark), ["download_fin"])
    assert rows(out, ["custom_uuid", "package_id", "title"]) == [("u1", "p1", "A"), (None, "123", "E")]


def test_one_scan_many_kinds(spark):
    out = explode_kinds(lines(spark), ["download_fin", "install_fin", "app_open", "game_open"])
    assert rows(out, ["kind", "title"]) == [
        ("app_open", "C"),
        ("download_fin", "A"),
        ("download_fin", "E"),
        ("game_open", "D"),
        ("install_fin", "B"),
    ]


def test_parse_events_columns(spark):
    out = parse_events(lines(spark), ["app_open", "game_open"], tz="UTC")
    got = rows(out, ["kind", "site", "package_id", "source", "date", "dt"])
    assert got == [
        ("app_open", "bestv", "p3", 1, D0, "2024-01-10"),
        ("game_open", "bestv", None, 0, D0, "2024-01-10"),
    ]


def test_parse_events_site_null_and_unmapped(spark):
    out = parse_events(lines(spark), ["install_fin", "download_fin"], tz="UTC")
    assert sorted(r["site"] for r in out.collect()) == ["others", "others", "youku"]


def test_parse_event_day_in_zone(spark):
    late = raw_frame(spark, [raw_line("u", ms(D0, 23, 30), "ALI", download_fin=[ev()])])
    assert parse_events(late, ["download_fin"], tz="UTC").first()["date"] == D0
    assert parse_events(late, ["download_fin"], tz="Asia/Shanghai").first()["date"] == D0 + dt.timedelta(1)


def test_parse_log_date(spark):
    raw = raw_frame(spark, [raw_line("u", ms(D0 - dt.timedelta(1), 23), "ALI", download_onclick=[ev()])])
    raw = raw.withColumn("log_date", F.lit(D0))
    ev_day = parse_events(raw, ["download_onclick"], tz="UTC").first()
    log_day = parse_events(raw, ["download_onclick"], tz="UTC", date_from="log").first()
    assert ev_day["date"] == D0 - dt.timedelta(1) and ev_day["log_date"] == D0
    assert log_day["date"] == D0


def test_kind_missing_from_schema_gives_no_rows(spark):
    from pyspark.sql import types as T

    from logcube.schemas import EVENT, raw_log_schema

    schema = raw_log_schema(kinds=("download_fin",))
    assert [f.name for f in schema["data"].dataType.fields] == ["download_fin"]
    raw = spark.createDataFrame([("u", None, 1, "d", None, None, "ALI", ([("t", "p", "x")],))], schema)
    assert explode_kinds(raw, ["install_fin"]).count() == 0
    assert explode_kinds(raw, ["install_fin", "download_fin"]).count() == 1
    assert parse_events(raw, ["app_open"], tz="UTC").count() == 0
    assert isinstance(EVENT, T.StructType)
