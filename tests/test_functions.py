import datetime as dt

from pyspark.sql import functions as F

from logcube.functions import scalar as S
from tests.fixtures import ms


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_channel_map_codes_unmapped_and_null(spark):
    df = spark.createDataFrame([("ALI",), ("IQIYI",), ("BESTV",), ("OTHER",), (None,)], "site string")
    got = [r[0] for r in df.select(S.channel_of("site")).collect()]
    assert got == ["youku", "iqiyi", "bestv", "others", "others"]


def test_channel_map_custom(spark):
    df = spark.createDataFrame([("X",), ("Y",)], "site string")
    got = [r[0] for r in df.select(S.channel_of("site", {"X": "x-tv"})).collect()]
    assert got == ["x-tv", "others"]


def test_local_date_ignores_session_zone(spark):
    # 2024-01-09 20:30 UTC is 2024-01-10 04:30 in Shanghai.
    t = ms(dt.date(2024, 1, 9), 20, 30)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, S.local_date(F.lit(t), "UTC")) == dt.date(2024, 1, 9)
            assert one(spark, S.local_date(F.lit(t), "Asia/Shanghai")) == dt.date(2024, 1, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_near_midnight(spark):
    t = ms(dt.date(2024, 1, 9), 23, 59) + 59_999
    assert one(spark, S.local_date(F.lit(t), "UTC")) == dt.date(2024, 1, 9)
    assert one(spark, S.local_date(F.lit(t + 1), "UTC")) == dt.date(2024, 1, 10)


def test_date_key_and_dt(spark):
    d = F.lit(dt.date(2024, 3, 5))
    assert one(spark, S.date_key(d)) == 20240305
    assert one(spark, S.dt_string(d)) == "2024-03-05"


def test_source_flag(spark):
    df = spark.createDataFrame([("p",), (None,)], "p string")
    assert [r[0] for r in df.select(S.source_flag("p")).collect()] == [1, 0]


def test_safe_ratio_and_ties(spark):
    assert one(spark, S.safe_ratio(F.lit(0), F.lit(0))) is None
    assert one(spark, S.safe_ratio(F.lit(41), F.lit(40))) == 1.03
    assert one(spark, S.safe_ratio(F.lit(51), F.lit(40))) == 1.28


def test_pct_change_text(spark):
    assert one(spark, S.pct_change_text(F.lit(5), F.lit(4))) == "25.0%"
    assert one(spark, S.pct_change_text(F.lit(1), F.lit(3))) == "-66.67%"
    assert one(spark, S.pct_change_text(F.lit(5), F.lit(0))) is None
    assert one(spark, S.pct_change_text(F.lit(5), F.lit(None).cast("bigint"))) is None


def test_ratio_change(spark):
    assert one(spark, S.ratio_change(F.lit(5), F.lit(4))) == 0.25
    assert one(spark, S.ratio_change(F.lit(2), F.lit(3))) == -0.3333


def test_log_date_of_path_takes_last_day_folder(spark):
    from logcube.sources.raw_logs import log_date_of_path

    df = spark.createDataFrame(
        [
            ("file:/data/2024-01-01/h/a.gz",),
            ("file:/arch/2023-12-31/data/2024-01-02/h/a.gz",),
            ("file:/logs/day=2024-01-03/part-0.json.gz",),
            ("file:/logs/nodate/a.gz",),
        ],
        "p string",
    )
    got = [r[0] for r in df.select(log_date_of_path(F.col("p")).cast("string")).collect()]
    assert got == ["2024-01-01", "2024-01-02", "2024-01-03", None]


def test_log_date_of_path_has_one_short_pattern(spark):
    """It is taken for every line: one search, and none through the file name."""
    from logcube.sources.raw_logs import log_date_of_path

    paths = ["/d/2024-01-01/2024-01-02", "/2024-01-01//x", "/d/a=b=2024-01-01/x", "/d/=2024-01-01/x", "2024-01-01/x", "/d/2024-01-01x/y", "/d/2024-01-01/", "x", "", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(log_date_of_path(F.col("p")).cast("string").alias("d"))
    assert [r.d for r in df.collect()] == ["2024-01-01", "2024-01-01"] + [None] * 8
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") == 1 and "regexp_extract(p#" not in plan
