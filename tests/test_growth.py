import datetime as dt

from pyspark.sql import functions as F

from logcube.functions.scalar import pct_change_text
from logcube.operators.cube import rollup_counts
from logcube.operators.growth import growth_report, with_lags
from logcube.plans.specs import SPECS
from tests.fixtures import D0, fact, facts_frame

DAY = dt.timedelta(days=1)


def frame(spark):
    r = []
    r += [fact("u1", D0, "all3")] * 5 + [fact("u1", D0 - DAY, "all3")] * 4 + [fact("u1", D0 - 7 * DAY, "all3")] * 2
    r += [fact("u1", D0, "today")]
    r += [fact("u1", D0 - DAY, "yesterday")]
    r += [fact("u1", D0 - 7 * DAY, "weekago"), fact("u2", D0, "weekago")]
    r += [fact(None, D0 - DAY, "zero"), fact("u9", D0, "zero")]  # previous day has 0 users
    r += [fact("u1", D0, None, None), fact("u2", D0 - DAY, None, None)]  # real NULL package
    df = facts_frame(spark, r).withColumn("fsk_cid", F.lit("c"))
    return df


def cube(spark):
    spec = SPECS["download_v1"]
    return rollup_counts(frame(spark), spec.keys, spec.grouping_sets)


def selfjoin_lags(cube, keys, n):
    """The reference's form: null-safe left join to the cube n days back."""
    prev = cube.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col("id_1").alias("_p_id"), F.col("date").alias("_p_date"), F.col("playNum").alias("_p_play"))
    cond = [cube[k].eqNullSafe(prev[f"_p_{k}"]) for k in keys] + [cube["id_1"] == prev["_p_id"], prev["_p_date"] == F.date_sub(cube["date"], n)]
    return cube.join(prev, cond, "left").select(*cube.columns, F.col("_p_play").alias(f"playNum_prev{n}"))


def test_window_equals_selfjoin(spark):
    spec = SPECS["download_v1"]
    c = cube(spark)
    w = with_lags(c, spec.keys).select(*c.columns, "playNum_prev1", "playNum_prev7")
    j1 = selfjoin_lags(c, spec.keys, 1)
    j = selfjoin_lags(j1, spec.keys, 7).select(*c.columns, "playNum_prev1", "playNum_prev7")
    assert w.exceptAll(j).count() == 0 and j.exceptAll(w).count() == 0


def test_presence_cases(spark):
    spec = SPECS["download_v1"]
    rep = growth_report(cube(spark), spec.keys, spec.key_names).where(F.col("_day") == D0)
    got = {(r["appId"], r["id_1"]): r for r in rep.collect()}
    all3 = got[("all3", 0)]
    assert (all3["totalPlayCount"], all3["playCountCompareDay"], all3["playCountCompareWeek"]) == (5, "25.0%", "150.0%")
    assert got[("today", 0)]["playCountCompareDay"] is None
    assert ("yesterday", 0) not in got  # a key gone today yields no row
    wk = got[("weekago", 0)]
    assert wk["playCountCompareDay"] is None and wk["playCountCompareWeek"] == "0.0%"
    assert got[("zero", 0)]["userCountCompareDay"] is None  # previous users = 0
    assert got[("zero", 0)]["playCountCompareDay"] is None  # previous plays = 0
    null_pkg = got[(None, 0)]  # real NULL key, compared with yesterday's real NULL key
    assert null_pkg["playCountCompareDay"] == "0.0%"
    total = got[(None, 15)]  # rolled-up NULL, kept apart by id_1
    assert total["totalPlayCount"] == 9


def test_average_growth_uses_rounded_averages(spark):
    # today 41 plays / 40 users -> 1.03 (rounded half-up); yesterday 1.0
    r = [fact(f"u{i}", D0, "p") for i in range(40)] + [fact("u0", D0, "p")]
    r += [fact("v", D0 - DAY, "p")]
    df = facts_frame(spark, r).withColumn("fsk_cid", F.lit("c"))
    spec = SPECS["download_v1"]
    rep = growth_report(rollup_counts(df, spec.keys, spec.grouping_sets), spec.keys, spec.key_names)
    row = rep.where((F.col("_day") == D0) & (F.col("id_1") == 0)).first()
    assert row["averagePlayCount"] == 1.03
    assert row["avgPlayCountCompareDay"] == spark.range(1).select(pct_change_text(F.lit(1.03), F.lit(1.0))).first()[0] == "3.0%"


def test_ratio_format(spark):
    spec = SPECS["download_v1"]
    rep = growth_report(cube(spark), spec.keys, spec.key_names, fmt="ratio").where(F.col("_day") == D0)
    all3 = rep.where((F.col("appId") == "all3") & (F.col("id_1") == 0)).first()
    assert (all3["playCountCompareDay"], all3["playCountCompareWeek"]) == (0.25, 1.5)
    assert dict(rep.dtypes)["playCountCompareDay"] == "double"
