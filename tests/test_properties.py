"""Property tests on random small fact sets: the window growth equals the
reference's null-safe self-join form, and counts add up across sets."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logcube.operators.cube import rollup_counts
from logcube.operators.growth import with_lags
from logcube.plans.specs import SPECS
from tests.fixtures import fact, facts_frame

DAY0 = dt.date(2024, 1, 1)

fact_rows = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3", None]),
        st.integers(0, 12),
        st.sampled_from(["p1", "p2", None]),
        st.sampled_from(["A", None]),
        st.sampled_from(["youku", "others"]),
    ),
    min_size=1,
    max_size=40,
)


def frame(spark, data):
    rows = [fact(u, DAY0 + dt.timedelta(d), p, t, s) for u, d, p, t, s in data]
    return facts_frame(spark, rows).withColumn("fsk_catalog", F.when(F.col("package_id") == "p1", "g"))


def selfjoin(cube, keys, n, measure):
    prev = cube.select(
        *[F.col(k).alias(f"_p_{k}") for k in keys],
        F.col("id_1").alias("_p_id"),
        F.col("date").alias("_p_date"),
        F.col(measure).alias("_p_m"),
    )
    cond = [cube[k].eqNullSafe(prev[f"_p_{k}"]) for k in keys]
    cond += [cube["id_1"] == prev["_p_id"], prev["_p_date"] == F.date_sub(cube["date"], n)]
    return cube.join(prev, cond, "left").select(*cube.columns, F.col("_p_m").alias(f"{measure}_prev{n}"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=fact_rows)
def test_window_lags_equal_selfjoin(spark, data):
    spec = SPECS["download_v2"]
    cube = rollup_counts(frame(spark, data), spec.keys, spec.grouping_sets)
    cols = cube.columns + ["users_prev1", "avgPlayNum_prev7"]
    w = with_lags(cube, spec.keys).select(*cols)
    j = selfjoin(selfjoin(cube, spec.keys, 1, "users"), spec.keys, 7, "avgPlayNum").select(*cols)
    assert w.exceptAll(j).count() == 0 and j.exceptAll(w).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=fact_rows)
def test_each_set_partitions_the_rows(spark, data):
    spec = SPECS["download_v2"]
    cube = rollup_counts(frame(spark, data), spec.keys, spec.grouping_sets)
    per_set = cube.groupBy("date", "id_1").agg(F.sum("playNum").alias("n"))
    spread = per_set.groupBy("date").agg(F.countDistinct("n").alias("k")).where("k > 1")
    assert spread.count() == 0
    expected = {}
    for u, d, *_ in data:
        expected[DAY0 + dt.timedelta(d)] = expected.get(DAY0 + dt.timedelta(d), 0) + (u is not None)
    totals = {r["date"]: r["playNum"] for r in cube.where("id_1 = 15").collect()}
    assert totals == expected
