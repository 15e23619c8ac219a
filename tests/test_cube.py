import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logcube.operators.cube import grouping_number, plan_lattice, rollup_counts
from logcube.plans.specs import SPECS
from tests.fixtures import D0, fact, facts_frame

EXPECTED_IDS = {
    "download_v1": {0, 15},
    "download_v2": {0, 12, 13, 14, 15},
    "open_v1": {0, 31},
    "open_v2": {0, 24, 25, 26, 27, 28, 29, 30, 31},
    "open_hybrid": {0, 31},
}


def frame(spark):
    rows = [
        fact("u1", D0, "p1", "A", "youku"),
        fact("u1", D0, "p1", "A", "youku"),
        fact("u2", D0, "p1", "A", "youku"),
        fact("u2", D0, "p2", "B", "iqiyi"),
        fact(None, D0, "p3", "C", "bestv"),  # all ids NULL in this group
        fact("u3", D0 - dt.timedelta(1), None, None, "others"),
    ]
    return facts_frame(spark, rows).withColumn("fsk_cid", F.lit("c")).withColumn("fsk_catalog", F.col("site"))


def test_grouping_ids_match_reference(spark):
    df = frame(spark)
    for name, ids in EXPECTED_IDS.items():
        spec = SPECS[name]
        out = rollup_counts(df, spec.keys, spec.grouping_sets)
        assert {r["id_1"] for r in out.collect()} == ids, name


def test_measures_and_zero_users(spark):
    spec = SPECS["download_v1"]
    out = {(r["date"], r["package_id"], r["id_1"]): r for r in rollup_counts(frame(spark), spec.keys, spec.grouping_sets).collect()}
    p1 = out[(D0, "p1", 0)]
    assert (p1["playNum"], p1["users"], p1["avgPlayNum"]) == (3, 2, 1.5)
    p3 = out[(D0, "p3", 0)]
    assert (p3["playNum"], p3["users"], p3["avgPlayNum"]) == (0, 0, None)
    total = out[(D0, None, 15)]
    assert (total["playNum"], total["users"]) == (4, 2)
    assert out[(D0 - dt.timedelta(1), None, 15)]["playNum"] == 1


def test_detail_counts_sum_to_total(spark):
    spec = SPECS["open_v2"]
    out = rollup_counts(frame(spark), spec.keys, spec.grouping_sets)
    by = out.groupBy("date", "id_1").agg(F.sum("playNum").alias("n")).collect()
    sums = {}
    for r in by:
        sums.setdefault(r["date"], set()).add(r["n"])
    assert all(len(v) == 1 for v in sums.values())  # every set partitions the rows


def test_pre_aggregate_is_identical(spark):
    for name in ("download_v2", "open_v2"):
        spec = SPECS[name]
        a = rollup_counts(frame(spark), spec.keys, spec.grouping_sets)
        b = rollup_counts(frame(spark), spec.keys, spec.grouping_sets, pre_aggregate=True)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert a.dtypes == b.dtypes


def test_sql_form_equals_dataframe_form(spark):
    from logcube.plans.sql_reports import cube_sql

    for name in ("download_v1", "open_v2"):
        spec = SPECS[name]
        a = rollup_counts(frame(spark), spec.keys, spec.grouping_sets)
        b = cube_sql(spark, frame(spark), spec)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_input_gives_no_rows(spark):
    spec = SPECS["install_v2"]
    empty = frame(spark).where("false")
    assert rollup_counts(empty, spec.keys, spec.grouping_sets).count() == 0


def test_lattice_is_planned_from_the_sets():
    spec = SPECS["open_v2"]
    top = ("source", "site", "fsk_catalog")
    assert plan_lattice(spec.grouping_sets, spec.keys) == {top: [tuple(k for k in spec.keys if k in s) for s in spec.grouping_sets[1:]]}
    assert plan_lattice([["a", "b", "c"], ["a", "b"], ["c"], ["b"], []], "abc") == {("a", "b"): [("a", "b"), ("b",)], ("c",): [("c",), ()]}
    assert plan_lattice([["b", "a"], []], ["a", "b"]) == {(): [()]}
    assert [grouping_number(s, "abc") for s in ("abc", "ab", "c", "")] == [0, 1, 6, 7]


SETS = [
    [["a", "b", "c"], ["a", "b"], ["b", "c"], ["a"], []],
    [["a", "b"], ["c"], ["b"]],  # no detail, two tops
    [["a", "b", "c"], []],
    [[]],
    [["a", "b", "c"]],
]


@pytest.mark.parametrize("sets", SETS)
@pytest.mark.parametrize("weight", [None, "events"])
def test_lattice_equals_the_expansion_and_plain_counting(spark, sets, weight):
    rng = random.Random(len(sets))
    users = [None, "bot", "bot", "bot", *[f"u{i}" for i in range(20)]]  # one user has many rows
    rows = [(D0 - dt.timedelta(rng.randint(0, 2)), rng.choice([None, "x", "y"]), rng.choice([None, 0, 1]), rng.choice("pqr"), rng.choice(users), rng.randint(1, 3)) for _ in range(600)]
    df = spark.createDataFrame(rows, "date date, a string, b int, c string, custom_uuid string, events int")
    a, b = (rollup_counts(df, ["a", "b", "c"], sets, lattice=x, weight=weight) for x in (True, False))
    assert a.dtypes == b.dtypes
    got, expanded = (sorted(map(str, x.collect())) for x in (a, b))
    want = []
    for s in sets:
        plays, seen = Counter(), {}
        for day, x, y, z, user, n in rows:
            values = {"a": x, "b": y, "c": z}
            group = (day, *[values[k] if k in s else None for k in "abc"], grouping_number(s, "abc"))
            seen.setdefault(group, set())
            if user is not None:
                plays[group] += n if weight else 1
                seen[group].add(user)
        want += [(*g, plays[g], len(u)) for g, u in seen.items()]
    assert got == expanded
    assert sorted(map(str, [tuple(r)[:-1] for r in a.collect()])) == sorted(map(str, want))
