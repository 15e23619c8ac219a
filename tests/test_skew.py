"""Hot keys: a package holding a third of all rows must give the same
reports through every join strategy, and the exact-distinct phase must
spread a hot group by user id."""

import re

from pyspark.sql import functions as F

from logcube.operators.cube import rollup_counts
from logcube.plans import reports
from logcube.plans.specs import SPECS
from logcube.sources import bridge

SF = "/root/testdata/sf0.001"


def hot_facts(spark):
    facts = bridge.facts(spark, SF)
    n = facts.count()
    # add copies of existing rows re-pointed at package "7" until it holds ~1/3
    hot = facts.limit(n // 2).withColumn("package_id", F.lit("7")).withColumn("source", F.lit(1))
    return facts.unionByName(hot)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_package_same_report_broadcast_or_salted(spark):
    facts, cat = hot_facts(spark), bridge.catalog(spark, SF)
    share = facts.where("package_id = '7'").count() / facts.count()
    assert share > 0.3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("install_v2", "open_v2"):
            b = reports.growth(facts, cat, SPECS[name], broadcast=True)
            s = reports.growth(facts, cat, SPECS[name], broadcast=False)
            assert "SortMergeJoin" in s._jdf.queryExecution().executedPlan().toString()
            assert same(b, s), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_distinct_phase_hashes_on_user(spark):
    def cube(name):
        return reports.cube(bridge.facts(spark, SF), bridge.catalog(spark, SF), SPECS[name])

    assert any("custom_uuid" in k and "spark_grouping_id" in k for k in exchanges(cube("open_v1")))
    # Of a lattice: events on the whole tuple, so neither a user's nor an app's go to one task.
    assert any("custom_uuid" in k and "package_id" in k and "site" in k for k in exchanges(cube("open_v2")))


def test_a_hot_user_is_few_rows_where_users_meet(spark):
    """Half of all events are one user's, over every app: by (date, user) there is
    one row per channel, source and category."""
    facts, cat = bridge.facts(spark, SF), bridge.catalog(spark, SF)
    bot = facts.withColumn("custom_uuid", F.lit("bot"))
    facts, spec = facts.unionByName(bot), SPECS["open_v2"]
    rich = reports.enriched_for(facts, cat, spec)
    top = rich.where("custom_uuid = 'bot'").groupBy("date").agg(F.count("*").alias("events"), F.count_distinct("source", "site", "fsk_catalog").alias("rows"))
    sums = top.agg(F.sum("events"), F.max("rows")).first()
    dims = rich.agg(F.count_distinct("source"), F.count_distinct("site"), F.count_distinct("fsk_catalog")).first()
    assert sums[0] > 300 and sums[1] <= dims[0] * dims[1] * (dims[2] + 1)
    a = rollup_counts(rich, spec.keys, spec.grouping_sets, lattice=True)
    assert same(a, rollup_counts(rich, spec.keys, spec.grouping_sets, lattice=False))
