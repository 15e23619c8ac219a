import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logcube.llm.exact_dedup import exact_dedup
from tests.llm.conftest import AWKWARD, SF


def expected(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    return out


def in_order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [4096, 64, 7])
def test_groups_are_the_equal_texts(spark, block):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = exact_dedup(docs, block_bytes=block).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert in_order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == in_order(expected(rows))
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert len({(r.n_bytes, r.level, r.name) for r in got}) == len({t or "" for _, t in rows})


def test_awkward_rows(awkward, empty):
    got = exact_dedup(awkward, block_bytes=16).collect()
    assert in_order((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == in_order(expected([r[:2] for r in AWKWARD]))
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({t or "" for _, t, *_ in AWKWARD})  # one of the repeated rows
    assert exact_dedup(empty).count() == 0


def test_blocks_that_share_a_key_get_new_keys(spark):
    docs = spark.createDataFrame([(i, "ab" * i) for i in range(20)], "doc_id bigint, text string")

    def weak(block, seed):  # with the first seed, every block has the same key
        return F.struct(F.xxhash64(block).alias("a")) if seed else F.struct(F.lit(0).cast("bigint").alias("a"))

    got = exact_dedup(docs, block_bytes=8, key=weak).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(i, i) for i in range(20)]


def test_a_large_group_of_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same " * 500)).otherwise(F.col("id").cast("string")).alias("text"))
    sizes = {r.group_size: r.n for r in exact_dedup(docs).groupBy("group_size").agg(F.count("*").alias("n")).collect()}
    assert sizes == {1000: 1000, 1: 2000}
