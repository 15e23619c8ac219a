import heapq
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from logcube.llm.mixing import apportion, mix, running, seats_of
from tests.llm.conftest import SF


def sainte_lague(weights, seats):
    got = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def filled(sizes, weights, total):
    """Water filling by rounds: cap, reshare the excess, until none is above."""
    caps, full = [2 * s for s in sizes], set()
    while True:
        rest = total - sum(caps[i] for i in full)
        open_weight = sum(w for i, w in enumerate(weights) if i not in full)
        targets = [caps[i] if i in full else rest * weights[i] / open_weight for i in range(len(sizes))]
        over = {i for i in range(len(sizes)) if i not in full and targets[i] > caps[i]}
        if not over:
            return targets
        full |= over


def test_apportionment_is_by_highest_quotients(spark):
    rng = random.Random(5)
    cases = [([1.0], 7), ([3.0, 3.0, 3.0], 4), ([5.0, 0.0, 5.0], 3), ([1e9, 1.0, 2.0], 50), ([53.0, 24.0, 23.0], 7), ([1.0, 2.0], 0)]
    cases += [([float(rng.randint(0, 1000)) for _ in range(rng.randint(1, 30))] + [1.0], rng.randint(0, 200)) for _ in range(40)]
    df = spark.createDataFrame(cases, "w array<double>, n bigint").withColumn("s", apportion(F.col("w"), F.col("n")))
    for r in df.collect():
        assert list(r.s) == sainte_lague(r.w, r.n), (r.w, r.n)


def check(rows, texts, block):
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = [(3, 1, 2)[i % 3] for i in range(len(order))]
    targets = dict(zip(order, filled([sizes[s] for s in order], weights, 1.5 * sum(sizes.values()))))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - targets[s]) <= block, s
    return taken


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    first = mix(docs, shard_words=3000).collect()
    check(first, texts, 64)
    again = mix(docs.repartition(7), shard_words=3000).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_one_hot_source(spark):
    rows = [(i, "a b c d", "hot" if i % 3 else f"s{i % 4}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    check(mix(docs, shard_words=100, block_words=8).collect(), rows, 16)


def test_awkward_rows(spark, awkward, empty):
    rows = mix(awkward).collect()
    texts = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    assert len(rows) == len(texts)
    check(rows, texts, 64)
    assert mix(empty).count() == 0
    wordless = spark.createDataFrame([(1, None, None), (2, " ", "s")], "doc_id bigint, text string, source string")
    assert [(r.size, r.taken, r.target) for r in mix(wordless).collect()] == [(0, 0, 0.0)] * 2


def by_heap(weights, seats):
    heap, got = [(-w, i) for i, w in enumerate(weights) if w > 0], [0] * len(weights)
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, i = heap[0]
        got[i] += 1
        heapq.heapreplace(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def test_seats_of_many_sources(spark):
    rng = random.Random(8)
    cases = [([1.0], 7), ([3.0] * 3, 4), ([5.0, 0.0, 5.0], 3), ([1e9, 1.0, 2.0], 50), ([1.0, 2.0], 0), ([0.0, 0.0], 5)]
    cases += [([float(int(rng.paretovariate(0.7))) for _ in range(3000)], n) for n in (10, 2999, 50_000)]
    cases += [([64.0] * 5000, 12_345), ([rng.random() * 1e6 for _ in range(40)], 100_000)]  # ties; few and many
    for weights, seats in cases:
        sources = spark.createDataFrame(list(enumerate(weights)), "ordinal int, target double")
        got = {r.ordinal: r.seats for r in seats_of(sources, seats).collect()}
        assert [got[i] for i in range(len(weights))] == by_heap(weights, seats), (weights[:5], seats)


def test_running_sums_over_partitions(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "a", "b", "c"]), rng.randint(0, 9)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k string, n int").repartition(7)
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", -r[0]))
    want, total = {}, 0
    for place, (i, _, n) in enumerate(order):
        want[i] = (place, total)
        total += n
    got = running(df, [F.col("k").asc_nulls_last(), F.col("id").desc()], {"before": F.col("n")}, "t")
    assert {r.id: (r["rank"], r.before) for r in got.collect()} == want
    assert sorted(got.columns) == ["before", "id", "k", "n", "rank"] and running(df.limit(0), [F.col("id")], {}, "t").count() == 0


def test_as_many_sources_as_documents(spark):
    rows = [(i, "w " * (i % 13), f"host{i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    check(mix(docs, block_words=8).collect(), rows, 8)
