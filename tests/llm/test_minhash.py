import itertools
import random
from collections import Counter

import numpy as np
import pytest

from logcube.llm import minhash
from logcube.llm.components import components
from logcube.llm.minhash import near_duplicates
from tests.llm.conftest import AWKWARD


def sets_of(rows, size):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    return out


def expected(rows, size, percent=80):
    """component per row, by brute force over all pairs that share a shingle."""
    sets, parent = sets_of(rows, size), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for sh in s:
            where.setdefault(sh, []).append(i)
    pairs = Counter(p for ids in where.values() for p in itertools.combinations(ids, 2))
    for (a, b), common in pairs.items():
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            parent[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def check(docs, size, **more):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs, shingle=size, **more).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(expected(rows, size), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return got


@pytest.mark.parametrize("size", [4, 5])
def test_components_are_those_of_all_pairs(spark, size):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), size)


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_large_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 10)
    rng = random.Random(4)
    bases = [[f"b{g}x{i}" for i in range(60 + 30 * g)] for g in range(3)]
    texts = [edited(rng, bases[i % 3], rng.choice([0.0, 0.01, 0.02, 0.03, 0.05])) for i in range(150)]
    texts += [t + " tail" * k for k, t in enumerate(texts[:12])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(docs, 4)


def test_awkward_rows(awkward, empty):
    rows = [r[:2] for r in AWKWARD]
    got = near_duplicates(awkward).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(expected(rows, 5), key=str)
    assert near_duplicates(empty).count() == 0


def test_few_words_and_case(spark):
    texts = ["A b", "a B", "a b c", "É b", "é b", "a b", "", None, "a b c d e f g h i j"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), 4)


def test_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 100, np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(100) > rng.choice([0.02, 0.1, 0.2])], rng.integers(0, 1 << 60, 4, np.uint64)])) for _ in range(60)]
    label = list(range(60))
    for a, b in itertools.combinations(range(60), 2):
        common = len(np.intersect1d(sets[a], sets[b]))
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            label = [label[a] if x == label[b] else x for x in label]
    found = list(range(60))
    for a, b in minhash.links(sets, 80):
        found = [found[a] if x == found[b] else x for x in found]
    assert len(set(label)) == len(set(found)) and len(set(zip(label, found))) == len(set(label))


def test_links_between_two_sides():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 80, np.uint64)
    for trial in range(20):
        sets = [np.unique(np.concatenate([base[rng.random(80) > rng.choice([0.02, 0.1, 0.2])], rng.integers(0, 1 << 60, 3, np.uint64)])) for _ in range(30)]
        n, label, found = int(rng.integers(1, 29)), list(range(30)), list(range(30))
        for a, b in itertools.product(range(n), range(n, 30)):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                label = [label[a] if x == label[b] else x for x in label]
        for a, b in minhash.links_between(sets[:n], sets[n:], 80):
            assert a < n <= b or b < n <= a
            found = [found[a] if x == found[b] else x for x in found]
        assert len(set(label)) == len(set(found)) == len(set(zip(label, found, strict=True)))


@pytest.mark.parametrize("pivots", [1, 4, 16])
def test_chains_of_near_copies_are_one_group(spark, monkeypatch, pivots):
    """Copies that drift: a set is linked with its neighbours only, so pivots connect
    little, and every link counts.  Beside them a star and loose sets."""
    for name, value in (("BLOCK_SETS", 8), ("PIVOTS", pivots)):
        monkeypatch.setattr(minhash, name, value)
    words = [f"c{i}" for i in range(400)]
    chain = [" ".join(words[3 * i : 3 * i + 120]) for i in range(60)]
    chain += [" ".join(words[3 * i : 3 * i + 120 + i]) for i in range(0, 60, 3)]  # other sizes
    rng = random.Random(7)
    star = [edited(rng, [f"s{i}" for i in range(150)], 0.02) for _ in range(60)]
    far = [edited(rng, [f"s{i}" for i in range(150)], 0.25) for _ in range(20)]
    rows = list(enumerate(rng.sample(chain + star + far, 160)))
    check(spark.createDataFrame(rows, "doc_id bigint, text string"), 4)
    # The same with all in one cluster, whatever the tables say.
    sets = [minhash.shingles(t, 4) for _, t in rows]
    members = [(b"r", minhash.node_of(x), len(x), x.astype("<u8").tobytes()) for x in sets]
    df = spark.createDataFrame(members, "root binary, node binary, n_shingles bigint, data binary").dropDuplicates(["node"])
    found = {bytes(r.node): bytes(r.root) for r in components(minhash.confirmed_links(df, 80)).collect()}
    want = {}
    for (_, _, component), x in zip(expected(rows, 4), sets, strict=True):
        want.setdefault(component, set()).add(minhash.node_of(x))
    got = {}
    for group in want.values():
        for node in group:
            got.setdefault(found.get(node, node), set()).add(node)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_bands_agree_as_often_as_sets_are_alike():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 60, 4000, np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 60, 1000, np.uint64)])
    keys = minhash.band_keys([np.sort(a), np.sort(b)], bands=400, rows=1, seed=3)
    assert abs((keys[0] == keys[1]).mean() - 0.6) < 0.06


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 300), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)} | {300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
