import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logcube.llm import quality_crf as q
from tests.llm.conftest import AWKWARD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The fixed counts, plainly."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


@pytest.fixture(scope="module")
def field(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    return q.train(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def random_field(rng):
    return q.Field(rng.normal(size=(len(q.FEATURES), q.BINS)), rng.normal(size=(2, 2)), rng.normal(size=2))


def score(field, bins, marks):
    e = field.emissions(bins)
    return field.start[marks[0]] + sum(e[t] * m for t, m in enumerate(marks)) + sum(field.steps[a, b] for a, b in itertools.pairwise(marks))


def test_viterbi_is_the_best_of_all_chains():
    rng = np.random.default_rng(0)
    for n in range(1, 9):
        field, bins = random_field(rng), rng.integers(0, q.BINS, (n, len(q.FEATURES)))
        best = max(itertools.product((0, 1), repeat=n), key=lambda marks: score(field, bins, marks))
        assert field.viterbi(bins).astype(int).tolist() == list(best)
    assert random_field(rng).viterbi(np.zeros((0, len(q.FEATURES)), int)).tolist() == []


def test_likelihood_and_gradient():
    rng = np.random.default_rng(1)
    field, sizes = random_field(rng), (5, 1, 3)
    bins = rng.integers(0, q.BINS, (3, 5, len(q.FEATURES)))
    mask = np.arange(5) < np.array(sizes)[:, None]
    marks = (rng.random((3, 5)) < 0.5) & mask
    value, gradient = q.likelihood(field, bins, mask, marks)
    want = 0.0
    for k, n in enumerate(sizes):
        every = [score(field, bins[k, :n], m) for m in itertools.product((0, 1), repeat=n)]
        want += score(field, bins[k, :n], marks[k, :n].astype(int)) - np.logaddexp.reduce(every)
    assert abs(value - want) < 1e-9
    for name in ("bins", "steps", "start"):
        array = getattr(field, name)
        for at in [tuple(rng.integers(0, s) for s in array.shape) for _ in range(6)]:
            ends = []
            for step in (1e-5, -1e-5):
                array[at] += step
                ends.append(q.likelihood(field, bins, mask, marks)[0])
                array[at] -= step
            assert abs((ends[0] - ends[1]) / 2e-5 - getattr(gradient, name)[at]) < 1e-5


def test_counts_of_all_documents(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: counts(r) for r in q.judge(docs, field).collect()}
    assert got == {r.doc_id: base(r.text) for r in docs.collect()}


def test_counts_of_random_texts(monkeypatch):
    rng = random.Random(2)
    for trial in range(300):
        if trial == 150:
            monkeypatch.setattr(q, "POINTS", 3)  # characters taken in small parts
        text = "".join(rng.choices(["a ", "b ", "ab", "\n", " ", "\t", "\r", "\x0b", "\x0c", "\x1c", " ", " ", "é", "#", "|", "😀 ", "漢"], k=rng.randint(0, 60)))
        found = q.describe(text)
        assert (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words) == base(text)[:5], repr(text)
        with_word = [line for line in text.split("\n") if WORD.search(line)]
        assert found.chars.tolist() == [sum(map(len, WORD.findall(line))) for line in with_word] and len(found.bins) == len(with_word)


def test_held_out_documents(spark, field):
    """Documents that were never learnt from: the good ones stay, most bad ones go."""
    quality = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = [r for r in q.judge(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), field).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.doc_id in quality]
    for r in rows:
        assert r.kept == (not r.base_failed and r.content_share >= q.MIN_SHARE)
    judged = [(quality[r.doc_id], r.kept) for r in rows if not r.base_failed]
    good, bad = [k for g, k in judged if g], [k for g, k in judged if not g]
    assert len(good) > 500 and len(bad) > 30
    assert sum(good) >= 0.995 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_lines_are_marked_in_their_context(field):
    prose = [
        "It was a fine day in the village, and they all went out to see the ships come in.",
        "None of the crew had been home since the spring, so there was much to tell, and more to hear.",
        "In the evening the lamps were lit along the harbour, and somebody began to play an old song.",
        "They came home late, tired and cheerful, and the children were asleep before the door was shut.",
    ]
    menu = "Home | About | News | Shop | Contact | Help | Login"
    junk = "BUY!! NOW!! ONLY!! TODAY!! CHEAP!! WATCHES!! HERE!! CLICK!! FAST!!"
    marks = field.viterbi(q.describe("\n".join([*prose[:3], menu, junk, junk, prose[3]])).bins)
    assert marks[:3].all() and not marks[3:6].any()


def test_awkward_rows(spark, awkward, empty, field):
    got = q.judge(awkward, field).collect()
    assert sorted((str(r.doc_id), counts(r)) for r in got) == sorted((str(d), base(t)) for d, t, *_ in AWKWARD)
    assert all(0 <= r.content_share <= 1 and r.n_boilerplate <= r.n_lines for r in got)
    assert not any(r.kept for r in got if r.n_words < 50)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 0), (5, 0, 1), (None, 1, 0), (7, None, 1), (99, 0, 0)], "doc_id bigint, quality int, text int")
    assert q.train(awkward, labels) is not None  # repeated labels and rows
    assert q.train(awkward, labels.where("quality = 1")) is None and q.train(empty, labels) is None and q.train(awkward, labels.limit(0)) is None
    assert q.judge(empty, None).count() == 0
    text = "word other words here now. " * 400_000 + "\n" * 100_000
    found = q.describe(text)
    assert (found.n_words, found.n_repeat_words, found.n_dup_lines, len(found.bins)) == (2_000_000, 2_000_000, 0, 1)
    assert [r.kept for r in q.judge(spark.createDataFrame([(1, "Many different words. " + " ".join(f"w{i}" for i in range(80)))], "doc_id bigint, text string"), None).collect()] == [True]
