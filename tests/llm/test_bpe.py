import random
import re

import pytest
import public_tokenizers as P

from logcube.llm import bpe
from tests.llm.conftest import AWKWARD, SF

RANKS = P.path("byte_bpe_50k.tiktoken")


def expected(text):
    return bpe._encoding(RANKS, P.PATTERN).encode_ordinary(text or "")


@pytest.mark.parametrize("chunk,overlap", [(200, 60), (64, 24), (32768, 512)])
def test_ids_are_the_librarys_for_any_chunks(spark, chunk, overlap):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, RANKS, P.PATTERN, chunk_chars=chunk, overlap_chars=overlap).collect()}
    assert got == {r.doc_id: expected(r.text) for r in docs.collect()}


def test_awkward_texts_encode_and_decode(spark, awkward, empty):
    encoded = bpe.encode(awkward, RANKS, P.PATTERN, chunk_chars=50, overlap_chars=20)
    rows = bpe.decode(encoded, RANKS).collect()
    key = lambda r: (r[0] is None, r[0], r[1])
    assert sorted([(r.doc_id, list(r.ids)) for r in rows], key=key) == sorted([(d, expected(t)) for d, t, *_ in AWKWARD], key=key)
    texts = sorted((t or "").encode() for _, t, *_ in AWKWARD)
    assert sorted(bytes(r.decoded) for r in rows) == texts
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).count() == 0


def test_long_runs_without_a_boundary_are_encoded_whole(spark):
    texts = ["a" * 900 + " b", " " * 700 + "end", "word " * 50 + "\n" * 300 + "word", "don't " * 200, "it's they've " * 90, "1" * 400 + "é" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for chunk in (64, 97, 128):
        got = bpe.encode(docs, RANKS, P.PATTERN, chunk_chars=chunk, overlap_chars=32).orderBy("doc_id").collect()
        assert [list(r.ids) for r in got] == [expected(t) for t in texts]


def test_nothing_decodes_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(rows, RANKS).orderBy("doc_id").collect()] == [b"", b""]


def test_cutting_long_runs_changes_no_id(monkeypatch):
    monkeypatch.setattr(bpe, "LONG_RUN", 2)
    monkeypatch.setattr(bpe, "_LONG_RUNS", re.compile(f"[{bpe.WHITE_SPACE}]{{2,}}+"))
    rng, cut = random.Random(0), 0
    for _ in range(3000):
        text = "".join(rng.choices(" \n\t\r\x85\xa0 　\x1c​", k=rng.randint(0, 3)) and rng.choices([*" \n\t\r\x85\xa0 　\x1c​", "  ", "ab", "'s", "1", "é!"], k=rng.randint(0, 12)))
        cut += len(bpe.without_long_runs(text)) > 1
        assert "".join(p for p, _ in bpe.without_long_runs(text)) == text
        assert bpe.encode_text(text, RANKS, P.PATTERN).tolist() == expected(text), repr(text)
    assert cut > 1000


def test_millions_of_equal_characters(spark):
    """The ids of 1,000 such characters, with one of their tokens repeated: the
    library itself cannot encode as many."""
    n, forms = 2_000_000, [("", " ", "x"), ("a ", "\n", "x"), ("", " ", ""), ("", "é", ""), ("", "x", " y"), ("", "\n", "")]
    docs = spark.createDataFrame([(i, a + c * n + b) for i, (a, c, b) in enumerate(forms)], "doc_id bigint, text string")
    rows = bpe.encode(docs, RANKS, P.PATTERN, decoded=True).orderBy("doc_id").collect()
    for r, (before, c, after) in zip(rows, forms, strict=True):
        short = expected(before + c * 1000 + after)
        unit = short[len(short) // 2]
        width = len(bpe._id_bytes(RANKS)[unit]) // len(c.encode())
        more = [unit] * ((n - 1000) // width)
        assert list(r.ids) == short[: len(short) // 2] + more + short[len(short) // 2 :]
        assert bytes(r.decoded) == (before + c * n + after).encode()


def test_bytes_come_with_the_ids(spark, awkward):
    for chunk in (50, 32768):
        got = bpe.encode(awkward, RANKS, P.PATTERN, chunk_chars=chunk, overlap_chars=20, decoded=True)
        assert got.columns == ["doc_id", "ids", "decoded"]
        assert sorted((tuple(r.ids), bytes(r.decoded)) for r in got.collect()) == sorted((tuple(expected(t)), (t or "").encode()) for _, t, *_ in AWKWARD)
