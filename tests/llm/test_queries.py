"""The registered queries: against SQL where it can express them, else against
the operator's brute-force tests; the pipeline against its stages by hand."""

import collections
import hashlib
import os

import duckdb
import public_tokenizers as P
import pytest

import corpus_pipeline
from logcube.llm import bpe
from logcube.llm import queries as llm
from tests.llm.conftest import SF
from tests.llm.test_minhash import expected as near_groups
from tests.llm.test_mixing import check as check_mix

TABLES = ("documents", "embeddings", "pages")
NAMES = [f"op{n}_" for n in range(1, 14)]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def test_one_query_of_each_operator():
    assert sorted(q.split("_")[0] + "_" for q in llm.queries()) == sorted(NAMES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "near-dedup", "mixing", "byte-level BPE"]


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    df, rel = llm.queries()[name](spark, SF), duck.sql(llm.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    want = collections.Counter(duck.sql(f"SELECT {columns} FROM ({llm.oracle_sql()[name]})").fetchall())
    assert collections.Counter(map(tuple, df.collect())) == want


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole, columns = rows_of(docs), docs.columns
    (_, identify), (_, exact), (_, near), (_, mixing), (_, encode) = corpus_pipeline.STAGES

    def stage(function, before, name):
        out = function(spark, before, SF)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    kept = stage(identify, docs, "0")
    assert kept.columns == columns
    assert sorted(rows_of(kept)) == sorted(r for r in whole if any(map(str.isalpha, r[1])))  # clean documents stay

    texts = {}
    for r in rows_of(kept):
        texts[r[1]] = max(texts.get(r[1], r), r)
    unique = stage(exact, kept, "1")
    assert unique.columns == columns and sorted(rows_of(unique)) == sorted(texts.values())

    groups = near_groups([(r[0], r[1]) for r in texts.values()], 5)
    left = {d for d, _, component in groups if d == component}
    single = stage(near, unique, "2")
    assert single.columns == columns and sorted(rows_of(single)) == sorted(r for r in texts.values() if r[0] in left)

    mixed = stage(mixing, single, "3")
    assert mixed.columns == columns
    copies = collections.Counter(rows_of(mixed))
    from logcube.llm.mixing import mix

    taken = mix(single).collect()
    check_mix(taken, [(r[0], r[1], r[3]) for r in rows_of(single)], 64)
    want = {r.doc_id: int(r.taken / r.size + 0.5) if r.size else 0 for r in taken}
    assert {r[0]: n for r, n in copies.items()} == {d: n for d, n in want.items() if n}

    ids = stage(encode, mixed, "4")
    tokens = {r[0]: bpe._encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encode_ordinary(r[1]) for r in copies}
    text = {r[0]: r[1] for r in copies}
    got = ids.collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows_of(mixed))
    for r in got:
        assert list(r.ids) == tokens[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_pipeline_takes_awkward_documents(spark, awkward):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == awkward.columns, name
    assert docs.where("text IS NULL OR trim(text) = ''").count() == 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(out) == docs.count() and all(r.n_tokens for r in out)
    empty = awkward.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
