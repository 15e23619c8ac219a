import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logcube.llm import token_files as tf
from logcube.plans.checkpoints import scratch_dir
from tests.llm.conftest import AWKWARD, SF

JSON = P.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 1 << 40)), max_size=700).map(sorted))
def test_elias_fano_keeps_every_number(values):
    packed, rest = tf.EliasFano.from_bytes(memoryview(tf.EliasFano.of(np.array(values, np.uint64)).to_bytes()))
    assert not len(rest)
    assert packed.all().tolist() == values
    assert [packed.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    assert len(tf.EliasFano.of(ends).to_bytes()) * 8 < 100_000 * (2 + np.log2(ends[-1] / 100_000) + 1)


def library():
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    return tokenizer


def expected(rows):
    tokenizer, start, out = library(), 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, ids))
        start += len(ids)
    return out


def written(spark, docs, **more):
    folder = scratch_dir(spark, "tokens")
    manifest = tf.write_token_files(docs, folder, tf.byte_level_encoder(JSON, 2), 50_257, **more)
    return manifest, folder


@pytest.mark.parametrize("file_bytes", [1 << 27, 3000])
def test_files_hold_the_librarys_ids_in_order(spark, file_bytes):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    manifest, folder = written(spark, docs, file_bytes=file_bytes)
    got = sorted((r.doc_id, r.start, r.ids) for r in tf.read_token_files(manifest, folder).collect())
    assert got == expected(sorted((r.doc_id, r.text) for r in docs.collect()))
    crcs = {"crc": ("bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()))}
    crcs = {r.doc_id: r.crc for r in tf.read_token_files(manifest, folder, crcs).collect()}
    assert crcs == {d: zlib.crc32(np.array(ids, "<u4").tobytes()) for d, _, ids in got}
    first = manifest.orderBy("part", "seq").first()
    reader = tf.FileReader(f"{folder}/{first.file}")
    assert len(reader) == first.n_docs and reader.n_ids == first.n_ids
    assert [reader.ids(i).tolist() for i in range(len(reader))] == [ids for *_, ids in got[: len(reader)]]


def test_awkward_rows(spark, awkward, empty):
    manifest, folder = written(spark, awkward)
    got = tf.read_token_files(manifest, folder).orderBy("start").collect()
    rows = sorted(((d, t) for d, t, *_ in AWKWARD), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [(r.doc_id, r.start, r.ids) for r in got] == expected(rows)
    manifest, folder = written(spark, empty)
    assert tf.read_token_files(manifest, folder).count() == 0


AWKWARD_TEXTS = ["a  b   c", " a b ", "x \n y\n\nz", "tab\t a", "\x1c    b", "  ", "", "\n", " \n", "a\n", "<|endoftext|> a<|endoftext|>"]
AWKWARD_TEXTS += ["é" * 100 + " " + "b" * 99, "don't  they've 'll", "漢字 \U0001f600 ok", "a\u3000 b", "x\u00a0 y \u00a0z", "a\r\nb c\r\n"]


def test_pieces_encode_as_the_whole():
    tokenizer = library()
    for _ in range(2):  # the second time remembered
        got = map(tf.byte_level_encoder(JSON), AWKWARD_TEXTS)
        assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in AWKWARD_TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t'abré1.!\u00a0\u0394\x1c", max_size=30), max_size=4))
def test_any_text_encodes_as_the_library_does(texts):
    tokenizer = library_once
    got = map(tf.byte_level_encoder(JSON), texts)
    assert [x.tolist() for x in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


library_once = library()
