import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logcube.llm import alignment as al
from logcube.llm import queries
from tests.llm.conftest import AWKWARD, SF

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_values():
    """Byte of each character of a byte-level vocabulary."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}


def tokens(text, libraries):
    """(id, bytes) lists of either library."""
    a, b = libraries
    values = byte_values()
    found_a = [(i, bytes(values[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    found_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        found_b.append((i, bytes([int(piece[1:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return found_a, found_b


def brute_force(rows, libraries):
    groups = []
    for _, text in rows:
        found = tokens(text, libraries) if text else ([], [])
        if text and any(b"".join(x for _, x in side) != (" " + text).encode() for side in found):
            found = [], []
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in found]
        common = sorted(set(ends[0]) & set(ends[1]))
        low, out = 0, []
        for end in common:
            out.append([[i for (i, _), e in zip(side, own, strict=True) if low < e <= end] for side, own in zip(found, ends, strict=True)])
            low = end
        groups.append((len(found[0]), len(found[1]), out))
    held, links = Counter(), []
    for _, _, own in groups:
        links.append([(a, b) for x, y in own for a in x for b in y])
        held.update(set(links[-1]))
    highest = defaultdict(int)
    for (a, _), n in held.items():
        highest[a] = max(highest[a], n)
    result = []
    for (doc_id, _), (n_a, n_b, own), pairs in zip(rows, groups, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        digest = hashlib.sha256(text.encode()).hexdigest() if own else ""
        result.append((doc_id, n_a, n_b, len(own), len(pairs), digest, sum(held[p] == highest[p[0]] for p in pairs), sum(held[p] for p in pairs)))
    return sorted(result, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = ["a<|endoftext|>b <s> </s> <unk> <0x41>", "▁ not given back", " two  spaces ", "x ", " ", "   ", "\x00nul\x7f", "tab\tend\r\n\n", "漢字 かな 😀😀 é́", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 9, "1234567890" * 7, "\n" * 40 + " " * 33 + "x", "ﬁ ligature ½ ①", "﻿bom​", "naïve İstanbul ſ"]


def test_query_equals_brute_force(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(queries.op12_tokenizer_alignment(spark, SF)) == brute_force(rows, libraries)


@pytest.mark.parametrize("small", [False, True])
def test_awkward_rows(spark, awkward, libraries, monkeypatch, small):
    if small:
        for name, value in {"STRIDE": 2, "STEP_CHARS": 60, "BATCH_ENTRIES": 60, "BATCH_DOCS": 3, "LARGE_GROUP": 2, "PAIRS_A_ROW": 7, "KEPT_STRETCHES": 5}.items():
            monkeypatch.setattr(al, name, value)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = awkward.select("doc_id", "text", "ids", "size").withColumnsRenamed({"ids": "pairs", "size": "batch"}).unionByName(more, allowMissingColumns=True)
    rows = [(r[0], r[1]) for r in AWKWARD] + [(100 + i, t) for i, t in enumerate(ODD)]
    # Python workers are told of the sizes with the function, so the steps are also run here.
    assert found(al.align_tokenizers(docs.coalesce(1), *PATHS)) == brute_force(rows, libraries)
    tools = al.both(*PATHS)
    texts = tools.tokens([t or "" for _, t in rows])
    whole, parts = al.align(texts, tools), [al.align(texts[i : i + 3], tools) for i in range(0, len(texts), 3)]
    assert whole.digests == [d for p in parts for d in p.digests]
    assert whole.links.sum() == whole.n_links.sum() == sum(p.links.sum() for p in parts)
    assert whole.pair.tolist() == [x for p in parts for x in p.pair]


def test_empty_table(spark, empty):
    assert found(al.align_tokenizers(empty, *PATHS)) == []


def test_galloping_intersects_any_lists():
    rng = np.random.default_rng(0)
    for trial in range(200):
        lists = [[np.unique(rng.integers(1, rng.integers(2, 400), rng.integers(1, 300))) for _ in range(2)] for _ in range(rng.integers(1, 6))]
        if trial % 4 == 0:
            lists.insert(1, [np.zeros(0, np.int64)] * 2)
        shift, sides, starts = 0, ([], []), ([0], [0])
        for pair in lists:
            for k in (0, 1):
                sides[k].append(pair[k] + shift)
                starts[k].append(starts[k][-1] + len(pair[k]))
            shift += 1000
        a, b = (np.concatenate(s) for s in sides)
        at_a, at_b = al.common_ends(a, np.array(starts[0]), b, np.array(starts[1]))
        assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_stretches_are_encoded_as_whole_texts(libraries):
    pieces, rng = al.Pieces(PATHS[1]), random.Random(1)
    assert pieces.apart
    for _ in range(3000):
        text = "".join(rng.choices([" ", "  ", "a", "the", "\n", "\t", "é", "漢", "😀", "x y", "<s>", "\x00", "...", "1", "  b"], k=rng.randint(1, 14)))
        assert pieces.ids(text).tolist() == libraries[1].encode(text), repr(text)


def test_entries_are_packed_and_unpacked():
    rng = np.random.default_rng(2)
    for top in (3, 300, 70_000, 5_000_000_000):
        places, links = np.unique(rng.integers(0, top, 40)), rng.integers(1, top, 40)
        links = links[: len(places)]
        got = al._unpacked(al._packed(places, links), len(places))
        assert got[0].tolist() == places.tolist() and got[1].tolist() == links.tolist()
    assert [x.tolist() for x in al._unpacked(al._packed(places[:0], links[:0]), 0)] == [[], []]
