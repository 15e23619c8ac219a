"""Alignment of two tokenizers by the byte offsets at which both end a token.

1. Every text is encoded by both, and the ends of their tokens are intersected by
   galloping: the list with fewer ends drives an exponential and then a binary
   search into the other.  The texts of a batch are searched side by side: every
   STRIDE-th end of a text gallops from the text's start, the ends between two of
   them from where the first one landed.
2. The common ends slice both token lists into groups; all pairs of a group are
   links.  The ranks of the ends give the ranges.
3. Texts are gathered into batches, each with its distinct pairs of ids and the
   number of its documents that hold each; only these are added up over the corpus
   (and joined with the sums), not the pairs of each document.
4. The sums come back to their batches, where every document adds up its own.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import cells, map_batches, stored, text_or_empty
from logcube.llm.token_files import PretokenEncoder

#: Every so many ends, one gallops from the start of its text.
STRIDE = 16
#: Characters that are encoded and aligned at a time, and texts.
STEP_CHARS, STEP_DOCS = 1 << 19, 1 << 12
#: A batch is closed with so many (document, pair) entries, or documents.
BATCH_ENTRIES, BATCH_DOCS = 1 << 21, 1 << 14
#: Larger groups are counted by their distinct ids.
LARGE_GROUP = 1 << 12
#: Stretches that a worker remembers, and the longest of them.
KEPT_STRETCHES, KEPT_CHARS = 200_000, 48
#: Rows of pairs in the table of batches.
PAIRS_A_ROW = 1 << 12


# ---------------------------------------------------------------- tokenizers


class ByteLevel:
    """A byte-level BPE file: ids of a text, and the bytes of each id."""

    def __init__(self, path: str):
        self.encoder = PretokenEncoder(path)
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}
        vocabulary = self.encoder.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encoder.encode(text), "<u4").astype(np.int64)


class Pieces:
    """A piece model that puts a space before a text.

    No piece has a space behind another character, so no merge reaches over the
    start of a run of spaces, and the stretches between are encoded apart."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = []
        for i, piece in enumerate(pieces):
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                mute = self.model.is_control(i) or self.model.is_unknown(i)
                self.bytes.append(b"" if mute else piece.replace("▁", " ").encode())
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.space = np.array([self.model.piece_to_id("▁")], "<u4").tobytes()
        self.stretches = re.compile(" +[^ ]*").findall
        self.known: dict[str, bytes] = {}

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; the stretches that are not remembered are encoded
        together, every one once."""
        if not self.apart:
            return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]
        parts = [self.stretches(" " + text) for text in texts]
        new = [s for s in {s for p in parts for s in p} if s not in self.known]
        for stretch, ids in zip(new, self.model.encode([s[1:] for s in new], num_threads=1), strict=True):
            self.known[stretch] = array("I", ids).tobytes() if stretch != " " else self.space
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, p)), "<u4").astype(np.int64) for p in parts]
        kept = len(self.known) - len(new)
        for stretch in new:
            if kept >= KEPT_STRETCHES or len(stretch) > KEPT_CHARS:
                del self.known[stretch]
            else:
                kept += 1
        return out

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]


@dataclass(frozen=True)
class Both:
    a: ByteLevel
    b: Pieces
    lengths_a: np.ndarray
    lengths_b: np.ndarray
    #: Decimal ids with what may follow them: a comma, a bar, a semicolon, nothing.
    written: list[bytes]

    @property
    def size(self) -> int:
        return max(len(self.lengths_a), len(self.lengths_b))

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of either tokenizer for each text; none if one of them does not give
        the text back."""
        none, out = np.zeros(0, np.int64), []
        for text, b in zip(texts, self.b.ids_of(texts), strict=True):
            whole = (" " + text).encode() if text else b""
            found = (self.a.ids(" " + text), b) if text else (none, none)
            sides = zip(found, (self.a.bytes, self.b.bytes), strict=True)
            fine = all(b"".join(map(table.__getitem__, ids.tolist())) == whole for ids, table in sides)
            out.append(found if fine else (none, none))
        return out


@lru_cache(maxsize=1)
def both(path_a: str, path_b: str) -> Both:
    a, b = ByteLevel(path_a), Pieces(path_b)
    lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (a, b)]
    size = max(map(len, lengths))
    return Both(a, b, *lengths, [b"%d%s" % (i, end) for end in (b",", b"|", b";", b"") for i in range(size)])


# ----------------------------------------------------------------- alignment


def gallop(ends: np.ndarray, wanted: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each of ``wanted`` the first place from ``start`` on, ``stop`` at most,
    whose end is no smaller: steps that double, then halves."""
    low, high = start.copy(), start.copy()
    step, going = 1, np.arange(len(wanted))
    while len(going):
        at = high[going]
        ahead = at < stop[going]
        ahead[ahead] = ends[at[ahead]] < wanted[going[ahead]]
        going = going[ahead]
        low[going] = high[going] + 1
        high[going] = np.minimum(high[going] + step, stop[going])
        step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) >> 1
        less = ends[middle] < wanted[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    return low


def common_ends(ends_a: np.ndarray, starts_a: np.ndarray, ends_b: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in either list of the ends that both have, text by text.  ``starts``
    are the texts' first places, and behind them the length of the list."""
    n_a, n_b = np.diff(starts_a), np.diff(starts_b)
    found = []
    for first, (ends_s, starts_s, n_s), (ends_l, starts_l) in (
        (True, (ends_a, starts_a, n_a), (ends_b, starts_b)),
        (False, (ends_b, starts_b, n_b), (ends_a, starts_a)),
    ):
        texts = np.flatnonzero((n_a <= n_b if first else n_a > n_b) & (n_s > 0))
        n = n_s[texts]
        local = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        places = np.repeat(starts_s[texts], n) + local
        wanted = ends_s[places]
        start, stop = np.repeat(starts_l[texts], n), np.repeat(starts_l[texts + 1], n)
        leads = np.flatnonzero(local % STRIDE == 0)
        landed = gallop(ends_l, wanted[leads], start[leads], stop[leads])
        start = np.repeat(landed, np.diff([*leads, len(places)]))
        start[leads] = landed
        other = gallop(ends_l, wanted, start, stop)
        hit = other < stop
        hit[hit] = ends_l[other[hit]] == wanted[hit]
        found.append((places[hit], other[hit]) if first else (other[hit], places[hit]))
    at_a, at_b = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at_a, kind="stable")
    return at_a[order], at_b[order]


@dataclass(frozen=True)
class Aligned:
    """Of the texts of a step: counts, digests, and their (pair, links) entries."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    document: np.ndarray  # of every entry
    pair: np.ndarray  # a << 32 | b
    links: np.ndarray


def align(texts: list[tuple[np.ndarray, np.ndarray]], tools: Both) -> Aligned:
    """Aligns texts of (ids of A, ids of B) that cover the same bytes."""
    n_a, n_b = (np.array([len(t[k]) for t in texts], np.int64) for k in (0, 1))
    starts_a, starts_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
    a, b = (np.concatenate([t[k] for t in texts]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(tools.lengths_a[a]), np.cumsum(tools.lengths_b[b])
    last_a, last_b = common_ends(ends_a, starts_a, ends_b, starts_b)
    first_a, first_b = (np.concatenate([[0], x[:-1] + 1]) if len(x) else x for x in (last_a, last_b))
    in_a, in_b = last_a - first_a + 1, last_b - first_b + 1
    n_texts, n_groups = len(texts), len(last_a)
    document = np.searchsorted(starts_a[1:], last_a, "right")  # of every group
    sizes = in_a * in_b

    group_a, group_b = np.repeat(np.arange(n_groups), in_a), np.repeat(np.arange(n_groups), in_b)
    kind_a, kind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    kind_a[last_a], kind_b[last_b] = 1, 2
    kind_b[starts_b[1:][n_b > 0] - 1] = 3
    row = np.empty(len(a) + len(b), np.int64)
    row[np.arange(len(a)) + first_b[group_a]] = a + kind_a * tools.size
    row[np.arange(len(b)) + last_a[group_b] + 1] = b + kind_b * tools.size
    digests = []
    for start, end in zip((starts_a + starts_b)[:-1].tolist(), (starts_a + starts_b)[1:].tolist(), strict=True):
        written = b"".join(map(tools.written.__getitem__, row[start:end].tolist()))
        digests.append(hashlib.sha256(written).hexdigest() if end > start else "")

    small = np.flatnonzero(sizes <= LARGE_GROUP)
    n = sizes[small]
    group = np.repeat(small, n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    ahead, behind = np.divmod(place, in_b[group])
    pairs, owners, links = [a[first_a[group] + ahead] << 32 | b[first_b[group] + behind]], [document[group]], [np.ones(len(group), np.int64)]
    for g in np.flatnonzero(sizes > LARGE_GROUP):
        ids_a, of_a = np.unique(a[first_a[g] : last_a[g] + 1], return_counts=True)
        ids_b, of_b = np.unique(b[first_b[g] : last_b[g] + 1], return_counts=True)
        pairs.append((ids_a[:, None] << 32 | ids_b).ravel())
        links.append(np.outer(of_a, of_b).ravel())
        owners.append(np.full(len(pairs[-1]), document[g]))
    pair, owner, link = (np.concatenate(x) for x in (pairs, owners, links))
    order = np.lexsort((pair, owner)) if len(links) > 1 else _order(owner, pair)
    pair, owner, link = pair[order], owner[order], link[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counted = np.add.reduceat(link, at) if len(at) else link
    by_text = np.bincount(document, minlength=n_texts)
    all_links = np.zeros(n_texts, np.int64)
    np.add.at(all_links, document, sizes)
    return Aligned(n_a, n_b, by_text, all_links, digests, owner[at], pair[at], counted)


def _order(owner: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """By owner, then by pair."""
    order = np.argsort(pair, kind="stable")
    return order[np.argsort(owner[order].astype(np.uint16) if len(owner) and owner[-1] < 1 << 16 else owner[order], kind="stable")]


# ------------------------------------------------------------------------ jobs


def _packed(places: np.ndarray, links: np.ndarray) -> bytes:
    """Ascending places by their steps, then the links, each as narrow as they fit."""
    out = b""
    for values in (np.diff(places, prepend=0), links):
        kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if values.max(initial=0) < 1 << 8 * int(k[2]))
        out += kind[2].encode() + values.astype(kind).tobytes()
    return out


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    at, out = 0, []
    for _ in range(2):
        width = int(data[at : at + 1])
        out.append(np.frombuffer(data, f"<u{width}", n, at + 1).astype(np.int64))
        at += 1 + n * width
    return np.cumsum(out[0]), out[1]


_DOC = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_BATCHES = pa.schema([
    ("batch", pa.int64()), ("doc_id", pa.int64()), *_DOC, ("n_pairs", pa.int32()), ("entries", pa.binary()),
    ("place", pa.int32()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())),
])
_DOC_DDL = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def _align_all(path_a: str, path_b: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = both(path_a, path_b)
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        n_batches, steps, entries, docs = 0, [], 0, 0
        ids, texts, size = [], [], 0

        def step() -> tuple[list, Aligned]:
            return ids, align(tools.tokens(texts), tools)

        for doc_id, text in cells(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= STEP_CHARS or len(ids) >= STEP_DOCS:
                steps.append(step())
                entries, docs = entries + len(steps[-1][1].pair), docs + len(ids)
                ids, texts, size = [], [], 0
                if entries >= BATCH_ENTRIES or docs >= BATCH_DOCS:
                    yield from _batch(base + n_batches, steps)
                    n_batches, steps, entries, docs = n_batches + 1, [], 0, 0
        if ids:
            steps.append(step())
        if steps:
            yield from _batch(base + n_batches, steps)

    return run


def _batch(batch: int, steps: list[tuple[list, Aligned]]) -> Iterator[pa.RecordBatch]:
    """The rows of a batch: its documents, each with its entries as places among
    the batch's pairs, and the pairs with their numbers of documents."""
    pairs, place, docs = np.unique(np.concatenate([s.pair for _, s in steps]), return_inverse=True, return_counts=True)
    done = 0
    for ids, s in steps:
        cuts = np.searchsorted(s.document, np.arange(len(ids) + 1))
        rows = []
        for k, doc_id in enumerate(ids):
            low, high = cuts[k], cuts[k + 1]
            row = {"batch": batch, "doc_id": doc_id, "n_a": s.n_a[k], "n_b": s.n_b[k], "n_groups": s.n_groups[k], "n_links": s.n_links[k], "groups_sha256": s.digests[k]}
            rows.append(row | {"n_pairs": high - low, "entries": _packed(place[done + low : done + high], s.links[low:high])})
        done += len(s.pair)
        yield pa.RecordBatch.from_pylist(rows, schema=_BATCHES)
    for start in range(0, len(pairs), PAIRS_A_ROW):
        part = slice(start, start + PAIRS_A_ROW)
        yield pa.RecordBatch.from_pylist([{"batch": batch, "place": start, "pairs": pairs[part], "docs": docs[part]}], schema=_BATCHES)


def _add_up(documents: pa.Table, sums: pa.Table) -> pa.Table:
    """The documents of a batch with n_best and count_sum, from its pairs' sums."""
    place = sums["place"].to_numpy()
    counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    counts[place], best[place] = sums["count"].to_numpy(), sums["best"].to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for n, data in zip(documents["n_pairs"].to_pylist(), documents["entries"], strict=True):
        where, links = _unpacked(data.as_py(), n)
        n_best.append(int(links[best[where]].sum()))
        count_sum.append(int(links @ counts[where]))
    columns = {c: documents[c] for c in ("doc_id", *[c for c, _ in _DOC])}
    return pa.table(columns | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())})


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256 (of "a1,a2|b1;a3|b2,b3"), n_best and count_sum.

    ``path_a`` is a byte-level BPE file, which encodes a space and the text,
    ``path_b`` a piece model, which puts the space there itself.  Links are all
    pairs of a group's occurrences; a pair of ids counts once for every row that
    holds it linked.  n_best are the links whose pair counts as much as any pair of
    its A id, count_sum the sum of the counts of all links.

    A text that is NULL or empty, or that one of the tokenizers does not give back,
    has no tokens: zeros, and no digest ('').  Strings of special tokens are
    ordinary text.  Repeated rows are rows of their own; other columns are not
    read; an empty table gives an empty result."""
    aligned, _ = align_and_count(docs, path_a, path_b, id_col, text_col)
    return aligned


def align_and_count(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents as ``align_tokenizers`` gives them, and the corpus's pairs:
    a, b, count (documents), best (of a)."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = f"batch bigint, doc_id bigint, {_DOC_DDL}, n_pairs int, entries binary, place int, pairs array<bigint>, docs array<int>"
    batches = stored(map_batches(texts, _align_all(path_a, path_b), schema), "aligned")
    of_batches = batches.where("pairs is not null").select("batch", "place", F.explode(F.arrays_zip("pairs", "docs", F.sequence(F.lit(0), F.size("pairs") - 1).alias("i"))).alias("p"))
    of_batches = of_batches.select("batch", (F.col("place") + F.col("p.i")).alias("place"), F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    a = F.shiftright("pair", 32)
    counted = stored(of_batches.groupBy("pair").agg(F.sum("docs").cast("bigint").alias("count")), "pair-counts")
    highest = counted.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))  # one row per id of the vocabulary
    counted = counted.join(F.broadcast(highest), a == F.col("a")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    sums = of_batches.join(counted, "pair").select(F.col("batch").alias("of_batch"), "place", "count", "best")
    documents = batches.where("pairs is null").drop("place", "pairs", "docs")
    joined = documents.groupBy("batch").cogroup(sums.groupBy("of_batch"))
    out = joined.applyInArrow(_add_up, f"doc_id bigint, {_DOC_DDL}, n_best bigint, count_sum bigint")
    pairs = counted.select(a.alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "count", "best")
    return out, pairs
