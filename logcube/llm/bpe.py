"""Byte-level BPE encoding and decoding by overlapping chunks.

A long text is cut into chunks of ``chunk_chars``, each with ``overlap_chars``
more of the text behind it, and the chunks are dealt out over tasks.  Every
chunk is pre-tokenised on its own, from its first character, so its first
boundaries may be wrong.  But pre-tokenising is deterministic from any
boundary on: where a chunk and the one before share a boundary inside their
overlap, they agree from there, and are stitched at that place.  The pieces
between stitches are whole pre-tokens; each is encoded by itself, and a text's
ids are its pieces' ids in order.  Decoding concatenates the bytes of the ids.

A text of one chunk is the degenerate case: there is nothing to stitch, and it
never leaves its task.  A text with an overlap that has no common boundary (a run
of letters or of white space longer than it) is encoded whole.  Wherever a text is
encoded, its long runs of white space are set apart first, by the rule that such a
run, without its last character if another one follows, is one pre-token: the
library would search the run backwards, and gives up on very long ones.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import FLUSH_BYTES, cells, in_batches, map_batches, stored, text_or_empty

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: A boundary counts only with so many more characters of its chunk behind it:
#: the chunk's end may cut a contraction ('re, 've) or a run short.
MARGIN = 8
#: White space (Unicode's), and how many in a row are a long run.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 1 << 16
_LONG_RUNS = re.compile(f"[{WHITE_SPACE}]{{{LONG_RUN},}}+")


@lru_cache(maxsize=4)
def _encoding(ranks_path: str, pattern: str):
    """The encoding of a rank file, made once in a worker."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _id_bytes(ranks_path: str) -> list[bytes]:
    with open(ranks_path, "rb") as lines:
        return [token for _, token in sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))]


@lru_cache(maxsize=4)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def boundaries(chunk: str, pattern: str) -> list[int]:
    """Ends of the chunk's pre-tokens that hang on nothing behind the chunk,
    without those after white space (a run of it may be cut in two ways)."""
    last = len(chunk) - MARGIN
    return [m.end() for m in _compiled(pattern).finditer(chunk) if m.end() <= last and not chunk[m.end() - 1].isspace()]


def without_long_runs(text: str) -> list[tuple[str, bool]]:
    """``text`` in pieces whose pre-tokens are the text's; with True, a piece is one
    pre-token: a long run of white space up to the end, or but for its last
    character before another."""
    if len(text) < LONG_RUN:
        return [(text, False)]
    pieces, done = [], 0
    for m in _LONG_RUNS.finditer(text):
        end = m.end() - (m.end() < len(text))
        pieces += [(text[done : m.start()], False), (text[m.start() : end], True)]
        done = end
    return [*pieces, (text[done:], False)]


def encode_text(text: str, ranks_path: str, pattern: str) -> np.ndarray:
    """The ids of a text (int32)."""
    encoding, ids = _encoding(ranks_path, pattern), []
    for piece, is_pretoken in without_long_runs(text):
        if is_pretoken:
            ids.append(np.array(encoding._encode_single_piece(piece), np.int32))
        else:
            ids.append(encoding.encode_to_numpy(piece, disallowed_special=()).astype(np.int32))
    return ids[0] if len(ids) == 1 else np.concatenate(ids)


def decode_ids(ids: np.ndarray, ranks_path: str) -> bytes:
    """The bytes of ids, in order."""
    return b"".join(map(_id_bytes(ranks_path).__getitem__, ids.tolist()))


def _encode_pieces(ranks_path: str, pattern: str, keep: dict[str, pa.DataType], decoded: bool) -> Callable:
    schema = pa.schema([*keep.items(), ("ids", pa.list_(pa.int32())), *([("decoded", pa.binary())] if decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, done = batch.column("text"), 0
            while done < batch.num_rows:
                ids, size, first = [], 0, done
                while done < batch.num_rows and size < FLUSH_BYTES:
                    ids.append(encode_text(texts[done].as_py(), ranks_path, pattern))
                    size += ids[-1].nbytes
                    done += 1
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                out = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))]
                if decoded:
                    out.append(pa.array([decode_ids(i, ranks_path) for i in ids], pa.binary()))
                kept = [batch.column(n).slice(first, done - first) for n in keep]
                yield pa.RecordBatch.from_arrays([*kept, *out], schema=schema)

    return run


def _cut(chunk_chars: int, overlap_chars: int) -> tuple[Callable, pa.Schema]:
    schema = pa.schema([("row_id", pa.int64()), ("chunk", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for row_id, text in cells(batches, "row_id", "text"):
                for k, start in enumerate(range(0, len(text), chunk_chars)):
                    piece = text[start : start + chunk_chars + overlap_chars]
                    yield 4 * len(piece), {"row_id": row_id, "chunk": k, "text": piece}

        yield from in_batches(rows(), schema)

    return run, schema


def _ends(pattern: str, chunk_chars: int, overlap_chars: int) -> Callable:
    schema = pa.schema([("row_id", pa.int64()), ("chunk", pa.int32()), ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for row_id, k, text in cells(batches, "row_id", "chunk", "text"):
                ends = boundaries(text, pattern)
                head = [e for e in ends if e <= overlap_chars]
                tail = [e - chunk_chars for e in ends if e >= chunk_chars]  # in the next chunk's places
                yield 16 * (len(head) + len(tail)) + 64, {"row_id": row_id, "chunk": k, "head": head, "tail": tail}

        yield from in_batches(rows(), schema)

    return run


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
    decoded: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (array<int>), without special
    tokens; with ``decoded``, the bytes that the ids decode to as well, from the same
    tasks (``decode`` does that for stored ids).

    NULL texts count as empty and have no ids; repeated rows are encoded each;
    other columns are not read; an empty table gives an empty result."""
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    whole = texts.where(F.length("text") <= chunk_chars)
    longer = texts.where(F.length("text") > chunk_chars).withColumn("row_id", F.monotonically_increasing_id())
    longer = stored(longer, "long-texts")

    cut, _ = _cut(chunk_chars, overlap_chars)
    chunks = map_batches(longer.select("row_id", "text"), cut, "row_id bigint, chunk int, text string")
    chunks = stored(chunks.repartition("row_id", "chunk"), "chunks")
    ends = map_batches(chunks, _ends(pattern, chunk_chars, overlap_chars), "row_id bigint, chunk int, head array<int>, tail array<int>")
    along = Window.partitionBy("row_id").orderBy("chunk")  # one light row per chunk of a text
    stitches = ends.withColumn("start", F.array_min(F.array_intersect("head", F.lag("tail").over(along))))
    stitches = stitches.withColumn("start", F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.col("start")))
    stitches = stitches.withColumns({
        "stop": F.lead("start").over(along) + chunk_chars,
        "last": F.lead("chunk").over(along).isNull(),
        "apart": F.max(F.col("start").isNull()).over(Window.partitionBy("row_id")),
    })
    stitches = stored(stitches.select("row_id", "chunk", "start", "stop", "last", "apart"), "stitches")

    piece = F.expr("substring(text, start + 1, if(last, length(text), stop - start))")
    pieces = chunks.join(stitches.where("not apart"), ["row_id", "chunk"]).select("row_id", "chunk", piece.alias("text"))
    found = ["ids", "decoded"] if decoded else ["ids"]
    out = "ids array<int>" + (", decoded binary" if decoded else "")
    run = _encode_pieces(ranks_path, pattern, {"row_id": pa.int64(), "chunk": pa.int32()}, decoded)
    pieces = map_batches(pieces, run, f"row_id bigint, chunk int, {out}")
    joined = pieces.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("chunk", *found))).alias("pieces"))  # one text's
    whole_bytes = F.unhex(F.array_join(F.transform("pieces.decoded", F.hex), "")) if decoded else F.lit(None)
    joined = joined.select("row_id", F.flatten("pieces.ids").alias("ids"), whole_bytes.alias("decoded"))
    stitched = longer.select("row_id", "doc_id").join(joined, "row_id").select("doc_id", *found)

    # Not stitched: texts of one chunk, and those with an overlap that agrees nowhere.
    apart = stitches.where("apart and chunk = 0").select("row_id")
    rest = whole.unionByName(longer.join(apart, "row_id", "left_semi").select("doc_id", "text"))
    doc_type = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.string()
    run = _encode_pieces(ranks_path, pattern, {"doc_id": doc_type}, decoded)
    return map_batches(rest, run, f"doc_id {id_type}, {out}").unionByName(stitched)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded`` (binary): the bytes of the ids in
    order.  NULL or no ids decode to no bytes."""
    names = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, done = batch.column(ids_col), 0
            while done < batch.num_rows:
                texts, size, first = [], 0, done
                while done < batch.num_rows and size < FLUSH_BYTES:
                    ids = lists[done].values
                    texts.append(decode_ids(ids.to_numpy(), ranks_path) if ids is not None else b"")
                    size += len(texts[-1])
                    done += 1
                part = batch.slice(first, done - first)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return map_batches(encoded.select(*names), run, schema)
