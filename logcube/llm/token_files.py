"""Token-id files with Elias-Fano document boundaries.

A file holds the ids of its documents one after another, two bytes each if the
vocabulary fits, and behind them the documents' ends as an Elias-Fano
sequence: of n ends up to u, the low log2(u / n) bits of each are packed, and
the high parts are one bit vector with a one per end at (high part + index).
That is about 2 + log2(u / n) bits per document.  The place of the i-th one,
and so the i-th end, is found from a sample of every 256th.  The ascending
document numbers are stored in the same way.

    ids | footer: low and high words, samples, of ends and of numbers | tail

All numbers are little-endian.  The tail has the counts and the magic.

Files are written by the tasks of one Spark job over documents in range
partitions, each streaming its ids out, under names of their own; only files
in the manifest, which Spark commits, belong to the result, so a lost or
repeated task leaves no trace in it.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import cells, map_batches, stored, text_or_empty

MAGIC = b"EFTOKEN1"
#: A sample of the upper bit vector's ones.
SAMPLE = 256
#: A file is closed when its ids hold so many bytes.
FILE_BYTES = 128 << 20
#: Tasks that read files back, at most.
READ_TASKS = 20_000
#: Pre-tokens that a worker remembers, and the longest of them.
KEPT_PRETOKENS, KEPT_CHARS = 690_000, 48

MANIFEST = "part int, seq int, file string, n_docs bigint, n_ids bigint"


# ---------------------------------------------------------------- Elias-Fano


@dataclass(frozen=True)
class EliasFano:
    """A non-decreasing sequence of ``n`` numbers from 0 to ``top``."""

    n: int
    low_bits: int
    low: np.ndarray  # uint64 words
    high: np.ndarray  # uint64 words
    samples: np.ndarray  # uint32: place of every SAMPLE-th one

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        index = np.arange(n, dtype=np.uint64)
        places = (values >> np.uint64(bits)) + index
        high = np.zeros((n + (top >> bits)) // 64 + 1, np.uint64)
        np.bitwise_or.at(high, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
        low = np.zeros(n * bits // 64 + 2, np.uint64)
        if bits:
            parts = values & np.uint64((1 << bits) - 1)
            at = index * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, parts << shift)
            over = shift + np.uint64(bits) > 64
            np.bitwise_or.at(low, word[over] + 1, parts[over] >> (np.uint64(64) - shift[over]))
        return EliasFano(n, bits, low, high, places[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        two = int(self.low[at >> 6]) | int(self.low[(at >> 6) + 1]) << 64
        return two >> (at & 63) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Number ``i`` of the sequence, from the sample before it."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        at = place >> 6
        word = int(self.high[at]) >> (place & 63) << (place & 63)
        while left >= word.bit_count():
            left -= word.bit_count()
            at += 1
            word = int(self.high[at])
        for _ in range(left):
            word &= word - 1
        one = at * 64 + (word & -word).bit_length() - 1
        return one - i << self.low_bits | self._low(i)

    def all(self) -> np.ndarray:
        """The whole sequence (uint64)."""
        ones = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))[: self.n].astype(np.uint64)
        index = np.arange(self.n, dtype=np.uint64)
        values = ones - index << np.uint64(self.low_bits)
        if self.low_bits:
            at = index * np.uint64(self.low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            upper = np.where(shift > 0, self.low[word + 1] << (np.uint64(64) - shift & np.uint64(63)), np.uint64(0))
            values |= (self.low[word] >> shift | upper) & np.uint64((1 << self.low_bits) - 1)
        return values

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.astype("<u8").tobytes() + self.high.astype("<u8").tobytes() + self.samples.astype("<u4").tobytes()

    @staticmethod
    def from_bytes(data: memoryview) -> tuple[EliasFano, memoryview]:
        """The sequence at the start of ``data``, and what follows it."""
        n, bits, *counts = struct.unpack_from("<QIQQQ", data)
        at, arrays = struct.calcsize("<QIQQQ"), []
        for count, kind in zip(counts, ("<u8", "<u8", "<u4"), strict=True):
            arrays.append(np.frombuffer(data, kind, count, at))
            at += arrays[-1].nbytes
        return EliasFano(n, bits, *arrays), data[at:]


# --------------------------------------------------------------------- files


def _file_system(uri: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


TAIL = struct.Struct("<QQIqQ8s")  # ids, bytes of the footer, bytes of an id, number of the first, documents without a number, magic


class FileWriter:
    """One file: ids are streamed out as they come, the footer at the end."""

    def __init__(self, folder: str, name: str, id_type: str):
        system, path = _file_system(folder)
        self.name, self.id_type = name, np.dtype(id_type)
        self.out = system.open_output_stream(f"{path}/{name}")
        self.n_ids, self.ends, self.numbers = 0, [], []

    def add(self, number: int | None, ids: np.ndarray) -> None:
        self.out.write(ids.astype(self.id_type).tobytes())
        self.n_ids += len(ids)
        self.ends.append(self.n_ids)
        self.numbers.append(number)

    def close(self) -> None:
        known = [x for x in self.numbers if x is not None]  # those without come first
        first = known[0] if known else 0
        footer = EliasFano.of(np.array(self.ends, np.uint64)).to_bytes()
        footer += EliasFano.of(np.array([x - first for x in known], np.uint64)).to_bytes()
        tail = TAIL.pack(self.n_ids, len(footer), self.id_type.itemsize, first, len(self.numbers) - len(known), MAGIC)
        self.out.write(footer + tail)
        self.out.close()


class FileReader:
    """Random access to the documents of one file."""

    def __init__(self, uri: str):
        system, path = _file_system(uri)
        self.source = system.open_input_file(path)
        size = self.source.size()
        tail = self.source.read_at(TAIL.size, size - TAIL.size)
        self.n_ids, footer, width, self.first, self.unnumbered, magic = TAIL.unpack(tail)
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        self.id_type = np.dtype(f"<u{width}")
        data = memoryview(self.source.read_at(footer, size - TAIL.size - footer))
        self.ends, rest = EliasFano.from_bytes(data)
        self._numbers, _ = EliasFano.from_bytes(rest)

    def __len__(self) -> int:
        return self.ends.n

    def offset(self, i: int) -> int:
        """Ids of the file before document ``i``."""
        return self.ends.select(i - 1) if i else 0

    def ids(self, i: int) -> np.ndarray:
        start, end = self.offset(i), self.offset(i + 1)
        width = self.id_type.itemsize
        return np.frombuffer(self.source.read_at((end - start) * width, start * width), self.id_type)

    def number(self, i: int) -> int | None:
        """Document number of document ``i``."""
        return self.first + self._numbers.select(i - self.unnumbered) if i >= self.unnumbered else None

    def documents(self, read_bytes: int = 8 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(number, offset, ids) of all documents, reading ahead in larger parts.
        Numbers and offsets are selected one by one, so nothing is unpacked whole."""
        width, first = self.id_type.itemsize, 0
        while first < len(self):
            places = [self.offset(first)]
            while first + len(places) <= len(self):
                places.append(self.offset(first + len(places)))
                if (places[-1] - places[0]) * width > read_bytes and len(places) > 2:
                    places.pop()  # of the next part
                    break
            part = np.frombuffer(self.source.read_at((places[-1] - places[0]) * width, places[0] * width), self.id_type)
            for k, (start, end) in enumerate(zip(places[:-1], places[1:], strict=True)):
                yield self.number(first + k), start, part[start - places[0] : end - places[0]]
            first += len(places) - 1


# ------------------------------------------------------------------ encoding

#: Up to here every Unicode version has the same letters, numbers and white space.
SETTLED = 0x300


def _settled_pattern() -> re.Pattern:
    """The byte-level pre-tokens ('s, letters, numbers, others, white space) of
    texts with settled characters only, with their classes written out."""

    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(SETTLED) if unicodedata.category(chr(c)).startswith(kind))

    letters, numbers, space = members("L"), members("N"), r"\t-\r \x85\xa0"
    return re.compile(
        f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def _byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself
    if it is printable in Latin-1, else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(0x100 + i) for i, b in enumerate(others)}


class _Merged(dict):
    """The ids of pre-tokens as little-endian 32-bit integers, merged by the
    library's model when first asked for."""

    def __init__(self, tokenize: Callable):
        self.tokenize, self.characters = tokenize, _byte_characters()

    def __missing__(self, token: str) -> bytes:
        if token.isascii() and token.isprintable():
            written = token.replace(" ", self.characters[32])
        else:
            written = token.encode().decode("latin-1").translate(self.characters)
        found = [t.id for t in self.tokenize(written)]
        ids = struct.pack(f"<{len(found)}I", *found)
        if len(token) <= KEPT_CHARS and len(self) < KEPT_PRETOKENS:
            self[token] = ids
        return ids


class PretokenEncoder:
    """Encodes texts by a byte-level BPE file of the tokenizers library, whose
    model merges every distinct pre-token; frequent ones are remembered, up to a
    number of them.  A text with unsettled characters is left to the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        if kind["model"]["type"] != "BPE" or kind["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        self.pretokens = _settled_pattern().findall
        self.unsettled = re.compile(f"[^\\x00-{chr(SETTLED - 1)}]").search
        self.merged = _Merged(self.tokenizer.model.tokenize).__getitem__

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers."""
        if self.unsettled(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.merged, self.pretokens(text)))


@lru_cache(maxsize=2)
def _pretoken_encoder(path: str) -> PretokenEncoder:
    return PretokenEncoder(path)


def byte_level_encoder(path: str, end_id: int | None = None) -> Callable[[str], np.ndarray]:
    """Encoder without special tokens, but for ``end_id`` behind every text."""
    end = b"" if end_id is None else struct.pack("<I", end_id)
    return lambda text: np.frombuffer(_pretoken_encoder(path).encode(text) + end, "<u4")


# ---------------------------------------------------------------------- jobs


def write_token_files(
    docs: DataFrame,
    folder: str,
    encode: Callable[[str], np.ndarray],
    vocabulary: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write the ids of all texts under ``folder`` in ascending document number
    (NULL first, then by a hash of the text); returns the manifest (part, seq,
    file, n_docs, n_ids), files in the order of (part, seq).

    ``folder`` is shared by all executors and of a kind that pyarrow opens.
    NULL texts count as empty; repeated rows are written each; other columns
    are not read; an empty table gives no files.  The empty manifest row of a
    partition without rows is left out."""
    id_type = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, seq, done = None, 0, []

        def finish(part: int) -> None:
            writer.close()
            done.append({"part": part, "seq": seq, "file": writer.name, "n_docs": len(writer.ends), "n_ids": writer.n_ids})

        part = 0
        for number, text, part in cells(batches, "doc_id", "text", "part"):
            if writer is None:
                writer = FileWriter(folder, f"{part:06d}-{seq:04d}-{uuid.uuid4().hex}.tok", id_type)
            writer.add(number, encode(text))
            if writer.n_ids * writer.id_type.itemsize >= file_bytes:
                finish(part)
                writer, seq = None, seq + 1
        if writer is not None:
            finish(part)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=MANIFEST_ARROW)

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("place"))
    rows = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    system, path = _file_system(folder)
    system.create_dir(path, recursive=True)
    return stored(map_batches(rows, run, MANIFEST), "manifest")


MANIFEST_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def read_token_files(manifest: DataFrame, folder: str, of_ids: dict[str, tuple[str, Callable[[np.ndarray], object]]] | None = None) -> DataFrame:
    """(doc_id, start, ...) of all documents, read back from the files; start
    is the number of ids of all documents before it.  ``of_ids`` names the other
    columns: a Spark type and a function of the document's ids (array of
    unsigned integers); by default ids, the ids themselves (array<int>)."""
    of_ids = of_ids or {"ids": ("array<int>", lambda ids: ids.astype(np.int32))}
    before = F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))  # one row per file
    placed = manifest.select("file", F.coalesce(before, F.lit(0)).cast("bigint").alias("before"))
    schema = "doc_id bigint, start bigint, " + ", ".join(f"{name} {kind}" for name, (kind, _) in of_ids.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", *of_ids]
        for rows in batches:
            for name, base in zip(rows.column("file").to_pylist(), rows.column("before").to_pylist(), strict=True):
                held, size = [], 0
                for number, offset, ids in FileReader(f"{folder}/{name}").documents():
                    held.append((number, base + offset, *[f(ids) for _, f in of_ids.values()]))
                    size += len(ids)
                    if size >= 1 << 20:
                        yield batch(held, names)
                        held, size = [], 0
                if held:
                    yield batch(held, names)

    def batch(held: list[tuple], names: list[str]) -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *map(pa.array, columns[2:])]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    # A number of partitions, as Spark would join the few small rows in one task.
    tasks = max(1, min(manifest.count(), READ_TASKS))
    return map_batches(placed.repartition(tasks), run, schema)
