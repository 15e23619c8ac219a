"""Secret scan: known forms, and character Markov models for the others.

Three patterns find the known forms.  All other runs of token characters are
scored by character Markov models, one of ordinary words and identifiers and one
of random strings for each of several alphabets: the log-likelihood ratio of the
transitions says which would rather write them.  A secret may be a part of a run
(behind a path, say), so the stretch of the greatest ratio is sought, and the ratio
alone decides: no length, character class or separator is asked for.

The models are trained from labelled samples: the values that the known forms
catch in the documents and seeded random strings are random, all other runs of
the documents are ordinary, and so are identifiers written from their words (in
camel case, with dashes, numbers, ...).  The transitions of all documents are counted in
their tasks and added up; the driver gets one number per pair of characters.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import cells, in_batches, map_batches, text_or_empty

#: Kinds of spans, in their order at one place.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
#: Every match of ASSIGN has one of these in lower case.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Characters of the models.
CHARACTERS = string.ascii_letters + string.digits + "+/_=-"
#: A stretch counts from this log-likelihood ratio on (nats).  Were text written by
#: the ordinary model, one in about e ** MIN_RATIO places would begin such a stretch.
MIN_RATIO = 25.0
#: Seeded random strings of each alphabet, beside those of the documents.
RANDOM_STRINGS, RANDOM_CHARS = 400, 40
#: Alphabets of random strings, each with a model; a value of the documents belongs
#: to the first that has all its characters.
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", string.ascii_lowercase, string.ascii_uppercase, string.ascii_lowercase + string.digits,
    string.ascii_uppercase + string.digits, CHARACTERS[:52], CHARACTERS[:62], CHARACTERS[:62] + "_-", CHARACTERS[:62] + "+/=",
)
#: Added to every count of transitions.
SMOOTHING = 0.5
#: Share of the ordinary model that hangs on the second character alone, and of that
#: the share that is alike for all: an unseen transition is rare, not impossible.
#: Another share repeats the first character, as rules and fillers do.
SINGLE, ALIKE, REPEATED = 0.1, 0.1, 0.08
#: Pairs of words of a document from which identifiers are written.
IDENTIFIERS = 8
LETTERS = re.compile(r"[A-Za-z]{2,}")
#: Takes the ratio of a stretch away wherever a run ends.
END = -1e4

N = len(CHARACTERS)
_CODES = np.full(256, N, np.uint8)  # N: not a character of the models
_CODES[np.frombuffer(CHARACTERS.encode(), np.uint8)] = np.arange(N)


def known_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the known forms, in order."""
    found, lower = [], text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [("assign", *m.span(), m.start(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        found += [("access", *m.span(), m.start()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if max(map(len, text.split()), default=0) >= HEX_CHARS:
        found += [("hex", *m.span(), m.start()) for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _codes(text: str) -> np.ndarray:
    """A code per code point; those outside the models have N."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(points < 128, _CODES[np.minimum(points, 255)], N).astype(np.int64)


def _transitions(codes: np.ndarray) -> np.ndarray:
    a, b = codes[:-1], codes[1:]
    inside = (a < N) & (b < N)
    return np.bincount(a[inside] * N + b[inside], minlength=N * N)


def _alphabet(codes: np.ndarray) -> int:
    """Number of the first alphabet with all the characters, else of the last."""
    present = set(codes[codes < N].tolist())
    fits = (k for k, letters in enumerate(_ALPHABET_CODES) if present <= letters)
    return next(fits, len(ALPHABETS) - 1)


_ALPHABET_CODES = [frozenset(_CODES[np.frombuffer(a.encode(), np.uint8)].tolist()) for a in ALPHABETS]


def _random_transitions(seed: int) -> np.ndarray:
    """Counts (alphabets x N * N) of the seeded random strings."""
    rng, total = np.random.default_rng(seed), np.zeros((len(ALPHABETS), N * N))
    for k, alphabet in enumerate(ALPHABETS):
        letters = _CODES[np.frombuffer(alphabet.encode(), np.uint8)].astype(np.int64)
        for row in letters[rng.integers(0, len(letters), (RANDOM_STRINGS, RANDOM_CHARS))]:
            total[k] += _transitions(row)
    return total


def identifiers(text: str) -> Iterator[str]:
    """Ordinary identifiers from words all over the text."""
    words = text.split()
    step = max(1, len(words) // (2 * IDENTIFIERS))
    found = [m[0].lower() for m in map(LETTERS.search, words[::step]) if m]
    for i, (u, v) in enumerate(zip(found[::2], found[1::2], strict=False)):
        number = str((len(words) * 7 + i * 331) % 10 ** (1 + i % 4))
        yield from (u + v.title(), u.title() + v.title(), f"{u}_{v}", f"{u}-{v}", f"{u}/{v}", f"{u}={v}", f"{u.upper()}_{v.upper()}", u + number, f"{u}-{number}", f"{number}_{v}")
        yield f"{1990 + i * 5}-{1 + i:02d}-{(len(words) + i) % 28 + 1:02d}-{u}"


def train(docs: DataFrame, text_col: str = "text", seed: int = 0) -> np.ndarray:
    """Log-likelihood ratios (alphabets x N x N) of the transitions, random over
    ordinary, from the labelled runs of all documents."""
    ordinary = len(ALPHABETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((ordinary + 1, N * N), np.int64)
        for (text,) in cells(batches, "text"):
            codes, known = _codes(text), known_spans(text)
            for _, _, end, value in known:
                counts[_alphabet(codes[value:end])] += _transitions(codes[value:end])
            for _, start, end, _ in known:
                codes[start:end] = N
            counts[ordinary] += _transitions(codes) + _transitions(_codes(" ".join(identifiers(text))))
        rows = ((24, {"model": int(k), "pair": int(p), "n": int(counts[k, p])}) for k, p in zip(*np.nonzero(counts), strict=True))
        yield from in_batches(rows, pa.schema([("model", pa.int32()), ("pair", pa.int32()), ("n", pa.int64())]))

    texts = docs.select(text_or_empty(text_col).alias("text"))
    counted = map_batches(texts, run, "model int, pair int, n bigint").groupBy("model", "pair").agg(F.sum("n").alias("n"))
    counts = np.concatenate([_random_transitions(seed), np.zeros((1, N * N))])
    for row in counted.collect():  # one row per model and pair of characters at most
        counts[row.model, row.pair] += row.n
    return ratios(counts)


def ratios(counts: np.ndarray) -> np.ndarray:
    """Log-likelihood ratios from the counts of the random models and, in the last
    row, of the ordinary one."""
    counts = counts.reshape(-1, N, N) + SMOOTHING
    likely = counts / counts.sum(axis=2, keepdims=True)
    single = counts[-1].sum(axis=0) / counts[-1].sum()
    ordinary = (1 - SINGLE - REPEATED) * likely[-1] + SINGLE * ((1 - ALIKE) * single + ALIKE / N) + REPEATED * np.eye(N)
    return np.log(likely[:-1]) - np.log(ordinary)


def stretches(steps: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """(first, last, sum) of parts of ``steps`` that do not meet, with sums of
    ``least`` at least: where the sum since the lowest one before comes so high, the
    part up to its peak, and then the same behind the peak."""
    sums = np.concatenate([[0.0], np.cumsum(steps)])
    depth = -np.minimum.accumulate(sums)  # never falls
    out, done = [], -1
    for at in np.flatnonzero(sums + depth >= least).tolist():
        if at <= done:
            continue
        start = int(np.searchsorted(depth, depth[at]))  # the lowest sum before, its first place
        end = int(np.searchsorted(depth, depth[at], "right"))  # where the sum falls below it
        peak = at + int(sums[at:end].argmax())
        out.append((start, peak - 1, float(sums[peak] - sums[start])))
        out += [(peak + first, peak + last, total) for first, last, total in stretches(steps[peak : end - 1], least)]
        done = end - 1
    return out


def random_spans(text: str, ratios: np.ndarray, taken: list[tuple[int, int]], min_ratio: float = MIN_RATIO) -> list[tuple[int, int, float]]:
    """(start, end, ratio) of the stretches that a random model would rather
    write, outside the spans of ``taken``.  A stretch is widened to the letters
    and digits around it; of two that meet, the one of the greater ratio counts."""
    codes = _codes(text)
    for start, end in taken:
        codes[start:end] = N
    a, b = codes[:-1], codes[1:]
    inside = (a < N) & (b < N)
    pairs = np.where(inside, a * N + b, N * N)

    def steps(table: np.ndarray) -> np.ndarray:
        return np.append(table.ravel(), END)[pairs]

    upper = np.cumsum(steps(ratios.max(axis=0)))  # no model's stretch has more
    if (upper - np.minimum(np.minimum.accumulate(upper), 0)).max(initial=0) < min_ratio:
        return []
    found = [s for table in ratios for s in stretches(steps(table), min_ratio)]
    plain = codes < 62  # letters and digits
    out: list[tuple[int, int, float]] = []
    for first, last, score in sorted(found, key=lambda s: (-s[2], s[0])):
        start, end = first, last + 2
        while start > 0 and plain[start - 1]:
            start -= 1
        while end < len(codes) and (plain[end] or text[end] == "=" and text[end - 1] != " "):
            end += 1
        if all(end <= s or e <= start for s, e, _ in out):
            out.append((start, end, score))
    return out


def scanner(ratios: np.ndarray) -> Callable[[str], list[dict]]:
    """Spans of a text: kind, start, end (code points, end exclusive) and, of
    those of the models, the ratio."""

    def scan(text: str) -> list[dict]:
        known = known_spans(text)
        spans = [{"kind": k, "start": s, "end": e, "ratio": None} for k, s, e, _ in known]
        spans += [{"kind": "markov", "start": s, "end": e, "ratio": r} for s, e, r in random_spans(text, ratios, [x[1:3] for x in known])]
        return sorted(spans, key=lambda x: (x["start"], KINDS.index(x["kind"])))

    return scan


def scan_secrets(docs: DataFrame, ratios: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of kind, start, end,
    ratio) in order; empty without secrets, for NULL and for empty texts.
    Repeated rows are scanned each; other columns are not read; an empty table
    gives an empty result, and a model trained on one knows random strings only."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(ratios)
        found = ((64, {"doc_id": d, "spans": scan(text)}) for d, text in cells(batches, "doc_id", "text"))
        yield from in_batches(((n + 64 * len(r["spans"]), r) for n, r in found), schema)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_batches(texts, run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,ratio:double>>")
