"""Quality rules: fixed counts, and a linear-chain conditional random field that
marks every line of a document as content or boilerplate.

A line with a word is a position of the chain.  Its features are bins of simple
ratios (symbols, capitals, digits, exclamation marks, separators, repeated words
and lines, ...), no words, so they hold for any script.  Viterbi decoding gives
the best marks of the whole chain; the share of a document's word characters
that lie in content lines is held against ``MIN_SHARE``.

The field is trained in numpy, by the gradient of its likelihood, on a bounded
sample of documents with a quality label: ``SAMPLE_DOCS`` by hash of their id,
``SAMPLE_LINES`` neighbouring lines of each.  Labels are of documents, marks of lines:
lines of good documents are content; those of bad ones start as boilerplate, and
after every round of training those that the field takes for content become so,
as a bad document may hold good lines.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import cells, in_batches, map_batches, text_or_empty

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: A document stays if so much of its word characters is in content lines.
MIN_SHARE = 0.5

SAMPLE_DOCS, SAMPLE_LINES = 2000, 32
ROUNDS, STEPS, RATE, DECAY = 3, 60, 0.2, 2e-3

#: Classes of characters.
SPACE, LOWER, UPPER, LETTER, DIGIT, STOP, SHOUT, BAR, SYMBOL, PLAIN = range(10)
CLASSES = 10
#: Code points whose classes are looked up at a time.
POINTS = 1 << 20

#: Upper edges of the bins of each feature but the last three, which count cases.
EDGES = {
    "words": (2, 4, 8, 16),
    "symbols": (0.001, 0.02, 0.05, 0.1, 0.2),
    "capitals": (0.15, 0.3, 0.6, 0.9),
    "letters": (0.3, 0.5, 0.7, 0.85),
    "digits": (0.001, 0.05, 0.2, 0.5),
    "shouts": (0.001, 0.1, 0.3, 0.6),
    "bars": (0.001, 0.1, 0.3),
    "distinct": (0.3, 0.5, 0.7, 0.9),
    "length": (2.5, 4, 7, 10, 15),
}
BINS = 8
FEATURES = (*EDGES, "stops", "repeated", "place")


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point below 0x10000, and of those above in the last place."""
    table = np.full(0x10001, PLAIN, np.uint8)
    by_category = {"Ll": LOWER, "Lu": UPPER, "Lt": UPPER, "Lm": LETTER, "Lo": LETTER, "Mn": LETTER, "Mc": LETTER, "Nd": DIGIT, "Nl": DIGIT, "No": DIGIT}
    for point in range(0x10000):
        category = unicodedata.category(chr(point))
        table[point] = by_category.get(category, SYMBOL if category[0] == "S" else PLAIN)
    for marks, kind in ((".,;:…。、，．", STOP), ("!?！？", SHOUT), ("|•·»›¦", BAR), (SYMBOLS.replace("|", "") + "@\\^_~{}[]=+", SYMBOL)):
        table[[ord(c) for c in marks]] = kind
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    return table


@dataclass(frozen=True)
class Lines:
    """A text's counts, and of its lines with a word: bins of the features
    (lines x features) and word characters."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    bins: np.ndarray
    chars: np.ndarray


def _counts(text: str, n_lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Characters by line and class, and words by line."""
    counts, words = np.zeros(n_lines * CLASSES, np.int64), np.zeros(n_lines, np.int64)
    table, line, in_word = _classes(), 0, False
    for start in range(0, len(text), POINTS):
        points = np.frombuffer(text[start : start + POINTS].encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds = table[np.minimum(points, 0x10000)]
        ends = points == 10
        lines = np.cumsum(ends) - ends  # from the part's first line on
        found = np.bincount(lines * CLASSES + kinds)
        counts[line * CLASSES : line * CLASSES + len(found)] += found
        inside = kinds != SPACE
        found = np.bincount(lines[inside & ~np.concatenate([[in_word], inside[:-1]])])
        words[line : line + len(found)] += found
        line, in_word = line + int(ends.sum()), bool(inside[-1])
    return counts.reshape(n_lines, CLASSES), words


def _repeated(ids: np.ndarray) -> int:
    """Words in windows of three that are found twice or more."""
    if len(ids) < 4:
        return 0
    windows = np.stack([ids[:-2], ids[1:-1], ids[2:]])
    order = np.lexsort(windows)
    same = (windows[:, order[1:]] == windows[:, order[:-1]]).all(axis=0)
    twice = np.zeros(len(order), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    covered = np.zeros(len(ids), bool)
    for i in range(3):
        covered[i : len(ids) - 2 + i] |= twice
    return int(covered.sum())


def describe(text: str) -> Lines:
    """Counts and lines of a text; words are runs of other than ASCII white space."""
    lines = text.split("\n")
    counts, line_words = _counts(text, len(lines))
    words = text.encode("utf-8", "surrogatepass").split()
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    at = np.flatnonzero(line_words)
    seen: dict[str, int] = {}
    again = np.zeros(len(at), bool)  # equal to another line
    n_dup = 0
    for k, i in enumerate(at.tolist()):
        first = seen.setdefault(lines[i], k)
        if first != k:
            again[first] = again[k] = True
            n_dup += 1
    word_chars = int(counts[:, 1:].sum())
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    counts, n = counts[at].astype(float), line_words[at]
    chars = counts[:, 1:].sum(axis=1)
    pairs = np.unique(np.repeat(np.arange(len(at)), n) * max(1, len(known)) + ids)
    distinct = np.bincount(pairs // max(1, len(known)), minlength=len(at)) / np.maximum(n, 1)
    cased = counts[:, LOWER] + counts[:, UPPER]
    values = {
        "words": n,
        "symbols": counts[:, SYMBOL] / np.maximum(chars, 1),
        "capitals": np.where(cased < 8, np.nan, counts[:, UPPER] / np.maximum(cased, 1)),
        "letters": counts[:, LOWER : LETTER + 1].sum(axis=1) / np.maximum(chars, 1),
        "digits": counts[:, DIGIT] / np.maximum(chars, 1),
        "shouts": counts[:, SHOUT] / np.maximum(n, 1),
        "bars": counts[:, BAR] / np.maximum(n, 1),
        "distinct": np.where(n < 4, np.nan, distinct),
        "length": chars / np.maximum(n, 1),
    }
    bins = np.zeros((len(at), len(FEATURES)), np.uint8)
    for k, (name, edges) in enumerate(EDGES.items()):
        bins[:, k] = np.where(np.isnan(values[name]), BINS - 1, np.digitize(values[name], edges))
    last = [lines[i].rstrip() for i in at]
    bins[:, -3] = [s[-1] in ".!?…。！？:;" if s else False for s in last]
    bins[:, -2] = again
    place = np.zeros(len(at), np.uint8)
    if len(at):
        place[0] += 1
        place[-1] += 2
    bins[:, -1] = place
    return Lines(len(words), word_chars, n_symbols, n_dup, _repeated(ids), bins, chars.astype(np.int64))


# ------------------------------------------------------------------- the field


@dataclass(frozen=True)
class Field:
    """Scores: of content over boilerplate by feature and bin, of the marks of
    two neighbouring lines, and of the first line's.  Mark 1 is content."""

    bins: np.ndarray  # (features, BINS)
    steps: np.ndarray  # (2, 2)
    start: np.ndarray  # (2,)

    def emissions(self, bins: np.ndarray) -> np.ndarray:
        return self.bins[np.arange(self.bins.shape[0]), bins].sum(axis=-1)

    def viterbi(self, bins: np.ndarray) -> np.ndarray:
        """The best marks of a document's lines (booleans: content)."""
        n = len(bins)
        out = np.ones(n, bool)
        if not n:
            return out
        (a00, a01), (a10, a11) = self.steps.tolist()
        scores = self.emissions(bins).tolist()
        low, high = float(self.start[0]), float(self.start[1]) + scores[0]
        from_low, from_high = [], []  # the mark before each boilerplate, each content
        for e in scores[1:]:
            stay, fall = low + a00, high + a10
            rise, keep = low + a01, high + a11
            from_low.append(fall >= stay)
            from_high.append(keep >= rise)
            low, high = max(stay, fall), max(rise, keep) + e
        mark = high >= low
        out[-1] = mark
        for t in range(n - 2, -1, -1):
            mark = from_high[t] if mark else from_low[t]
            out[t] = mark
        return out


def _log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def likelihood(field: Field, bins: np.ndarray, mask: np.ndarray, marks: np.ndarray) -> tuple[float, Field]:
    """Log-likelihood of the marks (documents x lines, padded behind ``mask``),
    and its gradient."""
    n, steps, n_features = bins.shape
    e = np.zeros((n, steps, 2))
    e[..., 1] = np.where(mask, field.emissions(bins), 0)
    a = field.steps
    forward, backward = np.zeros((n, steps, 2)), np.zeros((n, steps, 2))
    forward[:, 0] = field.start + e[:, 0]
    for t in range(1, steps):
        before = forward[:, t - 1, :, None] + a
        new = _log_sum(before[:, 0], before[:, 1]) + e[:, t]
        forward[:, t] = np.where(mask[:, t, None], new, forward[:, t - 1])
    for t in range(steps - 2, -1, -1):
        after = a + (e[:, t + 1] + backward[:, t + 1])[:, None]
        new = _log_sum(after[..., 0], after[..., 1])
        backward[:, t] = np.where(mask[:, t + 1, None], new, backward[:, t + 1])
    total = _log_sum(forward[:, -1, 0], forward[:, -1, 1])
    some = mask[:, 0]
    single = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
    y = np.stack([~marks, marks], axis=-1) * mask[..., None]
    both = mask[:, 1:]
    joint = np.exp(forward[:, :-1, :, None] + a + (e[:, 1:] + backward[:, 1:])[:, :, None] - total[:, None, None, None]) * both[..., None, None]
    seen = y[:, :-1, :, None] * y[:, 1:, None, :] * both[..., None, None]
    value = (e * y).sum() + (seen * a).sum() + (y[some, 0] * field.start).sum() - total[some].sum()
    error = (y - single)[..., 1]
    slots = bins + np.arange(n_features) * BINS
    by_bin = np.bincount(slots.ravel(), np.repeat(error.ravel(), n_features), minlength=n_features * BINS).reshape(n_features, BINS)
    return float(value), Field(by_bin, (seen - joint).sum(axis=(0, 1)), (y - single)[some, 0].sum(axis=0))


def fit(documents: list[np.ndarray], good: list[bool]) -> Field | None:
    """A field from the bins of documents and their labels; None without both."""
    chosen = [(d, g) for d, g in zip(documents, good, strict=True) if len(d)]
    if len({g for _, g in chosen}) < 2:
        return None
    longest = max(len(d) for d, _ in chosen)
    bins = np.zeros((len(chosen), longest, len(FEATURES)), np.int64)
    mask = np.zeros((len(chosen), longest), bool)
    for k, (d, _) in enumerate(chosen):
        bins[k, : len(d)], mask[k, : len(d)] = d, True
    fine = np.array([g for _, g in chosen])
    marks = mask & fine[:, None]
    lines = mask.sum()
    for _ in range(ROUNDS):
        field = Field(np.zeros((len(FEATURES), BINS)), np.zeros((2, 2)), np.zeros(2))
        names = ("bins", "steps", "start")
        first, second = ({k: 0.0 for k in names} for _ in range(2))
        for step in range(1, STEPS + 1):
            _, gradient = likelihood(field, bins, mask, marks)
            changed = {}
            for k in names:
                d = getattr(gradient, k) / lines - DECAY * getattr(field, k)
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.99 * second[k] + 0.01 * d * d
                changed[k] = getattr(field, k) + RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-9)
            field = Field(**changed)
        for k in np.flatnonzero(~fine):
            marks[k, : mask[k].sum()] = field.viterbi(bins[k][mask[k]])
    return field


# ------------------------------------------------------------------------ jobs


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> Field | None:
    """A field from the documents with a quality label (0 or 1) in ``labels``,
    of those ids for which ``learn`` (an expression on ``labels``) holds.  None,
    which takes every line for content, without labelled documents of both kinds."""
    known = labels.where(F.col(quality_col).isin(0, 1) & F.col(id_col).isNotNull())
    known = (known if learn is None else known.where(learn)).groupBy(F.col(id_col).alias("known")).agg(F.min(quality_col).alias("good"))
    known = known.orderBy(F.xxhash64("known"), "known").limit(SAMPLE_DOCS)  # bounded, so broadcast
    texts = docs.select(F.col(id_col).alias("doc"), text_or_empty(text_col).alias("text"))
    texts = texts.join(F.broadcast(known), F.col("doc") == F.col("known")).select(F.col("good").cast("int").alias("good"), F.xxhash64("known", "text").alias("place"), "text")
    schema = pa.schema([("place", pa.int64()), ("good", pa.int32()), ("bins", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for text, good, place in cells(batches, "text", "good", "place"):
                bins = describe(text).bins
                start = place % max(1, len(bins) - SAMPLE_LINES + 1)
                part = bins[start : start + SAMPLE_LINES]
                yield part.size + 64, {"place": place, "good": good, "bins": part.tobytes()}

        yield from in_batches(rows(), schema)

    sample = map_batches(texts, run, "place bigint, good int, bins binary").orderBy("place").limit(SAMPLE_DOCS).toArrow()
    documents = [np.frombuffer(b, np.uint8).reshape(-1, len(FEATURES)) for b in sample["bins"].to_pylist()]
    return fit(documents, [g == 1 for g in sample["good"].to_pylist()])


def judge(
    docs: DataFrame,
    field: Field | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_share: float = MIN_SHARE,
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, n_lines (with a word),
    n_boilerplate (of these), content_share (of the word characters) and kept.

    A text that is NULL, empty or without words has zeros, fails the base rules
    and has share 0.  Repeated rows are judged each; other columns are not read;
    an empty table gives an empty result."""
    columns = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())]
    schema = pa.schema([
        ("doc_id", pa.int64()), *columns, ("base_failed", pa.bool_()), ("n_lines", pa.int64()), ("n_boilerplate", pa.int64()), ("content_share", pa.float64()), ("kept", pa.bool_())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc_id, text in cells(batches, "doc_id", "text"):
                found = describe(text)
                content = np.ones(len(found.bins), bool) if field is None else field.viterbi(found.bins)
                share = float(found.chars[content].sum() / found.word_chars) if found.word_chars else 0.0
                failed = found.n_words < min_words or 100 * found.n_repeat_words > max_repeated_percent * found.n_words
                row = {"doc_id": doc_id, **{n: getattr(found, n) for n, _ in columns}, "base_failed": failed}
                yield 128, row | {"n_lines": len(content), "n_boilerplate": int((~content).sum()), "content_share": share, "kept": not failed and share >= min_share}

        yield from in_batches(rows(), schema)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    out = ", ".join(f"{n} bigint" for n, _ in columns)
    return map_batches(texts, run, f"doc_id bigint, {out}, base_failed boolean, n_lines bigint, n_boilerplate bigint, content_share double, kept boolean")
