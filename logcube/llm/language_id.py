"""Language identification: averaged hashed subword embeddings and a linear
softmax, trained by stochastic gradient descent, with calibrated rejection.

A text's subwords are all its windows of 3 and of 4 bytes, with ASCII letters in
lower case and everything else in ASCII as a space.  Each is hashed to a row of
an embedding table; the mean of a text's rows goes through a linear softmax.

Training uses a bounded sample: ``SAMPLE_DOCS`` labelled documents, as many of
each language, chosen by hash, and ``SAMPLE_WINDOWS`` subwords of each, drawn from
its whole text.  A part of the sample is held back; on it the softmax gets its
temperature, and the rejection its threshold: the lowest score from which on
the accepted texts have at most ``MAX_ERROR`` wrong languages.

The softmax only compares the learnt languages, and is sure of one for noise or
another language as well.  A text is therefore also rejected if its subwords are
too rare in the likeliest language: their mean log-likelihood lies further below
that of held-back texts, in deviations for as many different subwords, than the
limit.  The limit comes from the held-back texts alone: each is also measured in
every other language, as a text of one that was never learnt would be, and the
limit is in the middle between the median of these and what all but ``MAX_ODD`` of
the texts reach in their own language.

Prediction reads whole texts.  The mean and the linear layer commute, so the
table is multiplied with the layer once, and a text costs one row of scores per
subword.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import cells, in_batches, map_batches, text_or_empty

SAMPLE_DOCS, SAMPLE_WINDOWS = 6000, 256
SIZES = (3, 4)
BUCKETS = 1 << 15
DIMENSIONS = 16
STEPS, BATCH, RATE = 500, 64, 4.0
#: One in so many sampled documents is held back for the calibration.
CALIBRATION = 5
MAX_ERROR = 0.01
#: Share of held-back texts below which the limit of rare subwords lies.
MAX_ODD = 0.002
#: The limit where only one language is learnt.
ONE_LANGUAGE = -8.0
#: Added to every count of subwords.  Languages with fewer held-back texts than
#: this share the mean of all.
SMOOTHING, MIN_TEXTS = 0.5, 20
UNDETERMINED = "und"

_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[:128] = [ord(chr(b).lower()) if chr(b).isalpha() else ord(" ") for b in range(128)]


def windows(text: str) -> np.ndarray:
    """Embedding rows of all subwords, those of each size one after another."""
    data = _BYTES[np.frombuffer(b" " + text.encode() + b"   ", np.uint8)].astype(np.uint64)
    out = []
    for k, size in enumerate(SIZES):
        n = len(data) - size + 1
        gram = np.zeros(n, np.uint64)
        for i in range(size):
            gram |= data[i : n + i] << np.uint64(8 * i)
        bucket = gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 15)
        out.append(bucket.astype(np.int64) + k * BUCKETS)
    return np.concatenate(out)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Typical:
    """How likely subwords are in each language, and how likely its texts are."""

    likely: np.ndarray  # log-probability of a subword in each language, float32
    mean: np.ndarray  # of a text's mean log-likelihood, per language
    between: float  # variance between texts
    within: float  # variance between the subwords of a text
    lowest: float  # deviations from the mean below which a text is rejected

    def deviations(self, rows: np.ndarray, language: int) -> float:
        mean, _, different = _likelihood(self.likely, rows, language)
        return (mean - self.mean[language]) / np.sqrt(self.between + self.within / different)


def _likelihood(likely: np.ndarray, rows: np.ndarray, language: int) -> tuple[float, float, float]:
    """Mean and variance of the log-likelihoods of a text's subwords, and how many
    independent ones would have such a mean: repeated ones say nothing new."""
    found, counts = np.unique(rows, return_counts=True)
    share = counts / len(rows)
    value = likely[found, language].astype(np.float64)
    mean = float(share @ value)
    return mean, float(share @ (value - mean) ** 2), float(1 / (share @ share))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # rows of the embedding table through the linear layer, float32
    bias: np.ndarray
    temperature: float
    threshold: float
    typical: Typical | None = None

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.languages))
        for start in range(0, len(rows), 1 << 18):
            total += self.scores[rows[start : start + (1 << 18)]].sum(0, dtype=np.float64)
        return _softmax((total / len(rows) + self.bias)[None] / self.temperature)[0]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the text is rejected."""
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        rows = windows(text)
        p = self.probabilities(rows)
        best = int(p.argmax())
        odd = self.typical is not None and self.typical.deviations(rows, best) < self.typical.lowest
        return self.languages[best], float(p[best]), odd or bool(p[best] < self.threshold)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, sample_docs: int) -> list[tuple[str, np.ndarray]]:
    """(language, subwords) of the sampled documents, in an order of their own."""
    text = text_or_empty(text_col)
    rows = docs.where(learn).select(F.col(lang_col).alias("lang"), text.alias("text"), F.xxhash64(F.col(id_col).cast("string"), text).alias("place"))
    rows = rows.where("lang is not null")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    if not counts:
        return []
    each = sample_docs / len(counts)
    below = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(min(1.0, each / n))) for lang, n in sorted(counts.items())])
    unit = F.pmod("place", F.lit(1 << 30)) / float(1 << 30)
    schema = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("rows", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for lang, text, place in cells(batches, "lang", "text", "place"):
                if has_letter(text):
                    drawn = np.random.default_rng(place & 0xFFFFFFFF).choice(windows(text), SAMPLE_WINDOWS)
                    yield 4 * SAMPLE_WINDOWS, {"lang": lang, "place": place, "rows": drawn}

        yield from in_batches(found(), schema)

    drawn = map_batches(rows.where(unit < below), run, "lang string, place bigint, rows array<int>").collect()  # about sample_docs rows
    return [(r.lang, np.array(r.rows)) for r in sorted(drawn, key=lambda r: (r.place, r.lang, r.rows))]


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    max_error: float = MAX_ERROR,
    seed: int = 0,
) -> Model:
    """Fit the model to documents where ``learn`` holds and the language is
    known.  Without any, the model knows no language."""
    sample = _sample(docs, learn, id_col, text_col, lang_col, sample_docs)
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], np.zeros((0, 0), np.float32), np.zeros(0), 1.0, 0.0)
    rows = np.stack([r for _, r in sample])
    y = np.array([languages.index(lang) for lang, _ in sample])
    held = np.arange(len(y)) % CALIBRATION == 0
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(y))
    rng, n = np.random.default_rng(seed), len(languages)
    table = rng.uniform(-1, 1, (len(SIZES) * BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, n)), np.zeros(n)
    for step in range(STEPS):
        some = fit[rng.integers(0, len(fit), BATCH)]
        mean = table[rows[some]].mean(1)
        error = _softmax(mean @ layer + bias)
        error[np.arange(BATCH), y[some]] -= 1
        rate = RATE * (1 - step / STEPS)
        back = error @ layer.T / SAMPLE_WINDOWS
        layer -= rate * mean.T @ error / BATCH
        bias -= rate / 8 * error.mean(0)
        np.add.at(table, rows[some].ravel(), -rate * np.repeat(back, SAMPLE_WINDOWS, axis=0))
    held = np.flatnonzero(held)  # at least one: the first
    logits = table[rows[held]].mean(1) @ layer + bias
    temperature, threshold = _calibrated(logits, y[held], max_error)
    typical = _typical(rows[fit], y[fit], rows[held], y[held], n)
    return Model(languages, (table @ layer).astype(np.float32), bias, temperature, threshold, typical)


def _typical(rows: np.ndarray, y: np.ndarray, held: np.ndarray, held_y: np.ndarray, n: int) -> Typical:
    """Subwords counted in ``rows``, texts measured in ``held``."""
    likely = np.empty((len(SIZES) * BUCKETS, n), np.float32)
    for language in range(n):
        counts = np.bincount(rows[y == language].ravel(), minlength=len(likely)) + SMOOTHING
        likely[:, language] = np.log(counts / counts.sum())
    mean, within, different = np.array([_likelihood(likely, r, language) for r, language in zip(held, held_y, strict=True)]).T
    of = np.array([mean[held_y == k].mean() if (held_y == k).sum() >= MIN_TEXTS else mean.mean() for k in range(n)])
    inside = max(float(within.mean()), 1e-6)
    between = max(0.0, float(((mean - of[held_y]) ** 2 - inside / different).mean()))
    deviations = (mean - of[held_y]) / np.sqrt(between + inside / different)
    found = Typical(likely, of, between, inside, 0.0)
    others = [found.deviations(r, k) for r, own in zip(held, held_y, strict=True) for k in range(n) if k != own]
    return replace(found, lowest=_limit(deviations, np.array(others)))


def _limit(own: np.ndarray, others: np.ndarray) -> float:
    """Deviations below which a text is rejected, from those of texts in their
    own language and in others."""
    lowest = float(np.quantile(own, MAX_ODD))
    return min(lowest, (lowest + float(np.median(others))) / 2 if len(others) else ONE_LANGUAGE)


def _calibrated(logits: np.ndarray, y: np.ndarray, max_error: float) -> tuple[float, float]:
    """Temperature of the best likelihood, for labels smoothed by one wrong
    answer more (else texts without a wrong one would make every score 1), and
    the lowest score that keeps the error; 0 if all texts together keep it."""
    at, n = np.arange(len(y)), logits.shape[1]
    off = 1 / (len(y) + 2)
    target = np.full(logits.shape, off / max(1, n - 1))
    target[at, y] = 1 - off
    scale = np.geomspace(0.02, 50, 80)
    loss = [-(target * np.log(np.maximum(_softmax(logits / t), 1e-300))).sum() for t in scale]
    temperature = float(scale[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    score, wrong = p.max(1), p.argmax(1) != y
    order = np.argsort(-score)
    ends = np.append(np.diff(score[order]) != 0, True)  # equal scores are kept or rejected together
    fine = np.flatnonzero(ends & (np.cumsum(wrong[order]) <= max_error * (1 + at)))
    if not len(fine):
        return temperature, 1.0
    return temperature, 0.0 if fine[-1] == at[-1] else float(score[order[fine[-1]]])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, rejected.

    A NULL text or one without a letter is ``und`` with score 0 and rejected;
    others have the likeliest language, rejected below the model's threshold or if
    their subwords are too rare in it.
    Repeated rows are predicted each; only these two columns are read; an empty
    table gives an empty result."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for doc_id, text in cells(batches, "doc_id", "text"):
                lang, score, rejected = model.predict(text)
                yield 64, {"doc_id": doc_id, "lang_pred": lang, "score": score, "rejected": rejected}

        yield from in_batches(found(), schema)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(texts, run, "doc_id bigint, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, that are not rejected."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not model.predict(batch.column(at)[i].as_py())[2] for i in range(batch.num_rows)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, docs.schema)
