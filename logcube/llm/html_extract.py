"""Main text of HTML pages by a recurrent block labeller.

A page is a sequence of leaf blocks.  Each is described by the hashed names of
its tag path, its hashed words and a few numbers; a bidirectional LSTM reads the
whole sequence both ways, and a logistic unit labels every block from both
states, so a block's label hangs on all the others.  The text is the blocks
labelled as main text, in page order.

The network is numpy, trained by Adam on seeded labelled pages
(``html_samples``) when the model is first asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import cells, in_batches, map_batches, text_or_empty
from logcube.llm.html_blocks import Block, blocks
from logcube.llm.html_samples import page

PATH_DIMS, WORD_DIMS, NUMBERS = 256, 32, 6
INPUTS = PATH_DIMS + WORD_DIMS + NUMBERS
HIDDEN = 16
TRAIN_PAGES, EPOCHS, PAGES_A_STEP, RATE = 1500, 6, 30, 0.01
#: Blocks of pages that are labelled together, padded to the longest page.
CELLS = 12_000


@lru_cache(maxsize=1 << 16)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    vector = np.zeros(PATH_DIMS, np.float32)
    for name in path:
        vector[zlib.crc32(name.encode()) % PATH_DIMS] = 1
    if path:  # the innermost element apart
        vector[zlib.crc32(b"<" + path[-1].encode()) % PATH_DIMS] = 1
    return vector


def features(page_blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    out = np.zeros((len(page_blocks), INPUTS), np.float32)
    for i, b in enumerate(page_blocks):
        words = b.text.split()
        out[i, :PATH_DIMS] = _path_vector(b.path)
        hashes = np.fromiter(map(_word, words), np.int64, len(words))
        out[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.bincount(hashes, minlength=WORD_DIMS) / len(words)
        out[i, -NUMBERS:] = (
            np.log1p(len(words)) / 5, b.link_chars / len(b.text), b.text[-1] in ".!?", min(1, len(b.path) / 20), i / len(page_blocks), b.text[0].isupper()
        )
    return out


class _Words(dict):
    def __missing__(self, word: str) -> int:
        found = zlib.crc32(word.lower().encode()) % WORD_DIMS
        if len(self) < 1 << 19:
            self[word] = found
        return found


_word = _Words().__getitem__


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM; its parameters are a dict of float32 arrays."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {"out": rng.normal(0, 0.2, 2 * HIDDEN), "out_b": np.zeros(1)}
        for way in "fb":
            self.p |= {f"{way}x": rng.normal(0, 0.15, (INPUTS, 4 * HIDDEN)), f"{way}h": rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))}
            self.p[f"{way}b"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])  # remember at first
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _states(self, x: np.ndarray, mask: np.ndarray, way: str):
        """States (time, page, HIDDEN) of one direction; padding keeps the state."""
        steps, n, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        xs = x.reshape(-1, INPUTS) @ self.p[f"{way}x"] + self.p[f"{way}b"]
        xs = xs.reshape(steps, n, -1)
        states, kept = np.zeros((steps, n, HIDDEN), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = xs[t] + h @ self.p[f"{way}h"]
            i, f, o = np.split(_sigmoid(z[:, : 3 * HIDDEN]), 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN :])
            on = mask[t][:, None]
            new_c = f * c + i * g
            tc = np.tanh(new_c)
            kept.append((t, h, c, i, f, o, g, tc))
            h, c = np.where(on, o * tc, h), np.where(on, new_c, c)
            states[t] = h
        return states, kept

    def logits(self, x: np.ndarray, mask: np.ndarray):
        forward, kept_f = self._states(x, mask, "f")
        backward, kept_b = self._states(x, mask, "b")
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["out_b"][0], both, kept_f, kept_b

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        logits, both, *kept = self.logits(x, mask)
        p = _sigmoid(logits)
        n = mask.sum()
        error = (np.where(mask, p - y, 0) / n).astype(np.float32)
        loss = -np.where(mask, y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9), 0).sum() / n
        out = {"out": (both * error[..., None]).sum((0, 1)), "out_b": np.array([error.sum()])}
        back = error[..., None] * self.p["out"]
        for way, own, steps in (("f", back[..., :HIDDEN], kept[0]), ("b", back[..., HIDDEN:], kept[1])):
            out |= self._back(x, mask, way, own, steps)
        return out, float(loss)

    def _back(self, x, mask, way, own, steps):
        dh = dc = np.zeros(own.shape[1:], np.float32)
        dz_all = np.zeros((*own.shape[:2], 4 * HIDDEN), np.float32)
        d_h = np.zeros_like(self.p[f"{way}h"])
        for t, h0, c0, i, f, o, g, tc in reversed(steps):
            on = mask[t][:, None]
            dh = dh + own[t]
            dct = np.where(on, dc + dh * o * (1 - tc * tc), 0)
            dht = np.where(on, dh, 0)
            dz = np.concatenate([dct * g * i * (1 - i), dct * c0 * f * (1 - f), dht * tc * o * (1 - o), dct * i * (1 - g * g)], axis=1)
            dz_all[t] = dz
            d_h += h0.T @ dz
            dh = np.where(on, dz @ self.p[f"{way}h"].T, dh)
            dc = np.where(on, dct * f, dc)
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        return {f"{way}x": x.reshape(-1, INPUTS).T @ flat, f"{way}h": d_h, f"{way}b": flat.sum(0)}


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((steps, len(rows), INPUTS), np.float32), np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, True
    return x, mask


@lru_cache(maxsize=2)
def train(seed: int = 0, pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> Labeller:
    """The labeller, trained on seeded labelled pages; equal for equal seeds."""
    rng, model = np.random.default_rng(seed), Labeller(seed)
    samples = [(features(b), np.array(y, np.float32)) for b, y in (page(seed * pages + k) for k in range(pages)) if b]
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second, step = {k: np.zeros_like(v) for k, v in model.p.items()}, 0
    n_steps = epochs * -(-len(samples) // PAGES_A_STEP)
    for _ in range(epochs):
        order = rng.permutation(len(samples))
        order = order[np.argsort([len(samples[k][1]) // 20 for k in order], kind="stable")]  # pages of a step alike in length
        chunks = np.array_split(order, -(-len(order) // PAGES_A_STEP))
        for c in rng.permutation(len(chunks)):
            some = [samples[k] for k in chunks[c]]
            x, mask = _padded([s[0] for s in some])
            y = np.zeros(mask.shape, np.float32)
            for k, s in enumerate(some):
                y[: len(s[1]), k] = s[1]
            x[..., :PATH_DIMS] *= rng.random((x.shape[0], x.shape[1], PATH_DIMS)) > 0.1  # names may be missing
            found, _ = model.gradients(x, mask, y)
            step += 1
            rate = RATE * (1 - step / (n_steps + 1))
            for k, d in found.items():
                d = np.clip(d, -1, 1).astype(np.float32)
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return model


def main_texts(pages: list[list[Block]], model: Labeller) -> list[str]:
    """The main text of each page from its blocks."""
    texts = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        some = [order.pop()]  # the longest, and as many of the next as fit
        while order and (len(some) + 1) * len(pages[some[0]]) <= CELLS:
            some.append(order.pop())
        x, mask = _padded([features(pages[k]) for k in some])
        labels = model.logits(x, mask)[0] > 0
        for column, k in enumerate(some):
            texts[k] = " ".join(b.text for b, main in zip(pages[k], labels[:, column], strict=False) if main)
    return texts


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text ('' if none, or of NULL
    or empty html).  Repeated rows are read each; other columns are not read; an
    empty table gives an empty result."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            ids, parsed, size = [], [], 0
            for page_id, url, html in cells(batches, "page_id", "url", "html"):
                ids.append((page_id, url))
                parsed.append(blocks(html))
                size += len(html)
                if size >= 1 << 21 or len(ids) >= 1000:
                    yield from found(ids, parsed)
                    ids, parsed, size = [], [], 0
            yield from found(ids, parsed)

        def found(ids, parsed):
            for (page_id, url), text in zip(ids, main_texts(parsed, model), strict=True):
                yield 2 * len(text) + 128, {"page_id": page_id, "url": url, "text": text}

        yield from in_batches(rows(), schema)

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    return map_batches(rows, run, "page_id bigint, url string, text string")
