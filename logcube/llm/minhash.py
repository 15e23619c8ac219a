"""Near-duplicate groups by MinHash with tensored banding.

A document's set holds its distinct word shingles.  Two collections of
``bands`` bands, each of ``rows`` minhashes, are computed per set; a table key is
a pair of bands, one of each collection, so 2 * bands * rows minhashes serve
bands ** 2 tables of 2 * rows hashes each.  Two sets meet in a table if they
agree in a band of each collection: with similarity s the chance to miss is
about 2 * (1 - s ** rows) ** bands (at 0.8 with 5 rows and 32 bands 6e-6).

1. Equal sets are one node from here on.
2. Table keys are formed only where the first band is shared at all.  The
   members of a table are tied to its smallest one, and the connected parts of
   these ties are clusters.  A cluster holds every group that the tables can
   find, and no pair of a table is ever written out.
3. Links are confirmed on the full sets, cluster by cluster, in tasks of bounded
   size, which return the links that connect their sets, not all of them.  A large
   cluster is cut into blocks, by size first (linked sets differ by less than a
   fifth).  Some of its sets, the pivots, meet all its blocks.  The sets that the
   pivot with most links reaches, directly or by another pivot that shares a set
   with it, are connected from here on and need not meet each other; only the
   others meet all blocks.  A cluster of n near copies thus costs about n
   comparisons per pivot, and only sets that these do not reach meet all others.
4. Connected components of the confirmed links are the groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import cells, in_batches, map_batches, stored, text_or_empty
from logcube.llm.components import components
from logcube.operators.broadcast import bounded_broadcast

SHINGLE = 5
BANDS, ROWS = 32, 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Sets of a cluster and size step that meet all others.
PIVOTS = 16
#: A block of a cluster holds about so many sets and shingles at most.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 19
#: Shingles whose minhashes are computed at a time; columns of a count matrix.
HASH_CHUNK, COUNT_COLUMNS = 1 << 15, 1 << 11
#: Word hashes that a worker remembers.
KEPT_WORDS = 1 << 16

SKETCH = "doc_id bigint, text_hash bigint, n_shingles bigint, node binary, first array<bigint>, second array<bigint>"


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < KEPT_WORDS:
            self[word] = found
        return found


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=8)
def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct word shingles: words are runs of characters
    other than ASCII white space, A-Z in lower case; fewer words than ``size``
    are one shingle, none are none."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(_words.__getitem__, found), np.uint64, len(found))
    n = min(size, len(words))
    factors = _odd(size, 7)
    sums = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        sums += words[i : len(words) - n + 1 + i] * factors[i]
    return np.unique(_mixed(sums))


def node_of(shingle_set: np.ndarray) -> bytes:
    """Equal sets have one node."""
    return hashlib.blake2b(shingle_set.astype("<u8").tobytes(), digest_size=16).digest()


def band_keys(sets: list[np.ndarray], bands: int, rows: int, seed: int) -> np.ndarray:
    """Keys (sets x 2 * bands) of the bands of both collections; no empty sets."""
    n_hashes = 2 * bands * rows
    factors, low = _odd(n_hashes, seed), np.full((n_hashes, len(sets)), np.uint64(0xFFFFFFFFFFFFFFFF))
    ends = np.cumsum([len(s) for s in sets])
    everything = np.concatenate(sets)
    for start in range(0, len(everything), HASH_CHUNK):
        part = everything[start : start + HASH_CHUNK]
        first, last = np.searchsorted(ends, [start, start + len(part) - 1], "right")
        cuts = np.concatenate([[0], ends[first:last] - start]).astype(np.int64)
        for k in range(n_hashes):
            found = np.minimum.reduceat(part * factors[k], cuts)
            np.minimum(low[k, first : last + 1], found, out=low[k, first : last + 1])
    low >>= np.uint64(32)
    keys = np.zeros((2 * bands, len(sets)), np.uint64)
    for r in range(rows):
        keys = _mixed(keys * np.uint64(31) + low[r::rows])
    return (keys + np.arange(2 * bands, dtype=np.uint64)[:, None]).T


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, bands: int, rows: int, seed: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node, first, second): the set's node and
    band keys of either collection; NULL without a set."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()), ("first", pa.list_(pa.int64())), ("second", pa.list_(pa.int64()))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(ids, sets):
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(full, bands, rows, seed).view(np.int64)) if full else iter(())
            rows_out = []
            for (doc_id, text_hash), s in zip(ids, sets, strict=True):
                row = {"doc_id": doc_id, "text_hash": text_hash, "n_shingles": len(s)}
                if len(s):
                    k = next(keys)
                    row |= {"node": node_of(s), "first": k[:bands], "second": k[bands:]}
                rows_out.append(row)
            return pa.RecordBatch.from_pylist(rows_out, schema=schema)

        ids, sets, size = [], [], 0
        for doc_id, text, text_hash in cells(batches, "doc_id", "text", "text_hash"):
            ids.append((doc_id, text_hash))
            sets.append(shingles(text, shingle))
            size += len(sets[-1])
            if size >= 1 << 18 or len(ids) >= 2000:
                yield flush(ids, sets)
                ids, sets, size = [], [], 0
        if ids:
            yield flush(ids, sets)

    text = text_or_empty(text_col)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return map_batches(texts, run, SKETCH)


def clusters(nodes: DataFrame) -> DataFrame:
    """(node, root): the connected parts of the tables over ``nodes`` (node,
    first, second), for all nodes that share a table with another."""
    outer = nodes.select("node", F.posexplode("first").alias("i", "u"))
    shared = outer.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
    outer = stored(outer.join(shared, "u", "left_semi").select("node", "u"), "shared-bands")
    keys = outer.join(nodes.select("node", "second"), "node").select("node", F.explode(F.transform("second", lambda v: F.xxhash64("u", v))).alias("key"))
    tables = keys.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("high")).where("b <> high").select("key", "b")
    ties = keys.join(tables, "key").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    return components(ties)


def links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the same sets as all pairs with 100 * intersection >=
    ``percent`` * union do."""
    return _connecting(_linked(sets, sets, percent))


def links_between(lefts: list[np.ndarray], rights: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """The same of the pairs of a left and a right set only; right ones are
    numbered behind the left ones."""
    n = len(lefts)
    linked = np.zeros((n + len(rights),) * 2, bool)
    linked[:n, n:] = _linked(lefts, rights, percent)
    return _connecting(linked | linked.T)


def _linked(lefts: list[np.ndarray], rights: list[np.ndarray], percent: int) -> np.ndarray:
    """Which left sets are linked with which right ones."""
    sizes = [np.array([len(s) for s in side], np.int64) for side in (lefts, rights)]
    shingles = np.unique(np.concatenate(lefts))
    common = np.zeros((len(lefts), len(rights)), np.float32)  # exact: counts stay below 2 ** 24
    owners, columns = [], []
    for side, n in zip((lefts, rights), sizes, strict=True):
        values, owner = np.concatenate(side), np.repeat(np.arange(len(side)), n)
        column = np.searchsorted(shingles, values)
        known = column < len(shingles)
        known[known] = shingles[column[known]] == values[known]
        order = np.argsort(column[known], kind="stable")
        owners.append(owner[known][order])
        columns.append(column[known][order])
    for start in range(0, len(shingles), COUNT_COLUMNS):
        has = []
        for owner, column, side in zip(owners, columns, (lefts, rights), strict=True):
            low, high = np.searchsorted(column, [start, start + COUNT_COLUMNS])
            has.append(np.zeros((len(side), COUNT_COLUMNS), np.float32))
            has[-1][owner[low:high], column[low:high] - start] = 1
        common += has[0] @ has[1].T
    return (100 + percent) * common.astype(np.float64) >= percent * (sizes[0][:, None] + sizes[1]).astype(np.float64)


def _connecting(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a symmetric matrix that connect what all of them do."""
    out, seen = [], np.zeros(len(linked), bool)
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root], queue = True, [root]
        while queue:
            x = queue.pop()
            new = np.flatnonzero(linked[x] & ~seen)
            seen[new] = True
            out += [(x, int(y)) for y in new]
            queue += new.tolist()
    return out


def _confirm(percent: int, every: bool):
    """Links of each task's sets: of all its pairs, or if it has right sets, of
    those of a left and a right one; those that connect what all do, or ``every``."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            task, nodes, sides = None, [], ([], [])
            for key, right, node, data in cells(batches, "task", "right", "node", "data"):
                if key != task:
                    yield from pairs(nodes, *sides)
                    task, nodes, sides = key, [], ([], [])
                nodes.append(node)
                sides[right].append(np.frombuffer(data, "<u8"))
            yield from pairs(nodes, *sides)

        def pairs(nodes, lefts, rights):
            if not lefts or len(nodes) < 2:
                return
            if every:
                found = [(x, len(lefts) + y) for x, y in np.argwhere(_linked(lefts, rights, percent)).tolist()] if rights else []
            else:
                found = links_between(lefts, rights, percent) if rights else links(lefts, percent)
            yield from ((64, {"a": nodes[x], "b": nodes[y]}) for x, y in found)

        yield from in_batches(rows(), schema)

    return run


def _in_tasks(rows: DataFrame, percent: int, name: str, every: bool = False) -> DataFrame:
    """Confirmed links (a, b) of rows (task, right, node, data)."""
    rows = rows.repartition("task").sortWithinPartitions("task", "right")
    return stored(map_batches(rows, _confirm(percent, every), "a binary, b binary"), name)


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def confirmed_links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect the same ``members`` (root, node, n_shingles,
    data) of a cluster as all its links do."""

    def n_blocks() -> Column:
        return F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).cast("int")

    # Linked sets' sizes differ by less than one step of this scale.
    step = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    sizes = stored(members.groupBy("root").agg(n_blocks().alias("root_blocks")), "cluster-sizes")
    small = members.join(sizes.where("root_blocks = 1"), "root")
    found = [_in_tasks(small.select(F.xxhash64("root").alias("task"), F.lit(0).alias("right"), "node", "data"), percent, "links")]
    large = members.join(sizes.where("root_blocks > 1"), "root").select("root", "node", "n_shingles", step.alias("step"), "data")
    large = stored(large, "large-clusters")
    if large.isEmpty():
        return found[0]
    blocks = stored(large.groupBy("root", "step").agg(n_blocks().alias("n")), "block-counts")
    light = large.select("root", "node", "n_shingles", "step")
    near = F.explode(F.array(F.col("step") - 1, F.col("step"), F.col("step") + 1))
    place = F.pmod(F.xxhash64("node"), F.col("n")).cast("int")
    data = large.select("node", "data")

    def meeting(lefts: DataFrame) -> DataFrame:
        """``lefts`` (root, node, step, part) for every block of a near step: + at, block."""
        to = lefts.withColumn("at", near).join(blocks.withColumnRenamed("step", "at"), ["root", "at"])
        return to.withColumn("block", F.explode(_upto(F.col("n")))).drop("n")

    placed = large.join(blocks, ["root", "step"]).withColumn("block", place).drop("n")
    by_hash = Window.partitionBy("root", "step").orderBy(F.xxhash64("node"))
    pivots = light.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= PIVOTS)
    pivots = meeting(pivots.select("root", "node", "step")).join(data, "node")
    lefts = pivots.select(F.xxhash64("root", "at", "block").alias("task"), F.lit(0).alias("right"), "node", "data")
    rights = placed.select(F.xxhash64("root", "step", "block").alias("task"), F.lit(1).alias("right"), "node", "data")
    found.append(_in_tasks(lefts.unionByName(rights), percent, "pivot-links", every=True))  # PIVOTS a set and near step at most
    outside = stored(light.join(_reached(found[1], light), "node", "left_anti"), "outside")
    # Those that the pivots do not connect meet all sets of their cluster that may be linked.
    open_blocks = stored(outside.groupBy("root", "step").agg(n_blocks().alias("n")), "open-counts")
    lefts = outside.join(open_blocks, ["root", "step"]).withColumn("part", place).select("root", "node", "step", "part")
    lefts = meeting(lefts).join(data, "node")
    task = [F.xxhash64("root", "step", "part", "at", "block").alias("task")]
    lefts = lefts.select(*task, F.lit(0).alias("right"), "node", "data")
    rights = placed.withColumnRenamed("step", "at").withColumn("step", F.explode(F.array(F.col("at") - 1, F.col("at"), F.col("at") + 1)))
    rights = rights.join(open_blocks, ["root", "step"]).withColumn("part", F.explode(_upto(F.col("n"))))
    rights = rights.select(*task, F.lit(1).alias("right"), "node", "data")
    found.append(_in_tasks(lefts.unionByName(rights), percent, "other-links"))
    return reduce(DataFrame.unionByName, found)


def _sets(shingle: int):
    schema = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("n_shingles", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for node, root, text in cells(batches, "node", "root", "text"):
                found = shingles(text, shingle)
                if node_of(found) == node:  # not another text under the same doc_id
                    yield 8 * len(found) + 64, {"node": node, "root": root, "n_shingles": len(found), "data": found.astype("<u8").tobytes()}

        yield from in_batches(rows(), schema)

    return run


def _reached(pivot_links: DataFrame, light: DataFrame) -> DataFrame:
    """The nodes of each cluster that are connected with its best pivot (of most
    links) by one or two pivots: of the links (a: pivot, b: node)."""
    counts = pivot_links.groupBy("a").agg(F.count("*").alias("size")).join(light.select(F.col("node").alias("a"), "root"), "a")
    best = counts.groupBy("root").agg(F.max_by("a", F.struct("size", "a")).alias("a")).select("a")
    shared = pivot_links.join(best, "a", "left_semi").select("b")  # of one pivot each, so distinct
    near = pivot_links.join(shared, "b", "left_semi").select("a").distinct()
    return pivot_links.join(near, "a", "left_semi").select(F.col("b").alias("node")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 11,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept,
    text_hash (xxhash64 of the text).

    component_id is the smallest doc_id that links reach, kept whether it is
    the row's own (so repeated rows are all kept or all not).  A text without
    words, or NULL, has an empty set, which is linked with nothing.  A NULL
    doc_id counts as none: its row is in a group but never names it, and is
    kept only if the group has no other.  Other columns are not read; an empty
    table gives an empty result."""
    found = stored(sketches(docs, id_col, text_col, shingle, bands, rows, seed), "sketches")
    with_set = found.where("node is not null")
    classes = stored(with_set.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes")
    nodes = stored(with_set.select("node", "first", "second").dropDuplicates(["node"]), "nodes")
    groups = stored(clusters(nodes), "clusters")

    # The full sets of the clusters' nodes, from one text of each.
    wanted = groups.join(classes, "node").select("node", "root", F.col("doc_id").alias("of"))
    wanted = stored(wanted, "wanted")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    texts = texts.join(bounded_broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("of"))).select("node", "root", "text")
    members = map_batches(texts, _sets(shingle), "node binary, root binary, n_shingles bigint, data binary")
    members = stored(members, "sets")
    reached = components(confirmed_links(members.dropDuplicates(["node"]), percent))

    roots = classes.join(reached, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stored(roots.select("node", "root").join(named, "root").select("node", "component_id"), "components")
    out = found.select("doc_id", "text_hash", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "text_hash")
