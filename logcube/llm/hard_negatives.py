"""Hard negatives of anchors, found exactly in cover trees.

1. A bounded sample gives the top of the tree: centres by farthest-first order.
   Every row goes to its nearest centre, and the rows of a centre are dealt by
   hash into blocks of about BLOCK_ROWS, so a hot place is many blocks.
2. Every block is built into a cover tree in a task (``cover_tree``).  The trees
   are a table: the index, which holds every row.  They are dealt into slices of
   bounded bytes.
3. Anchors go in groups to every slice: a task holds the trees of a slice and
   lets one group after another descend.  The first pass finds an anchor's best
   rows of its own label, its positives.
4. The second pass finds, for every positive, the best rows of other labels
   whose score lies in the window below the positive's.

Either pass returns at most a few rows per anchor and slice, which a window
ranks.  Scores are integer inner products, and the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logcube.llm.common import map_batches, stored
from logcube.llm.cover_tree import FAR, Forest, Windows, build, search

#: Rows from which the centres are chosen, and how many there are at most.
SAMPLE_ROWS, MAX_CENTRES = 4096, 1024
#: Rows of a block, anchors of a group, bytes of a slice's vectors.
BLOCK_ROWS, GROUP_ANCHORS, SLICE_BYTES = 1024, 256, 32 << 20
#: Slices of a small table, so that several tasks search it.
LEAST_SLICES = 24
#: Stands for a missing id: the last of equal scores.
NO_ID = np.iinfo(np.int64).max

_TREE = "rows array<bigint>, ids array<bigint>, labels array<bigint>, dims int, kind string, data binary, first array<int>, last array<int>, radius array<double>, norm double"
_HIT = pa.schema([("anchor", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def matrix(vectors: pa.ListArray, scale: float, dims: int = 0) -> np.ndarray:
    """floor(scale * x) of every component x (float64); shorter vectors end in zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    dims = max(dims, int(lengths.max(initial=0)))
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def centres_of(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` norm-augmented centres, each the farthest of ``sample`` from those before it."""
    sample = np.clip(sample, -FAR, FAR)
    squares = np.einsum("ij,ij->i", sample, sample)
    augmented = np.column_stack([sample, np.sqrt(squares.max() - squares)])
    chosen, nearest = [0], np.full(len(sample), np.inf)
    while len(chosen) < n:
        step = augmented - augmented[chosen[-1]]
        nearest = np.minimum(nearest, np.einsum("ij,ij->i", step, step))
        if nearest.max() <= 0:
            break
        chosen.append(int(nearest.argmax()))
    return augmented[chosen]


def _assign(centres: np.ndarray, scale: float):
    norms = np.einsum("ij,ij->i", centres, centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.clip(matrix(batch.column("vector"), scale, centres.shape[1] - 1), -FAR, FAR)
            squares = np.einsum("ij,ij->i", own, own)
            more = np.sqrt(np.maximum(norms[0] - squares, 0))
            near = own[:, : centres.shape[1] - 1] @ centres[:, :-1].T + more[:, None] * centres[:, -1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.argmax(axis=1).astype(np.int32))], names=[*batch.schema.names, "centre"])

    return run


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Rows of neighbouring batches that agree in ``keys``, as one table each."""
    held, last = [], None
    for batch in batches:
        values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                if held and values[start] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(start, i - start))
                last, start = values[start], i
    if held:
        yield pa.Table.from_batches(held)


def _plant(scale: float):
    schema = pa.schema([
        ("slice", pa.int32()), ("rows", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("dims", pa.int32()), ("kind", pa.string()),
        ("data", pa.binary()), ("first", pa.list_(pa.int32())), ("last", pa.list_(pa.int32())), ("radius", pa.list_(pa.float64())), ("norm", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _runs(batches, "slice", "centre", "part"):
            vectors = matrix(block["vector"].combine_chunks(), scale)
            tree = build(vectors)
            low, high = vectors.min(initial=0), vectors.max(initial=0)
            kind = "<i2" if -(2**15) <= low and high < 2**15 else "<f8"
            row = {
                "slice": block["slice"][0].as_py(),
                "rows": block["row"].to_numpy()[tree.order],
                "ids": block["id"].fill_null(NO_ID).to_numpy()[tree.order],
                "labels": block["label"].to_numpy()[tree.order],
                "dims": vectors.shape[1],
                "kind": kind,
                "data": vectors[tree.order].astype(kind).tobytes(),
                "first": tree.first,
                "last": tree.last,
                "radius": tree.radius,
                "norm": tree.norm,
            }
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


def _padded(vectors: np.ndarray, dims: int) -> np.ndarray:
    return vectors if vectors.shape[1] == dims else np.pad(vectors, ((0, 0), (0, dims - vectors.shape[1])))


def _forest(trees: list[dict]) -> Forest:
    sizes = [len(t["rows"]) for t in trees]
    starts = np.cumsum([0, *sizes])
    dims = max(t["dims"] for t in trees)
    vectors = [_padded(np.frombuffer(t["data"], t["kind"]).reshape(len(t["rows"]), t["dims"]).astype(np.float64), dims) for t in trees]

    def joined(name):
        return np.concatenate([np.asarray(t[name]) for t in trees])

    shift = np.repeat(starts[:-1], sizes)
    norm = np.repeat([t["norm"] for t in trees], sizes)
    return Forest(np.concatenate(vectors), joined("rows"), joined("ids"), joined("labels"), joined("first") + shift, joined("last") + shift, joined("radius"), norm, starts[:-1])


def _bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer n with low * score <= 100 * n <= high * score."""
    ends = [(-(-low * int(s) // 100), high * int(s) // 100) for s in scores]
    kind = np.float64 if all(abs(int(s)) < 2**53 for s in scores) else object
    return np.array([a for a, _ in ends], kind), np.array([b for _, b in ends], kind)


def _descend(scale: float, k: int, window: tuple[int, int] | None):
    """Search the groups that follow a slice's trees; for the best rows of the
    anchor's label, or, with a window, of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trees, forest = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                if row["slice"].as_py() != at:
                    at, trees, forest = row["slice"].as_py(), [], None
                if row["group"].as_py() is None:
                    lists = {n: row[n].values.to_numpy() for n in ("rows", "ids", "labels", "first", "last", "radius")}
                    trees.append(lists | {n: row[n].as_py() for n in ("dims", "kind", "data", "norm")})
                    continue
                if forest is None:
                    if not trees:
                        continue  # a slice without rows
                    forest, trees = _forest(trees), []
                yield _hits(forest, row, scale, k, window)

    return run


def _hits(forest: Forest, group: dict, scale: float, k: int, window: tuple[int, int] | None) -> pa.RecordBatch:
    anchors = group["rows"].values.to_numpy()
    labels = group["labels"].values.to_numpy()
    vectors = matrix(group["vectors"].values, scale, forest.vectors.shape[1])
    if vectors.shape[1] > forest.vectors.shape[1]:  # what the trees lack counts nothing
        vectors = vectors[:, : forest.vectors.shape[1]]
    if window is None:
        query = np.arange(len(anchors))
        wide = np.full(len(anchors), np.inf)
        windows = Windows(query, -wide, wide, k, True)
    else:
        scores = group["scores"].values
        query = np.repeat(np.arange(len(anchors)), scores.value_lengths().to_numpy())
        windows = Windows(query, *_bounds(scores.flatten().to_numpy(), *window), k, False)
    which, node, score = search(forest, vectors, anchors, labels, windows)
    # Each row of an anchor once, however many of its windows it is in.
    query = windows.query[which]
    _, once = np.unique(query * np.int64(len(forest.rows)) + node, return_index=True)
    query, node, score = query[once], node[once], score[once]
    whole = pa.array([int(s) for s in score], pa.int64())
    ids = forest.ids[node]
    return pa.RecordBatch.from_arrays([pa.array(anchors[query]), pa.array(forest.rows[node]), pa.array(ids, mask=ids == NO_ID), whole], schema=_HIT)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    scale: float = 256.0,
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the inner product of two rows,
    and equal scores go by the smaller id.  An anchor's positives are its best
    ``positives`` other rows of the same label (an integer), a positive's
    negatives the best ``negatives`` rows of other labels with
    window[0] * positive_score <= 100 * negative_score <= window[1] * positive_score.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take
    no part.  A row that is repeated in id, label and vector counts once; rows of
    one id that differ are rows of their own.  A row without an id can be a
    positive or a negative, the last of equals.  A vector that is shorter than
    another counts as zero where it ends.  Scores beyond a long are the greatest
    long.  Other columns are not read; an empty table gives an empty result."""
    spark = vectors.sparkSession
    vector = F.col(vector_col).cast("array<double>") if vectors.schema[vector_col].dataType.simpleString() != "array<float>" else F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), vector.alias("vector"), is_anchor.alias("asks"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    # Of equal rows, and of equal hashes, one is as good as another: any centres give all results.
    sample = rows.select("vector").orderBy(F.xxhash64("id", "vector")).limit(SAMPLE_ROWS).toArrow()["vector"].combine_chunks()
    n_rows, n_anchors = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    sample = matrix(sample, scale) if len(sample) else np.zeros((1, 1))
    centres = centres_of(sample, max(1, min(MAX_CENTRES, -(-n_rows // BLOCK_ROWS))))

    distinct = rows.groupBy("id", "label", "vector").agg(F.max("asks").alias("asks"))
    schema = f"id bigint, label bigint, vector {rows.schema['vector'].dataType.simpleString()}, asks boolean, centre int"
    placed = map_batches(distinct, _assign(centres, scale), schema).withColumn("row", F.monotonically_increasing_id())
    placed = stored(placed, "placed")
    slice_rows = max(BLOCK_ROWS, SLICE_BYTES // (8 * centres.shape[1]))
    n_slices = max(-(-n_rows // slice_rows), min(LEAST_SLICES, -(-n_rows // BLOCK_ROWS)), 1)
    parts = placed.groupBy("centre").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("parts"))  # MAX_CENTRES rows at most
    blocks = placed.join(F.broadcast(parts), "centre").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    blocks = blocks.withColumn("slice", F.pmod(F.xxhash64("centre", "part"), F.lit(n_slices)).cast("int"))
    blocks = blocks.select("slice", "centre", "part", "row", "id", "label", "vector").repartition(n_slices, "slice")
    index = stored(map_batches(blocks.sortWithinPartitions("slice", "centre", "part", "row"), _plant(scale), f"slice int, {_TREE}"), "cover-trees")

    n_groups = max(1, -(-n_anchors // GROUP_ANCHORS))
    asked = placed.where("asks").select(F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int").alias("group"), "row", "id", "label", "vector")

    def hits(anchors: DataFrame, k: int, between: tuple[int, int] | None) -> DataFrame:
        """(anchor, row, id, score): the best of every slice for ``anchors``."""
        own = [f.name for f in anchors.schema if f.name not in ("group",)]
        groups = anchors.groupBy("group").agg(F.sort_array(F.collect_list(F.struct(*own))).alias("a"))  # about GROUP_ANCHORS
        groups = groups.select("group", F.col("a.row").alias("rows"), F.col("a.label").alias("labels"), F.col("a.vector").alias("vectors"), F.col("a.scores").alias("scores"))
        groups = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))
        work = index.unionByName(groups, allowMissingColumns=True).repartition(n_slices, "slice")
        work = work.sortWithinPartitions("slice", F.col("group").asc_nulls_first())
        return map_batches(work, _descend(scale, k, between), "anchor bigint, row bigint, id bigint, score bigint")

    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    chosen = hits(asked.withColumn("scores", F.array().cast("array<bigint>")), positives, None)
    chosen = chosen.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    chosen = stored(chosen.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    scores = chosen.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores"))  # a few per anchor
    again = asked.join(scores.withColumnRenamed("anchor", "row"), "row")
    rivals = hits(again, negatives, window)
    wide, other = F.col("positive_score").cast("decimal(38,0)"), F.col("score").cast("decimal(38,0)") * 100
    inside = (wide * window[0] <= other) & (other <= wide * window[1])
    pairs = rivals.join(chosen, "anchor").where(inside)
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return pairs.join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
