"""Exact dedup by deterministic block naming.

Every text (UTF-8 bytes) is cut into blocks of ``block_bytes``.  The distinct
blocks are sorted and numbered, so equal blocks, and only those, share an
integer name.  Then adjacent names are paired and the distinct pairs sorted
and numbered again, until every document has one name.  (text length, name)
is equal exactly when the texts are: names come from comparing contents, so
no hash can merge two different texts.

Block contents move once, already combined on the map side: a block that a
third of all documents share leaves each map task once.  Documents meet their
blocks' names on a 128-bit key of the block.  The naming sees every distinct
block, so it also sees whether two of them share a key; if so, the keys are
drawn anew with another seed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import stored

BLOCK_BYTES = 4096
#: Stands for the missing right half of an odd pair; names are never negative.
NO_NAME = -1


def block_key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def _blocks(data: Column, block_bytes: int) -> Column:
    """Array of the blocks; an empty text has one empty block."""
    last = F.floor(F.greatest(F.lit(0), F.octet_length(data) - 1) / block_bytes).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def _named(keys: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct keys, sorted within hash partitions and numbered: equal keys
    get one name, different keys different names."""
    names = keys.select(*columns).distinct().sortWithinPartitions(*columns)
    return names.withColumn("name", F.monotonically_increasing_id())


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    key: Callable[[Column, int], Column] = block_key,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, n_bytes, level and name (n_bytes, level and name identify the text).

    NULL texts count as empty; texts are equal when their bytes are.  The row
    with the largest doc_id stays (a NULL doc_id is the smallest); of repeated
    rows with that doc_id exactly one stays.  Other columns are not read, so
    their names cannot clash.  An empty table gives an empty result."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    seed = 0
    while True:
        rows, names = _keyed_rows(docs, id_col, data, block_bytes, key, seed), _block_names(docs, data, block_bytes, key, seed)
        if names.groupBy("key").count().where("count > 1").isEmpty():
            break
        seed += 1
    identities = _identities(rows, names)
    rows = rows.drop("keys").join(identities, "row_id")
    identity = ["n_bytes", "level", "name"]
    groups = rows.groupBy(*identity).agg(F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count("*").alias("group_size"))
    groups = stored(groups, "groups")  # apart from the join, whose hot partitions Spark can then split
    return rows.join(groups, identity).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"),
        "text_sha256",
        *identity,
    )


def _keyed_rows(docs: DataFrame, id_col: str, data: Column, block_bytes: int, key, seed: int) -> DataFrame:
    """One light row per document: its number, digest and block keys.  Written
    out, as the row numbers must not change between uses."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.octet_length(data).alias("n_bytes"),
        F.sha2(data, 256).alias("text_sha256"),
        F.transform(_blocks(data, block_bytes), lambda b: key(b, seed)).alias("keys"),
    )
    return stored(rows, "block-keys")


def _block_names(docs: DataFrame, data: Column, block_bytes: int, key, seed: int) -> DataFrame:
    blocks = docs.select(F.explode(_blocks(data, block_bytes)).alias("block"))
    return stored(_named(blocks, ["block"]).select(key(F.col("block"), seed).alias("key"), "name"), "block-names")


def _identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row_id, level, name): names paired level by level until one is left."""
    parts = rows.select("row_id", F.posexplode("keys").alias("pos", "key")).join(names, "key").select("row_id", "pos", "name")
    done, level = [], 0
    while True:
        parts = stored(parts, f"names-{level}")
        last = parts.groupBy("row_id").agg(F.max("pos").alias("last"), F.max("name").alias("name"))
        done.append(last.where("last = 0").select("row_id", F.lit(level).alias("level"), "name"))
        if parts.where("pos > 0").isEmpty():
            return reduce(DataFrame.unionByName, done)
        open_rows = last.where("last > 0").select("row_id")
        even = F.col("pos") % 2 == 0
        pairs = (
            parts.join(open_rows, "row_id", "left_semi")
            .groupBy("row_id", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_NAME).cast("long")).alias("b"))
        )
        pairs = stored(pairs, f"pairs-{level}")
        parts = pairs.join(_named(pairs, ["a", "b"]), ["a", "b"]).select("row_id", "pos", "name")
        level += 1
