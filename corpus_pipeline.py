"""From raw documents to token ids: language ID, exact dedup, near-dedup,
mixing, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; all but the last return the columns of ``docs``.  A stage
decides with a light table of row keys (doc_id and a hash of the text) and
drops or repeats the rows themselves in one pass over the texts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.llm import bpe, language_id
from logcube.llm.common import stored, text_or_empty
from logcube.llm.exact_dedup import exact_dedup
from logcube.llm.minhash import near_duplicates
from logcube.llm.mixing import mix
from logcube.operators.broadcast import bounded_broadcast

#: Of four parts of the documents by crc32 of the id, this one is never learnt from.
HELD_OUT = 2


def _without(docs: DataFrame, dropped: DataFrame, digest, name: str) -> DataFrame:
    """``docs`` without the rows whose doc_id and ``digest`` of the text are in
    ``dropped`` (doc_id, ``name``)."""
    dropped = bounded_broadcast(stored(dropped.select(F.col("doc_id").alias("gone_id"), F.col(name).alias("gone_text")), "dropped"))
    return docs.join(dropped, docs["doc_id"].eqNullSafe(F.col("gone_id")) & (digest == F.col("gone_text")), "left_anti")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language ID does not reject."""
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != HELD_OUT
    return language_id.accepted(docs, language_id.train(docs, learn))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: that with the largest doc_id."""
    digest = F.sha2(text_or_empty().cast("binary"), 256)
    found = stored(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "exact")
    by_row = found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    by_row = stored(by_row.where("not kept or rows > 1"), "copies")  # the others stay as they are
    left = _without(docs, by_row.where("not kept or rows > 1"), digest, "text_sha256")
    # Repeated rows of a text that stays: one of them.
    again = bounded_broadcast(by_row.where("kept and rows > 1").select(F.col("doc_id").alias("again_id"), F.col("text_sha256").alias("again_text")))
    again = docs.join(again, docs["doc_id"].eqNullSafe(F.col("again_id")) & (digest == F.col("again_text")), "left_semi")
    return left.unionByName(again.dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id."""
    found = near_duplicates(docs)
    return _without(docs, found.where("not kept"), F.xxhash64(text_or_empty()), "text_hash")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, to the nearest whole number."""
    mixed = mix(docs).withColumn("copies", F.when(F.col("size") > 0, F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))).otherwise(0).cast("int"))
    changed = mixed.where("copies <> 1").groupBy("doc_id", "text_hash").agg(F.max("copies").alias("copies"))
    changed = bounded_broadcast(stored(changed.select(F.col("doc_id").alias("mixed_id"), F.col("text_hash").alias("mixed_text"), "copies"), "mixed"))
    same = docs["doc_id"].eqNullSafe(F.col("mixed_id")) & (F.xxhash64(text_or_empty()) == F.col("mixed_text"))
    copies = F.coalesce("copies", F.lit(1))
    rows = docs.join(changed, same, "left").where(copies > 0)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).select(*[docs[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and sha256 of the ids (decimal, joined by a space)
    and of the bytes that they decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

#: SQL has no form of the trained language model, MinHash groups and BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
