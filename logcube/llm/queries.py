"""The registered queries of the training-data operators, each over its whole
table, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from logcube.llm import bpe, html_extract, language_id, quality_crf
from logcube.llm import fingerprint as fp
from logcube.llm.alignment import align_tokenizers
from logcube.llm.common import table
from logcube.llm.exact_dedup import exact_dedup
from logcube.llm.hard_negatives import mine
from logcube.llm.line_dedup import drop_boilerplate
from logcube.llm.minhash import near_duplicates
from logcube.llm.mixing import mix
from logcube.llm.secret_scan import scan_secrets, train
from logcube.llm.token_files import byte_level_encoder, read_token_files, write_token_files
from logcube.plans.checkpoints import scratch_dir


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, train(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("markov").alias("n_markov"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents"), host=F.col("source"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4).drop("text_hash")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fp.fingerprints_of_edits(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fp.to_hex(F.col("fingerprint")).alias("fingerprint"),
        fp.to_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        fp.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fp.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    encode = byte_level_encoder(public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, encode, vocabulary=50_257)
    digests = {
        "n_tokens": ("bigint", len),
        "ids_crc32": ("bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes())),
    }
    return read_token_files(manifest, folder, digests)


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extract.extract(table(spark, sf_dir, "pages"), html_extract.train())
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = exact_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(docs, learn=~held_out)
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), is_anchor=F.col("vec_id") % 100 == 0, label=label)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(table(spark, sf_dir, "documents"), path_a, path_b)


def op13_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    field = quality_crf.train(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return quality_crf.judge(docs, field)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secrets": op1_secrets,
        "op2_line_dedup": op2_line_dedup,
        "op3_near_duplicates": op3_near_duplicates,
        "op4_fingerprints": op4_fingerprints,
        "op5_bpe_round_trip": op5_bpe_round_trip,
        "op6_token_files": op6_token_files,
        "op7_html_main_text": op7_html_main_text,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_source_mix": op9_source_mix,
        "op10_language_id": op10_language_id,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_quality_lines": op13_quality_lines,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": r"""WITH pages AS (
  SELECT row_number() OVER () AS page, doc_id, source AS host, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents
), lines AS (
  SELECT page, host, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS pos FROM pages
), common AS (
  SELECT host, trim(line) AS line, count(DISTINCT page) AS n FROM lines WHERE trim(line) <> '' GROUP BY ALL
  HAVING count(DISTINCT page) >= 5
), boilerplate AS (
  SELECT c.host, c.line FROM common c JOIN (SELECT host, count(*) AS pages FROM pages GROUP BY host) t
    ON c.host IS NOT DISTINCT FROM t.host WHERE c.n > t.pages * 0.02
), left_lines AS (
  SELECT l.page, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n
  FROM lines l LEFT JOIN boilerplate b ON b.host IS NOT DISTINCT FROM l.host AND b.line = trim(l.line)
  WHERE b.line IS NULL GROUP BY l.page
)
SELECT p.doc_id, p.host, CAST(len(p.all_lines) AS BIGINT) AS n_lines,
       CAST(len(p.all_lines) - coalesce(l.n, 0) AS BIGINT) AS n_dropped, coalesce(l.text, '') AS text
FROM pages p LEFT JOIN left_lines l USING (page)""",
        "op8_exact_dedup": """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op9_source_mix": r"""WITH sized AS (
  SELECT doc_id, source, md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, source_size, ordinal, CASE ordinal % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END :: DOUBLE AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ordinal
        FROM sized GROUP BY source)
), filling AS (
  SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS full_at,
         (1.5 * (SELECT sum(source_size) FROM sources)
          - coalesce(sum(2.0 * source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources WINDOW up AS (ORDER BY 2.0 * source_size / weight, ordinal)
), targets AS (
  SELECT source, source_size, ordinal,
         CAST(least(cap, (SELECT max(level) FROM filling WHERE level <= full_at) * weight) AS DOUBLE) AS target,
         greatest(1, least(4096, CAST(ceil(source_size / 100000) AS BIGINT))) AS shards
  FROM filling
), quotients AS (
  SELECT ordinal, row_number() OVER (ORDER BY target / (2 * i + 1) DESC, ordinal) AS place
  FROM targets, range((SELECT CAST(round(sum(target) / 64) AS BIGINT) FROM targets)) AS r(i)
  WHERE i <= target / 64 + 64
), seats AS (
  SELECT ordinal, count(*) AS seats FROM quotients
  WHERE place <= (SELECT CAST(round(sum(target) / 64) AS BIGINT) FROM targets) GROUP BY ordinal
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.ordinal, s.place,
         CAST('0x' || substr(s.place, 1, 8) AS BIGINT) % t.shards AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), shards AS (
  SELECT ordinal, shard, sum(size) AS shard_size FROM placed GROUP BY ordinal, shard
), shard_quotients AS (
  SELECT s.ordinal, s.shard, seats,
         row_number() OVER (PARTITION BY s.ordinal ORDER BY s.shard_size / (2 * i + 1) DESC, s.shard) AS place
  FROM shards s JOIN seats USING (ordinal), range((SELECT max(seats) FROM seats)) AS r(i)
  WHERE i <= seats
), quotas AS (
  SELECT ordinal, shard, count(*) AS quota FROM shard_quotients WHERE place <= seats GROUP BY ordinal, shard
), dealt AS (
  SELECT p.*, shard_size, least(coalesce(quota, 0) * 64, shard_size * 2) AS words,
         sum(size) OVER (PARTITION BY p.ordinal, p.shard ORDER BY p.place, p.doc_id) - size AS start
  FROM placed p JOIN shards USING (ordinal, shard) LEFT JOIN quotas USING (ordinal, shard)
)
SELECT doc_id, size, source_size, target,
       CASE WHEN shard_size = 0 THEN 0
            ELSE CAST(words // shard_size * size + least(size, greatest(0, words % shard_size - start)) AS BIGINT) END AS taken
FROM dealt""",
        "op11_hard_negatives": """WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM positives JOIN scored s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER best <= 5""",
    }
