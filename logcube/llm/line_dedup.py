"""Line dedup by site-relative frequency.

A line is boilerplate of a host if the pages of the host that contain it are
more than ``max_ratio`` of the host's pages, and at least ``min_pages``.  Each
page then loses its boilerplate lines.

Lines are compared without the spaces around them, by 64-bit hash within their
host, so only hashes are shuffled, and a page counts once for a line.  A
host has at most (lines per page / max_ratio) boilerplate lines, so they fit in
one array, which every page of the host meets: by broadcast while all arrays
are small, else by a join in which every host is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logcube.llm.common import stored, text_or_empty

MAX_RATIO, MIN_PAGES = 0.02, 5
#: Up to so many boilerplate lines of all hosts (8 bytes each) are broadcast.
BROADCAST_LINES = 1_000_000
SALTS = 64


def host_of_url(url: str) -> Column:
    """The host of a URL column, for tables of web pages; NULL if it has none."""
    return F.expr(f"try_parse_url(`{url}`, 'HOST')")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, host: Column, text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the hashes of every host's boilerplate lines, for hosts
    that have some.  Blank lines are none; pages without a host (NULL) are the
    pages of one host."""
    own = F.array_distinct(F.transform(F.filter(_lines(text_or_empty(text_col)), lambda x: F.trim(x) != ""), _hash))
    pages = docs.select(host.alias("host"), own.alias("own"))
    totals = docs.select(host.alias("host")).groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("own").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = totals.withColumnRenamed("host", "of")
    common = counts.join(totals, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > F.col("pages") * max_ratio)
    return common.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))  # at most lines per page / max_ratio


def drop_boilerplate(docs: DataFrame, host: Column, id_col: str = "doc_id", text_col: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per row of ``docs``: doc_id, host, n_lines, n_dropped, text (the
    lines left, in order).  NULL texts are one empty line; repeated rows count
    as pages of their own; other columns are not read; an empty table gives an
    empty result."""
    found = stored(boilerplate(docs, host, text_col, max_ratio, min_pages), "boilerplate").withColumnRenamed("host", "of")
    pages = docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), _lines(text_or_empty(text_col)).alias("all_lines"))
    same = F.col("host").eqNullSafe(F.col("of"))
    if (found.agg(F.sum(F.size("lines"))).first()[0] or 0) <= BROADCAST_LINES:
        pages = pages.join(F.broadcast(found), same, "left")
    else:
        found = found.withColumn("found_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        pages = pages.withColumn("salt", F.pmod(F.xxhash64("doc_id", "all_lines"), F.lit(SALTS)).cast("int"))
        pages = pages.join(found, same & (F.col("salt") == F.col("found_salt")), "left")
    left = F.when(F.col("lines").isNull(), F.col("all_lines")).otherwise(
        F.filter("all_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("lines", _hash(x)))
    )
    pages = pages.withColumn("left", left)
    return pages.select(
        "doc_id",
        "host",
        F.size("all_lines").cast("bigint").alias("n_lines"),
        (F.size("all_lines") - F.size("left")).cast("bigint").alias("n_dropped"),
        F.array_join("left", "\n").alias("text"),
    )
