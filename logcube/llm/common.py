"""What the training-data operators share: reading a table, intermediate
tables in the cluster's shared folder, and a few text rules."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logcube.plans.checkpoints import scratch_dir

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python task takes at a time, at most.
BATCH_ROWS = 1000
#: A Python task sends its rows on whenever they hold so many bytes.
FLUSH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh Parquet table in the shared scratch folder and
    read back: cuts the lineage, fixes generated ids, survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def in_batches(rows: Iterable[tuple[int, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(bytes, row) pairs as record batches of about FLUSH_BYTES."""
    held, size = [], 0
    for n_bytes, row in rows:
        held.append(row)
        size += n_bytes
        if size >= FLUSH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def cells(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of the batches, one Python row at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def release_memory() -> None:
    """Give freed memory back to the system: a worker outlives its task, and keeps
    what it once had while other stages run beside it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim is not None:
            trim(0)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with batches of BATCH_ROWS rows at most in
    this session: Spark's default of 10,000 is many MB of texts, which a worker
    and its executor each hold more than once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(task, schema)
