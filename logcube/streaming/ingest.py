"""S1 + K1 as a Structured Streaming job: new ``.gz`` log files are parsed
into the fact table as they arrive, instead of re-listing a whole day.

Run it with ``trigger(availableNow=True)`` from the nightly scheduler (it
processes everything new, then stops) or with a processing-time trigger.

Exactly-once per log file: a micro-batch becomes a run of the fact table with
the files that no run in force has parsed.  A batch replayed after a failure, a
renewed checkpoint, a second stream, or files that the day ingest has parsed
already therefore add nothing, and both may run at the same time (see
``sources.facts``).  Progress lives in ``checkpoint`` (a shared
folder).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logcube.plans.ingest import write_lines
from logcube.schemas import EVENT_KINDS, RAW_LOG
from logcube.sources.facts import add_days, day_runs, parsed_files
from logcube.sources.raw_logs import log_date_of_path, read_log_files


#: What a stream of files gives of each; ``content`` is never selected, so never read.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def read_file_stream(spark: SparkSession, log_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the log files under ``<root>/<yyyy-MM-dd>/<sub>/*.gz``
    (path, log_file), with ``log_date`` taken from the directory.  A batch reads
    the lines of those files only that are new to the fact table."""
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.gz")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    file = F.col("_metadata.file_path")
    return reader.load(f"{log_root.rstrip('/')}/*/*").select("path", log_date_of_path(file).alias("log_date"), file.alias("log_file"))


def batch_writer(fact_root: str, kinds: Sequence[str], tz: str, fmt: str = "orc", schema: T.StructType = RAW_LOG):
    """foreachBatch function: parse the files of the batch that are new to the
    fact table, and add them as one run; their bad lines are stored with it.

    A batch has the files (``read_file_stream``) or, without ``path``, their lines."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, by_file = batch.sparkSession, "path" in batch.columns
        found: dict[str, set[str]] = {}
        paths: dict[str, str] = {}
        columns = [F.col("log_date").cast("string").alias("day"), "log_file", F.col("path") if by_file else F.lit(None).alias("path")]
        for r in batch.select(*columns).distinct().collect():  # the batch's files
            if r.day is not None:  # files outside a day folder belong to no log day
                found.setdefault(r.day, set()).add(r.log_file)
                paths[r.log_file] = r.path
        new = {}
        for day, files in found.items():
            runs = day_runs(spark, fact_root, [day]).get(day, [])
            new[day] = files - parsed_files(spark, fact_root, day, [r["run"] for r in runs])
        # What another writer has parsed meanwhile is left out, and the rest tried again.
        while new := {day: files for day, files in new.items() if files}:
            names = [f for files in new.values() for f in files]
            if by_file:
                rows = read_log_files(spark, [paths[f] for f in sorted(names)], schema)
            else:
                rows = batch.where("log_date is not null")
                if len(names) < sum(map(len, found.values())):  # a batch's file names, so broadcast
                    rows = rows.join(F.broadcast(spark.createDataFrame([(f,) for f in names], "log_file string")), "log_file", "left_semi")
            run, _ = write_lines(rows, fact_root, new, kinds, tz, fmt, schema)
            new = add_days(spark, fact_root, run, new)

    return write


def start_ingest(
    spark: SparkSession,
    log_root: str,
    fact_root: str,
    checkpoint: str,
    tz: str,
    kinds: Sequence[str] = EVENT_KINDS,
    available_now: bool = True,
    processing_time: str | None = None,
    fmt: str = "orc",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest stream; returns the running query."""
    stream = read_file_stream(spark, log_root, max_files_per_trigger=max_files_per_trigger)
    writer = (
        stream.writeStream.foreachBatch(batch_writer(fact_root, kinds, tz, fmt))
        .option("checkpointLocation", checkpoint)
        .queryName("logcube_ingest")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
