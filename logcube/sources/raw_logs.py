"""Read one or more days of gzip JSON log lines.

Layout: ``<root>/<yyyy-MM-dd>/<sub>/<file>.gz``.  The schema is explicit
(``schemas.RAW_LOG``), malformed lines are kept as NULL fields with the text
in ``_corrupt_record`` (PERMISSIVE), and each row carries ``log_date``, the
date of its directory, and ``log_file``.  ``rectime`` is read as text, so that a
quoted or fractional number counts like a plain one.  Gzip files are not
splittable: one task per file up to the explode, which the fact write's
REBALANCE then spreads.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logcube.schemas import RAW_LOG

CORRUPT = "_corrupt_record"
#: ``rectime``, which is read as text, as epoch milliseconds.
EPOCH_MS = "try_cast(try_cast(trim(rectime) AS DECIMAL(38, 6)) AS BIGINT)"


class NoInputError(RuntimeError):
    """No ``.gz`` log file exists for a requested day (the reference exited
    with status 123 here)."""

    exit_code = 123

    def __init__(self, day: str, path: str):
        super().__init__(f"no .gz log files for {day} under {path}")
        self.day = day
        self.path = path


def _as_str(day) -> str:
    return day.isoformat() if isinstance(day, _dt.date) else str(day)


def _missing(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", lambda: None)() or ""
    return "PATH_NOT_FOUND" in cond or "PATH_NOT_FOUND" in str(e)


def files_per_day(spark: SparkSession, root: str, days: list[str], layout: str = "{day}/*/*.gz") -> dict[str, list[str]]:
    """Log files per requested day, from ONE listing job over a brace glob of
    all days (``root/{d1,d2,...}/...``); days without files are absent."""
    if not days:
        return {}
    pattern = layout.format(day="{" + ",".join(days) + "}")
    try:
        listed = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{pattern}").select(F.col("_metadata.file_path").alias("path"))
    except AnalysisException as e:
        if _missing(e):
            return {}
        raise
    found: dict[str, list[str]] = {}
    for r in listed.select(log_date_of_path(F.col("path")).cast("string").alias("d"), "path").collect():  # file names
        found.setdefault(r["d"], []).append(r["path"])
    return found


def require_input(spark: SparkSession, root: str, days: Iterable, layout: str = "{day}/*/*.gz") -> dict[str, list[str]]:
    """The log files of each day; ``NoInputError`` for the first day
    without any."""
    days = [_as_str(d) for d in days]
    found = files_per_day(spark, root, days, layout)
    for day in days:
        if not found.get(day):
            folder = layout.format(day=day).split("/")[0]
            raise NoInputError(day, f"{root.rstrip('/')}/{folder}")
    return found


DEFAULT_LAYOUT = "{day}/*/*.gz"


def read_raw_logs(
    spark: SparkSession,
    root: str,
    days: Iterable,
    schema: T.StructType = RAW_LOG,
    check_input: bool = True,
    layout: str = DEFAULT_LAYOUT,
) -> DataFrame:
    """The log lines of ``days`` with ``log_date`` (date) appended.

    ``layout`` places a day's files below ``root``; the default is
    ``<day>/<sub>/<file>.gz``; ``"day={day}/*.gz"`` reads Hive-style folders.
    """
    days = [_as_str(d) for d in days]
    if check_input:
        require_input(spark, root, days, layout)
    paths = [f"{root.rstrip('/')}/{layout.format(day=d)}" for d in days]
    return with_log_columns(line_reader(spark.read, schema).json(paths))


def line_schema(schema: T.StructType) -> T.StructType:
    """``schema`` as lines are read: ``rectime`` as text, and the corrupt record."""
    fields = [T.StructField(f.name, T.StringType()) if f.name == "rectime" else f for f in schema.fields]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def line_reader(reader, schema: T.StructType):
    """``spark.read`` or ``spark.readStream`` set up for log lines."""
    return reader.schema(line_schema(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def read_log_files(spark: SparkSession, paths: Iterable[str], schema: T.StructType = RAW_LOG) -> DataFrame:
    """The lines of the given files as ``read_raw_logs`` gives them."""
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]  # names, not patterns
    return with_log_columns(line_reader(spark.read, schema).json(literal))


def with_log_columns(lines: DataFrame) -> DataFrame:
    """Lines with ``rectime`` as epoch milliseconds (NULL if it is no number)
    and ``log_date`` and ``log_file`` of their file."""
    return lines.withColumns({
        "rectime": F.expr(EPOCH_MS),
        "log_date": log_date_of_path(F.col("_metadata.file_path")),
        "log_file": F.col("_metadata.file_path"),
    })


def parse_lines(lines: DataFrame, schema: T.StructType = RAW_LOG, text: Column | None = None) -> DataFrame:
    """``lines`` (log_date, log_file, line) read like log files: the fields of
    their JSON (of ``text``, an expression on ``line``, if given), with rectime as
    epoch milliseconds, and ``reason``: why no dated report reads it, if so.
    ``corrupt``: no JSON of the schema; ``undated``: no number as rectime."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = line_schema(schema)
    parsed = lines.select("log_date", "log_file", "line", F.from_json(F.col("line") if text is None else text, full, options).alias("_json"))
    fields = [F.col(f"_json.{f.name}").alias(f.name) for f in full.fields]
    rows = parsed.select("log_date", "log_file", "line", *fields).withColumn("rectime", F.expr(EPOCH_MS))
    reason = F.when(F.col(CORRUPT).isNotNull(), "corrupt").when(F.col("rectime").isNull(), "undated")
    return rows.withColumn("reason", reason)


def bad_lines(spark: SparkSession, files: Iterable[str], schema: T.StructType = RAW_LOG) -> DataFrame:
    """The lines of log files that no dated report reads: log_date, log_file,
    reason and the line as it is."""
    file = F.col("_metadata.file_path")
    lines = spark.read.text(sorted(files)).select(log_date_of_path(file).alias("log_date"), file.alias("log_file"), F.col("value").alias("line"))
    parsed = parse_lines(lines.where(F.trim("line") != ""), schema)
    return parsed.where("reason is not null").select("log_date", "log_file", "reason", "line")


def log_date_of_path(path):
    """The last ``yyyy-MM-dd`` folder name (optionally ``name=yyyy-MM-dd``)
    in a file path.  It is taken for every line, so the pattern runs once, and
    on a file name of one character, which leaves it few places to try."""
    short = F.substring(path, F.lit(1), F.length(path) - F.length(F.substring_index(path, "/", -1)) + 1)
    day = F.regexp_extract(short, r"^.*/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})/(?:[^/]*/)*[^/]+$", 1)
    return F.to_date(F.nullif(day, F.lit("")))
