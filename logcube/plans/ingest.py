"""Log lines into the fact table: what the nightly ingest and the stream share,
the quarantine of lines that cannot be read, and its replay."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logcube.operators.events import parse_events
from logcube.schemas import EVENT_KINDS, RAW_LOG
from logcube.sources import facts, store
from logcube.sources.raw_logs import CORRUPT, bad_lines, parse_lines


def write_lines(
    raw: DataFrame, fact_root: str, files: Mapping[str, Iterable[str]], kinds: Sequence[str], tz: str, fmt: str = "orc", schema: T.StructType = RAW_LOG
) -> tuple[facts.Run, dict[str, int]]:
    """Write the events of log lines as a run that is not in force yet, and store
    the bad lines of its ``files``.  Lines, ``corrupt`` and ``undated`` ones are
    counted while the events are written; the files are read a second time only if
    there are such."""
    seen = Observation()
    run = facts.write_run(parse_events(raw.observe(seen, *_line_counts()), kinds, tz), fact_root, fmt)
    counts = _observed(seen) or _counted(raw)
    if counts["corrupt"] or counts["undated"]:
        facts.write_bad_lines(bad_lines(raw.sparkSession, [f for own in files.values() for f in own], schema), fact_root, run)
    return run, counts


def _line_counts() -> list[Column]:
    undated = F.col(CORRUPT).isNull() & F.col("rectime").isNull()
    return [F.count("*").alias("lines"), F.count(CORRUPT).alias("corrupt"), F.count_if(undated).alias("undated")]


def _observed(seen: Observation) -> dict[str, int] | None:
    """What was observed, or None: without any event, Spark cuts the whole
    plan of the write short, and the observation with it."""
    try:
        return {k: int(v or 0) for k, v in seen.get.items()} or None
    except Py4JJavaError as e:
        if "AssertionError" not in str(e.java_exception):
            raise
        return None


def _counted(raw: DataFrame) -> dict[str, int]:
    # All fields are selected first, as Spark tells corrupt lines only then.
    return {k: int(v or 0) for k, v in raw.select("data", "rectime", CORRUPT).agg(*_line_counts()).first().asDict().items()}


def replay_bad_lines(
    spark: SparkSession,
    fact_root: str,
    days: Iterable,
    tz: str,
    kinds: Sequence[str] = EVENT_KINDS,
    schema: T.StructType = RAW_LOG,
    repair: Callable[[Column], Column] | None = None,
    fmt: str = "orc",
) -> list[str]:
    """Read the stored bad lines of log days again, after a change of ``schema``
    or with their text mended by ``repair``; the days that were committed.

    What can be read now becomes a run of its log day, what cannot stays stored
    under that run.  One commit of the day puts both in the place of the old lines
    and of the rows without a day that undated ones have, so a line counts once
    however often this runs.  A day whose bad lines another writer has replaced or
    replayed meanwhile is left as it is."""
    before = {}
    for day, runs in facts.day_runs(spark, fact_root, days).items():
        taken = {b for r in runs for b in r["bad"]}
        if taken:
            before[day] = taken
    if not before:
        return []
    stored = facts.read_bad_lines(spark, fact_root, log_days=list(before))
    rows = parse_lines(stored, schema, None if repair is None else repair(F.col("line")))
    run = facts.write_run(parse_events(rows.where("reason is null or reason = 'undated'"), kinds, tz), fact_root, fmt)
    facts.write_bad_lines(rows.where("reason is not null").select("log_date", "log_file", "reason", "line"), fact_root, run)
    facts.put_files(spark, fact_root, run, {day: [] for day in before})
    done = []
    for day, taken in before.items():

        def change(content: dict | None, day=day, taken=taken) -> dict | None:
            present = content["runs"] if content else []
            if not taken <= {b for r in present for b in r["bad"]}:
                return None
            for r in present:
                if taken & set(r["bad"]):
                    r |= {"bad": [b for b in r["bad"] if b not in taken], "parts": [p for p in r["parts"] if p["dt"] is not None]}
            return {"log_day": day, "runs": [*present, run.entry(day)]}

        if store.update(spark, f"{fact_root.rstrip('/')}/_days", day, change):
            done.append(day)
    return done
