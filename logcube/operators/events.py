"""Turn raw log lines (one struct of event arrays per line) into
typed event rows.

One scan serves any number of event kinds: each kind's array is tagged with
its name, the tagged arrays are exploded, then the events.  ``explode`` (not
``explode_outer``) is deliberate: NULL and empty arrays yield no row, and
events without a ``time`` are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logcube.functions.scalar import channel_of, dt_string, local_date, source_flag

# The fields of a log line that an event row keeps.
LINE_FIELDS = ("custom_uuid", "account", "rectime", "device_name", "vercode", "vername", "site")


def explode_kinds(
    raw: DataFrame,
    kinds: Sequence[str],
    passthrough: Sequence[str] = (),
) -> DataFrame:
    """One row per event of the given kinds.

    Output: the line fields present in ``raw`` + ``passthrough``, then
    ``kind, time, package_id, title``.
    """
    if not kinds:
        raise ValueError("explode_kinds needs at least one event kind")
    keep = [c for c in LINE_FIELDS if c in raw.columns] + [c for c in passthrough if c not in LINE_FIELDS]
    present = set(raw.schema["data"].dataType.fieldNames())
    # A kind the log schema does not have yields no rows (never an analysis error).
    kinds = [k for k in kinds if k in present]
    if not kinds:
        return raw.select(
            *keep,
            F.lit(None).cast("string").alias("kind"),
            *[F.lit(None).cast("string").alias(c) for c in ("time", "package_id", "title")],
        ).where(F.lit(False))
    if len(kinds) == 1:
        (kind,) = kinds
        rows = raw.select(*keep, F.lit(kind).alias("kind"), F.explode(F.col("data").getField(kind)).alias("_e"))
    else:
        tagged = F.array(
            *[F.struct(F.lit(k).alias("kind"), F.col("data").getField(k).alias("events")) for k in kinds]
        )
        rows = raw.select(*keep, F.explode(tagged).alias("_k")).select(
            *keep, F.col("_k.kind").alias("kind"), F.explode(F.col("_k.events")).alias("_e")
        )
    return rows.where(F.col("_e.time").isNotNull()).select(
        *keep,
        "kind",
        F.col("_e.time").alias("time"),
        F.col("_e.package_id").alias("package_id"),
        F.col("_e.title").alias("title"),
    )


def parse_events(
    raw: DataFrame,
    kinds: Sequence[str],
    tz: str,
    passthrough: Sequence[str] = (),
    date_from: str = "event",
    channels: dict[str, str] | None = None,
) -> DataFrame:
    """Raw log lines -> fact rows.

    ``tz`` is the zone whose calendar day defines ``date``/``dt`` (required:
    the reference silently used the session zone).  ``date_from="log"`` takes
    the date of the log directory instead (column ``log_date`` as added by
    ``sources.raw_logs.read_raw_logs``), which is what the click stage of the
    install funnel uses.
    """
    has_log_date = "log_date" in raw.columns
    ev = explode_kinds(raw, kinds, passthrough=list(passthrough) + (["log_date"] if has_log_date else []))
    if date_from == "event":
        date = local_date(F.col("rectime"), tz)
    elif date_from == "log":
        if not has_log_date:
            raise ValueError("date_from='log' needs a log_date column (see sources.raw_logs)")
        date = F.col("log_date")
    else:
        raise ValueError(f"date_from must be 'event' or 'log', not {date_from!r}")
    def optional(name: str, dtype: str):
        return F.col(name) if name in ev.columns else F.lit(None).cast(dtype).alias(name)

    return ev.select(
        *passthrough,
        "custom_uuid",
        optional("account", "string"),
        date.alias("date"),
        optional("log_date", "date"),
        "device_name",
        optional("vercode", "string"),
        optional("vername", "string"),
        channel_of(F.col("site"), channels).alias("site"),
        "package_id",
        "title",
        "kind",
        source_flag(F.col("package_id")).alias("source"),
        dt_string(date).alias("dt"),
    )
