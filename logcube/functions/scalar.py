"""Scalar rules of the reports, as Column expressions.

All of them stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Raw `site` code -> report channel name.  Any other code,
# and NULL, maps to OTHER_CHANNEL.
CHANNELS = {
    "ALI": "youku",
    "IQIYI": "iqiyi",
    "BESTV": "bestv",
}
OTHER_CHANNEL = "others"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def channel_of(site, channels: dict[str, str] | None = None) -> Column:
    """Site code -> channel; unmapped codes and NULL -> 'others'."""
    site = _col(site)
    mapping = CHANNELS if channels is None else channels
    expr = None
    for code, name in mapping.items():
        expr = (F.when if expr is None else expr.when)(site == F.lit(code), F.lit(name))
    return F.lit(OTHER_CHANNEL) if expr is None else expr.otherwise(F.lit(OTHER_CHANNEL))


def local_date(epoch_ms, tz: str) -> Column:
    """P5: epoch milliseconds -> calendar date in time zone ``tz``.

    Independent of ``spark.sql.session.timeZone``: the instant is built as a
    TIMESTAMP_NTZ in UTC and converted explicitly.
    """
    utc_wall = F.timestamp_add("MILLISECOND", _col(epoch_ms), _epoch_ntz())
    if tz.upper() in ("UTC", "Z", "+00:00"):
        return F.to_date(utc_wall)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_wall))


def epoch_ms_of(ts_ntz) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ read as UTC wall time."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts_ntz))


def dt_string(date) -> Column:
    """Date -> 'yyyy-MM-dd' partition value."""
    return _col(date).cast("string")


def date_key(date) -> Column:
    """Date -> yyyymmdd int, by arithmetic (no string round trip)."""
    d = _col(date)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def source_flag(package_id) -> Column:
    """1 when the event names a package, else 0."""
    return F.when(_col(package_id).isNotNull(), F.lit(1)).otherwise(F.lit(0))


def safe_ratio(num, den, scale: int = 2) -> Column:
    """A3: round(num / den, scale); NULL instead of a division-by-zero error."""
    return F.round(F.try_divide(_col(num), _col(den)), scale)


def pct_change_text(cur, prev) -> Column:
    """Growth as text, e.g. '25.0%'; NULL when there is no previous value
    or it is 0."""
    pct = F.round((F.try_divide(_col(cur), _col(prev)) - F.lit(1)) * F.lit(100), 2)
    return F.concat(pct.cast("string"), F.lit("%"))


def ratio_change(cur, prev, scale: int = 4) -> Column:
    """R2: growth as a number, round(cur / prev - 1, scale)."""
    return F.round(F.try_divide(_col(cur), _col(prev)) - F.lit(1), scale)
