"""Broadcast only behind a proven size bound.

``bounded_broadcast`` first asks the optimizer for its size estimate of the
candidate side: an estimate far above the bound (a big table) ends the check
without a job.  Otherwise one aggregation job measures the side exactly,
its row count and payload bytes (string bytes + 8 per non-string column),
with partial aggregation per partition (no single-task funnel).  The frame
is wrapped in ``F.broadcast`` only if both measures are within bounds; else
it is returned unchanged and the join plans as a shuffle join, where AQE's
skew-join splitting covers hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_ROWS = 1_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
# An estimate this many times above max_bytes is taken as "too big" unmeasured.
ESTIMATE_SLACK = 64
_UNKNOWN = 2**63 - 1  # what sources without statistics (e.g. JDBC) report


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, or None when the source has none."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - defensive: stats are best effort
        return None
    return None if size >= _UNKNOWN else size


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, payload bytes) of ``df``, by one partially aggregated job."""
    widths = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        else:
            widths.append(F.lit(8))
    width = sum(widths[1:], widths[0]) if widths else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    est = estimated_bytes(df)
    if est is not None and est > ESTIMATE_SLACK * max_bytes:
        return False
    n, b = measure(df)
    return n <= max_rows and b <= max_bytes


def bounded_broadcast(
    df: DataFrame,
    max_rows: int | None = DEFAULT_MAX_ROWS,
    max_bytes: int = DEFAULT_MAX_BYTES,
) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is within both bounds, else ``df``.

    ``max_rows=None`` or ``0`` disables broadcasting.
    """
    if not max_rows or max_rows <= 0:
        return df
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
