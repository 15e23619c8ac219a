"""Column-level helpers (all JVM-side built-ins, no UDFs)."""

from logcube.functions.scalar import (  # noqa: F401
    CHANNELS,
    channel_of,
    date_key,
    dt_string,
    epoch_ms_of,
    local_date,
    pct_change_text,
    ratio_change,
    safe_ratio,
    source_flag,
)
