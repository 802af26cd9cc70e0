"""Version clocks. Cell versions are milliseconds; stay in TIMESTAMP_NTZ so
results never depend on the session time zone (no date_trunc on NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ms_floor(ts: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to whole milliseconds by interval arithmetic. What is below a millisecond is
    the same in every time zone (their offsets are whole seconds), and is counted in whole numbers."""
    t = F.col(ts) if isinstance(ts, str) else ts
    sub_ms_micros = F.pmod(F.unix_micros(t.cast("timestamp")), F.lit(1000))
    return t - F.expr("INTERVAL '0.000001' SECOND") * sub_ms_micros
