"""Byte and record accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_bytes(written: DataFrame, payload: str = "raw_data") -> DataFrame:
    """One row: records written and the bytes of their payload."""
    return written.agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.octet_length(payload).cast("bigint")), F.lit(0)).cast("bigint").alias("total_bytes"),
    )


def status_counts(statuses: DataFrame) -> DataFrame:
    """Records and payload bytes per decision status."""
    return statuses.groupBy("status").agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(F.col("bytes").cast("bigint")), F.lit(0)).cast("bigint").alias("bytes"),
    )
