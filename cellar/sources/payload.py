"""Payload files: raw fetch payloads kept as files (one file per fetch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_payload_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, modificationTime, length, content`` of every file, as BINARY.

    Spark's file scan skips zero-length files, so an empty payload has no row
    here; records carry empty payloads as ``raw_data = X''`` instead.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def with_payload(records: DataFrame, files: DataFrame, path: str = "payload_path") -> DataFrame:
    """Records whose ``raw_data`` comes from ``files`` (see ``read_payload_files``) by their ``path`` column.

    A record without a file there keeps its own ``raw_data``; the size follows
    the payload. Join narrow records here, before any payload is attached.
    """
    f = files.select(F.col("path").alias("__path"), F.col("content").alias("__content"))
    out = records.join(f, F.col(path) == F.col("__path"), "left")
    own = F.col("raw_data") if "raw_data" in records.columns else F.lit(None).cast("binary")
    size = F.col("content_size") if "content_size" in records.columns else F.lit(None).cast("bigint")
    return (out.withColumn("content_size", F.coalesce(F.octet_length("__content").cast("bigint"), size))
            .withColumn("raw_data", F.coalesce("__content", own)).drop("__path", "__content", path))


def payload_sizes(records: DataFrame) -> DataFrame:
    """Byte lengths of request and response payloads of each record."""
    return records.select(
        "seq",
        F.octet_length("request").cast("bigint").alias("request_bytes"),
        F.octet_length("raw_data").cast("bigint").alias("raw_bytes"),
    )
