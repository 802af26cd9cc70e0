"""User hooks: value serializers, content hooks, side outputs and ip resolution."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.functions import html
from cellar.functions.keys import url_host
from cellar.operators.joins import salted_join


# ---- value serializers (BINARY Column -> BINARY Column) ----------------------

def base64_serializer(value: Column) -> Column:
    """Serializer writing the RFC 4648 base64 text of each value (native
    expressions; Spark's ``base64`` may emit MIME line breaks, removed here)."""
    return F.encode(F.replace(F.base64(value), F.lit("\r\n"), F.lit("")), "US-ASCII")


def pandas_serializer(fn: Callable[[bytes], bytes]) -> Callable[[Column], Column]:
    """Wrap an opaque bytes -> bytes function as an Arrow-batched pandas UDF."""

    @F.pandas_udf("binary")
    def _ser(s: pd.Series) -> pd.Series:
        return s.map(lambda b: None if b is None else fn(bytes(b)))

    return lambda c: _ser(c)


# ---- content hooks (DataFrame with body -> same rows + family__qualifier) ---

def title_hook(family: str = "parse", qualifier: str = "title") -> Callable[[DataFrame], DataFrame]:
    def hook(df: DataFrame) -> DataFrame:
        return df.withColumn(f"{family}__{qualifier}", html.extract_title(html.as_text("body")))

    return hook


def text_hook(family: str = "parse", qualifier: str = "text") -> Callable[[DataFrame], DataFrame]:
    def hook(df: DataFrame) -> DataFrame:
        return df.withColumn(f"{family}__{qualifier}", html.extract_text(html.as_text("body")))

    return hook


def chain_hooks(*hooks: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    def hook(df: DataFrame) -> DataFrame:
        for h in hooks:
            df = h(df)
        return df

    return hook


def links(puts_with_body: DataFrame, body: str = "body") -> DataFrame:
    """Side output: one row per outgoing link (row_key, seq, link, position)."""
    return puts_with_body.select(
        "row_key", "seq", F.posexplode(html.extract_links(html.as_text(body))).alias("position", "link")
    )


# ---- ip resolution ------------------------------------------------------------

def resolve_ip(records: DataFrame, hosts: DataFrame) -> DataFrame:
    """Fill ``ip`` from a host table where the record has none.

    Adds ``host`` and ``ip_status`` (given | resolved | missing). The host table
    is reduced to one row per host; the join is salted by ``seq``, so a hot
    host's records meet in several tasks.
    """
    h = hosts.groupBy("host").agg(F.min("ip").alias("__ip"))
    out = salted_join(records.withColumn("host", url_host("url")), h, "host", "seq")
    status = (
        F.when(F.col("ip").isNotNull(), F.lit("given"))
        .when(F.col("__ip").isNotNull(), F.lit("resolved"))
        .otherwise(F.lit("missing"))
    )
    return out.withColumn("ip_status", status).withColumn("ip", F.coalesce("ip", "__ip")).drop("__ip")
