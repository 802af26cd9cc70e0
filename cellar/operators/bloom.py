"""Hash filters: rows that cannot have a partner stay out of a shuffle.

A filter of a key set has ``2**FILTER_BITS`` bits, one set for each key, held as
rows (word, bits): at most ``2**(FILTER_BITS - 6)`` of them, 16 MB, whatever the
number of keys, so it is safe to broadcast. It is built by one aggregate and
probed by a look-up of one long in generated code. It lets every row with a
partner through, and others by chance (1 in 7 at ten million keys); the exact
join that follows decides. With many more keys it holds nothing back and the
plan is the join alone: the rows are the same at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 26


def _bit(columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << FILTER_BITS))


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))


def key_filter(keys: DataFrame, columns: list[str]) -> DataFrame:
    """The filter of the keys in ``columns``."""
    bit = _bit(columns)
    rows = keys.select(F.shiftright(bit, 6).cast("int").alias("__word"), _mask(bit).alias("__bits"))
    return rows.groupBy("__word").agg(F.bit_or("__bits").alias("__bits"))


def may_hold(rows: DataFrame, columns: list[str], words: DataFrame) -> DataFrame:
    """The rows whose key, in ``columns``, may be in the filter (missing values are a key like others)."""
    bit = _bit(columns)
    found = rows.withColumn("__word", F.shiftright(bit, 6).cast("int")).join(F.broadcast(words), "__word")
    return found.filter(F.col("__bits").bitwiseAND(_mask(bit)) != 0).select(*rows.columns)
