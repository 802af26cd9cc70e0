"""A join whose left side may hold one key in a large share of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8
# Rows without a key match nothing; they are spread over many more salts.
NULL_SALTS = 10_000


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "left", salts: int = SALTS) -> DataFrame:
    """``left`` joined with ``right``, which has at most one row per ``key``.

    Each right row is repeated for every salt and each left row takes a salt
    from its ``spread`` column, so a hot key's rows meet in ``salts`` tasks
    instead of one, with or without adaptive execution.
    """
    h = F.xxhash64(spread)
    salt = F.when(F.col(key).isNull(), F.pmod(h, F.lit(NULL_SALTS)) + salts).otherwise(F.pmod(h, F.lit(salts)))
    left = left.withColumn("__salt", salt.cast("int"))
    right = right.filter(F.col(key).isNotNull()).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"], how).drop("__salt")
