"""URL filter: site rules first, then logistic regression on hashed character n-grams.

Only DataFrame functions. Training takes a small labelled URL table (at most
``MAX_LABELLED`` rows are accepted; more is an error, not a cut): each gradient
step is one aggregate over the labelled rows, and the weights (one double for
each of ``buckets``) stay on the driver and enter the next step as a literal.
Scoring is a per-row expression over the URL.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and is judged by its (then empty) features alone, that is by
the intercept.
"""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import stage_table

MAX_LABELLED = 20_000
#: (verdict, host and path) of a site list
Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule_column(rules: list[Rule], host: Column, path: Column, what: int) -> Column:
    """Verdict (``what`` 0) or text (1) of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, prefix = rule[1].partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + prefix))
        out = F.when(fits, F.lit(rule[what])).otherwise(out)
    return out


def ngram_buckets(host: Column, path: Column, sizes: tuple[int, ...], buckets: int) -> Column:
    """Distinct hashed n-grams; a host's and a path's differ, and ^ and $ mark the ends."""
    parts = []
    for tag, text in (("h", host), ("p", path)):
        marked = F.concat(F.lit("^"), F.translate(text, ascii_uppercase, ascii_lowercase), F.lit("$"))
        for n in sizes:
            grams = _grams(tag, marked, n, buckets)
            parts.append(F.when(F.length(text) > 0, grams).otherwise(F.array().cast("array<int>")))
    return F.array_distinct(F.concat(*parts))


def _grams(tag: str, text: Column, n: int, buckets: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substring(text, i, n)), F.lit(buckets)).cast("int"))


def fit(labelled: DataFrame, sizes: tuple[int, ...] = (3, 4, 5), buckets: int = 1 << 14, steps: int = 40,
        rate: float = 0.5, penalty: float = 1e-3) -> tuple[float, list[float]]:
    """Intercept and weights from rows of url and label (1: to block, 0: to allow; others unused)."""
    rows = labelled.filter(F.col("label").isin(0, 1) & F.col("url").isNotNull())
    rows = rows.select(F.col("label").cast("double").alias("y"),
                       ngram_buckets(host_of(F.col("url")), path_of(F.col("url")), sizes, buckets).alias("x"))
    rows = stage_table(rows.coalesce(1), "urls")
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if n > MAX_LABELLED:
        raise ValueError(f"{n} labelled URLs; at most {MAX_LABELLED} are trained on")
    if not n or positive in (0, n):
        return (0.0 if not n else math.copysign(5.0, positive - 0.5)), [0.0] * buckets
    bias, weights = math.log(positive / (n - positive)), [0.0] * buckets
    squares = [1e-8] * (buckets + 1)
    for _ in range(steps):
        wrong = rows.select("x", (F.lit(1.0) / (1.0 + F.exp(-margin(F.col("x"), bias, weights))) - F.col("y")).alias("e"))
        parts = F.concat(F.array(F.struct(F.lit(-1).alias("b"), F.col("e").alias("g"))),
                         F.transform("x", lambda b: F.struct(b.alias("b"), (F.col("e") / _norm(F.col("x"))).alias("g"))))
        gradient = wrong.select(F.inline(parts)).groupBy("b").agg(F.sum("g").alias("g")).collect()  # buckets + 1 rows at most
        for r in gradient:  # a step for each weight by its own past gradients
            b, g = r["b"], r["g"] / n
            g += penalty * weights[b] if b >= 0 else 0.0
            squares[b] += g * g
            if b >= 0:
                weights[b] -= rate * g / math.sqrt(squares[b])
            else:
                bias -= rate * g / math.sqrt(squares[b])
    return bias, weights


def margin(x: Column, bias: float, weights: list[float]) -> Column:
    """Intercept plus the weights of the buckets, over the square root of their number."""
    # one string literal, folded to an array once; thousands of literals would each be a plan node
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    total = F.aggregate(x, F.lit(0.0), lambda a, b: a + F.get(w, b))
    return F.lit(bias) + total / _norm(x)


def _norm(x: Column) -> Column:
    return F.sqrt(F.greatest(F.size(x), F.lit(1)).cast("double"))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: list[Rule], sizes: tuple[int, ...] = (3, 4, 5),
               buckets: int = 1 << 14, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, score (the model's probability of block)."""
    bias, weights = fit(labelled, sizes, buckets, **options)
    out = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    out = out.withColumn("__x", ngram_buckets(F.col("host"), F.col("path"), sizes, buckets))
    score = F.lit(1.0) / (1.0 + F.exp(-margin(F.col("__x"), bias, weights)))
    host, path = F.col("host"), F.col("path")
    return out.select(
        "page_id", "host", "path", rule_column(rules, host, path, 1).alias("rule"),
        F.coalesce(rule_column(rules, host, path, 0), F.when(score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"),
    )
