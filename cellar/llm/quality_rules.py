"""Quality rules: a decision list learned by sequential covering, applied as Spark conditions.

``text_statistics`` computes per-text counts with SQL functions alone.
``learn_rules`` grows and prunes threshold conjunctions on labelled statistics;
each step is one small aggregate over binned rows, and only per-bin counts
(features x bins) reach the driver. ``rules_column`` turns the ordered rules
into one CASE expression.

Defined results: a null or white-space text has no words and zero counts;
null statistics or labels take no part in learning; without usable labels the
list is empty and rejects nothing; documents labelled both ways count once for
each label.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import WORD, stage_table, word_array

SYMBOLS = "#*$%&|<>"


def _count_of(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def text_statistics(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and helper counts.

    A word counts as repeated if one of the 3-word windows that hold it occurs
    twice or more in the text. Windows are compared by 64-bit hash within one
    text; their order is a sort inside the row, so a text made of one line
    repeated costs no more than any other.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*keys, t.alias("__t"))
    base = base.select("*", word_array(F.col("__t")).alias("__w"), F.split("__t", "\n").alias("__lines"))
    base = base.select(
        *keys,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).alias("n_symbols"),
        _count_of(F.col("__t"), "A-Z").alias("n_upper"),
        _count_of(F.col("__t"), "0-9").alias("n_digits"),
        _count_of(F.col("__t"), "!?").alias("n_marks"),
        F.filter("__lines", lambda x: x.rlike(WORD)).alias("__lines"),
        F.when(F.size("__w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("__w") - 3),
            lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)),
        )).alias("__h"),
    )
    base = base.withColumn("__sorted", F.when(
        F.size("__h") > F.size(F.array_distinct("__h")),
        F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    ))
    same = lambda k, x: F.get("__sorted", k)["h"] == x["h"]
    repeated = F.filter("__sorted", lambda x, k: F.coalesce(same(k + 1, x), F.lit(False))
                        | F.coalesce(same(k - 1, x), F.lit(False)))
    base = base.withColumn("__at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    gaps = F.zip_with("__at", F.slice("__at", 2, F.greatest(F.size("__at") - 1, F.lit(1))),
                      lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))).cast("long"))
    lines = F.size("__lines").cast("long")
    return base.select(
        *keys, "n_words", "word_chars", "n_symbols",
        (lines - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
        .alias("n_repeat_words"),
        lines.alias("n_lines"), "n_upper", "n_digits", "n_marks",
    )


def ratio_features() -> dict[str, Column]:
    """Features of the decision list, from the columns of ``text_statistics``."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "mark_share": share("n_marks", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, features: dict[str, Column]) -> Column:
        value = features[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self, features: dict[str, Column]) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(features)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def learn_rules(rows: DataFrame, features: list[str], label: str, fold: str, max_rules: int = 8,
                max_conditions: int = 3, bins: int = 24, min_precision: float = 0.7,
                min_cover: int = 5) -> list[Rule]:
    """An ordered list of rules that pick rows with ``label`` 1 out of rows with label 0 or 1.

    Thresholds are quantiles of each class (at most ``2 * bins`` a feature). Two
    thirds of the rows (by hash of ``fold``) grow a rule by FOIL gain; the rest
    prune its last conditions by (p - n) / (p + n). A rule is kept if both parts
    together give ``min_precision`` over at least ``min_cover`` rows; learning
    ends at the first that does not.
    """
    usable = rows.filter(F.col(label).isin(0, 1))
    for f in features:
        usable = usable.filter(F.col(f).isNotNull() & ~F.isnan(f))
    at = [i / bins for i in range(1, bins)]
    cuts: dict[str, list[float]] = {}
    stats = usable.groupBy(label).agg(*[F.percentile_approx(f, at, 2000).alias(f) for f in features]).collect()
    for f in features:
        cuts[f] = sorted({float(x) for r in stats for x in (r[f] or [])})
    binned = usable.select(
        *[_bin(F.col(f), cuts[f]).alias(f) for f in features],
        F.col(label).cast("int").alias("__y"), (F.pmod(F.xxhash64(fold), F.lit(3)) == 0).alias("__prune"),
    ).groupBy(*features, "__y", "__prune").agg(F.count(F.lit(1)).alias("__n"))
    left = stage_table(binned, "rules")

    rules: list[Rule] = []
    while len(rules) < max_rules:
        found = _grow(left.filter(~F.col("__prune")), features, cuts, max_conditions)
        if not found:
            break
        tests = [_prefix(found[:k], cuts) for k in range(1, len(found) + 1)]
        sums = [F.sum(F.when(t & (F.col("__y") == y) & (F.col("__prune") | F.lit(whole)), F.col("__n")).otherwise(0))
                .alias(f"s{k}_{y}_{int(whole)}") for k, t in enumerate(tests) for y in (0, 1) for whole in (False, True)]
        got = left.agg(*sums).first()
        score = lambda k, w: (got[f"s{k}_1_{w}"] or 0, got[f"s{k}_0_{w}"] or 0)
        worth = lambda k: (lambda p, n: (p - n) / (p + n) if p + n else -1.0)(*score(k, 0))
        best = max(range(len(tests)), key=lambda k: (worth(k), -k))
        p, n = score(best, 1)
        if p + n < min_cover or p / (p + n) < min_precision:
            break
        rules.append(Rule(tuple(found[:best + 1]), p / (p + n)))
        left = left.filter(~tests[best])
    return rules


def _bin(value: Column, cuts: list[float]) -> Column:
    """Number of cut points below the value (bounded: one comparison per cut)."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < value)).cast("int") if cuts else F.lit(0)


def _prefix(conditions: list[Condition], cuts: dict[str, list[float]]) -> Column:
    """The conditions on binned rows: value > cuts[j] is the same as bin > j."""
    out = F.lit(True)
    for c in conditions:
        j = cuts[c.feature].index(c.threshold)
        out = out & ((F.col(c.feature) > j) if c.above else (F.col(c.feature) <= j))
    return out


def _grow(rows: DataFrame, features: list[str], cuts: dict[str, list[float]], most: int) -> list[Condition]:
    chosen: list[Condition] = []
    while len(chosen) < most:
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in features])).alias("c")
        counts = (rows.filter(_prefix(chosen, cuts)).select(cells, "__y", "__n").groupBy("c.f", "c.b")
                  .agg(F.sum(F.when(F.col("__y") == 1, F.col("__n")).otherwise(0)).alias("p"),
                       F.sum(F.when(F.col("__y") == 0, F.col("__n")).otherwise(0)).alias("n")).collect())
        by: dict[str, dict[int, tuple[int, int]]] = {}
        for r in counts:
            by.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"])
        if not by:
            break
        p0, n0 = (sum(x[i] for x in next(iter(by.values())).values()) for i in (0, 1))
        if p0 == 0 or n0 == 0:
            break
        before, best, gain = math.log2(p0 / (p0 + n0)), None, 0.0
        for f in features:
            p = n = 0
            for j, cut in enumerate(cuts[f]):
                got = by.get(f, {}).get(j, (0, 0))
                p, n = p + got[0], n + got[1]
                for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                    if pp and (g := pp * (math.log2(pp / (pp + nn)) - before)) > gain + 1e-12:
                        best, gain = Condition(f, above, cut), g
        if best is None:
            break
        chosen.append(best)
    return chosen


def rules_column(rules: list[Rule], features: dict[str, Column]) -> Column:
    """Number (from 1) of the first rule that holds, else null."""
    out = None
    for k, r in enumerate(rules, 1):
        out = F.when(r.column(features), k) if out is None else out.when(r.column(features), k)
    return out.cast("int") if out is not None else F.lit(None).cast("int")


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (text of the learned rule that rejects, else null) and kept."""
    features = ratio_features()
    stats = stage_table(text_statistics(docs, ["doc_id"]), "statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    poor = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", (1 - F.col("quality")).alias("poor")).distinct()
    train = stats.filter(~failed).join(poor, "doc_id").select("doc_id", "poor", *[c.alias(f) for f, c in features.items()])
    rules = learn_rules(train, list(features), "poor", "doc_id", **options)
    number = rules_column(rules, features)
    text = F.element_at(F.array(*[F.lit(str(r)) for r in rules]), F.col("__rule")) if rules else F.lit(None).cast("string")
    return (stats.withColumn("base_failed", failed).withColumn("__rule", F.when(~F.col("base_failed"), number))
            .withColumn("kept", ~F.col("base_failed") & F.col("__rule").isNull())
            .withColumn("rule", F.when(F.col("__rule").isNotNull(), text)).drop("__rule"))
