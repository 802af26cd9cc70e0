"""Spelling variants against a plain version that compares all words."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from brute import SF0001, documents
from pyspark.sql import functions as F

from cellar.llm import spelling
from cellar.llm.queries import op13_spelling


def plain_words(rows, least_length=7, least_count=2) -> dict[str, int]:
    counts: Counter = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def edits(w: str, letters: str) -> set[str]:
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    out |= {w[:i] + c + w[i + k:] for i in range(len(w) + 1) for c in letters for k in (0, 1)}
    return out - {w}


def plain_variants(rows) -> list[tuple]:
    counts = plain_words(rows)
    letters = "".join(sorted({c for w in counts for c in w}))
    form, near = {}, {}
    for w, n in counts.items():
        found = [v for v in edits(w, letters) if v in counts]
        near[w] = len(found)
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, near[w], None if form[w] is None else counts[form[w]]))
    return sorted(out)


def ours(df) -> list[tuple]:
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_whole_table_equals_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(SF0001)]
    got = ours(op13_spelling(spark, SF0001))
    assert got == plain_variants(rows)
    assert sum(r[4] for r in got) > 0


def test_chains_ties_and_odd_rows(spark):
    words = ["abcdefg"] * 600 + ["abcdefgh"] * 40 + ["abcdefgxh"] * 3 + ["abcdeff"] * 600 + ["éabcdefg"] * 2 + ["aaaaaaaa"] * 20 + ["aaaaaaa"] * 2 + ["Abcdefg×"] * 2
    rows = [(i, w) for i, w in enumerate(words)] + [(None, "abcdefg abcdefg"), (7, None), (8, ""), (9, " 1 2 "), (9, "aaaaaaaa"), (9, "aaaaaaaa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    got = ours(spelling.variants(docs))
    assert got == plain_variants(rows)
    by = {r[0]: r for r in got}
    assert by["abcdefgxh"][1] == "abcdefgh" and by["abcdefgxh"][2] in ("abcdefg", "abcdeff")


def test_empty_table(spark):
    assert ours(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_very_long_words(spark):
    long = "ab" * 40_000
    rows = [(1, long + " " + long[:-1]), (1, long + " " + long[:-1] + "c"), (1, long[:-1] + " " + long[:-1] + "c")]
    assert ours(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == plain_long(rows)


def plain_long(rows):
    counts = plain_words(rows)
    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or a == b:
            return False
        i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]
    return sorted((w, None, w, n, sum(near(w, v) for v in counts), None) for w, n in counts.items())


def test_pairs_meet_exactly_at_one_edit():
    rng = np.random.default_rng(5)
    words = sorted({"".join(rng.choice(list("abé"), rng.integers(1, 7))) for _ in range(300)})
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    p, s, word, _, inserted = spelling.node_pairs(codes, first)
    under: dict = {}
    for a, b, w, ins in zip(p, s, word, inserted):
        under.setdefault((a, b), []).append((words[w], ins))
    met = {frozenset((v, w)) for g in under.values() for v, vi in g for w, wi in g if v != w and not (vi and wi)}
    assert met == {frozenset((v, w)) for v in words for w in edits(v, "abé") if w in set(words)}
