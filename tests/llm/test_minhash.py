"""HyperMinHash near-duplicates against all pairs of full sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from brute import SF0001, documents, words
from pyspark.sql import functions as F

from cellar.llm import minhash
from cellar.llm.queries import op12_minhash


def plain_set(text) -> frozenset:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i:i + 2]) for i in range(len(w) - 1)) if len(w) > 1 else frozenset(w)


def plain_components(rows) -> list[tuple]:
    """(doc_id, set size, component_id, kept), all pairs of distinct sets compared."""
    sets = [plain_set(t) for _, t in rows]
    kinds = sorted({s for s in sets if s}, key=sorted)
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for j in range(i):
            b = kinds[j]
            common = len(a & b) if min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)) else 0
            if 100 * common >= 80 * (len(a) + len(b) - common):
                parent[find(i)] = find(j)
    at = {s: i for i, s in enumerate(kinds)}
    least: dict = {}
    for (d, _), s in zip(rows, sets):
        if s and d is not None:
            root = find(at[s])
            least[root] = min(least.get(root, d), d)
    out = []
    for (d, _), s in zip(rows, sets):
        c = least.get(find(at[s])) if s else d
        out.append((d, len(s), c, d == c))
    return sorted(out, key=repr)


def ours(df) -> list[tuple]:
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_whole_table_equals_all_pairs(spark):
    got = ours(op12_minhash(spark, SF0001))
    assert got == plain_components([(r["doc_id"], r["text"]) for r in documents(SF0001)])
    assert any(not r[3] for r in got)


def near_copies(n=260, size=60, seed=3) -> list[tuple]:
    """Copies of one text with words changed, similar to it but not all to each other; some of them far off."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(size)]
    rows = [(0, " ".join(base))]
    for d in range(1, n):
        w = list(base)
        for _ in range(rng.choice([1, 2, 2, 3, 3, 4, 5, 7])):
            w[rng.randrange(size)] = f"x{rng.randrange(10_000)}"
        rows.append((d, " ".join(w)))
    return rows


@pytest.mark.parametrize("rounds", [1, 3])
def test_a_group_of_near_copies(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    monkeypatch.setattr(minhash, "BLOCK", 50)
    monkeypatch.setattr(minhash, "BIG", 10)
    rows = near_copies()
    rows += [(1000 + d, t) for d, t in rows[:40]]  # exact copies
    got = ours(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)))
    assert got == plain_components(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d e"), (8, "a b c d e f"), (9, "a b c d"),
            (8, "a b c d e f"), (8, "other text of an id that recurs"), (None, "a b c d e"), (None, "no id"), (None, None),
            (10, "word " * 30_000), (11, "WORD word"), (12, " ".join(f"u{i}" for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("key", F.lit("k")).withColumn("regs", F.lit(0))
    assert ours(minhash.near_duplicates(docs)) == plain_components(rows)


def test_empty_table(spark):
    assert ours(minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_estimates_are_close_and_keys_meet():
    rng = np.random.default_rng(1)
    for size in (5, 40, 700, 6000):
        for j in (0.0, 0.5, 0.8, 0.95):
            both = round(size * 2 * j / (1 + j))
            names = [f"s{rng.integers(1 << 60)}" for _ in range(2 * size)]
            a, b = " ".join(names[:size]), " ".join(names[:both] + names[size:2 * size - both])
            h, edge = minhash.shingle_sets(pa.array([a, b]), 1)
            regs = minhash.registers(h, edge)
            n = np.diff(edge)
            true = len(np.intersect1d(h[:edge[1]], h[edge[1]:])) / len(np.unique(h))
            assert abs(minhash.estimate(regs[:1], regs[1:], n[:1], n[1:])[0] - true) < (0.2 if size > 5 else 0.35)
            if true >= 0.8:
                keys = minhash.band_keys(regs)
                assert (keys[0] == keys[1]).any()
