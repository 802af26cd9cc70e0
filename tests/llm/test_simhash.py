import random

import brute
import numpy as np
import pytest
from brute import SF0001

from cellar.llm import queries, simhash

SCHEMA = "doc_id long, text string, fp string"


def test_golay_code_is_perfect_and_keys_meet():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 2000)
    coded = simhash.decode(words)
    again = (coded << 11) ^ simhash._remainder(coded << 11)  # the codeword itself
    assert max(int(x).bit_count() for x in words ^ again) <= 3
    for a in words[:300].tolist():
        i, j = rng.choice(23, 2, replace=False)
        b = a ^ (1 << int(i)) ^ (1 << int(j))
        ka, kb = (set(simhash.golay_keys(np.array([x]))[0]) - {-1} for x in (a, b))
        assert ka & kb and len(ka) in (1, 6)


def test_bucket_keys_meet_within_two_bits():
    rng = random.Random(3)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), rng.randint(0, 2)):
            b ^= 1 << k
        ka, kb = (set(simhash.bucket_keys(np.array([x], np.uint64))[1].tolist()) for x in (a, b))
        assert ka & kb


def _check(rows, want_rows):
    want = brute.component_ids(want_rows)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows}
    assert len(rows) == len(want_rows)
    assert got == {(d, f"{f:016x}", want[f]) for d, f in want_rows}


def test_query_against_brute_force(spark):
    docs = brute.documents(SF0001)
    _check(queries.op5_simhash(spark, SF0001).collect(), [(d["doc_id"], brute.fingerprint(d["text"])) for d in docs])


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    texts = [(1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "two words"), (7, long), (8, long + " end"),
             (None, "nothing here at all"), (9, "é É a b")]
    df = spark.createDataFrame([(d, t, "x") for d, t in texts], SCHEMA)
    _check(simhash.near_duplicates(df).collect(), [(d, brute.fingerprint(t)) for d, t in texts])
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert [i for _, i in ids] == [1, 4, 6, 7, 9, 0] and ids[-1][0]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).count() == 0 and simhash.keep_one(df).count() == 0


@pytest.mark.parametrize("bucket", [1, 40])
def test_links_of_dense_fingerprints(spark, bucket):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(3)]
    fps = {b ^ (1 << i) ^ (1 << j) for b in base for i in range(0, 64, 9) for j in range(0, 64, 7)} | {rng.getrandbits(64) for _ in range(50)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    roots = {r["node"] % (1 << 64): r["root"] for r in simhash.components(simhash.links(df, bucket=bucket)).collect()}
    want = brute.component_ids([(f, f) for f in fps])
    groups = {}
    for f in fps:
        groups.setdefault(want[f], set()).add(roots.get(f, f"alone {f}"))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_component_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 100)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in [*range(61), 100, 101]}
