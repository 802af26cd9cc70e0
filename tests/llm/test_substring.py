import random

import brute
import pytest
from brute import SF0001

from cellar.llm import queries, substring


def _got(df):
    return sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect())


def test_query_against_brute_force(spark):
    docs = brute.documents(SF0001)
    want = sorted((d["doc_id"], *x) for d, x in zip(docs, brute.repeats([d["text"] for d in docs])))
    assert _got(queries.op6_substring(spark, SF0001)) == want


def _texts(seed=7):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz")
    passage = [word() + str(i) for i in range(50)]
    near = [f"n{i}" for i in range(30)]
    texts = [None, "", " \n ", "a " * 200, "short one"]
    for k in range(12):
        own = [f"d{k}_{i}" for i in range(rng.randint(0, 80))]
        texts.append(" ".join(own + passage[rng.randint(0, 8):rng.randint(42, 50)] + [word() for _ in range(40)]))
        texts.append("\n".join([f"e{k}_{i}" for i in range(20)] + near + [f"f{k}_{i}" for i in range(20)]))
    return [*texts, texts[6], texts[6], texts[8] + " tail " + texts[8]]


@pytest.mark.parametrize("shard", [1, 256])
def test_edge_texts(spark, shard):
    texts = _texts()
    rows = [(i if i % 5 else None, t, "clash", 3) for i, t in enumerate(texts)] + [(6, texts[6], "clash", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, N_removed int")
    out = substring.remove_repeats(df, words_only=True, shard=shard).collect()
    assert out[0].__fields__[:4] == df.columns and len(out) == len(rows)
    from hashlib import sha256

    want = brute.repeats([r[1] for r in rows])
    got = sorted((str(r[0]), r[4], r[5], sha256(r["text"].encode()).hexdigest()) for r in out)
    assert got == sorted((str(r[0]), *w) for r, w in zip(rows, want))


def test_text_keeps_what_stays(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    df = spark.createDataFrame([(1, f"My  own\tstart. {shared}\nand end"), (2, f"{shared} Other"), (3, "  clean\n text "), (4, None)],
                               "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in substring.remove_repeats(df).collect()}
    assert got == {1: ("My  own\tstart. and end", 40), 2: ("Other", 40), 3: ("  clean\n text ", 0), 4: (None, 0)}


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_reference_spans(spark):
    ref = [f"r{i}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(["a"] + ref[10:60] + ["b"])), (2, " ".join(ref[:34] + ["x"])), (3, None)], "doc_id long, text string")
    reference = spark.createDataFrame([(" ".join(ref[:150]),), (" ".join(ref[150:]),), (None,)], "text string")
    for words in (200_000, 100):
        got = {r["doc_id"]: r["text"] for r in substring.remove_reference(df, reference, 35, words).collect()}
        assert got == {1: "a b", 2: " ".join(ref[:34] + ["x"]), 3: None}


def test_reference_result_does_not_depend_on_shards(spark):
    words = [f"w{i}" for i in range(120)]
    # passages that overlap in the document, and words that meet only where an earlier cut joined them
    texts = [" ".join(words[:50]), " ".join(words[40:76]), " ".join(words[80:100] + ["z"] * 40 + words[100:120]),
             " ".join(words[80:120]), " ".join(["z"] * 40)]
    reference = spark.createDataFrame([(t,) for t in texts[:2] + texts[3:]], "text string")
    docs = spark.createDataFrame([(1, " ".join(words[:76]), "x"), (2, " ".join(["a", *words[:76], "b"]), "x"), (3, texts[2], "x"), (4, None, "x")],
                                 "doc_id long, text string, __spans string")
    want = {1: "", 2: "a b", 3: " ".join(words[80:120]), 4: None}
    for shard_words in (200_000, 60, 20, 7):
        out = substring.remove_reference(docs, reference, 35, shard_words)
        assert out.columns == docs.columns and {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_automaton_counts_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        segs = [[rng.choice("abc") for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 5))]
        segs = [list(x) for x in {tuple(s) for s in segs}]
        weights = [rng.choice([1, 1, 2]) for _ in segs]
        count = {}
        for s, n in zip(segs, weights):
            for i in range(len(s) - 2):
                count[tuple(s[i:i + 3])] = count.get(tuple(s[i:i + 3]), 0) + n
        for s, n, spans in zip(segs, weights, substring.repeated_spans(segs, weights, 3)):
            want = {j for i in range(len(s) - 2) if count[tuple(s[i:i + 3])] > 1 for j in range(i, i + 3)}
            assert {j for a, b in spans for j in range(a, b)} == want
