import math
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from brute import SF0001, documents

from cellar.llm import language, queries, toxicity

SF001 = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    want = {d["doc_id"]: d["lang"] for d in documents(SF001)}
    rows = [r for r in queries.op8_language(spark, SF001).collect() if r["held_out"]]
    assert len(rows) > 150 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_language_edge_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "der Hund und die Katze", "de") for i in range(20)]
    model = language.learn(spark.createDataFrame([*rows, (1, None, "en"), (2, "x", None)], "doc_id long, text string, lang string"), least=1)
    assert model.languages == ["de", "en"]
    texts = [None, "", "123 _ !", "the dog", "DER KATZE", "katzen hunden", "ʘ", "the " * 50_000]
    lang, score = model.predict(texts)
    assert lang == ["und", "und", "und", "en", "de", "de", "de", "en"] and score[:3].tolist() == [0, 0, 0] and score[6] == 0.5
    df = spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(texts)] + [(3, "the dog", "xx", 2), (None, "the", None, 0)],
                               "doc_id long, text string, lang_pred string, score int")
    out = language.with_language(df, model)
    assert Counter((r["doc_id"], r["lang_pred"]) for r in out.collect())[3, "en"] == 2 and out.count() == 10
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.predict_documents(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in language.predict_documents(unlabelled).collect()] == [(1, language.held_out is None, "und", 0.0)]


def test_language_letters_are_those_of_unicode():
    assert language.text_words("\u00bd \u00b2 \u2460 \u2167 7_\u0301") == []  # numerals, a mark on no letter
    assert language.text_words("\u0939\u093f\u0928\u094d\u0926\u0940 E\u0301t\u00e9 x2y") == ["\u0939\u093f\u0928\u094d\u0926\u0940", "e\u0301t\u00e9", "x", "y"]
    model = language.Model(["a", "b"], {"x": 0}, np.log([[0.9, 0.1]]), {}, np.zeros((0, 2)))
    assert model.predict(["\u00bd \u00b2 \u2460", "x"])[0] == ["und", "a"]


def test_language_dirty_labels_are_bounded(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "der Hund", "de") for i in range(9)]
    rows += [(200 + i, "noise", f"dirty-{i}") for i in range(300)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), least=1, max_languages=2)
    assert model.languages == ["de", "en"] and model.word_scores.shape[1] == 2
    assert model.predict(["the dog", "der Hund"])[0] == ["en", "de"]


def test_language_scores_against_a_plain_version():
    rng = random.Random(3)
    words = {"und": 0, "the": 1}
    grams = {g: i for i, g in enumerate({x for w in ("hund", "dog", "and") for n in (5, 3, 1) for x in language.word_grams(w, n)})}
    table = np.log([[rng.random() for _ in range(3)] for _ in range(2 + len(grams))])
    model = language.Model(["a", "b", "c"], words, table[:2], grams, table[2:])
    for text in ("und the hund", "dog dogs the zzz", "and hunde", "q"):
        total = np.zeros(3)
        for w in language.text_words(text):
            if w in words:
                total += table[words[w]]
                continue
            for n in language.GRAMS:
                known = [table[2 + grams[g]] for g in language.word_grams(w, n) if g in grams]
                if known:
                    total += np.mean(known, axis=0)
                    break
        lang, score = model.predict([text, None])
        p = np.exp(total - total.max())
        assert lang[0] == "abc"[int(total.argmax())] and math.isclose(score[0], p.max() / p.sum(), rel_tol=1e-9)


def _bins(text):
    """Distinct hashed n-grams of one text, by its own loop."""
    padded = toxicity._SEPARATOR + (text or "").lower() + toxicity._SEPARATOR
    out = set()
    for salt, n in zip(toxicity._SALTS.tolist(), toxicity.SIZES):
        for i in range(len(padded) - n + 1):
            h = sum(ord(c) * int(m) for c, m in zip(padded[i:i + n], toxicity._MULTIPLIERS)) % (1 << 32) ^ salt
            h = (h ^ (h >> 15)) * 2246822519 % (1 << 32)
            h = (h ^ (h >> 13)) * 3266489917 % (1 << 32)
            out.add(h >> (32 - toxicity.BITS))
    return out


def test_ngrams_of_a_batch_are_those_of_each_text():
    texts = ["You IDIOT, é\U0001F600!", None, "", "a", "ab", "İx", "plain words\nhere", "a"]
    row, bins = toxicity.distinct_bins(texts)
    for k, t in enumerate(texts):
        mine = set(bins[row == k].tolist())
        edge = _bins("")  # separators alone: may be counted with either neighbour
        assert _bins(t) - edge <= mine <= _bins(t) | edge


def test_toxicity_held_out_accuracy(spark):
    label = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF001}/labels.parquet").to_pylist()}
    text = {d["doc_id"]: d["text"].lower().split() for d in documents(SF001)}
    insults = set("pathetic moron disgusting worthless scum idiot clown loser trash stupid".split())
    rows = queries.op9_toxicity(spark, SF001).collect()
    assert len(rows) == len(text)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    rude = lambda r: sum(w.strip(".,!") in insults for w in text[r["doc_id"]]) > 1
    assert sum(r["predicted"] for r in held if not rude(r)) <= 0.02 * len(held)
    caught = [r["predicted"] for r in held if rude(r)]
    assert caught and sum(caught) >= 0.85 * len(caught)


def test_toxicity_edge_rows(spark):
    docs = [(i, f"you stupid {i} thing" if i % 2 else f"a kind {i} thing", "s") for i in range(80)]
    docs += [(100, None, "s"), (101, "", "s"), (102, "stupid " * 20_000, "s"), (None, "stupid", "s"), (3, docs[3][1], "s")]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(5, None), (None, 1), (4, 0), (6, 1), (6, 0), (100, 0)], "doc_id long, toxic int")
    rows = toxicity.score_documents(df, labels).collect()
    assert len(rows) == len(docs) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["predicted"] for r in rows}
    assert by[102] == 1 and by[7] == 1 and by[8] == 0 and by[101] == 0
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns and {r[0] for r in kept.collect()} >= {8, 100, 101} and 7 not in {r[0] for r in kept.collect()}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.score_documents(df, none).collect()} == {0}
    assert toxicity.drop_toxic(df.limit(0), labels).count() == 0
