import brute
import pytest
from brute import SF0001
from pyspark.sql import functions as F

from cellar.llm import quality_rules as q
from cellar.llm import queries

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r for r in queries.op1_quality_rules(spark, SF0001).collect()}
    docs = brute.documents(SF0001)
    assert len(rows) == len(docs)
    for d in docs:
        want = brute.statistics(d["text"])
        r = rows[d["doc_id"]]
        assert tuple(r[n] for n in NAMES) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] is None)


EDGES = [None, "", " \n\t\x0b\x0c\r", "a", "a b", "a b c", "a b c a b c", "x " * 5000, "a\nb\n\n \na\na\n", "é|ü #\U0001F600 <>",
         "a b c d a b c", "l1 m n\nl1 m n\nzz", "a\u00a0b\x1cc d"]


def test_edge_texts(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(EDGES)], "doc_id long, text string, n_words int, `__w` string")
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in q.text_statistics(df, ["doc_id"]).collect()}
    assert got == {i: brute.statistics(t) for i, t in enumerate(EDGES)}


def test_learns_a_planted_conjunction_and_orders_rules(spark):
    rows = spark.range(6000).select("id", (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"))
    bad = ((F.col("a") > 70) & (F.col("b") <= 30)) | (F.col("a") <= 5)
    rules = q.learn_rules(rows.withColumn("y", bad.cast("int")), ["a", "b"], "y", "id")
    number = q.rules_column(rules, {"a": F.col("a"), "b": F.col("b")})
    wrong = rows.filter(number.isNotNull() != bad).count()
    assert wrong < 300 and 2 <= len(rules) <= 8
    assert [str(r) for r in rules] == [str(r) for r in q.learn_rules(rows.withColumn("y", bad.cast("int")), ["a", "b"], "y", "id")]


@pytest.mark.parametrize("labels", ["", "1,1", "1,null;null,0"])
def test_without_usable_labels_nothing_is_rejected(spark, labels):
    rows = [tuple(None if x == "null" else int(x) for x in r.split(",")) for r in labels.split(";") if r]
    marks = spark.createDataFrame(rows, "doc_id long, quality int")
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: (r["base_failed"], r["kept"], r["rule"]) for r in q.judge(docs, marks).collect()}
    assert out == {1: (False, True, None), 2: (True, False, None)}


def test_empty_table(spark):
    assert q.judge(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")).count() == 0
