"""Every stage against its operator or brute force on what the stage before kept; edge tables through all stages."""

import brute
import corpus_pipeline as p
import numpy as np
from brute import SF0001
from pyspark.sql import functions as F
from test_packing import _ids, _round_trip

from cellar.llm import decontamination, queries, toxicity


def _stage(name):
    return dict(p.STAGES)[name]


def test_stages_on_each_others_rows(spark):
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash", "substring", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns = docs.columns

    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, spark.read.parquet(f"{SF0001}/labels.parquet")).collect()}
    kept = _stage("toxicity")(spark, docs, SF0001).cache()
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {d for d, s in scores.items() if s < 0.7}

    rows = kept.collect()
    fps = [(r["doc_id"], brute.fingerprint(r["text"])) for r in rows]
    least = brute.component_ids(fps)
    one = _stage("simhash")(spark, kept, SF0001).cache()
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == {d for d, f in fps if least[f] == d}

    rows = sorted(one.collect())
    want = brute.repeats([r["text"] for r in rows])
    cut = _stage("substring")(spark, one, SF0001).cache()
    got = sorted(cut.collect())
    assert cut.columns == columns and [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    from hashlib import sha256

    for before, after, (_, removed, digest) in zip(rows, got, want):
        assert sha256(" ".join(brute.words(after["text"])).encode()).hexdigest() == digest
        assert after["text"] == before["text"] if not removed else after["n_chars"] == len(after["text"])

    leaking = {r["doc_id"] for r in decontamination.leaks(cut, spark.read.parquet(f"{SF0001}/benchmark.parquet")).collect()}
    clean = _stage("decontamination")(spark, cut, SF0001).cache()
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in got} - leaking

    rows = clean.collect()
    pieces = _stage("packing")(spark, clean, SF0001).collect()
    _round_trip(pieces, dict(zip([r["doc_id"] for r in rows], _ids([r["text"] for r in rows], 1))))
    assert p.ORACLE_SQL is None and {r["doc_id"] for r in p.run(spark, SF0001).collect()} == {r["doc_id"] for r in rows}


def test_edge_tables_pass_through_all_stages(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, score double, n_words int, spans string"
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, long), (5, long), (6, "you idiot"), (None, "no id"), (7, "same"), (7, "same"), (8, "x " * 400)]
    df = spark.createDataFrame([(d, t, None, None, None if t is None else len(t), "f", None, 1, "s") for d, t in rows], schema)
    for docs in (df, df.limit(0)):
        n = docs.count()
        for name, stage in p.STAGES[:-1]:
            docs = stage(spark, docs, SF0001)
            assert docs.columns == df.columns, name
            now = docs.count()
            assert now <= n and (now > 0) == (n > 0)
            n = now
        pieces = _stage("packing")(spark, docs, SF0001)
        tokens = pieces.agg(F.sum("length")).first()[0] or 0
        assert tokens == sum(len(x) for x in _ids([r["text"] for r in docs.collect()], 1))


def test_registered_query_names():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert np.all([k in names for k in entry.oracle_sql()])
