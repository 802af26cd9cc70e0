import pyarrow as pa
from brute import SF0001

from cellar.llm import decontamination as d
from cellar.llm import queries

ITEM = "A train leaves Paris at 9 hours and travels 120 km to Lyon before 120 workers arrive at the old station of the town."
DOCS = "doc_id long, text string, item_id string, leaks int"


def _kinds(text):
    t = d.templates(pa.array([text]))
    return t.kind.tolist()


def test_template_tokens():
    assert _kinds("We saw Anna at 5 km, (12%) and $3.50 . \nThen Bob left!") == [0, 0, 3, 0, 1, 2, 1, 0, 1, 0, 3, 0]
    a, b = (d.templates(pa.array([x])).code.tolist() for x in ("In May Anna had 5 kg.", "in may Berta had 77 lb"))
    assert a[2:] == b[2:] or a[0] == b[0]


def _texts():
    other = ITEM.replace("Paris", "Rome").replace("Lyon", "Turin").replace("120", "75").replace("9 hours", "7 hours")
    mixed = ITEM.replace("travels 120", "travels 75")  # one item value, two document values
    return [ITEM, f"Some words first. {other} And more after it.", mixed, None, "", "nothing of it here", f"{ITEM} {other}",
            "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20", f"x {ITEM.lower()}", "long " * 30_000 + ITEM]


def test_exact_and_reparameterised_leaks(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(_texts())] + [(0, ITEM, "clash", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    bench = spark.createDataFrame([(7, ITEM), (9, ITEM), (8, None), (10, ""), (11, "short"), (12, "five plain words in all")], "item_id long, text string")
    got = [tuple(r) for r in d.leaks(docs, bench).select("doc_id", "item_id", "kind").collect()]
    found = {(a, k) for a, i, k in got if i == 7}
    assert {i for _, i, _ in got} == {7} and len([g for g in got if g[0] == 0]) == 2
    assert {(0, "exact"), (1, "reparameterised"), (6, "exact"), (9, "exact")} <= found
    covered = {r["doc_id"]: r["coverage"] for r in d.leaks(docs, bench, share=0.9, tokens=1000).collect()}
    assert covered[1] == 1 and covered[2] < 1  # the inconsistent slot's windows do not count
    strict = {r["doc_id"] for r in d.leaks(docs, bench, share=0.99, tokens=1000).collect()}
    assert 2 not in strict and {0, 1, 6, 9} <= strict
    kept = d.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r[0] for r in kept.collect()} >= {3, 4, 5, 7}
    assert not {0, 1, 6, 9} & {r[0] for r in kept.collect()}


def test_blocks_give_the_same_rows(spark):
    docs, bench = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(tuple(r) for r in d.leaks(docs, bench).collect())
    assert whole and whole == sorted(tuple(r) for r in d.leaks(docs, bench, block_bytes=1500).collect())


def test_query_finds_every_document_with_a_whole_item(spark):
    docs, bench = (spark.read.parquet(f"{SF0001}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in queries.op10_decontamination(spark, SF0001).collect()}
    holds = {(x["doc_id"], b["item_id"]) for x in docs for b in bench if b["text"].strip() in x["text"]}
    assert holds <= got

    def words(t):
        return [w.strip(".,!?").lower() for w in t.split()]

    # nothing without at least one window of eight words in common
    for doc_id, item in got:
        a, b = (words(next(r["text"] for r in rows if r[0] == k)) for rows, k in ((docs, doc_id), (bench, item)))
        assert {tuple(a[i:i + 8]) for i in range(len(a) - 7)} & {tuple(b[i:i + 8]) for i in range(len(b) - 7)}


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert d.leaks(docs, bench).count() == 0 and d.leaks(one, bench).count() == 0 and d.drop_leaks(one, bench).count() == 1
    assert d.leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).count() == 0


def _found(spark, items, texts, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = {(r["doc_id"], r["item_id"]): (r["kind"], r["n_covered"], r["n_item"]) for r in d.leaks(docs, bench, **options).collect()}
    kept = {r["doc_id"] for r in d.drop_leaks(docs, bench, **options).collect()}
    assert kept == set(range(len(texts))) - {doc for doc, _ in rows}
    return rows


def test_slot_values_of_other_lengths_and_words_put_in(spark):
    item = "the old train to Paris leaves the big station at noon and the guests of Lyon walk to the inn near the river"
    longer = item.replace("Paris", "New York").replace("Lyon", "Rio De Janeiro")
    words = item.split()
    put_in = " ".join(w for i in range(0, len(words), 9) for w in [*words[i:i + 9], "really"])
    clash = item.replace("Lyon", "Paris").replace("the old train to Paris", "the old train to New York")
    got = _found(spark, [item, longer, item.replace("Lyon", "Paris")],
                 [longer, f"x x. {item}", put_in, clash, "New York and Rio De Janeiro are far from the old station of the town"])
    assert got[0, 0] == ("reparameterised", 23, 23) and got[0, 1] == ("exact", 26, 26)
    assert got[1, 0] == ("exact", 23, 23) and got[1, 1] == ("reparameterised", 26, 26)
    assert got[2, 0][1] >= 16 and got[2, 0][0] == "exact"
    assert got[3, 2][1] < 23  # Paris would stand for New York and for Paris
    assert not [k for k in got if k[0] == 4]
    # three pieces of eight words, each below both limits
    parts = ["red " * 2 + f"{a} ways we go on in the cold" for a in ("one", "two", "six")]
    split = " ".join(parts) + " " + " ".join(f"w{i}" for i in range(40))
    broken = "now ".join(p + " " for p in parts)
    assert _found(spark, [split], [broken])[0, 0][1] >= 16 and not _found(spark, [split], [parts[1]])


def test_exact_copies_of_items_without_plain_words(spark):
    sums = "12 + 7 = 19, 30 + 4 = 34, 8 + 9 = 17, 5 + 6 = 11"
    people = "Anna Berg 1901 Paris, Boris Kahn 1912 Rome, Clara Lund 1923 Oslo, David Moor 1934 Bern"
    table = "5 km 7 km 9 km 12 km 15 kg 18 kg 21 kg 24 kg"
    texts = [f"The sums are {x} and no more." for x in (sums, people, table)]
    got = _found(spark, [sums, people, table], [*texts, table.replace("km", "mi").replace("kg", "lb")])
    assert set(got) == {(0, 0), (1, 1), (2, 2)} and {k for k, *_ in got.values()} == {"exact"}
    assert all(covered == size for _, covered, size in got.values())


def test_short_mid_line_lower_cased_and_unpunctuated_copies(spark):
    items = ["What is the capital of France?", "Who wrote Hamlet?", "Anna Berg met Boris in Rome. Then Clara Lund left for Oslo! Bern was next."]
    texts = [f"Q: {items[0]} A: Paris", f"He asked, {items[0].lower()} Nobody knew", "so what is the capital of france then", f"Quiz - {items[1]}",
             f"x {items[2].lower()}", "Notes: " + items[2].replace(".", "").replace("!", ""), items[2].upper(), "What is the capital of it? Who wrote?"]
    got = _found(spark, items, texts)
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 2), (6, 2)}
    assert all(kind == "exact" and covered == size for kind, covered, size in got.values())
    docs = spark.createDataFrame(list(enumerate(_texts())), "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert 8 in {r["doc_id"] for r in d.leaks(docs, bench, share=1.0, tokens=1000).collect()}
