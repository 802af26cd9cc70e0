import random
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import pytest
from brute import SF0001
from tokenizers import AddedToken, Tokenizer

from cellar.llm import packing, queries, token_output
from cellar.llm.tokens import Encoder

TEXTS = [None, "", " ", "  two  spaces \n\n and\tlines  ", "It's we'll 12,000 ünï — 日本語 \u00a0x \u3000 y", "<|endoftext|> a", "word " * 3000,
         "x" * 9000, "\x1c a \x1d b", "tail \n", "a   b    c"]


def _ids(texts, end):
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.encode_special_tokens = True
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def test_encoder_equals_the_tokenizer():
    texts = TEXTS + [d["text"] for d in brute.documents(SF0001)]
    flat, edge = Encoder(queries.tokenizer_path()).encode(texts, 7)
    assert [flat[i:j].tolist() for i, j in zip(edge, edge[1:])] == _ids(texts, 7)


SPECIAL = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b c", " <|endoftext|><|endoftext|> ", "one  <|endoftext|>  two <|endoftext",
           "<|endoftext|>\nline <|endoftext|>'s", "|> x <|endo", "text|> y", None]


def _plain(texts, end, tokenizer=None):
    t = tokenizer or Tokenizer.from_file(queries.tokenizer_path())
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


def test_special_strings_as_the_plain_call(spark, tmp_path):
    texts = SPECIAL + TEXTS + [f"{d['text']} <|endoftext|> {d['text']}" for d in brute.documents(SF0001)[:20]]
    flat, edge = Encoder(queries.tokenizer_path(), encode_special_tokens=False).encode(texts, 7)
    assert [flat[i:j].tolist() for i, j in zip(edge, edge[1:])] == _plain(texts, 7)
    # added tokens that reach over spaces
    t = Tokenizer.from_file(queries.tokenizer_path())
    t.add_tokens([AddedToken("<x>", rstrip=True, lstrip=True), AddedToken("two words"), AddedToken("solo", single_word=True)])
    t.save(path := str(tmp_path / "t.json"))
    texts = ["a <x> b c", "some two words here", "solo solos so solo", "we are two", "words of", *SPECIAL]
    flat, edge = Encoder(path, encode_special_tokens=False).encode(texts, 7)
    assert [flat[i:j].tolist() for i, j in zip(edge, edge[1:])] == _plain(texts, 7, t)


def test_query_and_pipeline_give_special_ids(spark, tmp_path):
    rows = list(enumerate(SPECIAL))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    want = dict(enumerate(_plain(SPECIAL, 1)))
    _round_trip(queries.op3_packing(spark, str(tmp_path)).collect(), want)
    _round_trip(corpus_pipeline.pack(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "").collect(), want)


def test_query_round_trip(spark):
    docs = brute.documents(SF0001)
    want = dict(zip([d["doc_id"] for d in docs], _ids([d["text"] for d in docs], 1)))
    _round_trip(queries.op3_packing(spark, SF0001).collect(), want)


def _round_trip(rows, want):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for d, ids in want.items():
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at:at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for s in by_sequence.values():
        s.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in s)
        assert [r["offset"] for r in s] == np.cumsum([0, *(r["length"] for r in s)])[:-1].tolist() and total <= 2048
        padding += 0 if total & (total - 1) == 0 else 2048 - total
        assert len({(r["tier"], r["step_group"]) for r in s}) == 1
    assert padding == 0
    loads = defaultdict(int)
    for r in rows:
        loads[r["step_group"]] += r["length"]
    return loads


def test_edge_texts_and_repeated_rows(spark):
    texts = TEXTS * 2
    df = spark.createDataFrame([(i, t, 5, "z") for i, t in enumerate(texts)], "doc_id long, text string, start int, ids string").coalesce(1)
    got = queries.piece_digests(packing.pack(df, queries.tokenizer_path(), buffer_tokens=3000)).collect()
    _round_trip(got, dict(enumerate(_ids(texts, 1))))
    same = spark.createDataFrame([(None, "a b")] * 3, "doc_id long, text string").coalesce(1)
    assert packing.pack(same, queries.tokenizer_path()).count() >= 3


def test_windows_are_full_and_step_groups_even():
    rng = random.Random(4)
    pieces = [(rng.choice([1, 7, 100, 900, 2048, 5000]) + rng.randint(0, 90), i, 0) for i in range(800)]
    windows, left = packing.fill_tiers(pieces)
    assert all(sum(p[0] for p in w) in packing.TIERS for w in windows)
    assert sum(p[0] for p in left) < 2048
    seen = defaultdict(int)
    for n, doc, _ in [p for w in windows + packing.cut_to_tiers(left) for p in w]:
        seen[doc] += n
    assert seen == {doc: n for n, doc, _ in pieces}
    sizes = [sum(p[0] for p in w) for w in windows]
    load = defaultdict(int)
    for g, n in zip(packing.step_groups(sizes, 1 << 14), sizes):
        load[g] += n
    assert max(load.values()) - min(load.values()) <= 2048


@pytest.mark.parametrize("f", [packing.pack, token_output.pack_rows])
def test_empty_table(spark, f):
    assert f(spark.createDataFrame([], "doc_id long, text string"), queries.tokenizer_path()).count() == 0


def _unpack(rows, capacity):
    docs = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == capacity and r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert r["position_resets"] == (r["cu_seqlens"] if r["n_tokens"] < capacity else r["cu_seqlens"][:-1])
        assert (ids[r["n_tokens"]:] == 50256).all()
        for d, at, i, j in zip(r["doc_ids"], r["doc_starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert at not in docs[d]
            docs[d][at] = ids[i:j].tolist()
    return {d: [x for _, p in sorted(parts.items()) for x in p] for d, parts in docs.items()}


def test_rows_round_trip(spark, tmp_path):
    docs = brute.documents(SF0001)
    token_output.write_matrices(queries.op2_token_output(spark, SF0001), str(tmp_path / "m"))
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    assert _unpack(rows, 2048) == dict(zip([d["doc_id"] for d in docs], _ids([d["text"] for d in docs], 50256)))
    assert sum(r["n_tokens"] for r in rows) > 0.95 * 2048 * len(rows)
    df = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string").coalesce(1)
    small = token_output.pack_rows(df, queries.tokenizer_path(), capacity=64, buffer_tokens=500).collect()
    assert _unpack(small, 64) == dict(enumerate(_ids(TEXTS * 2, 50256)))


def test_segment_tree_finds_the_best_fit():
    rng = random.Random(1)
    tree, rooms = token_output.RoomTree(100), []
    for _ in range(500):
        if rooms and rng.random() < 0.4:
            r = rooms.pop(rng.randrange(len(rooms)))
            tree.add(r, -1)
        else:
            rooms.append(rng.randint(0, 100))
            tree.add(rooms[-1], 1)
        n = rng.randint(0, 100)
        assert tree.least(n) == min((r for r in rooms if r >= n), default=None)
    pieces = [(rng.randint(1, 250), i, 0) for i in range(300)]
    rows = token_output.best_fit_decreasing(pieces, 100)
    assert all(sum(p[0] for p in r) <= 100 for r in rows) and sum(p[0] for r in rows for p in r) == sum(p[0] for p in pieces)


def test_pieces_known_from_older_texts_keep_their_ids(monkeypatch):
    """Generations of known pieces age and come back; the ids stay those of a fresh encoder."""
    from cellar.llm import tokens

    monkeypatch.setattr(tokens, "_KEPT", 40)
    path = queries.tokenizer_path()
    kept = Encoder(path, encode_special_tokens=False)
    for round_ in range(30):
        texts = [" ".join(f"word{(7 * round_ + k * k) % 90} <|endoftext|>x{k % 5}" for k in range(25)), None, "", " a  b "]
        got, fresh = kept.encode(texts, 7), Encoder(path, encode_special_tokens=False).encode(texts, 7)
        assert got[0].tolist() == fresh[0].tolist() and got[1].tolist() == fresh[1].tolist()
