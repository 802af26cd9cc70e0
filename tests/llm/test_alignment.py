"""Token alignment against a plain version, one text at a time."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from brute import SF0001, documents
from pyspark.sql import functions as F

from cellar.llm import alignment
from cellar.llm.queries import op11_alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    return a, b, alignment.a_bytes(a), alignment.b_bytes(b)


def plain_alignment(rows, models) -> tuple[list[tuple], dict]:
    a, b, a_text, b_text = models
    per, held = [], Counter()
    for d, text in rows:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        want = (" " + text).encode() if text else b""
        if any(b"".join(t[i] for i in x) != want for x, t in zip(ids, (a_text, b_text))):
            ids = ([], [])
        spans = []
        for x, t in zip(ids, (a_text, b_text)):
            at, out = 0, []
            for i in x:
                out.append((at, at + len(t[i]), i))
                at += len(t[i])
            spans.append(out)
        links, j = [], 0
        for s, e, i in spans[0]:
            while j and spans[1][j][0] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((i, spans[1][k][2]))
                k += 1
            j = min(k, len(spans[1]) - 1)
        both = {e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}
        groups, left, right = [], [], []
        sides = [[], []]
        for side, out in zip(spans, sides):
            group = []
            for _, e, i in side:
                group.append(str(i))
                if e in both:
                    out.append(",".join(group))
                    group = []
        groups = [f"{x}|{y}" for x, y in zip(*sides)]
        held.update(set(links))
        per.append((d, len(spans[0]), len(spans[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = [(d, na, nb, g, len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), h) for d, na, nb, g, ls, h in per]
    return sorted(out, key=repr), dict(held)


def ours(df) -> list[tuple]:
    return sorted(map(tuple, df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_whole_table_equals_plain_version(spark, models):
    want, _ = plain_alignment([(r["doc_id"], r["text"]) for r in documents(SF0001)], models)
    assert ours(op11_alignment(spark, SF0001)) == want


def odd_rows() -> list[tuple]:
    rng = random.Random(9)
    parts = [" ", "  ", "\n", "\t", " ", "　", "▁", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "<unk>", "é", "é", "ﬁ", "½", "日本", "🙂", "\x00", "aaa", "aaaa",
             "the", "The", " the", "word", ".", ",", "1234", "\r\n", "ß", "Straße", "﻿", "don't", "'ll", "A", "qzx"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, " "), (1003, "\n"), (None, "no id at all"), (7, "the id recurs"), (1004, "a" * 30_000), (1005, "word " * 20_000),
                   (1006, "one"), (1006, "one")]


@pytest.mark.parametrize("chunk", [200, 8 << 20])
def test_odd_texts_chunks_and_pairs(spark, models, chunk):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("x")).withColumn("n_a", F.lit(1)).repartition(3)
    got, pairs = alignment.align(docs, A, B, chunk_bytes=chunk)
    want, held = plain_alignment(rows, models)
    assert ours(got) == want
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == held
    assert sum(r[1] == 0 for r in want) > 4 and sum(r[1] > 0 for r in want) > 150


def test_empty_table(spark):
    got, pairs = alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert ours(got) == [] and pairs.count() == 0
