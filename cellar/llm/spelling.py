"""Spelling variants: words one code point apart, found through pairs of trie nodes.

A word's prefixes are nodes of the forward trie, its suffixes nodes of the
reversed one. A node's number is a 64-bit fold of its path, so that every task
numbers a node alike and no dictionary of nodes has to be gathered. A word of
length L files itself under the pairs of integers

- (prefix of i code points, suffix from i + 1): position i is skipped;
- (prefix of i code points, suffix from i): a code point may be inserted at i.

Two words meet under a skipped position of both exactly if they differ in that
one code point, and under a skipped position of the longer and an inserted one
of the shorter exactly if the longer has one code point more. A skipped
position is shared by at most one word for each letter of the alphabet (90) and
an inserted one by one word, so no key is ever hot, and rows are linear in
the length of the words. Numbers of different nodes may be equal by chance; the
words themselves are compared at the end, so that such a meeting is dropped.

Defined results: null and empty texts have no runs; a null doc_id hashes as
empty text; repeated rows count each time; an empty table gives no rows; of
tied forms the smallest in code-point order is taken; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import mix64, stage_table, text_bytes
from cellar.runtime import delete_path, write_stage

#: Letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
#: Every run whose check sum this divides loses one code point.
TYPO_EVERY = 31
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 18  # code points that are numbered at once


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 7, least_count: int = 2) -> DataFrame:
    """word, n: the runs of all texts, lower-cased, some with a typo, that are long and frequent enough.

    A word has at least as many code points in its run, so shorter runs are not taken up at all.
    """
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode(
        F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.encode(F.concat("d", F.lit(":"), "run"), "UTF-8"))
    runs = runs.select("run", h.alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % TYPO_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


# ---- trie nodes ------------------------------------------------------------------


def node_pairs(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of all words: (prefix node, suffix node, word number, position, whether a code point is inserted there).

    ``codes``: code points of all words one after the other; word k has ``codes[first[k]:first[k + 1]]``.
    """
    size = np.diff(first)
    n, total = len(size), len(codes)
    word = np.repeat(np.arange(n), size)
    at = np.arange(total) - np.repeat(first[:-1], size)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(int(size.max(initial=0)), 1), _BASE)]))
    letter = mix64(codes.astype(np.uint64) + np.uint64(1))
    ahead = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter * power[at])])
    back = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter * power[np.repeat(size, size) - 1 - at])])
    # nodes at the n + total places between code points, ends of words included
    place = np.repeat(first[:-1], size + 1) + (np.arange(total + n) - np.repeat(first[:-1] + np.arange(n), size + 1))
    owner = np.repeat(np.arange(n), size + 1)
    prefix = mix64(ahead[place] - ahead[first[:-1]][owner])
    suffix = mix64(back[first[1:]][owner] - back[place])
    skipped = np.arange(total) + word  # the place before each code point
    return (np.concatenate([prefix[skipped], prefix]), np.concatenate([suffix[skipped + 1], suffix]), np.concatenate([word, owner]),
            np.concatenate([at, place - first[:-1][owner]]), np.concatenate([np.zeros(total, bool), np.ones(total + n, bool)]))


def _file_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").cast(pa.large_string())
        ids = batch.column("wid").to_numpy(zero_copy_only=False)
        buf, edges = text_bytes(words)
        # a code point begins at every byte that does not continue one
        begins = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[edges]
        codes = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), "<u4")
        at = 0
        while at < len(ids):
            to = min(max(int(np.searchsorted(begins, begins[at] + _BLOCK, "right")) - 1, at + 1), len(ids))
            first = begins[at:to + 1] - begins[at]
            p, s, word, place, inserted = node_pairs(codes[begins[at]:begins[to]], first)
            for i in range(0, len(p), _BLOCK):
                cut = slice(i, i + _BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p[cut].view(np.int64)), pa.array(s[cut].view(np.int64)), pa.array(ids[at:to][word[cut]]),
                     pa.array(place[cut].astype(np.int32)), pa.array(inserted[cut])],
                    names=["prefix", "suffix", "wid", "at", "inserted"])
            at = to


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs of ``words`` (wid, word, n) that differ by one code point, once each: a, b (wids), their words and counts."""
    filed = words.select("wid", "word").mapInArrow(_file_words, "prefix long, suffix long, wid long, at int, inserted boolean")
    one = filed.filter(~F.col("inserted")).select("prefix", "suffix", F.col("wid").alias("a"), "at")
    other = filed.select("prefix", "suffix", F.col("wid").alias("b"), "inserted")
    met = one.join(other, ["prefix", "suffix"]).filter(F.col("inserted") | (F.col("a") < F.col("b")))
    met = met.groupBy("a", "b").agg(F.min(F.struct("at", "inserted")).alias("x")).select("a", "b", "x.at", "x.inserted")
    left = words.select(F.col("wid").alias("a"), F.col("word").alias("a_word"), F.col("n").alias("a_n"))
    right = words.select(F.col("wid").alias("b"), F.col("word").alias("b_word"), F.col("n").alias("b_n"))
    rest = F.when(F.col("inserted"), F.col("at") + 1).otherwise(F.col("at") + 2)  # of the second word, after the edit
    size = F.length("a_word")
    same = ((F.col("a_word").substr(F.lit(1), F.col("at")) == F.col("b_word").substr(F.lit(1), F.col("at")))
            & (F.col("a_word").substr(F.col("at") + 2, size) == F.col("b_word").substr(rest, size)))
    return met.join(left, "a").join(right, "b").filter(same).drop("at", "inserted")


# ---- forms and roots -------------------------------------------------------------


def roots(forms: DataFrame) -> tuple[DataFrame, str]:
    """(wid, root) for every row of ``forms`` (wid, to): the last word of its chain; and the table's path.

    A form is at least ten times as frequent as its word, so that chains are short; each round doubles the steps.
    """
    spark = forms.sparkSession
    now, path = write_stage(forms.select("wid", F.col("to").alias("root")), "llm-roots")
    while True:
        step = now.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        after, new = write_stage(now.join(step, "root", "left").select(
            "wid", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "llm-roots")
        delete_path(spark, path)
        now, path = after.select("wid", "root"), new
        if after.filter("moved").isEmpty():
            return now, path


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 7, least_count: int = 2,
             times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    The form is the near word of largest n, if that is at least ``times`` the word's own n, else null; the root is
    where following forms ends (the word itself without a form).
    """
    counted = word_counts(docs, doc_id, text, least_length, least_count)
    words = stage_table(counted.withColumn("wid", F.monotonically_increasing_id()), "words")
    pairs = near_pairs(words)
    other = F.struct((-F.col("n2")).alias("m"), F.col("w2").alias("word"), F.col("to"))
    ways = [pairs.select(F.col(x).alias("wid"), F.col(f"{x}_n").alias("n1"), F.col(y).alias("to"), F.col(f"{y}_word").alias("w2"),
                         F.col(f"{y}_n").alias("n2")) for x, y in (("a", "b"), ("b", "a"))]
    near = ways[0].unionByName(ways[1]).groupBy("wid").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.when(F.col("n2") >= times * F.col("n1"), other)).alias("f"))
    near = stage_table(near.select("wid", "n_near", F.col("f.to").alias("to"), F.col("f.word").alias("form"), (-F.col("f.m")).alias("form_n")), "near-words")
    last, _ = roots(near.filter(F.col("to").isNotNull()))
    named = last.join(words.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root").select("wid", "root_word")
    out = words.join(near, "wid", "left").join(named, "wid", "left")
    return out.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.col("form_n").cast("long").alias("form_n"))
