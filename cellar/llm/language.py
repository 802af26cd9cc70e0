"""Language identification: known words first, then ever shorter character n-grams.

A text's letters (Unicode category L, with the marks that follow them) form words. A word of the vocabulary adds its log frequency in
each language; any other word adds the mean log frequency of its longest known
n-grams (five letters down to one; two or more with marks at the word's ends), and nothing
if it has none. The language with the highest total wins; the score is its
share among all languages (softmax of the totals).

Word and n-gram counts are Spark aggregates over a bounded sample of labelled
texts (about ``per_language`` each, by hash); the vocabulary and the n-gram
table are bounded by ``max_words`` and ``max_grams``, their columns by
``max_languages`` (the languages with the most labelled texts, ties by name):
the model's size. Scoring streams whole texts in Arrow batches.

Defined results: ``und`` with score 0 for a null text, a text without letters,
and for every text if no language was learned; ties go to the first language by
name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import slices, stage_table

GRAMS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
_CACHE = 300_000


def text_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$" if n > 1 else word
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray  # (words, languages)
    grams: dict[str, int]
    gram_scores: np.ndarray
    seen: dict = field(default_factory=dict, repr=False)

    def scores(self, words: list[str]) -> np.ndarray:
        """Log frequencies of each word by language; what was worked out before is kept up to a bound."""
        out = np.zeros((len(words), len(self.languages)))
        flat, rows, sizes = [], [], []
        for k, w in enumerate(words):
            if (i := self.words.get(w)) is not None:
                out[k] = self.word_scores[i]
            elif (s := self.seen.get(w)) is not None:
                out[k] = s
            else:
                for n in GRAMS:
                    found = [g for x in word_grams(w, n) if (g := self.grams.get(x)) is not None]
                    if found:
                        flat += found
                        rows.append(k)
                        sizes.append(len(found))
                        break
        if rows:
            edge = np.cumsum([0, *sizes[:-1]])
            out[rows] = np.add.reduceat(self.gram_scores[flat], edge) / np.array(sizes)[:, None]
            if len(self.seen) > _CACHE:
                self.seen.clear()
            for k in rows:
                if len(words[k]) < 24:
                    self.seen[words[k]] = out[k]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        words = [text_words(t) for t in texts]
        n = np.array([len(w) for w in words])
        if not self.languages or not n.sum():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        codes = pa.array([x for w in words for x in w], pa.string()).dictionary_encode()
        each = self.scores(codes.dictionary.to_pylist())
        at, owner = codes.indices.to_numpy(), np.repeat(np.arange(len(texts)), n)
        total = np.stack([np.bincount(owner, each[at, j], len(texts)) for j in range(len(self.languages))], axis=1)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else UNKNOWN for b, k in zip(best, n)], np.where(n > 0, share, 0.0)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", 1 << 21):
        counts = Counter((lang, w) for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist())
                         for w in text_words(t))
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "word", "n"])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 20_000):
            part = b.slice(at, 20_000)
            counts: Counter = Counter()
            for lang, w, n in zip(*(part.column(c).to_pylist() for c in ("lang", "word", "n"))):
                for size in GRAMS:
                    for g in word_grams(w, size):
                        counts[lang, g] += n
            keys = list(counts)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                              pa.array([counts[k] for k in keys], pa.int64())], names=["lang", "word", "n"])


def learn(docs: DataFrame, per_language: int = 1_500, max_words: int = 100_000, max_grams: int = 100_000,
          least: int = 3, max_languages: int = 200) -> Model:
    """A model from ``docs`` (doc_id, text, lang); the caller leaves out held-out rows."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    total = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    pick = F.lit(0.0)
    for lang, n in total.items():
        pick = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(pick)
    sample = labelled.filter(part < pick).select("lang", "text")
    words = stage_table(sample.mapInArrow(_count_words, "lang string, word string, n long")
                        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "lang-words")
    grams = words.repartition(16).mapInArrow(_count_grams, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    languages = sorted(total)
    return Model(languages, *_frequencies(words, languages, max_words, least, False),
                 *_frequencies(grams, languages, max_grams, least, True))


def _frequencies(counts: DataFrame, languages: list[str], most: int, least: int, by_size: bool) -> tuple[dict, np.ndarray]:
    """The ``most`` most frequent words or n-grams, and their smoothed log frequency in each language."""
    kept = (counts.groupBy("word").agg(F.sum("n").alias("all"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
            .filter(F.col("all") >= least).orderBy(F.desc("all"), "word").limit(most).collect())  # the model's size
    index = {r["word"]: i for i, r in enumerate(kept)}
    table = np.array([[r["by"].get(x, 0) for x in languages] for r in kept], float).reshape(len(kept), len(languages)) + 0.5
    size = np.array([len(r["word"]) if by_size else 0 for r in kept], int)
    for s in set(size.tolist()):
        table[size == s] /= table[size == s].sum(axis=0)
    return index, np.log(table)


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_words, max_grams and max_languages
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            lang, score = sent.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; held-out rows (by doc_id) take no part in learning."""
    model = learn(docs.filter(~held_out(F.col("doc_id"))), **options)
    out = with_language(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
