"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct hashed n-grams of the lower-cased whole text. A
feature's scale is the log ratio of its document shares among toxic and clean
training texts; logistic regression on the scaled features gives the score.

Training uses a bounded sample: about ``per_class`` labelled texts of each class,
chosen by hash and weighted back to the class sizes. The n-gram counts are a
Spark aggregate; only the ``features`` best n-grams and the sample's feature
numbers reach the driver, where the regression is fitted. Scoring streams whole
texts in Arrow batches.

Defined results: a null or empty text has no n-grams and is scored by the
intercept; a document labelled both ways trains as both; a null doc_id or label
takes no part; without labels of both classes every score is 1 (all of them
toxic) or 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import free_name, slices, stage_table

SIZES = (3, 4, 5)
BITS = 20
_SEPARATOR = "\x01" * (max(SIZES) - 1)
_rng = np.random.default_rng(20)
_MULTIPLIERS = (_rng.integers(1, 1 << 31, max(SIZES)) * 2 + 1).astype(np.uint32)
_SALTS = _rng.integers(1, 1 << 31, len(SIZES)).astype(np.uint32)


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # float32, one for each of 2 ** BITS hashed n-grams


def ngram_bins(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each n-gram size the hashed n-gram at every position of the joined texts, and the texts' starts.

    Separators as long as the longest n-gram less one keep texts apart.
    """
    low = [(t or "").lower() for t in texts]
    # an n-gram that begins in the separators belongs to the text after them
    starts = np.cumsum([0, *(len(t) + len(_SEPARATOR) for t in low)])
    joined = _SEPARATOR + "".join(t + _SEPARATOR for t in low)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    total, out, size = np.zeros(len(codes), np.uint32), [], 0
    for salt, n in zip(_SALTS, SIZES):
        while size < n:
            total[:len(codes) - size] += codes[size:] * _MULTIPLIERS[size]
            size += 1
        h = total[:max(len(codes) - n + 1, 0)] ^ salt
        h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(3266489917)
        out.append((h >> np.uint32(32 - BITS)).astype(np.int64))
    return out, starts


def distinct_bins(texts: list[str | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bin) of the distinct n-grams of each text, only ``wanted`` bins (bool by bin) if given."""
    bins, starts = ngram_bins(texts)
    keys = []
    for b in bins:
        at = np.arange(len(b)) if wanted is None else np.flatnonzero(wanted[b])
        owner = np.searchsorted(starts, at, "right") - 1
        keys.append((np.minimum(owner, len(texts) - 1) << BITS) | b[at])
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return keys >> BITS, keys & ((1 << BITS) - 1)


def _count_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for b in slices(batches, "text", 1 << 20):
        row, bins = distinct_bins(b.column("text").to_pylist())
        label = b.column("y").to_numpy(zero_copy_only=False)[row]
        for y in (0, 1):
            counts[y] += np.bincount(bins[label == y], minlength=1 << BITS)
    seen = np.flatnonzero(counts.sum(axis=0))
    for at in range(0, len(seen), 1 << 16):
        part = seen[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[0][part]), pa.array(counts[1][part])],
                                         names=["bin", "clean", "toxic"])


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """text, y, weight: about ``per_class`` labelled texts of each class, by hash of doc_id."""
    labels = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    total = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: min(1.0, per_class / n) for y, n in total.items()}
    part = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    pick = F.when(F.col("y") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    weight = F.when(F.col("y") == 1, F.lit(1 / share.get(1, 1.0))).otherwise(F.lit(1 / share.get(0, 1.0)))
    chosen = labels.filter(part < pick).withColumn("weight", weight)  # about 2 * per_class rows: may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return stage_table(rows.dropDuplicates(["doc_id", "y", "text"]).select("text", "y", "weight"), "toxic-sample")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 8_000, features: int = 1 << 13, smooth: float = 1.0,
        penalty: float = 1e-4, steps: int = 200, least_texts: int = 5) -> Model:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); the caller leaves out held-out rows."""
    sample = training_sample(docs, labels, per_class)
    n = {r["y"]: (r["n"], r["w"]) for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w")).collect()}
    zero = np.zeros(1 << BITS, np.float32)
    if set(n) != {0, 1}:
        return Model(20.0 if 1 in n else -20.0, zero)
    counts = (sample.select("text", "y").repartition(16).mapInArrow(_count_bins, "bin long, clean long, toxic long")
              .groupBy("bin").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
              .filter(F.col("clean") + F.col("toxic") >= least_texts))
    share = lambda c, y: (F.col(c) + smooth) / (n[y][0] + 2 * smooth)
    counts = counts.withColumn("r", F.log(share("toxic", 1) / share("clean", 0)))
    gain = F.abs("r") * F.sqrt(F.greatest(F.col("clean") / n[0][0], F.col("toxic") / n[1][0]))
    best = counts.orderBy(gain.desc(), "bin").limit(features).select("bin", "r").collect()  # the model's size
    ratio = zero.copy()
    ratio[[r["bin"] for r in best]] = [r["r"] for r in best]
    wanted = ratio != 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            row, bins = distinct_bins(b.column("text").to_pylist(), wanted)
            edge = np.searchsorted(row, np.arange(b.num_rows + 1))
            x = [bins[i:j].astype("<i4").tobytes() for i, j in zip(edge, edge[1:])]
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("weight"), pa.array(x, pa.binary())], names=["y", "w", "x"])

    got = sample.repartition(16).mapInArrow(encode, "y int, w double, x binary").collect()  # the bounded sample
    got.sort(key=lambda r: (r["y"], r["w"], bytes(r["x"])))
    bias, w = _regress([np.frombuffer(r["x"], "<i4") for r in got], np.array([r["y"] for r in got], float),
                       np.array([r["w"] for r in got]), ratio, penalty, steps)
    return Model(bias, w)


def _regress(x: list[np.ndarray], y: np.ndarray, weight: np.ndarray, ratio: np.ndarray, penalty: float,
             steps: int) -> tuple[float, np.ndarray]:
    """Logistic regression on ratio-scaled presence, by accelerated gradient steps (Adam)."""
    used, cols = np.unique(np.concatenate(x), return_inverse=True)
    rows = np.repeat(np.arange(len(x)), [len(v) for v in x])
    scale, n = ratio[used].astype(float), len(used)
    weight = weight / weight.sum()
    rate = float(np.clip((weight * y).sum(), 1e-6, 1 - 1e-6))
    p = np.concatenate([np.zeros(n), [np.log(rate / (1 - rate))]])
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, (p[:n] * scale)[cols], len(x)) + p[n]
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.concatenate([np.bincount(cols, e[rows], n) * scale + penalty * p[:n], [e.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    out = np.zeros(len(ratio), np.float32)
    out[used] = p[:n] * scale
    return float(p[n]), out


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    row, bins = distinct_bins(texts, model.weights != 0)
    z = np.bincount(row, model.weights[bins], len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` plus the score (0 to 1) of every whole text."""
    keep = [c for c in docs.columns if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS floats, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            s = pa.array(scores(b.column(text).to_pylist(), sent.value))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], s], names=[*keep, name])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted; held-out rows (by doc_id) take no part in training."""
    model = fit(docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))), **options)
    out = with_score(docs.select("doc_id", "text"), model, keep_text=False)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, unchanged."""
    score = free_name(docs, "toxicity")
    model = fit(docs.filter(~held_out(F.col("doc_id"))), labels.filter(~held_out(F.col("doc_id"))), **options)
    return with_score(docs, model, name=score).filter(F.col(score) < threshold).drop(score)
