"""Near duplicates by SimHash, found with Golay-code fuzzy keys.

A 64-bit fingerprint has three segments: bits 0-22, 23-45 and 46-63 (the last
filled up with zeros to 23 bits). The perfect binary Golay code maps each
23-bit word to the one codeword within three bits. A word's keys are the
12-bit indices of the codewords of all words within one bit of it, one to six
of them. Two words at most two bits apart have a word between them that is
within one bit of both, so they share a key.

Two fingerprints that link differ in at most two bits, so one of the three
segments is equal in both (pigeonhole) and the next one differs in at most two:
they meet under (segment number, equal segment, Golay index of the next one).

Buckets of up to ``BUCKET`` distinct fingerprints are joined pair by pair and
verified by bit count. Fingerprints of fuller buckets go another exact way: each
is filed under itself and its 64 one-bit neighbours; all that meet under one
such centre are within two bits of each other and link to the least of them,
so their number of rows is linear. Components come from alternating star
steps on written edge tables; nothing is collected.

Defined results: a null or wordless text has fingerprint zero and links like
any other; repeated rows share a fingerprint; a component of rows that all lack
a doc_id has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import free_name, salted_join, slices, stage_table, text_bytes, word_spans, xxh64_spans
from cellar.runtime import delete_path, write_stage

#: Largest number of distinct fingerprints that are compared pair by pair under one key.
BUCKET = 40
#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GENERATOR = 0b101011100011
LENGTH, CHECK = 23, 11
SEGMENTS = ((0, 23), (23, 23), (46, 18))


# ---- fingerprints ----------------------------------------------------------------


def simhash(hashes: np.ndarray) -> int:
    """Bit k is 1 if it is set in over half the hashes."""
    if len(hashes) == 0:
        return 0
    lanes = hashes.view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
    if len(hashes) < 200:
        ones = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(lanes[:, j], minlength=256) @ bits for j in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def text_fingerprints(texts: pa.Array, shingle: int = 3) -> np.ndarray:
    """SimHash of every text: lower-cased A-Z, word shingles joined by one space, XXH64 with seed 42."""
    buf, offsets = text_bytes(texts)
    lower = buf.copy()
    lower[(buf >= 65) & (buf <= 90)] += 32
    starts, ends, first = word_spans(lower, offsets)
    sizes = ends - starts
    # the words again, each followed by exactly one space: a shingle is then one span of bytes
    to = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(int(to[-1]), 32, np.uint8)
    if len(sizes):
        total = int(sizes.sum())
        within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        joined[np.repeat(to[:-1], sizes) + within] = lower[np.repeat(starts, sizes) + within]
    n = np.diff(first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    at = np.repeat(first[:-1], count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    last = at + np.repeat(np.minimum(np.maximum(n, 1), shingle), count) - 1
    h = xxh64_spans(joined, to[at], to[last] + sizes[last]) if len(at) else np.zeros(0, np.uint64)
    edge = np.concatenate([[0], np.cumsum(count)])
    return np.array([simhash(h[edge[i]:edge[i + 1]]) for i in range(len(n))], np.uint64)


def with_fingerprint(docs: DataFrame, text: str, shingle: int = 3, name: str = "fp", keep_text: bool = False) -> DataFrame:
    """``docs`` plus the fingerprint as a bigint (its 64 bits); without the text unless it is kept."""
    keep = [c for c in docs.columns if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            fp = text_fingerprints(b.column(text), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(fp)], names=[*keep, name])

    return docs.mapInArrow(run, schema)


# ---- Golay keys ------------------------------------------------------------------


def _remainder(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit polynomial by the generator."""
    rest = words.copy()
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        rest ^= np.where((rest >> bit) & 1, GENERATOR << (bit - CHECK), 0)
    return rest


@cache
def _leaders() -> np.ndarray:
    """Error pattern of at most three bits for each of the 2048 remainders (the code is perfect)."""
    one = 1 << np.arange(LENGTH)
    pairs = one[:, None] | one[None, :]
    triples = pairs[:, :, None] | one[None, None, :]
    patterns = np.unique(np.concatenate([[0], one, pairs.ravel(), triples.ravel()]))
    table = np.zeros(1 << CHECK, np.int64)
    table[_remainder(patterns)] = patterns
    return table


def decode(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within three bits of each 23-bit word."""
    return (words ^ _leaders()[_remainder(words)]) >> CHECK


def golay_keys(words: np.ndarray) -> np.ndarray:
    """(n, 24) indices of all words within one bit; repeats are set to -1."""
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(LENGTH)])[None, :]
    keys = np.sort(decode(near.ravel()).reshape(near.shape), axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def bucket_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: (segment number, that segment, Golay index of the next segment)."""
    seg = [((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for i in range(3):
        golay = golay_keys(seg[(i + 1) % 3])
        r, c = np.nonzero(golay >= 0)
        rows.append(r)
        keys.append((i << 40) | (seg[i][r] << 12) | golay[r, c])
    return np.concatenate(rows), np.concatenate(keys)


def _file_under_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 20_000):
            fps = b.column("fp").slice(at, 20_000).to_numpy(zero_copy_only=False)
            rows, keys = bucket_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], names=["key", "fp"])


# ---- links and components ---------------------------------------------------------


def links(fps: DataFrame, bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that span all links of up to ``bits`` bits.

    Small buckets give every linked pair; full ones a star around each centre,
    which has the same components. The key scheme covers two bits at most.
    """
    if not 0 <= bits <= 2:
        raise ValueError("the Golay keys cover at most two differing bits")
    keys = stage_table(fps.select("fp").distinct().mapInArrow(_file_under_keys, "key long, fp long"), "golay")
    sizes = stage_table(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "golay-sizes")
    small = keys.join(sizes.filter(F.col("n") <= bucket).select("key"), "key")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (small.withColumnRenamed("fp", "a").join(small.withColumnRenamed("fp", "b"), "key")
             .filter((F.col("a") < F.col("b")) & (apart <= bits)).select("a", "b").distinct())
    full = salted_join(keys, sizes.filter(F.col("n") > bucket).select("key"), ["key"], "inner", spread=["fp"])
    full = stage_table(full.select("fp").distinct(), "golay-full")
    if bits < 2 or full.isEmpty():
        return pairs if bits == 2 else pairs.unionByName(_near(full, bits))
    flips = F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i))
                                             for i in range(64)])).alias("centre")
    filed = full.select("fp", flips)
    least = filed.groupBy("centre").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    stars = salted_join(filed, least.select("centre", "a"), ["centre"], "inner", spread=["fp"])
    stars = stars.filter(F.col("a") != F.col("fp")).select("a", F.col("fp").alias("b")).distinct()
    return pairs.unionByName(stars)


def _near(fps: DataFrame, bits: int) -> DataFrame:
    """Links of at most one bit among the fingerprints of full buckets: a look-up of every neighbour."""
    if bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))
    flips = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), i)) for i in range(64)]))
    return fps.select(F.col("fp").alias("a"), flips.alias("b")).filter("a < b").join(
        fps.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each component, for all nodes of ``edges`` (a, b).

    Alternating large and small stars: each step hangs a node's larger (then
    its smaller) neighbours on the least one. Steps are joins with one minimum
    per node, so that a node with many links is never gathered.
    """
    spark = edges.sparkSession
    now, path = write_stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                            .filter("u != v").distinct(), "llm-edges")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both.filter("v > u"), least, ["u"], "inner", spread=["v"]).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large, middle = write_stage(large, "llm-large-star")
        delete_path(spark, path)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = salted_join(large, least, ["u"], "inner", spread=["v"])
        hung = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now, path = write_stage(hung.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "llm-small-star")
        delete_path(spark, middle)
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def classes(rows: DataFrame, bits: int = 2) -> DataFrame:
    """One row per fingerprint of ``rows`` (doc_id, fp): fp, root, component_id."""
    least = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    roots = components(links(least, bits)).withColumnRenamed("node", "fp")
    linked = stage_table(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "classes")
    smallest = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return salted_join(linked.select("fp", "root"), smallest, ["root"], "inner", spread=["fp"])


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of every row."""
    rows = stage_table(with_fingerprint(docs.select("doc_id", "text"), "text", shingle), "simhash")
    found = salted_join(rows, classes(rows, bits), ["fp"], "inner", spread=["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """The row with the smallest doc_id of each component (one of them where rows repeat); all its columns."""
    fp, key = free_name(docs, "fp"), free_name(docs, "id_key")
    rows = stage_table(with_fingerprint(docs.select("doc_id", "text"), "text", shingle), "simhash")
    groups = salted_join(rows, classes(rows, bits), ["fp"], "inner", spread=["doc_id"])
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("x"))
    first = first.select(_id_key(F.col("x.doc_id")).alias(key), F.col("x.fp").alias(fp))
    texts = with_fingerprint(docs, "text", shingle, fp, keep_text=True).withColumn(key, _id_key(F.col("doc_id")))
    return texts.join(first, [key, fp], "left_semi").dropDuplicates([key, fp]).drop(key, fp)


def _id_key(doc_id):
    return F.coalesce(doc_id.cast("string"), F.lit("null"))
