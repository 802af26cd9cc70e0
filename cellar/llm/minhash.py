"""Near duplicates by HyperMinHash: compressed registers, banded, estimated, confirmed on full sets.

A document is the set of its distinct word shingles, each an XXH64. The first
``BUCKET_BITS`` bits put a hash into a bucket; of a bucket's least hash only the
count of leading zeros and the ``MANTISSA_BITS`` bits behind the leading one are
kept, 16 bits a register. An empty bucket borrows the register of the
first full one in an order of its own, so that any two documents agree in each
register with the probability of their Jaccard similarity, small sets too.

1. Rows with equal sets are one node (partial aggregation; 128 bits of the set).
2. Bands of ``BAND`` registers give each node 51 keys. A pair at a similarity of 0.8
   shares none with a probability of (1 - 0.8^5)^51 = 2e-9.
3. Star rounds: in every bucket that holds nodes of several components, each
   node is paired with one node of another component, the one that it shares
   the most buckets with is tried, and components are contracted. A group of
   near copies thus takes a number of pairs linear in its size. Rounds go on
   while large buckets hold several components.
4. What is still apart after the rounds is compared exhaustively in blocks:
   every node outside its bucket's main component with all nodes of the bucket.
   Blocks are dealt over tasks and only pairs that pass the estimate leave them.
5. A pair is confirmed in two steps: the Jaccard similarity estimated from the
   registers, corrected for chance collisions, must not be ``SLACK`` (over six
   standard deviations) below the threshold; then the full sets decide.

Defined results: a null or wordless text has an empty set and is linked with
nothing; repeated rows are one node; a component whose rows all lack a doc_id
has a null component_id and keeps all of them; an empty table gives no rows;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import mix64, salted_join, slices, stage_table, text_bytes, word_spans, xxh64_spans
from cellar.llm.simhash import components
from cellar.runtime import delete_path, write_stage

BUCKET_BITS = 8
MANTISSA_BITS = 10
REGISTERS = 1 << BUCKET_BITS
BAND = 5
#: Rounds in which a group of near copies is linked by stars.
ROUNDS = 8
#: Nodes of a block of the exhaustive comparison.
BLOCK = 256
#: Star rounds go on while a bucket of several components holds more nodes, and while they link this part of their pairs.
BIG = 5_000
LEAST_LINKED = 0.03
#: Pairs of one node that meet in a task.
HOT = 200
#: Bits of the filters that keep rows without a partner out of a shuffle (8 MB).
FILTER_BITS = 26
#: How far an estimate may fall below the threshold.
SLACK = 0.2
_SPLIT = np.uint64(0x5851F42D4C957F2D)


# ---- sets and registers -----------------------------------------------------------


def shingle_sets(texts: pa.Array, shingle: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts and their n + 1 offsets.

    A-Z are lower-cased, words joined by one space; a text of fewer words is one shingle, of none has none.
    """
    buf, offsets = text_bytes(texts)
    lower = buf.copy()
    lower[(buf >= 65) & (buf <= 90)] += 32
    starts, ends, first = word_spans(lower, offsets)
    sizes = ends - starts
    to = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.full(int(to[-1]), 32, np.uint8)
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    joined[np.repeat(to[:-1], sizes) + within] = lower[np.repeat(starts, sizes) + within]
    n = np.diff(first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.repeat(first[:-1], count) + (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    last = at + np.minimum(n[doc], shingle) - 1
    h = xxh64_spans(joined, to[at], to[last] + sizes[last]) if len(at) else np.zeros(0, np.uint64)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.searchsorted(doc[new], np.arange(len(n) + 1))


def set_hashes(h: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    total = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(x))]) for x in (h, h ^ _SPLIT)]
    return tuple(mix64(t[edge[1:]] - t[edge[:-1]]) for t in total)


@cache
def _borrow_order() -> np.ndarray:
    """For each register, the rank in which it asks the others."""
    rng = np.random.default_rng(20240229)
    return np.argsort(rng.random((REGISTERS, REGISTERS)), axis=1).astype(np.int16)


def registers(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """(n, REGISTERS) uint16: leading zeros and mantissa of each bucket's least hash, densified; zeros for an empty set."""
    n = len(edge) - 1
    out = np.zeros((n, REGISTERS), np.uint16)
    if len(h) == 0:
        return out
    doc = np.repeat(np.arange(n), np.diff(edge))
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    least = np.ones(len(h), bool)
    least[1:] = (bucket[1:] != bucket[:-1]) | (doc[1:] != doc[:-1])
    rest = ((h[least] << np.uint64(BUCKET_BITS)) >> np.uint64(11)).astype(np.float64)  # 53 bits, exact
    part, power = np.frexp(rest)
    mantissa = np.where(rest > 0, (part * 2 - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
    zeros = np.where(rest > 0, 53 - power, 53)
    out[doc[least], bucket[least]] = (zeros << MANTISSA_BITS) + mantissa + 1
    rank = _borrow_order()
    for i in np.flatnonzero((out == 0).any(axis=1) & (np.diff(edge) > 0)):
        row = out[i]
        full = np.flatnonzero(row)
        empty = np.flatnonzero(row == 0)
        row[empty] = row[full[np.argmin(rank[empty][:, full], axis=1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(n, bands) keys of the bands."""
    bands = REGISTERS // BAND
    cut = regs[:, :bands * BAND].reshape(len(regs), bands, BAND).astype(np.uint64)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), (len(regs), bands))
    for j in range(BAND):
        key = mix64(key ^ cut[:, :, j]) + np.uint64(j)
    return key


def chance(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that registers of sets of n and m elements without a common one are equal."""
    a, b = n / REGISTERS, m / REGISTERS
    s = a + b
    out = np.zeros(len(s))
    for zeros in range(53):
        low, high = 2.0 ** -(zeros + 1), 2.0 ** -zeros
        out += low / (1 << MANTISSA_BITS) * a * b / s * (np.exp(-s * low) - np.exp(-s * high))
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of register rows, corrected for chance collisions."""
    p = chance(n.astype(float), m.astype(float))
    return ((a == b).mean(axis=1) - p) / (1 - p)


def _matrix(column: pa.Array) -> np.ndarray:
    raw, _ = text_bytes(column.cast(pa.large_binary()).view(pa.large_string()) if len(column) else pa.array([], pa.large_string()))
    return raw.view(np.uint16).reshape(-1, REGISTERS)


def _sketch(schema: T.StructType, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, edge = shingle_sets(b.column("text"), shingle)
            h1, h2 = set_hashes(h, edge)
            regs = registers(h, edge)
            raw = pa.array([r.tobytes() for r in regs], pa.binary())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("doc_id", "x1", "x2")], pa.array(np.diff(edge)),
                                              pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), raw], names=schema.names)

    return run


def sketches(docs: DataFrame, shingle: int = 2) -> DataFrame:
    """doc_id, x1, x2 (hashes of the text), n (set size), h1, h2 (hashes of the set) and registers of every row."""
    long = [T.StructField(c, T.LongType()) for c in ("x1", "x2", "n", "h1", "h2")]
    schema = T.StructType([docs.schema["doc_id"], *long, T.StructField("regs", T.BinaryType())])
    return docs.select("doc_id", "text", *_text_hash()).mapInArrow(_sketch(schema, shingle), schema)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys = band_keys(_matrix(b.column("regs")))
        ids = np.repeat(b.column("nid").to_numpy(zero_copy_only=False), keys.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["key", "nid"])


# ---- filters ahead of shuffles ---------------------------------------------------------


def _words(keys: DataFrame, column: str) -> DataFrame:
    """A hash filter of ``keys``: one bit of ``2**FILTER_BITS`` for each key, as at most ``2**(FILTER_BITS - 6)`` words."""
    bit = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    return keys.select(F.shiftright(bit, 6).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int")).alias("bits")) \
        .groupBy("word").agg(F.bit_or("bits").alias("bits"))


def _may_hold(rows: DataFrame, column: str, words: DataFrame) -> DataFrame:
    """Rows whose key may be one of the filter's: all that are, and some others. The filter is broadcast; its size is fixed."""
    bit = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    found = rows.withColumn("word", F.shiftright(bit, 6).cast("int")).join(F.broadcast(words), "word")
    return found.filter(F.col("bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))) != 0).drop("word", "bits")


# ---- pairs --------------------------------------------------------------------------


def _close(similarity: float):
    """Keeps pairs of rows whose estimate does not rule them out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (b.column(c).to_numpy(zero_copy_only=False) for c in ("a_n", "b_n"))
            ok = estimate(_matrix(b.column("a_regs")), _matrix(b.column("b_regs")), n, m) >= similarity - SLACK
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(ok)), b.column("b").filter(pa.array(ok))], names=["a", "b"])

    return run


def _sided(pairs: DataFrame, facts: DataFrame, columns: list[str]) -> DataFrame:
    """``pairs`` (a, b) with the columns of both nodes. b may be one node in many rows: it is repeated once for each ``HOT`` of them."""
    one = facts.select(F.col("nid").alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns])
    uses = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / HOT).alias("parts"))
    two = uses.join(facts.select(F.col("nid").alias("b"), *[F.col(c).alias(f"b_{c}") for c in columns]), "b")
    two = two.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    dealt = salted_join(pairs, uses, ["b"], "inner", spread=["a"]).withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts"))).drop("parts")
    return dealt.join(one, "a").join(two, ["b", "part"]).drop("part")


def _confirm(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    both = _sided(pairs, sets, ["items"])
    common = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - common
    return both.filter(100 * common >= F.lit(round(100 * similarity)) * union).select("a", "b")


def _size_fits(similarity: float):
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return 100 * small >= F.lit(round(100 * similarity)) * large


def _sets_of(docs: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """nid and the sorted shingle hashes of ``nodes`` (nid, doc_id, t1, t2), from the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            h, edge = shingle_sets(b.column("text"), shingle)
            items = pa.LargeListArray.from_arrays(pa.array(edge.astype(np.int64)), pa.array(h.view(np.int64))).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("nid"), items], names=["nid", "items"])

    texts = _may_hold(docs.select(F.col("doc_id").alias("d"), *_text_hash(), "text"), "x1", _words(nodes, "x1"))
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("x1") == F.col("t1")) & (F.col("x2") == F.col("t2"))
    found = texts.join(nodes.withColumnsRenamed({"x1": "t1", "x2": "t2"}), same).select("nid", "text").mapInArrow(run, "nid long, items array<long>")
    return found.dropDuplicates(["nid"])


def _text_hash() -> list:
    """Two 64-bit hashes that tell texts apart."""
    return [F.xxhash64("text").alias("x1"), F.xxhash64(F.lit(1), F.col("text")).alias("x2")]


def _contested(members: DataFrame, turn: int) -> DataFrame:
    """Buckets of ``members`` (key, nid, comp, size, copies): key and the node that the others are tried with.

    First the one of most copies, which is often what the others were made from; then, of the component that has the
    most nodes, another one in each round.
    """
    first = F.col("copies") if turn == 0 else F.col("size")
    order = F.struct((-first).alias("x"), F.xxhash64(F.lit(turn), F.col("comp")).alias("y"), F.xxhash64(F.lit(turn), F.col("nid")).alias("z"), "nid", "comp")
    return members.groupBy("key").agg(F.min(order).alias("lo")).select("key", F.col("lo.nid").alias("lo"), F.col("lo.comp").alias("lo_comp"))


def _star_pairs(members: DataFrame, buckets: DataFrame) -> DataFrame:
    """(a, b): for each node the node of another component that it is put beside in most buckets."""
    beside = salted_join(members.select("key", "nid", "comp"), buckets, ["key"], "inner", spread=["nid"])
    tried = beside.filter(F.col("comp") != F.col("lo_comp")).select("nid", F.col("lo").alias("b")).groupBy("nid", "b").agg(F.count(F.lit(1)).alias("n"))
    best = tried.groupBy("nid").agg(F.max(F.struct("n", "b")).alias("x"))
    return best.select(F.col("nid").alias("a"), F.col("x.b").alias("b"))


def _blocks(members: DataFrame, facts: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (key, i, j, asks, nid, comp, rest, n, regs, items) of the blocks: of each bucket that holds several components, every node
    outside the main one (``asks``, ``rest``) with every node."""
    by = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    of = by.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("main"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("parts"))
    of = of.filter("parts > 1").select("key", F.col("main.comp").alias("main"), F.col("all"), (F.col("all") - F.col("main.n")).alias("few"))
    rows = salted_join(members.select("key", "nid", "comp"), of, ["key"], "inner", spread=["nid"])
    rows = rows.withColumn("rest", F.col("comp") != F.col("main"))

    def parts(n):
        return F.ceil(F.col(n) / BLOCK)

    def dealt(n):
        return F.pmod(F.xxhash64("nid"), parts(n)).cast("long")

    def every(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), parts(n) - 1))

    asking = rows.filter("rest").select("key", dealt("few").alias("i"), every("all").alias("j"), F.lit(True).alias("asks"), "nid", "comp", "rest")
    asked = rows.select("key", every("few").alias("i"), dealt("all").alias("j"), F.lit(False).alias("asks"), "nid", "comp", "rest")
    return asking.unionByName(asked).join(facts.select("nid", "n", "regs").join(sets, "nid"), "nid")


def _block_pairs(similarity: float, at_once: int = 40_000):
    """Links (a, b) of sorted block rows of different components: not ruled out by size or estimate, confirmed on the full sets.

    Of the nodes of one component that a node is linked with, one is given.
    """
    limit = round(100 * similarity)

    def confirmed(col: dict, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cut = np.append(np.flatnonzero(np.diff(a, prepend=-1)), len(a))
        for i, j in zip(cut[:-1], cut[1:]):
            to, own = b[i:j], col["items"][col["edge"][a[i]]:col["edge"][a[i] + 1]]
            size = col["n"][to]
            done = np.cumsum(size) - size
            theirs = col["items"][np.repeat(col["edge"][to] - done, size) + np.arange(int(size.sum()))]
            common = np.add.reduceat(own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs, done)
            to = to[100 * common >= limit * (len(own) + size - common)]
            to = to[np.unique(col["comp"][to], return_index=True)[1]]
            yield np.full(len(to), col["nid"][a[i]]), col["nid"][to]

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "asks", "nid", "comp", "rest", "n")}
        regs = _matrix(t.column("regs").combine_chunks())
        items = t.column("items").combine_chunks()
        col["edge"] = items.offsets.to_numpy().astype(np.int64)
        col["items"] = items.values.to_numpy(zero_copy_only=False).view(np.uint64)
        new = np.ones(len(regs), bool)
        new[1:] = (col["key"][1:] != col["key"][:-1]) | (col["i"][1:] != col["i"][:-1]) | (col["j"][1:] != col["j"][:-1])
        edge = np.append(np.flatnonzero(new), len(regs))
        group = np.cumsum(new) - 1
        asked = edge[:-1] + np.add.reduceat(~col["asks"], edge[:-1])  # asked rows stand first
        asks = np.flatnonzero(col["asks"])
        size = (asked - edge[:-1])[group[asks]]
        done = np.concatenate([[0], np.cumsum(size)])
        for at in range(0, int(done[-1]), at_once):
            k = np.arange(at, min(at + at_once, int(done[-1])))
            which = np.searchsorted(done, k, "right") - 1
            a = asks[which]
            b = edge[group[a]] + k - done[which]
            small, large = np.minimum(col["n"][a], col["n"][b]), np.maximum(col["n"][a], col["n"][b])
            ok = ((col["comp"][a] != col["comp"][b]) & (~col["rest"][b] | (col["nid"][a] < col["nid"][b]))
                  & (100 * small >= limit * large))
            a, b = a[ok], b[ok]
            ok = estimate(regs[a], regs[b], col["n"][a], col["n"][b]) >= similarity - SLACK
            found = list(confirmed(col, a[ok], b[ok])) if ok.any() else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if kept is None else pa.concat_tables([kept, t])
            key, i, j = (t.column(c).combine_chunks().to_numpy() for c in ("key", "i", "j"))
            same = (key == key[-1]) & (i == i[-1]) & (j == j[-1])
            cut = int(np.argmax(same)) if len(same) else 0  # the last block may go on
            if cut:
                yield from pairs(t.slice(0, cut))
            kept = t.slice(cut)
        if kept is not None and len(kept):
            yield from pairs(kept)

    return run


# ---- classes -----------------------------------------------------------------------------


def links(docs: DataFrame, sketched: DataFrame, nodes: DataFrame, similarity: float = 0.8, shingle: int = 2) -> DataFrame:
    """(node, root) of all nodes that are linked with another one.

    ``sketched``: rows (sid, doc_id, x1, x2, n, regs); ``nodes``: (nid, copies), each the sid of one row of its set.
    """
    spark = docs.sparkSession
    facts = sketched.filter("n > 0").join(nodes.select(F.col("nid").alias("sid"), "copies"), "sid").withColumnRenamed("sid", "nid")
    facts, all_facts = write_stage(facts.select("nid", "doc_id", "x1", "x2", "n", "copies", "regs"), "llm-minhash-nodes")
    keys, all_keys = write_stage(facts.select("nid", "regs").mapInArrow(_bands, "key long, nid long"), "llm-minhash-bands")
    shared = stage_table(keys.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"), "minhash-shared")
    members = salted_join(_may_hold(keys, "key", _words(shared, "key")), shared, ["key"], "inner", spread=["nid"])
    members, shown = write_stage(members.join(facts.select("nid", "copies"), "nid"), "llm-minhash-members")
    facts = stage_table(facts.join(members.select("nid").distinct(), "nid", "left_semi"), "minhash-candidates")
    for path in (all_facts, all_keys):
        delete_path(spark, path)
    sets = stage_table(_sets_of(docs, facts.select("nid", "doc_id", "x1", "x2"), shingle), "minhash-sets")
    roots, turn, stars = spark.createDataFrame([], "node long, root long"), 0, True
    now = members.withColumns({"comp": F.col("nid"), "size": F.lit(1)})
    while True:
        if stars:
            tried, path = write_stage(_star_pairs(now, _contested(now, turn)), "llm-minhash-tried")
            near = _sided(tried, facts, ["n", "regs"]).filter(_size_fits(similarity)).mapInArrow(_close(similarity), "a long, b long")
            found = stage_table(_confirm(near, sets, similarity), "minhash-links")
            n = found.count()
            few = n <= LEAST_LINKED * tried.count()
            delete_path(spark, path)
        else:
            blocks = _blocks(now, facts, sets).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "asks")
            found = stage_table(blocks.mapInArrow(_block_pairs(similarity), "a long, b long").distinct(), "minhash-links")
            n = found.count()
        if n:
            old = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = stage_table(components(old.unionByName(found) if turn else found), "minhash-roots")
        if not stars:
            delete_path(spark, shown)
            return roots
        turn += 1
        # buckets of one component need not be looked at again
        sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
        rooted = salted_join(roots.withColumnRenamed("node", "nid"), sizes, ["root"], "inner", spread=["nid"])
        now = members.select("key", "nid", "copies").join(rooted, "nid", "left").withColumns(
            {"comp": F.coalesce("root", "nid"), "size": F.coalesce("size", F.lit(1))}).drop("root")
        rooted, path = write_stage(now, "llm-minhash-rooted")
        open_keys = rooted.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("c")).filter("x != y")
        now, after = write_stage(salted_join(rooted, open_keys.select("key", "c"), ["key"], "inner", spread=["nid"]), "llm-minhash-members")
        members = now
        stars = turn < ROUNDS and not few and (now.agg(F.max("c")).first()[0] or 0) > BIG
        for old in (path, shown):
            delete_path(spark, old)
        shown = after


def near_duplicates(docs: DataFrame, similarity: float = 0.8, shingle: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept (doc_id = component_id) of every row."""
    docs = docs.select("doc_id", "text")
    rows = stage_table(sketches(docs, shingle).withColumn("sid", F.monotonically_increasing_id()), "minhash")
    nodes = stage_table(rows.groupBy("n", "h1", "h2").agg(F.min("sid").alias("nid"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
                        "minhash-classes")
    roots = links(docs, rows, nodes.filter("n > 0"), similarity, shingle)
    rooted = stage_table(nodes.join(roots.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid")), "minhash-rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = salted_join(rooted.select("root", "n", "h1", "h2"), smallest, ["root"], "inner", spread=["h1"]).drop("root")
    out = salted_join(rows.select("doc_id", "sid", "n", "h1", "h2"), found, ["n", "h1", "h2"], "inner", spread=["sid"])
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

