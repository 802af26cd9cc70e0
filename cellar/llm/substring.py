"""Substring dedup: word spans that occur more than once are removed, found with suffix automata.

A window is ``window`` consecutive words of one text; a word goes if a window
that covers it occurs a second time anywhere. Two ways to use the automata:

``remove_reference`` is for a reference of bounded size: it is dealt into
shards, each shard's automaton is broadcast, and documents stream past it; the
matching statistics give the maximal spans.

``remove_repeats`` removes what the corpus repeats within itself. There the
reference is the corpus, which no broadcast holds, so the reference is sharded
by content and each shard meets only the passages that can match it:

1. A window's anchor is its word ``GRAM``-gram with the least hash (the first of
   equals). Equal windows have equal anchors. Consecutive windows with one
   anchor form a segment; each window lies in exactly one segment.
2. Anchors that occur once hold no repeat. What is left is aggregated by the
   segments' 128-bit content hash: a segment that occurs twice is a repeat as a
   whole and needs no automaton.
3. Anchors with two or more distinct segments are contested. Their distinct
   segments are the reference shard of that anchor: a suffix automaton over
   their words, with the number of occurrences of each state, gives at every
   word the longest suffix that occurs twice. Anchors with more than ``SHARD``
   distinct segments (a passage quoted in very many places) are dealt on by the
   128-bit hash of each single window, which meets equal windows only.
4. Spans go back to their documents by (doc_id, hash of the text).

Defined results: null and wordless texts have no words and lose none; repeated
rows repeat each other's windows; all occurrences go, the first included.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import free_name, mix64, slices, stage_table, text_bytes, word_spans, xxh64_spans

WINDOW = 35
GRAM = 6
SHARD = 256
_BASES = (np.uint64(6364136223846793005), np.uint64(3202034522624059733))
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)


# ---- the automaton -----------------------------------------------------------------


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the number of occurrences of each state."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _copy(self, p: int, word, q: int) -> int:
        twin = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        self.link[q] = twin
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = twin
            p = self.link[p]
        return twin

    def add(self, words, weight: int = 1) -> None:
        """Add a sequence that occurs ``weight`` times."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._copy(last, word, q)
            else:
                cur, p = len(nxt), last
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                count.append(0)
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = cur
                    p = link[p]
                if p >= 0:
                    q = nxt[p][word]
                    link[cur] = q if length[q] == length[p] + 1 else self._copy(p, word, q)
                last = cur
            count[last] += weight

    def finish(self, least: int = 2) -> list[int]:
        """For each state the length of its longest suffix that occurs ``least`` times or more."""
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        for s in reversed(order):
            self.count[self.link[s]] += self.count[s]
        best = [0] * len(self.next)
        for s in order:
            best[s] = self.length[s] if self.count[s] >= least else best[self.link[s]]
        return best

    def matching(self, words) -> Iterator[int]:
        """At each word the length of the longest suffix that occurs in the automaton."""
        state = size = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            yield size


def spans_of(lengths, window: int) -> list[tuple[int, int]]:
    """Maximal spans covered by matches of ``window`` words or more that end at each place."""
    out: list[tuple[int, int]] = []
    for i, n in enumerate(lengths):
        if n >= window:
            if out and i + 1 - n <= out[-1][1]:
                out[-1] = (min(out[-1][0], i + 1 - n), i + 1)
                while len(out) > 1 and out[-1][0] <= out[-2][1]:
                    out[-2:] = [(out[-2][0], out[-1][1])]
            else:
                out.append((i + 1 - n, i + 1))
    return out


def repeated_spans(segments: list[list], weights: list[int], window: int) -> list[list[tuple[int, int]]]:
    """For each word sequence the spans whose windows occur twice or more among all, ``weights`` counted."""
    automaton = SuffixAutomaton()
    for words, n in zip(segments, weights):
        automaton.add(words, n)
    best, out = automaton.finish(), []
    for words, n in zip(segments, weights):
        if n > 1:
            out.append([(0, len(words))] if len(words) >= window else [])
            continue
        state, lengths = 0, []
        for word in words:
            state = automaton.next[state][word]
            lengths.append(best[state])
        out.append(spans_of(lengths, window))
    return out


# ---- segments ------------------------------------------------------------------------


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each span of word hashes."""
    out = []
    for base, inverse in zip(_BASES, _INVERSES):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(base, len(words)), dtype=np.uint64)])
        out.append(mix64((total[ends] - total[starts]) * _powers(inverse, len(words) + 1)[starts]).view(np.int64))
    return out


def text_segments(texts: pa.Array, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text number, first word, number of words, anchor and two content hashes of every segment."""
    buf, offsets = text_bytes(texts)
    starts, ends, first = word_spans(buf, offsets)
    words = xxh64_spans(buf, starts, ends)
    n = len(words) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * _BASES[0] + words[j:j + len(grams)]
    grams = mix64(grams)
    # least of ``window - gram + 1`` neighbours, the first of equals, by doubling
    width, low, place = 1, grams, np.arange(len(grams))
    want = window - gram + 1
    while width < want:
        step = min(width, want - width)
        size = len(low) - step
        later = low[step:] < low[:size]
        low, place = np.where(later, low[step:], low[:size]), np.where(later, place[step:], place[:size])
        width += step
    text = np.searchsorted(first, np.arange(n), "right") - 1
    valid = np.arange(n) + window <= first[text + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (place[at[1:]] != place[at[:-1]]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    begin = at[head]
    end = at[np.concatenate([head[1:], [len(at)]]) - 1] + window
    h1, h2 = _span_hashes(words, begin, end)
    owner = text[begin]
    return owner, begin - first[owner], end - begin, grams[place[begin]].view(np.int64), h1, h2


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text) and text."""
    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text")


def _anchors(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            anchor, n = np.unique(text_segments(b.column("text"), window, gram)[3], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], names=["anchor", "n"])

    return run


def _segments(window: int, gram: int, kind):
    """One row per distinct segment of a text, with all its places: a text that repeats itself gives few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            owner, at, size, anchor, h1, h2 = text_segments(b.column("text"), window, gram)
            order = np.lexsort((at, h2, h1, anchor, owner))
            owner, at, size, anchor, h1, h2 = (x[order] for x in (owner, at, size, anchor, h1, h2))
            new = np.ones(len(at), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            head = np.flatnonzero(new)
            places = pa.ListArray.from_arrays(pa.array(np.append(head, len(at)).astype(np.int32)), pa.array(at.astype(np.int32)))
            rows = pa.array(owner[head])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), b.column("th").take(rows), places, pa.array(size[head].astype(np.int32)),
                 pa.array(anchor[head]), pa.array(h1[head]), pa.array(h2[head])], names=["doc_id", "th", "at", "size", "anchor", "h1", "h2"])

    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("th", T.LongType()), T.StructField("at", T.ArrayType(T.IntegerType())),
                           T.StructField("size", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("anchor", "h1", "h2")]])
    return run, schema


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the wanted segments of each text, joined by one space."""
    for b in slices(batches, "text"):
        cols: list[list] = [[] for _ in range(5)]
        for text, wanted in zip(b.column("text").to_pylist(), b.column("wanted").to_pylist()):
            words = (text or "").encode().split()
            for w in wanted:
                row = (w["anchor"], w["h1"], w["h2"], w["n"], b" ".join(words[w["at"]:w["at"] + w["size"]]))
                for c, x in zip(cols, row):
                    c.append(x)
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.binary())],
                                         names=["anchor", "h1", "h2", "n", "words"])


def _by_shard(window: int):
    """Rows sorted by anchor and hashes: one automaton for each anchor, which has at most ``SHARD`` segments."""

    def settle(group: list[tuple]) -> list[tuple]:
        group = [g for i, g in enumerate(group) if not i or g[:3] != group[i - 1][:3]]
        spans = repeated_spans([g[4].split() for g in group], [g[3] for g in group], window)
        return [(*g[:3], a, b) for g, s in zip(group, spans) if g[3] == 1 for a, b in s]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for b in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and group[0][0] != row[0]:
                    found += settle(group)
                    group = []
                group.append(row)
            yield _span_batch(found)
        yield _span_batch(settle(group))

    return run


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["anchor", "h1", "h2", "a", "b"])


def _single_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "words"):
            buf, offsets = text_bytes(b.column("words").cast(pa.large_binary()).view(pa.large_string()))
            starts, ends, first = word_spans(buf, offsets)
            words = xxh64_spans(buf, starts, ends)
            size = np.maximum(np.diff(first) - window + 1, 0)
            row = np.repeat(np.arange(b.num_rows), size)
            at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
            begin = first[row] + at
            w1, w2 = _span_hashes(words, begin, begin + window)
            take = [b.column(c).take(pa.array(row)) for c in ("anchor", "h1", "h2", "n")]
            yield pa.RecordBatch.from_arrays([*take, pa.array(at.astype(np.int32)), pa.array(w1), pa.array(w2)],
                                             names=["anchor", "h1", "h2", "n", "a", "w1", "w2"])

    return run


# ---- operators -------------------------------------------------------------------------


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """Spans to remove: doc_id, th (hash of the text), spans (array of first word and end), one row per text that has any."""
    texts = _texts(docs)
    anchors = (texts.select("text").mapInArrow(_anchors(window, gram), "anchor long, n long")
               .groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"))
    anchors = stage_table(anchors, "anchors")
    run, schema = _segments(window, gram, docs.schema["doc_id"].dataType)
    found = stage_table(texts.mapInArrow(run, schema).join(anchors, "anchor", "left_semi"), "segments")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", F.get("at", F.lit(0)).alias("at"), "size")
    distinct = stage_table(found.groupBy("anchor", "h1", "h2").agg(
        F.sum(F.size("at")).alias("n"), F.min(place).alias("p")), "distinct")
    contested = stage_table(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "contested")

    wanted = distinct.join(contested, "anchor").select("anchor", "h1", "h2", "n", "k", "p.doc_id", "p.th", "p.at", "p.size")
    wanted = wanted.groupBy(F.col("doc_id").alias("__d"), F.col("th").alias("__t")).agg(
        F.collect_list(F.struct("anchor", "h1", "h2", "n", "at", "size")).alias("wanted"))
    segments = stage_table(
        texts.join(wanted, (F.col("th") == F.col("__t")) & F.col("doc_id").eqNullSafe(F.col("__d"))).select("text", "wanted")
        .mapInArrow(_fetch, "anchor long, h1 long, h2 long, n long, words binary"), "contested-words")
    spans = (segments.join(contested.filter(F.col("k") <= shard).select("anchor"), "anchor", "left_semi")
             .select("anchor", "h1", "h2", "n", "words").repartition("anchor").sortWithinPartitions("anchor", "h1", "h2")
             .mapInArrow(_by_shard(window), "anchor long, h1 long, h2 long, a int, b int"))
    large = segments.join(contested.filter(F.col("k") > shard).select("anchor"), "anchor", "left_semi").dropDuplicates(["anchor", "h1", "h2"])
    single = stage_table(large.select("anchor", "h1", "h2", "n", "words").mapInArrow(
        _single_windows(window), "anchor long, h1 long, h2 long, n long, a int, w1 long, w2 long"), "windows")
    twice = single.groupBy("w1", "w2").agg(F.sum("n").alias("times")).filter("times > 1").select("w1", "w2")
    single = single.filter("n = 1").join(twice, ["w1", "w2"], "left_semi").select(
        "anchor", "h1", "h2", "a", (F.col("a") + window).cast("int").alias("b"))
    whole = distinct.filter("n > 1").select("anchor", "h1", "h2", F.lit(0).alias("a"), F.lit(1 << 30).alias("b"))
    spans = spans.unionByName(single).unionByName(whole).groupBy("anchor", "h1", "h2").agg(
        F.collect_list(F.struct("a", "b")).alias("s"))  # at most a segment's windows
    # read back, the spans meet the places in a plain join, of which the planner can split a hot segment
    spans = stage_table(spans, "spans")
    out = found.join(spans, ["anchor", "h1", "h2"]).select("doc_id", "th", "size", "s", F.explode("at").alias("at"))
    out = out.select("doc_id", "th", "at", "size", F.explode("s").alias("x"))
    out = out.select("doc_id", "th", (F.col("at") + F.col("x.a")).alias("a"),
                     (F.col("at") + F.least(F.col("x.b"), F.col("size"))).alias("b")).distinct()
    return out.groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "b")).alias("spans"))  # at most a text's words


def _cut(schema: T.StructType, names: tuple[str, str, str], words_only: bool):
    spans_name, total_name, gone_name = names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            buf, offsets = text_bytes(b.column("text"))
            starts, ends, first = word_spans(buf, offsets)
            raw, texts, total, gone = buf.tobytes(), [], np.diff(first), np.zeros(b.num_rows, np.int64)
            lists = b.column(spans_name)
            null = b.column("text").is_null().to_pylist()
            for i in range(b.num_rows):
                lo, n = int(first[i]), int(total[i])
                drop = np.zeros(n, bool)
                for s in lists[i].as_py() or []:
                    drop[s["a"]:s["b"]] = True
                gone[i] = drop.sum()
                if words_only:
                    keep = np.flatnonzero(~drop) + lo
                    texts.append(b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())]))
                elif null[i]:
                    texts.append(None)
                elif not gone[i]:
                    texts.append(raw[offsets[i]:offsets[i + 1]])
                else:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], drop, [False]]).astype(np.int8)))
                    out, at = [], int(offsets[i])
                    for x, y in zip(edge[::2].tolist(), edge[1::2].tolist()):
                        out.append(raw[at:starts[lo + x]])
                        at = int(starts[lo + y]) if y < n else int(offsets[i + 1])
                    texts.append(b"".join([*out, raw[at:offsets[i + 1]]]))
            made = {"text": pa.array(texts, pa.binary()).cast(pa.string()), total_name: pa.array(total.astype(np.int64)), gone_name: pa.array(gone)}
            yield pa.RecordBatch.from_arrays([made[f] if f in made else b.column(f) for f in schema.names], names=schema.names)

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, words_only: bool = False, total: str = "n_words",
                   gone: str = "n_removed", **options) -> DataFrame:
    """All rows and columns of ``docs``, ``text`` without its repeated words, and two columns with the words before and those removed.

    The text keeps its own white space around what stays, or is the kept words
    joined by one space if ``words_only``.
    """
    total, gone = free_name(docs, total), free_name(docs, gone)
    spans, hashed, other, key = (free_name(docs, c) for c in ("__spans", "__th", "__other", "__key"))
    found = repeats(docs.select("doc_id", "text"), window, **options).select(
        F.col("doc_id").alias(key), F.col("th").alias(other), F.col("spans").alias(spans))
    joined = docs.withColumn(hashed, F.xxhash64("text")).join(
        found, (F.col(hashed) == F.col(other)) & F.col("doc_id").eqNullSafe(F.col(key)), "left").drop(hashed, other, key)
    schema = T.StructType([*docs.schema.fields, T.StructField(total, T.LongType()), T.StructField(gone, T.LongType())])
    return joined.mapInArrow(_cut(schema, (spans, total, gone), words_only), schema)


def remove_reference(docs: DataFrame, reference: DataFrame, window: int = WINDOW, shard_words: int = 200_000) -> DataFrame:
    """All rows of ``docs`` without the maximal spans of ``window`` words or more that occur in ``reference`` (text).

    The reference is a table of bounded size; each shard of about
    ``shard_words`` words is broadcast as one automaton and meets all documents
    as they came. A document's spans of all shards travel with its row and are cut
    once at the end, so the result does not depend on the shards.
    """
    spark = docs.sparkSession
    size = F.size(F.split(F.col("text"), r"[\x20\x09-\x0D]+"))
    rows = reference.filter(F.col("text").isNotNull()).select("text").distinct()
    shards = max(1, -(-(rows.agg(F.sum(size)).first()[0] or 0) // shard_words))
    spans, total, gone = (free_name(docs, c) for c in ("__spans", "__total", "__gone"))
    span = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
    schema, marked = docs.schema, T.StructType([*docs.schema.fields, T.StructField(spans, span)])
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    out = docs.withColumn(spans, F.array().cast(span))
    for k in range(shards):
        automaton = SuffixAutomaton()
        for r in rows.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == k).toLocalIterator():
            automaton.add(r["text"].encode().split())
        sent = spark.sparkContext.broadcast(automaton)  # bounded by shard_words

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                found = []
                for text, old in zip(b.column("text").to_pylist(), b.column(spans).to_pylist()):
                    new = spans_of(sent.value.matching((text or "").encode().split()), window)
                    found.append(_united([*((s["a"], s["b"]) for s in old), *new]))
                column = pa.array([[{"a": x, "b": y} for x, y in f] for f in found], kind)
                yield pa.RecordBatch.from_arrays([column if f == spans else b.column(f) for f in marked.names], names=marked.names)

        out = out.mapInArrow(run, marked)
    return out.mapInArrow(_cut(schema, (spans, total, gone), False), schema)


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
