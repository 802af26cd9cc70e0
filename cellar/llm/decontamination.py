"""Benchmark decontamination by template windows.

Words become template tokens: numbers, units after a number, and capitalised
words inside a sentence turn into typed placeholders; any other word is its
lower-cased self without outer punctuation. A run of one placeholder type is one
token, whose value is the whole run, so a slot's value may have any number of
words. All windows of ``window`` template tokens of the benchmark items, hashed,
are looked up in every document if they have ``least_words`` plain words; a
second look-up takes all windows of ``window`` lower-cased words as they are, so
that exact copies are found whatever they consist of and wherever they stand
(capital letters and sentence marks around them do not matter). Matched windows that lie on one diagonal
(document place minus item place) form blocks; blocks that follow each other in
the item and in the document form a chain over any number of diagonals. Its
placeholders must be consistent: one item value always stands for one document
value. A document leaks an item if the words of a chain cover ``share`` of the
item, or ``tokens`` words of it in a row, where gaps of less than a window (a
word put in or changed) do not end the row and do not count.

The benchmark is the stated query set: it is read in blocks of bounded size,
each block's window table goes to all tasks, and every block meets all whole
documents. Only matches leave the tasks.

Defined results: null and empty texts match nothing; an item shorter than a
window counts as one window of its own length, as a template if it has at least
``least_words`` plain words, as it is always (so an item of one word is found in
every text that holds the word); equal item texts are one item, named by the
smallest item_id; repeated documents are reported each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cellar.llm.common import free_name, mix64, slices, text_bytes, word_spans, xxh64_spans

WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3
#: Units of measure, money and time that count as a placeholder after a number (fixed values).
UNITS = """percent kg g mg lb lbs oz ton tons km m cm mm mi mile miles ft feet inch inches yard yards l ml litre litres liter
liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years usd eur
gbp dollar dollars cent cents euro euros pound pounds degree degrees celsius fahrenheit kwh watt watts volt volts mph""".split()
_SALT = np.array([3, 5, 7, 11], np.uint64) * np.uint64(0x9E3779B97F4A7C15 // 16)
_lut = lambda chars: np.isin(np.arange(256), list(chars.encode()))
_OUTER = _lut("!\"#%&'()*,./:;<=>?@[\\]^_`{|}~-")
_NUMERIC = _lut("0123456789.,:/")
_DIGIT = _lut("0123456789")
_STOP = _lut(".!?")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(6364136223846793005)
#: What windows are made of.
TEMPLATE, EXACT = 0, 1
BLOCK_BYTES = 8 << 20


@dataclass
class Template:
    """Template tokens of a batch of texts, one after another."""

    code: np.ndarray  # hash of the word, or of the placeholder's type
    kind: np.ndarray
    value: np.ndarray  # hash of the lower-cased word or run of words
    first: np.ndarray  # index of each text's first token, n + 1
    start: np.ndarray  # first word of each token, n + 1
    words: np.ndarray  # hash of each lower-cased word
    first_word: np.ndarray  # index of each text's first word, n + 1


def _hashes(words: list[str]) -> np.ndarray:
    buf, offsets = text_bytes(pa.array(words))
    return np.unique(xxh64_spans(buf, offsets[:-1], offsets[1:]))


def templates(texts: pa.Array) -> Template:
    buf, offsets = text_bytes(texts)
    starts, ends, first = word_spans(buf, offsets)
    stop = _STOP[buf[ends - 1]] if len(ends) else np.zeros(0, bool)
    begin, end = starts.copy(), ends.copy()
    for trim in ("end", "begin"):
        live = np.arange(len(begin))
        while len(live):
            at = end[live] - 1 if trim == "end" else begin[live]
            live = live[_OUTER[buf[at]]]
            if trim == "end":
                end[live] -= 1
            else:
                begin[live] += 1
            live = live[end[live] > begin[live]]
    lines = np.flatnonzero(buf == 10)
    line = np.searchsorted(lines, starts)
    opens = np.ones(len(starts), bool)  # first word of a text, a line or a sentence
    opens[1:] = stop[:-1] | (line[1:] != line[:-1])
    opens[first[:-1][first[:-1] < len(starts)]] = True
    some = end > begin
    begin, end, opens = begin[some], end[some], opens[some]
    first = np.concatenate([[0], np.cumsum(some)])[first]
    if not len(begin):
        none = np.zeros(0, np.uint64)
        return Template(none, np.zeros(0, np.int8), none, first, np.zeros(1, np.int64), none, first)
    pad = np.concatenate([buf, np.zeros(1, np.uint8)])
    a, b = pad[begin], np.where(end - begin > 1, pad[np.minimum(begin + 1, len(buf))], 0)
    accented = (a == 0xC3) & (b >= 0x80) & (b <= 0x9E)  # capital letters of Latin-1
    lower = _LOWER[buf]
    lower[begin[accented] + 1] += 32
    value = xxh64_spans(lower, begin, end)
    numeric = np.concatenate([[0], np.cumsum(_NUMERIC[buf])])
    money = (a == ord("$")) | (a == ord("+"))
    number = (numeric[end] - numeric[begin] == end - begin - money) & (_DIGIT[a] | (money & _DIGIT[b]))
    name = ~opens & (((a >= 65) & (a <= 90) & (b >= 97)) | accented) & (end - begin > 1)
    unit = np.zeros(len(begin), bool)
    unit[1:] = number[:-1] & np.isin(value[1:], _hashes(UNITS))
    unit[first[:-1][first[:-1] < len(begin)]] = False
    kind = np.select([number, unit, name], [NUMBER, UNIT, NAME], WORD).astype(np.int8)
    new = np.ones(len(kind), bool)  # a run of one placeholder type is one token
    new[1:] = (kind[1:] == WORD) | (kind[1:] != kind[:-1])
    new[first[:-1][first[:-1] < len(kind)]] = True
    head = np.flatnonzero(new)
    count = np.cumsum(new)
    place = np.arange(len(kind)) - head[count - 1]
    power = np.full(int(place.max()) + 1, _BASE, np.uint64)
    power[0] = 1
    run = np.add.reduceat(value * np.multiply.accumulate(power)[place], head)
    token = kind[head]
    return Template(np.where(token == WORD, run, _SALT[token]), token, run, np.concatenate([[0], count])[first],
                    np.append(head, len(kind)), value, first)


def window_hashes(codes: np.ndarray, first: np.ndarray, window: int, plain: np.ndarray | None = None,
                  least_words: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of every window inside one text that has enough ``plain`` tokens."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h = h * _BASE + codes[j:j + n]
    ok = np.ones(n, bool)
    if plain is not None:
        total = np.concatenate([[0], np.cumsum(plain)])
        ok = total[window:] - total[:n] >= least_words
    for edge in first[1:-1]:
        ok[max(edge - window + 1, 0):edge] = False
    at = np.flatnonzero(ok)
    return at, mix64(h[at])


@dataclass
class Piece:
    """Windows of one lane (layer and diagonal) that touch each other."""

    layer: int
    shift: int
    place: int  # first and last token in the item, by the layer's count
    end: int
    stands: dict  # item value of each slot: document value


class Block:
    """The windows of a bounded block of benchmark items, ready for look-up."""

    def __init__(self, ids: list, texts: list[str], window: int, least_words: int, share: float, tokens: int):
        self.ids, self.window, self.least, self.share, self.tokens = ids, window, least_words, share, tokens
        self.items = templates(pa.array(texts, pa.string()))
        self.tables = {}
        self._add(TEMPLATE, least_words)
        self._add(EXACT, 1)

    def _windows(self, t: Template, layer: int, w: int) -> tuple[np.ndarray, np.ndarray]:
        if layer == EXACT:
            return window_hashes(t.words, t.first_word, w)
        return window_hashes(t.code, t.first, w, t.kind == WORD, self.least)

    @staticmethod
    def _first(t: Template, layer: int) -> np.ndarray:
        return t.first_word if layer == EXACT else t.first

    def _add(self, layer: int, shortest: int) -> None:
        """Tables of a layer's windows; an item shorter than a window is one window if it has ``shortest`` tokens."""
        first = self._first(self.items, layer)
        size = np.diff(first)
        for w in sorted({self.window, *(int(s) for s in size if shortest <= s < self.window)}):
            at, h = self._windows(self.items, layer, w)
            item = np.searchsorted(first, at, "right") - 1
            at, h, item = (x[(size[item] >= w) if w == self.window else (size[item] == w)] for x in (at, h, item))
            order = np.argsort(h, kind="stable")
            table = np.zeros(1 << 16, bool)
            table[(h >> np.uint64(48)).astype(np.int64)] = True
            self.tables[layer, w] = (h[order], at[order], item[order], table)

    def matches(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text number, item number, covered words, item words, placeholders, changed placeholders)."""
        t = templates(texts)
        hits: dict[tuple[int, int], dict[tuple[int, int], set[tuple[int, int]]]] = {}
        for (layer, w), (table_h, table_at, table_item, quick) in self.tables.items():
            at, h = self._windows(t, layer, w)
            some = np.flatnonzero(quick[(h >> np.uint64(48)).astype(np.int64)]) if len(h) else np.zeros(0, np.int64)
            lo = np.searchsorted(table_h, h[some], "left")
            hi = np.searchsorted(table_h, h[some], "right")
            first = self._first(t, layer)
            for k in np.flatnonzero(hi > lo):
                p = int(at[some[k]])
                doc = int(np.searchsorted(first, p, "right")) - 1
                for q in range(lo[k], hi[k]):
                    place = int(table_at[q])
                    hits.setdefault((doc, int(table_item[q])), {}).setdefault((layer, p - place), set()).add((place, w))
        for (doc, item), lanes in sorted(hits.items()):
            got = self._judge(t, item, lanes)
            if got:
                yield doc, item, *got[:3], -got[3]

    def _judge(self, t: Template, item: int, lanes: dict) -> tuple[int, int, int, int] | None:
        """Covered words, item words, placeholders and minus the changed ones of the best chain that is a leak."""
        size = int(self.items.first_word[item + 1] - self.items.first_word[item])
        chains = [c for (layer, shift), found in lanes.items() for c in self._lane(t, layer, shift, sorted(found))]
        pieces = [p for c in chains for p in c]
        spans = np.array([self._span(t, p, p.place) + self._span(t, p, p.end) for p in pieces], np.int64)
        scored = [(sum(self._span(t, p, p.end)[0] - self._span(t, p, p.place)[0] for p in c), c) for c in chains]
        if max((s for s, _ in scored), default=0) < size and len(chains) > 1:
            scored += self._chains(pieces, spans)
        best = None
        for score, chain in sorted(scored, key=lambda x: -x[0]):
            if score < (best[0] if best else min(self.share * size, self.tokens)):
                break
            covered, longest, slots, changed = self._walk(t, chain)
            got = (covered, size, slots, -changed)
            if (covered >= self.share * size or longest >= self.tokens) and (best is None or got > best):
                best = got
        return best

    def _span(self, t: Template, p: Piece, token: int) -> tuple[int, int]:
        """Item word and document word where ``token`` of the item begins."""
        if p.layer == EXACT:
            return token, token + p.shift
        return int(self.items.start[token]), int(t.start[token + p.shift])

    def _stands(self, t: Template, layer: int, shift: int, place: int, w: int) -> dict | None:
        """Document value of each item value in a window, None if one would stand for two."""
        out: dict = {}
        items = self.items
        if layer == EXACT:  # slots that lie inside the window as a whole keep their values
            lo, hi = np.searchsorted(items.start, [place, place + w + 1]).tolist()
            return {(int(items.kind[q]), int(items.value[q])): int(items.value[q]) for q in range(lo, hi - 1) if items.kind[q] != WORD}
        for q in range(place, place + w):
            if items.kind[q] != WORD:
                value = int(t.value[q + shift])
                if out.setdefault((int(items.kind[q]), int(items.value[q])), value) != value:
                    return None
        return out

    def _lane(self, t: Template, layer: int, shift: int, found: list[tuple[int, int]]) -> Iterator[list[Piece]]:
        """Consistent chains of one diagonal; windows that contradict one chain go to a later one."""
        todo = [(place, w, s) for place, w in found if (s := self._stands(t, layer, shift, place, w)) is not None]
        while todo:
            stands: dict = {}
            chain: list[Piece] = []
            left = []
            for place, w, new in todo:
                if any(stands.get(k, v) != v for k, v in new.items()):
                    left.append((place, w, new))
                    continue
                stands.update(new)
                if chain and place <= chain[-1].end:
                    chain[-1].end = max(chain[-1].end, place + w)
                    chain[-1].stands.update(new)
                else:
                    chain.append(Piece(layer, shift, place, place + w, dict(new)))
            yield chain
            todo = left

    @staticmethod
    def _chains(pieces: list[Piece], spans: np.ndarray) -> list[tuple[int, list[Piece]]]:
        """For each piece the best consistent chain that ends with it, by the words of the item it covers."""
        order = np.lexsort((spans[:, 3], spans[:, 2]))
        q0, p0, q1, p1 = spans[order].T
        score, before, stands = (q1 - q0).copy(), [-1] * len(order), []
        for i in range(len(order)):
            own = pieces[order[i]].stands
            stands.append(own)
            cut = np.maximum(np.maximum(q1[:i] - q0[i], p1[:i] - p0[i]), 0)  # words that both cover count once
            total = score[:i] + (q1[i] - q0[i]) - cut
            some = np.flatnonzero((cut < q1[i] - q0[i]) & (p1[:i] < p1[i]) & (total > score[i]))
            for j in some[np.lexsort((-p1[some], -total[some]))]:
                if all(stands[j].get(k, v) == v for k, v in own.items()):
                    score[i], before[i], stands[i] = total[j], int(j), {**stands[j], **own}
                    break
        out = []
        for i in range(len(order)):
            chain, j = [], i
            while j >= 0:
                chain.append(pieces[order[j]])
                j = before[j]
            out.append((int(score[i]), chain[::-1]))
        return out

    def _walk(self, t: Template, chain: list[Piece]) -> tuple[int, int, int, int]:
        """Covered words of the item, most of them in a row, placeholders and changed placeholders of a chain."""
        covered = run = longest = item_end = doc_end = 0
        slots: dict[int, bool] = {}
        same: set[int] = set()  # words covered as they are
        for p in chain:
            for token in range(p.place, p.end):
                (q, d), (q_end, d_end) = self._span(t, p, token), self._span(t, p, token + 1)
                if q < item_end or d < doc_end:
                    continue
                near = covered and q - item_end < self.window and d - doc_end < self.window
                run = (run if near else 0) + q_end - q
                covered, longest, item_end, doc_end = covered + q_end - q, max(longest, run), q_end, d_end
                if p.layer == EXACT:
                    same.add(token)
                elif self.items.kind[token] != WORD:
                    slots[token] = bool(self.items.value[token] != t.value[token + p.shift])
        for token in set((np.searchsorted(self.items.start, sorted(same), "right") - 1).tolist()):
            if self.items.kind[token] != WORD and same.issuperset(range(self.items.start[token], self.items.start[token + 1])):
                slots[token] = False
        return covered, longest, len(slots), sum(slots.values())


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list, list[str]]]:
    """Distinct item texts with their smallest item_id, in blocks of about ``block_bytes``."""
    items = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = items.withColumn("size", F.octet_length("text"))
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        if part:
            yield [r["item_id"] for r in part], [r["text"] for r in part]


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, least_words: int = 4, share: float = 0.5,
          tokens: int = 16, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_covered, n_item, coverage, n_slots, n_changed, kind ('exact' or 'reparameterised')."""
    schema = T.StructType([docs.schema["doc_id"], benchmark.schema["item_id"], *[
        T.StructField(c, T.LongType()) for c in ("n_covered", "n_item", "n_slots", "n_changed")]])
    out = None
    for block in _matchers(docs, benchmark, window, least_words, share, tokens, block_bytes):
        def run(batches: Iterator[pa.RecordBatch], sent=block) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                rows = list(sent.value.matches(b.column("text")))
                if rows:
                    doc, item, *rest = map(list, zip(*rows))
                    ids = pa.array([sent.value.ids[i] for i in item], to_arrow_type(schema["item_id"].dataType))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc)), ids,
                                                      *[pa.array(x, pa.int64()) for x in rest]], names=schema.names)

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.select("doc_id", "item_id", "n_covered", "n_item", (F.col("n_covered") / F.col("n_item")).alias("coverage"),
                      "n_slots", "n_changed", F.when(F.col("n_changed") > 0, "reparameterised").otherwise("exact").alias("kind"))


def _matchers(docs, benchmark, window, least_words, share, tokens, block_bytes):
    context = docs.sparkSession.sparkContext
    for ids, texts in _blocks(benchmark, block_bytes):
        yield context.broadcast(Block(ids, texts, window, least_words, share, tokens))  # bounded by block_bytes


def drop_leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, least_words: int = 4, share: float = 0.5,
               tokens: int = 16, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that leak no item, unchanged."""
    flag = free_name(docs, "leaks")
    for block in _matchers(docs, benchmark, window, least_words, share, tokens, block_bytes):
        schema = T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])

        def run(batches: Iterator[pa.RecordBatch], sent=block) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                hit = np.zeros(b.num_rows, bool)
                hit[[m[0] for m in sent.value.matches(b.column("text"))]] = True
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hit)], names=schema.names)

        docs = docs.mapInArrow(run, schema).filter(~F.col(flag)).drop(flag)
    return docs
