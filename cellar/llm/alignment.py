"""Alignment of two tokenizers' ids over one text, by the bytes that they cover.

Each text is encoded by A (a byte-level ``tokenizers`` file) with a space in
front and by B (a ``sentencepiece`` model that puts that space itself). Byte
offsets where tokens of both end cut the tokens into groups. A link is a pair
of token occurrences whose bytes overlap: between two neighbouring ends, of A
or of B, lies exactly one.

Identity-map fast path: an array over A's ids holds the id of B with the same
bytes. A group of one token each always is such a pair; the documents that
hold it are counted in vectors of the vocabulary's length. Only pairs of other
ids, from irregular groups, go through a shuffle.

Neither tokenizer merges across a single space between two characters that are
not white space (checked for B against its pieces), so texts are cut there, and
each distinct piece of a chunk is encoded and aligned once. Documents are taken
in chunks of about ``CHUNK`` bytes of text:

1. Each chunk writes its documents (counts, digest of the groups, pieces as
   numbers), its pieces' links, its distinct irregular pairs with the number
   of its documents that hold them, and its task's vectors.
2. Pairs are counted over all chunks; counts go back to the chunks that asked,
   which hold each pair once, so that no pair is hot.
3. Each chunk adds up counts by piece, then by document. The vectors (one
   number for each id of A) travel with the tasks; their length is the
   vocabulary's.

Defined results: a text that is null, empty, or that the tokenizers do not
cover byte by byte has no tokens: zeros and an empty string; repeated rows are
documents of their own; an empty table gives no rows; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cellar.llm.common import slices, stage_table, text_bytes
from cellar.llm.tokens import Encoder, piece_edges

#: Bytes of text in a chunk (at least one document).
CHUNK = 4 << 20
_KEPT_PIECES = 100_000  # that the encoder of A remembers between chunks
_MARK = "▁"  # how B writes a space (fixed value)


def byte_values() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def a_bytes(tokenizer) -> list[bytes]:
    """Bytes of every id of a byte-level ``tokenizers`` tokenizer."""
    value = byte_values()
    out = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        out[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
    return out


def b_bytes(model) -> list[bytes]:
    """Bytes of every id of a ``sentencepiece`` model."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_MARK, " ").encode())
    return out


class Aligner:
    """Encodes distinct pieces by both tokenizers and aligns them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Encoder(a_path, encode_special_tokens=True)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        for i in range(self.b.get_piece_size()):
            if _MARK in self.b.id_to_piece(i).lstrip(_MARK):
                raise ValueError("the model has pieces that reach over a space")
        a, b = a_bytes(self.a.tokenizer), b_bytes(self.b)
        self.a_text, self.b_text = _Spans(a), _Spans(b)
        self.b_size = len(b)
        plain: dict[bytes, int] = {}
        for i, x in enumerate(b):
            if not (self.b.is_control(i) or self.b.is_unknown(i)) and (x not in plain or not self.b.is_byte(i)):
                plain[x] = i
        self.same = np.array([plain.get(x, -1) for x in a])
        self.number = _Spans([b"%d" % i for i in range(max(len(a), len(b)))])

    def align(self, pieces: list[bytes]) -> dict:
        """For each piece: ok (both cover it byte by byte; else it has no tokens), counts (tokens of A, of B, groups), written
        (its groups) and the pair codes (A's id * size of B's vocabulary + B's id) of its links, with their edges."""
        if len(self.a.known) > _KEPT_PIECES:
            self.a._forget()  # noqa: SLF001
        a, a_edge = self.a.encode(pa.array([p.decode() for p in pieces], pa.large_string()))
        encoded = self.b.encode([p[1:].decode() for p in pieces], num_threads=1)
        b_edge = np.concatenate([[0], np.cumsum(np.fromiter(map(len, encoded), np.int64, len(encoded)))])
        b = np.fromiter(chain.from_iterable(encoded), np.int64, int(b_edge[-1]))
        del encoded
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        ok = self.a_text.spell(a, a_edge, raw, size) & self.b_text.spell(b, b_edge, raw, size)
        a, b = a[ok[np.repeat(np.arange(len(size)), np.diff(a_edge))]].astype(np.int64), b[ok[np.repeat(np.arange(len(size)), np.diff(b_edge))]]
        # ends of all tokens of the covered pieces, one piece after the other
        a_end, b_end = np.cumsum(self.a_text.size[a]), np.cumsum(self.b_text.size[b])
        ends = np.union1d(a_end, b_end)
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        codes = a[np.searchsorted(a_end, ends)] * self.b_size + b[np.searchsorted(b_end, ends)]
        to = np.concatenate([[0], np.cumsum(np.where(ok, size, 0))])
        at = {k: np.searchsorted(v, to, "right") for k, v in (("a", a_end), ("b", b_end), ("link", ends), ("group", both))}
        # tokens in the order in which groups are written: those of A, then those of B
        a_to, b_to = np.searchsorted(a_end, both, "right"), np.searchsorted(b_end, both, "right")
        a_at = np.arange(len(a)) + np.concatenate([[0], b_to])[np.searchsorted(both, a_end)]
        b_at = np.arange(len(b)) + a_to[np.searchsorted(both, b_end)]
        ids, follow = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[a_at], ids[b_at] = a, b
        follow[a_at[a_to - 1]], follow[b_at[b_to - 1]] = ord("|"), ord(";")
        width = self.number.size[ids] + 1
        done = np.concatenate([[0], np.cumsum(width)])
        written = np.empty(int(done[-1]), np.uint8)
        last = done[1:] - 1
        digit = np.ones(len(written), bool)
        digit[last] = False
        written[last] = follow
        written[digit] = self.number.of(ids)
        return {"ok": ok, "counts": np.stack([np.diff(at[k]) for k in ("a", "b", "group")], axis=1), "codes": codes, "link_edge": at["link"],
                "written": written.tobytes(), "written_edge": done[at["a"] + at["b"]]}


class _Spans:
    """A table of byte strings that are gathered many at once."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(strings), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        """The strings of ``ids``, one after the other."""
        size = self.size[ids]
        shift = self.start[ids] - (np.cumsum(size) - size)
        return self.raw[np.repeat(shift, size) + np.arange(int(size.sum()))]

    def spell(self, ids: np.ndarray, edge: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ids of each piece (``edge``) spell its bytes (``raw``, cut by ``size``)."""
        done = np.concatenate([[0], np.cumsum(self.size[ids])])
        fits = np.diff(done[edge]) == size
        if not fits.all():
            ids, raw = ids[fits[np.repeat(np.arange(len(size)), np.diff(edge))]], raw[np.repeat(fits, size)]
        wrong = np.concatenate([[0], np.cumsum(self.of(ids) != raw)])
        fits[fits] = np.diff(wrong[np.concatenate([[0], np.cumsum(size[fits])])]) == 0
        return fits


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each with a space in front, and their offsets; null and empty texts have none."""
    buf, offsets = text_bytes(texts)
    size = np.diff(offsets)
    to = np.concatenate([[0], np.cumsum(size + (size > 0))])
    out = np.full(int(to[-1]), 32, np.uint8)
    text = np.ones(len(out), bool)
    text[to[:-1][size > 0]] = False
    out[text] = buf
    return out, to


def align_chunk(aligner: Aligner, texts: pa.Array) -> dict:
    """Counts, digests and pieces of a chunk's documents, the links of its pieces and its distinct pairs."""
    buf, offsets = spaced(texts)
    edges = piece_edges(buf, offsets)
    bounds = pa.py_buffer(np.append(edges, len(buf)).astype(np.int64))
    cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges), [None, bounds, pa.py_buffer(np.ascontiguousarray(buf))])
    coded = cut.dictionary_encode()
    piece = coded.indices.to_numpy().astype(np.int64)
    got = aligner.align(coded.dictionary.to_pylist())
    ok, counts, link_edge = got["ok"], got["counts"], got["link_edge"]
    to = got["written_edge"].tolist()
    names = [got["written"][i:j] for i, j in zip(to, to[1:])]  # each piece's groups, each with a semicolon behind
    width = np.diff(link_edge)
    pairs, link = np.unique(got["codes"], return_inverse=True)
    del got
    first = np.searchsorted(edges, offsets)
    n = len(offsets) - 1
    held, stamp, seen = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64), np.zeros(len(ok), np.int64)
    totals, digests, pieces = np.zeros((n, 4), np.int64), [""] * n, [piece[:0]] * n
    for d in range(n):
        p = piece[first[d]:first[d + 1]]
        if len(p) == 0 or not ok[p].all():
            continue
        pieces[d] = p
        totals[d, :3] = counts[p].sum(axis=0)
        totals[d, 3] = width[p].sum()
        digests[d] = hashlib.sha256(b"".join([names[i] for i in p.tolist()])[:-1]).hexdigest()
        order = np.arange(len(p))
        seen[p] = order  # of equal pieces the last one stays
        kinds = p[seen[p] == order]
        size = width[kinds]
        at = link[np.repeat(link_edge[kinds] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        order = np.arange(len(at))
        stamp[at] = order
        held[at[stamp[at] == order]] += 1  # documents that hold the pair
    return {"pieces": pieces, "totals": totals, "digests": digests, "pairs": pairs, "held": held, "link": link, "link_edge": link_edge}


@cache
def _aligner(a_path: str, b_path: str) -> Aligner:
    """One for all tasks of a worker."""
    return Aligner(a_path, b_path)


# ---- on Spark ---------------------------------------------------------------------

_TOTALS = ("n_a", "n_b", "n_groups", "n_links")


def _chunk_schema(doc_id: T.StructField) -> T.StructType:
    """A chunk's documents, one row for the chunk itself (links), and one for each task (vector)."""
    long = [T.StructField(c, T.LongType()) for c in _TOTALS]
    raw = [T.StructField(c, T.BinaryType()) for c in ("pieces", "pairs", "held", "link", "link_edge", "vector")]
    return T.StructType([T.StructField("chunk", T.LongType()), doc_id, *long, T.StructField("groups_sha256", T.StringType()), *raw])


def _raw(array: np.ndarray, dtype: str) -> bytes:
    return np.ascontiguousarray(array.astype(dtype)).tobytes()


def _encode(a_path: str, b_path: str, schema: T.StructType, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligner(a_path, b_path)
        chunk = TaskContext.get().partitionId() << 32
        vector = np.zeros(len(aligner.same), np.int64)
        arrow = to_arrow_schema(schema)

        def row(**given) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([given.get(f.name)], f.type) for f in arrow], schema=arrow)

        for b in slices(batches, "text", chunk_bytes):
            got = align_chunk(aligner, b.column("text"))
            identical = aligner.same[got["pairs"] // aligner.b_size] == got["pairs"] % aligner.b_size
            np.add.at(vector, got["pairs"][identical] // aligner.b_size, got["held"][identical])
            narrow = "<u2" if len(got["link_edge"]) <= 1 << 16 else "<u4"
            none = pa.nulls(b.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk] * b.num_rows, pa.int64()), b.column("doc_id").cast(arrow.field("doc_id").type),
                *[pa.array(got["totals"][:, k]) for k in range(4)], pa.array(got["digests"], pa.string()),
                pa.array([_raw(p, narrow) for p in got["pieces"]], pa.binary()), none, none, none, none, none], schema=arrow)
            yield row(chunk=chunk, pairs=_raw(got["pairs"], "<i8"), held=_raw(got["held"], "<i8"), link=_raw(got["link"], "<u4"),
                      link_edge=_raw(got["link_edge"], "<i8"))
            chunk += 1
        yield row(vector=_raw(vector, "<i8"))

    return run


def _add_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for raw in b.column("vector").to_pylist():
            v = np.frombuffer(raw, "<i8")
            total = v.copy() if total is None else total + v
    if total is not None:
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["a", "n"])


def _irregular(same: np.ndarray, b_size: int):
    """The pairs of other ids that documents of a chunk hold: chunk, at (its place in the chunk), pair, n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, pairs, held in zip(*(b.column(c).to_pylist() for c in ("chunk", "pairs", "held"))):
                pairs, held = np.frombuffer(pairs, "<i8"), np.frombuffer(held, "<i8")
                at = np.flatnonzero((same[pairs // b_size] != pairs % b_size) & (held > 0))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), chunk)), pa.array(at.astype(np.int32)), pa.array(pairs[at]),
                                                  pa.array(held[at])], names=["chunk", "at", "pair", "n"])

    return run


def _score(same: np.ndarray, b_size: int, regular: np.ndarray, best: np.ndarray):
    """Adds each document's n_best and count_sum, from the counts of its chunk's pairs."""
    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        docs = rows.filter(pc.is_valid(rows.column("pieces")))
        links = rows.filter(pc.is_valid(rows.column("link")))
        pairs, link, edge = (np.frombuffer(links.column(c)[0].as_py(), t) for c, t in (("pairs", "<i8"), ("link", "<u4"), ("link_edge", "<i8")))
        a = pairs // b_size
        n = np.where(same[a] == pairs % b_size, regular[a], 0)
        n[replies.column("at").to_numpy()] = replies.column("n").to_numpy()
        on_top = (n == best[a]) & (n > 0)
        top, total = (np.concatenate([[0], np.cumsum(x[link])])[edge] for x in (on_top.astype(np.int64), n))
        top, total = np.diff(top), np.diff(total)
        narrow = "<u2" if len(edge) <= 1 << 16 else "<u4"
        pieces = [np.frombuffer(p.as_py(), narrow) for p in docs.column("pieces")]
        out = docs.select(["doc_id", *_TOTALS])
        out = out.append_column("n_best", pa.array([int(top[p].sum()) for p in pieces], pa.int64()))
        out = out.append_column("count_sum", pa.array([int(total[p].sum()) for p in pieces], pa.int64()))
        return out.append_column("groups_sha256", docs.column("groups_sha256"))

    return run


def align(docs: DataFrame, a_path: str, b_path: str, chunk_bytes: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The documents' alignment, and the counts of all pairs.

    doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is held by the most documents of all pairs of its A id, ties
    included), count_sum (documents that hold the pair, added up over links), groups_sha256; and (a, b, n).
    """
    docs = docs.select("doc_id", "text")
    schema = _chunk_schema(docs.schema["doc_id"])
    chunks = stage_table(docs.mapInArrow(_encode(a_path, b_path, schema, chunk_bytes), schema), "align-chunks")
    aligner = _aligner(a_path, b_path)
    same, b_size = aligner.same, aligner.b_size
    # at most one row for each id of A
    regular = np.zeros(len(same), np.int64)
    vectors = chunks.filter(F.col("vector").isNotNull()).select("vector").mapInArrow(_add_vectors, "a long, n long")
    for r in vectors.groupBy("a").agg(F.sum("n").alias("n")).collect():
        regular[r["a"]] = r["n"]
    asked = chunks.filter(F.col("link").isNotNull()).select("chunk", "pairs", "held").mapInArrow(
        _irregular(same, b_size), "chunk long, at int, pair long, n long")
    counts = stage_table(asked.groupBy("pair").agg(F.sum("n").alias("n")), "align-pairs")
    best = regular.copy()
    for r in counts.groupBy(F.expr(f"pair div {b_size}").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = max(best[r["a"]], r["n"])
    replies = asked.select("chunk", "at", "pair").join(counts, "pair").select("chunk", "at", "n")
    rows = chunks.filter(F.col("chunk").isNotNull()).drop("held", "vector")
    out = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in (*_TOTALS, "n_best", "count_sum")],
                        T.StructField("groups_sha256", T.StringType())])
    scored = rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_score(same, b_size, regular, best), out)
    pairs = counts.select(F.expr(f"pair div {b_size}").alias("a"), (F.col("pair") % b_size).alias("b"), "n")
    ids = docs.sparkSession.createDataFrame(pd.DataFrame({"a": np.flatnonzero(regular), "b": same[regular > 0], "n": regular[regular > 0]}),
                                            "a long, b long, n long")
    return scored, pairs.unionByName(ids)
