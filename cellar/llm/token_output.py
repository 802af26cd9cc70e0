"""Token-id output: best-fit-decreasing packing into rows of a fixed capacity, written as binary matrices.

Documents gather in a buffer of bounded size in each partition; a buffer's
pieces, longest first, each go to the open row with the least room that still
holds them. A segment tree over the room values finds that row in logarithmic
time. A document longer than a row is split into full rows and a rest, without
loss. Rows that a buffer leaves less than ``full`` full return to the next
buffer, at most a quarter of a buffer's tokens.

One output row is one row of the id matrix, padded to the capacity, with the
cumulative segment lengths and the places where positions start again.

Defined results: a null or empty text has only the end id; repeated rows are
packed each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cellar.llm.common import slices
from cellar.llm.tokens import worker_encoder

Piece = tuple[int, int, int]  # length, document number, first token


class RoomTree:
    """Segment tree over room values 0..capacity: how many open rows have each, with search for the least one >= n."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.count = [0] * (2 * self.size)

    def add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i //= 2

    def least(self, n: int) -> int | None:
        """Least room >= ``n`` that some row has."""
        i = n + self.size
        if self.count[i]:
            return n
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_decreasing(pieces: list[Piece], capacity: int) -> list[list[Piece]]:
    """Rows of pieces; pieces longer than the capacity are split first."""
    parts = []
    for n, doc, at in pieces:
        while n > capacity:
            parts.append((capacity, doc, at))
            n, at = n - capacity, at + capacity
        parts.append((n, doc, at))
    parts.sort(key=lambda p: (-p[0], p[1], p[2]))
    tree, rows, by_room = RoomTree(capacity), [], {}
    for p in parts:
        room = tree.least(p[0])
        if room is None:
            k, room = len(rows), capacity
            rows.append([])
        else:
            k = by_room[room].pop()
            tree.add(room, -1)
        rows[k].append(p)
        by_room.setdefault(room - p[0], []).append(k)
        tree.add(room - p[0], 1)
    return rows


def pack_rows(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 50256, pad_id: int = 50256,
              wide: bool = False, buffer_tokens: int = 1 << 20, full: float = 0.98) -> DataFrame:
    """One row per sequence: sequence_id, ids (capacity little-endian uint16, or uint32 if ``wide``), n_tokens,
    cu_seqlens (0, then the end of each segment), position_resets (where each segment, and the padding, starts),
    doc_ids and doc_starts (of each segment: its document and its first token's place there)."""
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("position_resets", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("doc_starts", T.ArrayType(T.LongType()))])
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = worker_encoder(tokenizer), TaskContext.get().partitionId() << 33
        if not wide and encoder.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer need wide=True")
        kept: dict[int, tuple] = {}  # document number: (doc_id, ids, first token held)
        pieces: list[Piece] = []
        numbers, count, sequences, kind = 0, 0, 0, None

        def batch(rows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences
            cols: list[list] = [[] for _ in range(7)]
            for row in rows:
                lengths = [p[0] for p in row]
                ends = np.cumsum(lengths).tolist()
                line = np.full(capacity, pad_id, dtype)
                line[:ends[-1]] = np.concatenate([kept[d][1][at - kept[d][2]:at - kept[d][2] + n] for n, d, at in row])
                resets = [0, *ends]
                out = (base + sequences, line.tobytes(), ends[-1], [0, *ends], resets if ends[-1] < capacity else resets[:-1],
                       [kept[d][0] for _, d, _ in row], [at for _, _, at in row])
                for c, x in zip(cols, out):
                    c.append(x)
                sequences += 1
            ints = pa.list_(pa.int32())
            kinds = [pa.int64(), pa.binary(), pa.int32(), ints, ints, pa.list_(kind), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=schema.names)

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, pieces, count
            rows = best_fit_decreasing(pieces, capacity)
            rows.sort(key=lambda r: sum(p[0] for p in r))
            wait = 0
            if not last:
                held = 0
                while wait < len(rows) and (size := sum(p[0] for p in rows[wait])) < full * capacity and held + size <= buffer_tokens // 4:
                    held, wait = held + size, wait + 1
            for at in range(wait, len(rows), 256):
                yield batch(rows[at:at + 256])
            pieces = [p for r in rows[:wait] for p in r]
            new: dict[int, tuple] = {}
            for _, d, at in pieces:  # of the documents that wait keep only the tokens still needed
                first = min(at, new[d][2]) if d in new else at
                new[d] = (kept[d][0], kept[d][1][first - kept[d][2]:].copy(), first)
            kept, count = new, sum(p[0] for p in pieces)

        for b in slices(batches, "text"):
            kind = b.column("doc_id").type
            flat, edge = encoder.encode(b.column("text"), end_id)
            flat = flat.astype(dtype)
            for doc_id, i, j in zip(b.column("doc_id").to_pylist(), edge.tolist(), edge[1:].tolist()):
                kept[numbers] = (doc_id, flat[i:j], 0)
                pieces.append((j - i, numbers, 0))
                numbers, count = numbers + 1, count + j - i
            if count >= buffer_tokens:
                yield from flush(False)
        if pieces:
            yield from flush(True)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def write_matrices(sequences: DataFrame, path: str) -> None:
    """Write the packed rows as Parquet files under ``path``: every file is an id matrix with its segment tables."""
    sequences.write.mode("overwrite").parquet(path)
