"""Hierarchical packing into windows of several lengths.

Each partition is packed as a stream, without a shuffle: documents gather in a
buffer of bounded size, and each buffer is packed by itself.

- A document gives full windows of the longest tier; its rest is routed to the
  shortest tier that holds it.
- Tiers are packed from the longest: the longest piece opens a window, and the
  gap takes the longest pieces that fit, which come from shorter tiers. What
  then remains of a gap takes the front of the shortest piece left; the rest of
  that piece is routed again. So a window ends up full unless pieces run out.
- Pieces of an unfinished window wait for the next buffer. At the end of the
  partition they are cut into the tiers' lengths, and what is less than the
  shortest tier into ever smaller halves of it, so that nothing is padded if
  the shortest tier is a power of two.
- Sequences of a buffer are dealt to step groups of about ``step_tokens``,
  longest first to the lightest group.

The result depends only on the partition's rows and their order, so a task run
again gives the same rows. Defined results: a null or empty text has only the
end id; repeated rows are packed each.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cellar.llm.common import slices
from cellar.llm.tokens import worker_encoder

TIERS = (64, 128, 256, 512, 1024, 2048)
PIECE_COLUMNS = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]


def tail_sizes(tiers: tuple[int, ...]) -> list[int]:
    """Lengths that a partition's last tokens are cut into, longest first."""
    out = sorted(tiers, reverse=True)
    while out[-1] % 2 == 0:
        out.append(out[-1] // 2)
    return out


#: One piece of a document: length, document number, first token.
Piece = tuple[int, int, int]


def fill_tiers(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows (each a list of pieces whose lengths add up to a tier) and the pieces left over."""
    longest, windows, pool = tiers[-1], [], []
    for n, doc, at in pieces:
        while n >= longest:
            windows.append([(longest, doc, at)])
            n, at = n - longest, at + longest
        if n:
            pool.append((n, doc, at))
    pool.sort()
    left: list[Piece] = []
    for k in range(len(tiers) - 1, -1, -1):
        tier, under = tiers[k], tiers[k - 1] if k else 0
        while pool and pool[-1][0] > under:
            window, gap = [pool.pop()], 0
            gap = tier - window[0][0]
            while gap and pool:
                i = bisect_right(pool, (gap, 1 << 62, 0))
                if i:
                    window.append(pool.pop(i - 1))
                    gap -= window[-1][0]
                else:
                    n, doc, at = pool.pop(0)
                    window.append((gap, doc, at))
                    insort(pool, (n - gap, doc, at + gap))
                    gap = 0
            if gap:
                left += window
            else:
                windows.append(window)
    return windows, left


def cut_to_tiers(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Windows for the pieces left at the end: full ones of ever shorter lengths, then at most one that is not full."""
    sizes = tail_sizes(tiers)
    out, queue = [], sorted(pieces, reverse=True)
    total = sum(p[0] for p in queue)
    while total:
        gap = next((t for t in sizes if t <= total), total)
        total -= gap
        window = []
        while gap:
            n, doc, at = queue.pop(0)
            take = min(n, gap)
            window.append((take, doc, at))
            gap -= take
            if n > take:
                queue.insert(0, (n - take, doc, at + take))
        out.append(window)
    return out


def step_groups(lengths: list[int], step_tokens: int) -> list[int]:
    """A group for each sequence so that groups hold about the same number of tokens."""
    groups = max(1, -(-sum(lengths) // step_tokens))
    heap, out = [(0, g) for g in range(groups)], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        load, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + lengths[i], g))
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS,
         buffer_tokens: int = 1 << 20, step_tokens: int = 1 << 16, encode_special_tokens: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, ids (little-endian uint32), doc_tokens, sequence_id, offset, tier, step_group.

    ``tier`` is the padded length of the piece's sequence. A special token's string in a text
    is ordinary text if ``encode_special_tokens``, else it gives that token's id.
    """
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, t) for c, t in (
        ("start", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()),
        ("offset", T.LongType()), ("tier", T.IntegerType()), ("step_group", T.LongType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, base = worker_encoder(tokenizer, encode_special_tokens), TaskContext.get().partitionId() << 33
        kept: dict[int, tuple] = {}  # document number: (doc_id, ids, first token held, tokens in all)
        pieces: list[Piece] = []
        numbers, count, sequences, groups, kind = 0, 0, 0, 0, None
        full = set(tail_sizes(tiers))

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal sequences, groups
            sizes = [sum(p[0] for p in w) for w in windows]
            group = step_groups(sizes, step_tokens)
            cols: list[list] = [[] for _ in PIECE_COLUMNS]
            for w, size, g in zip(windows, sizes, group):
                tier, offset = size if size in full else tiers[-1], 0
                for n, doc, at in w:
                    doc_id, ids, held, total = kept[doc]
                    row = (doc_id, at, ids[at - held:at - held + n].tobytes(), total, base + sequences, offset, tier,
                           base + groups + g)
                    for c, x in zip(cols, row):
                        c.append(x)
                    offset += n
                sequences += 1
            groups += max(group, default=-1) + 1
            types = [kind, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=PIECE_COLUMNS)

        def flush() -> pa.RecordBatch:
            nonlocal pieces, kept, count
            windows, pieces = fill_tiers(pieces, tiers)
            out = rows(windows)
            held: dict[int, tuple] = {}
            for _, doc, at in pieces:  # of the documents that wait keep only the tokens still needed
                first = min(at, held[doc][2]) if doc in held else at
                doc_id, ids, old, total = kept[doc]
                held[doc] = (doc_id, ids[first - old:].copy(), first, total)
            kept, count = held, sum(p[0] for p in pieces)
            return out

        for b in slices(batches, "text"):
            kind = b.column("doc_id").type
            flat, edge = encoder.encode(b.column("text"), end_id)
            flat = flat.astype("<u4")
            for doc_id, i, j in zip(b.column("doc_id").to_pylist(), edge.tolist(), edge[1:].tolist()):
                kept[numbers] = (doc_id, flat[i:j], 0, j - i)
                pieces.append((j - i, numbers, 0))
                numbers, count = numbers + 1, count + j - i
            if count >= buffer_tokens:
                yield flush()
        if pieces:
            yield flush()
            if pieces:
                yield rows(cut_to_tiers(pieces, tiers))

    return docs.select("doc_id", "text").mapInArrow(run, schema)
