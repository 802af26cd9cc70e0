"""Shared helpers: words, vectorised hashing over Arrow text, written stage tables.

A word is a maximal run of characters other than the six ASCII white-space
characters (space and 0x09-0x0D), in every operator that counts words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellar.runtime import write_stage

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"  # one character of a word
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True

# XXH64 primes (fixed values of the published algorithm).
_P1 = np.uint64(11400714785074694791)
_P2 = np.uint64(14029467366897019727)
_P3 = np.uint64(1609587929392839161)
_P4 = np.uint64(9650029242287828579)
_P5 = np.uint64(2870177450012600261)


# ---- Spark side -----------------------------------------------------------------


def word_array(text: Column) -> Column:
    """Words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: later steps read files that outlive any executor.
    """
    return write_stage(df, f"llm-{name}")[0]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int = 8,
                spread: list[str] | None = None) -> DataFrame:
    """Join whose left side may hold one key in a large share of its rows.

    ``right`` has at most one row per key and is repeated ``salts`` times; each
    left row takes a salt from its ``spread`` columns, so that a hot key's rows
    meet in ``salts`` tasks.
    """
    spread = spread or [c for c in left.columns if c not in on]
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---- inside tasks ---------------------------------------------------------------


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; a null has no bytes."""
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``max_bytes`` of text (at least one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (n + 1)."""
    if len(buf) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = _IS_SPACE[buf]
    before = np.empty(len(buf), bool)
    before[0], before[1:] = True, space[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = True
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = True, space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    inside = ~space
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(33))
    x = x * _P2
    x = x ^ (x >> np.uint64(29))
    x = x * _P3
    return x ^ (x >> np.uint64(32))


def xxh64_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of every byte span of ``buf``, vectorised over the spans."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    pad = np.concatenate([buf, np.zeros(8, np.uint8)])
    u64 = np.ndarray(len(pad) - 7, "<u8", pad, strides=(1,))
    u32 = np.ndarray(len(pad) - 7, "<u4", pad, strides=(1,))
    size = ends - starts
    at = starts.copy()
    h = np.full(len(size), seed, np.uint64) + _P5
    big = np.flatnonzero(size >= 32)
    if len(big):
        zero = np.full(len(big), seed, np.uint64)
        acc = [zero + _P1 + _P2, zero + _P2, zero.copy(), zero - _P1]
        p, left, live = starts[big], size[big], np.arange(len(big))
        while len(live):
            for j in range(4):
                acc[j][live] = _rotl(acc[j][live] + u64[p[live] + 8 * j] * _P2, 31) * _P1
            p[live] += 32
            left[live] -= 32
            live = live[left[live] >= 32]
        v = _rotl(acc[0], 1) + _rotl(acc[1], 7) + _rotl(acc[2], 12) + _rotl(acc[3], 18)
        for a in acc:
            v = (v ^ (_rotl(a * _P2, 31) * _P1)) * _P1 + _P4
        h[big], at[big] = v, p
    h += size.astype(np.uint64)
    live = np.flatnonzero(ends - at >= 8)
    while len(live):
        k = _rotl(u64[at[live]] * _P2, 31) * _P1
        h[live] = _rotl(h[live] ^ k, 27) * _P1 + _P4
        at[live] += 8
        live = live[ends[live] - at[live] >= 8]
    live = np.flatnonzero(ends - at >= 4)
    if len(live):
        k = u32[at[live]].astype(np.uint64) * _P1
        h[live] = _rotl(h[live] ^ k, 23) * _P2 + _P3
        at[live] += 4
    live = np.flatnonzero(ends > at)
    while len(live):
        h[live] = _rotl(h[live] ^ (pad[at[live]].astype(np.uint64) * _P5), 11) * _P1
        at[live] += 1
        live = live[ends[live] > at[live]]
    h ^= h >> np.uint64(33)
    h *= _P2
    h ^= h >> np.uint64(29)
    h *= _P3
    h ^= h >> np.uint64(32)
    return h
