"""Token ids of whole texts by a public tokenizer file, fast on texts with repeated words.

A byte-level BPE never merges across a single space between two characters that
are not white space, so texts are cut before such spaces, each distinct piece is
encoded once and the ids are put together again. New pieces are encoded many at
a time as one text: a token that begins with a space begins the next piece.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from cellar.llm.common import text_bytes

#: Pieces kept in each of two generations.
_KEPT = 300_000
_JOINED = 2_000
#: How a byte-level vocabulary writes the byte 0x20 (fixed value).
_SPACE = "Ġ"
_ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])

_SPACES = _ASCII_SPACE.tolist()


def _wide_space(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whether the bytes are white space of three bytes, in UTF-8."""
    general = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF))) | ((b == 0x81) & (c == 0x9F)))
    return general | ((a == 0xE1) & (b == 0x9A) & (c == 0x80)) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))


def _small_space(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == 0xC2) & ((b == 0x85) | (b == 0xA0))


def piece_edges(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets where pieces begin, in order: each text's start, and every space between two
    characters of one text that are not white space."""
    pad = np.concatenate([np.zeros(3, np.uint8), buf, np.zeros(4, np.uint8)])
    at = np.flatnonzero(buf == 32)
    p3, p2, p1, n1, n2, n3 = (pad[at + 3 + k] for k in (-3, -2, -1, 1, 2, 3))
    ok = ~(_ASCII_SPACE[p1] | _ASCII_SPACE[n1] | _wide_space(p3, p2, p1) | _small_space(p2, p1) | _wide_space(n1, n2, n3) | _small_space(n1, n2))
    start = np.zeros(len(buf) + 2, bool)
    start[offsets] = True
    ok &= ~(start[at] | start[at + 1])
    edge = np.zeros(len(buf) + 1, bool)
    edge[at[ok]] = True
    edge[offsets] = True
    return np.flatnonzero(edge[:-1])


def _holds(buf: np.ndarray, parts: list[bytes]) -> bool:
    raw = buf.tobytes() if parts else b""
    return any(p in raw for p in parts)


@lru_cache(maxsize=1)
def worker_encoder(path: str, encode_special_tokens: bool = True) -> Encoder:
    """The encoder of this Python worker, kept from task to task with the pieces it knows."""
    return Encoder(path, encode_special_tokens)


class Encoder:
    """Encodes lists of texts with the ``tokenizers`` file at ``path``, without adding special tokens.

    A special token's string in a text is ordinary text if ``encode_special_tokens``; else it gives
    that token's id, as the plain ``tokenizers`` call does.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if not (t.special and encode_special_tokens)]
        self.added = [t.content.encode() for t in added]
        # tokens that reach over their own piece: texts that hold an added token are then encoded whole
        self.whole = any(t.lstrip or t.rstrip or t.single_word or any(c.isspace() for c in t.content) for t in added)
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith(_SPACE)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self._age()

    def _age(self) -> None:
        """The known pieces become the older generation; what it held is forgotten."""
        self.older = (self.known, self.ids, self.edge) if self.known else ({}, None, None)
        self.known = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.edge = np.zeros(1 << 18, np.int64)

    def encode(self, texts: pa.Array | list[str | None], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (uint32) and their n + 1 offsets; ``end`` follows each text."""
        buf, starts = text_bytes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        edges = piece_edges(buf, starts)
        if self.whole:
            raw, ends = buf.tobytes(), starts.tolist()
            held = np.array([any(raw.find(a, i, j) >= 0 for a in self.added) for i, j in zip(ends, ends[1:])], bool)
            edges = edges[np.isin(edges, starts) | ~held[np.searchsorted(starts, edges, "right") - 1]]
        bounds = pa.py_buffer(np.append(edges, len(buf)).astype(np.int64))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges), [None, bounds, pa.py_buffer(np.ascontiguousarray(buf))])
        codes = pieces.dictionary_encode()
        slot = self._slots(codes.dictionary.to_pylist(), _holds(buf, self.added))[codes.indices.to_numpy()]
        begin = self.edge[slot]
        size = self.edge[slot + 1] - begin
        done = np.concatenate([[0], np.cumsum(size)])
        offsets = done[np.searchsorted(edges, starts)]
        flat = self.ids[np.repeat(begin - done[:-1], size) + np.arange(int(done[-1]))]
        if end is not None:
            flat = np.insert(flat, offsets[1:], end)
            offsets = offsets + np.arange(len(texts) + 1)
        return flat, offsets

    def _slots(self, keys: list[bytes], special: bool) -> np.ndarray:
        """Slots of the pieces ``keys``; some may hold an added token if ``special``."""
        known = self.known
        new = [k for k in keys if k not in known]
        if len(known) + len(new) > _KEPT and known:
            self._age()
            known, new = self.known, keys
        new = self._again(new)
        added = self.added if special else []
        plain, mixed = [], []
        for k in new:  # a plain piece has one space, in front, does not end in white space and holds no added token
            fits = k[0] == 32 and k.count(32) == 1 and (k[-1] < 128 and not _SPACES[k[-1]] or not k.decode()[-1].isspace())
            (plain if fits and not (added and any(a in k for a in added)) else mixed).append(k)
        self._add(mixed, [e.ids for e in self.tokenizer.encode_batch_fast([k.decode() for k in mixed], add_special_tokens=False)])
        joined = 1 if self.whole else _JOINED
        groups = [plain[i:i + joined] for i in range(0, len(plain), joined)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([b"".join(g).decode() for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            first = np.flatnonzero(self.opens[ids])
            if len(first) != len(group) or first[0]:
                raise ValueError("the tokenizer does not begin every word with a space token")
            self._store(group, ids, np.append(first[1:], len(ids)))
        return np.fromiter(map(known.__getitem__, keys), np.int64, len(keys))

    def _again(self, keys: list[bytes]) -> list[bytes]:
        """Take what the older generation knows of ``keys``; the rest."""
        slots, ids, edge = self.older
        back = [k for k in keys if k in slots]
        if not back:
            return keys
        at = np.fromiter(map(slots.__getitem__, back), np.int64, len(back))
        size = edge[at + 1] - edge[at]
        done = np.cumsum(size)
        self._store(back, ids[np.repeat(edge[at] - done + size, size) + np.arange(int(done[-1]))], done)
        return [k for k in keys if k not in slots]

    def _add(self, keys: list[bytes], each: list[list[int]]) -> None:
        self._store(keys, np.array([i for x in each for i in x], np.uint32), np.cumsum([len(x) for x in each]))

    def _store(self, keys: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Keep the ids of ``keys``, which end at ``ends``, in the next slots."""
        n = len(self.known)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(keys) + 1 > len(self.edge):
            self.edge = np.concatenate([self.edge, np.zeros_like(self.edge)])
        self.ids[self.used:self.used + len(ids)] = ids
        self.edge[n + 1:n + 1 + len(keys)] = self.used + ends
        self.used += len(ids)
        self.known.update(zip(keys, range(n, n + len(keys))))
