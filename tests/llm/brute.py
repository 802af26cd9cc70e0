"""Plain one-text-at-a-time versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import xxhash

SF0001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(sf_dir: str) -> list[dict]:
    return pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def statistics(text: str | None) -> tuple[int, int, int, int, int]:
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {k for k, n in Counter(windows).items() if n > 1}
    covered = {j for i, x in enumerate(windows) if x in often for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def fingerprint(text: str | None) -> int:
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(rows: list[tuple]) -> dict:
    """fingerprint -> smallest doc_id reachable by links of two bits or fewer; rows: (doc_id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least: dict = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return {f: least.get(find(f)) for f in fps}


def repeats(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """Words, removed words and SHA-256 of what stays of every text."""
    where = defaultdict(int)
    split = [words(t) for t in texts]
    for w in split:
        for i in range(len(w) - window + 1):
            where[tuple(w[i:i + window])] += 1
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if where[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
