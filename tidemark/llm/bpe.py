"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token's bytes form a doubly linked list.  Each adjacent pair that the
vocabulary can merge lies in the bucket of its merge rank; a two-level bitmap
of ranks (one summary word over leaf words) says which buckets are occupied,
and find-first-set gives the lowest rank at once.  A bucket holds list
positions; an entry is stale, and skipped, when its left part or its right
neighbour has since been merged away or its pair has another rank.  Within a
rank the leftmost position merges first.  Every merge adds at most two
entries, so a pre-token of n bytes takes O(n) queue steps, long ones too.

Up to ``WIDE`` bytes a bucket is a bitmap of positions; beyond, a heap, as
operations on a bitmap take time with its width.

Null and empty texts encode to no ids.  Encoding is a pure function of the
text; repeated rows give equal results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

WIDE = 512  # longer pre-tokens keep a bucket's positions in a heap
LEAF = 8  # bits of a leaf word's index within the summary: 256 ranks a leaf


class Encoder:
    """Ranks, the split pattern and a bounded cache of encoded pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_entries: int = 1_200_000):
        self.ranks = ranks
        self.findall = regex.compile(pattern).findall
        self.by_id = {i: t for t, i in ranks.items()}
        self.by_text = {str(i): t for t, i in ranks.items()}
        self.cache: dict[str, str] = {}
        self.cache_entries = cache_entries

    @classmethod
    def from_file(cls, path: str, pattern: str, cache_entries: int = 1_200_000) -> Encoder:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return cls(ranks, pattern, cache_entries)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > WIDE:
            return self._merge_wide(piece)
        n = len(piece)
        get = ranks.get
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [get(piece[i : i + 2], -1) for i in range(n)]  # rank of the pair that begins here
        pair[-1] = -1
        buckets: dict[int, int] = {}  # rank -> bitmap of positions
        leaves: dict[int, int] = {}
        summary = 0
        for i, r in enumerate(pair):
            if r >= 0:
                if r in buckets:
                    buckets[r] |= 1 << i
                else:
                    buckets[r] = 1 << i
                    q = r >> LEAF
                    leaves[q] = leaves.get(q, 0) | 1 << (r & 255)
                    summary |= 1 << q
        while summary:
            top = summary & -summary
            q = top.bit_length() - 1
            leaf = leaves[q]
            low = leaf & -leaf
            r = q << LEAF | low.bit_length() - 1
            bucket = buckets.pop(r)
            leaves[q] = leaf ^ low
            if leaf == low:
                summary ^= top
            while bucket:
                first = bucket & -bucket
                bucket ^= first
                i = first.bit_length() - 1
                if pair[i] != r:
                    continue  # stale
                j = nxt[i]
                k = nxt[j]
                nxt[i] = k
                pair[j] = -1
                lowest = r
                if k < n:
                    prv[k] = i
                    pair[i] = new = get(piece[i : nxt[k]], -1)
                    if new >= 0:
                        lowest = new
                        buckets[new] = buckets.get(new, 0) | 1 << i
                        x = new >> LEAF
                        leaves[x] = leaves.get(x, 0) | 1 << (new & 255)
                        summary |= 1 << x
                else:
                    pair[i] = -1
                p = prv[i]
                if p >= 0:
                    pair[p] = new = get(piece[p:k], -1)
                    if new >= 0:
                        if new < lowest:
                            lowest = new
                        buckets[new] = buckets.get(new, 0) | 1 << p
                        x = new >> LEAF
                        leaves[x] = leaves.get(x, 0) | 1 << (new & 255)
                        summary |= 1 << x
                if lowest < r and bucket:  # a lower rank has come up: it goes first
                    buckets[r] = buckets.get(r, 0) | bucket
                    leaves[q] |= low
                    summary |= top
                    break
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : nxt[i]]])
            i = nxt[i]
        return out

    def _merge_wide(self, piece: bytes) -> list[int]:
        """The same queue for very long pre-tokens, with a bucket's positions in a heap instead of one wide bitmap."""
        ranks = self.ranks
        n = len(piece)
        get = ranks.get
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # rank of the pair that begins at a position, -1 for none
        buckets: dict[int, list[int]] = {}
        leaves: dict[int, int] = {}
        summary = 0
        for i in range(n - 1):
            if (r := get(piece[i : i + 2])) is not None:
                pair[i] = r
                if r in buckets:
                    buckets[r].append(i)  # positions come in order: a valid heap
                else:
                    buckets[r] = [i]
                    q = r >> LEAF
                    leaves[q] = leaves.get(q, 0) | 1 << (r & 255)
                    summary |= 1 << q
        while summary:
            q = (summary & -summary).bit_length() - 1
            leaf = leaves[q]
            low = (leaf & -leaf).bit_length() - 1
            r = q << LEAF | low
            bucket = buckets[r]
            while bucket:
                i = heappop(bucket)
                if pair[i] != r:
                    continue  # stale
                j = nxt[i]
                k = nxt[j]
                nxt[i] = k
                pair[j] = -1
                p = prv[i]
                if k < n:
                    prv[k] = i
                    new = get(piece[i : nxt[k]])
                    pair[i] = -1 if new is None else new
                    if new is not None:
                        if new in buckets:
                            heappush(buckets[new], i)
                        else:
                            buckets[new] = [i]
                            x = new >> LEAF
                            leaves[x] = leaves.get(x, 0) | 1 << (new & 255)
                            summary |= 1 << x
                else:
                    pair[i] = -1
                if p >= 0:
                    new = get(piece[p:k])
                    pair[p] = -1 if new is None else new
                    if new is not None:
                        if new in buckets:
                            heappush(buckets[new], p)
                        else:
                            buckets[new] = [p]
                            x = new >> LEAF
                            leaves[x] = leaves.get(x, 0) | 1 << (new & 255)
                            summary |= 1 << x
                # a lower rank may have come up; ranks below r leave this bucket for later
                if summary & -summary != 1 << q or leaves[q] & -leaves[q] != 1 << low:
                    break
            if not bucket:
                del buckets[r]
                leaves[q] &= ~(1 << low)
                if not leaves[q]:
                    summary &= ~(1 << q)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : nxt[i]]])
            i = nxt[i]
        return out

    def _ids_of(self, token: str) -> str:
        ids = ",".join(map(str, self.merge(token.encode("utf-8", "surrogatepass"))))
        if len(token) <= 64:
            if len(self.cache) >= self.cache_entries:
                self.cache.clear()
            self.cache[token] = ids
        return ids

    def encode_joined(self, text: str) -> str:
        """The decimal ids of a text joined by commas (empty for an empty text)."""
        get, ids_of = self.cache.get, self._ids_of
        return ",".join([get(t) or ids_of(t) for t in self.findall(text)])

    def encode(self, text: str) -> list[int]:
        joined = self.encode_joined(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode_joined(self, joined: str) -> bytes:
        return b"".join(map(self.by_text.__getitem__, joined.split(","))) if joined else b""

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.by_id.__getitem__, ids))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, pattern: str, cache_entries: int = 1_200_000) -> Encoder:
    """One encoder (and cache) per Python worker and vocabulary."""
    key = (path, pattern, cache_entries)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder.from_file(path, pattern, cache_entries)
    return _ENCODERS[key]


def round_trip(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False, cache_entries: int = 1_200_000) -> DataFrame:
    """Encode and decode: ``key, n_tokens, ids_sha256, decoded_sha256`` (and ``ids`` if asked for).

    A worker keeps the ids of ``cache_entries`` pre-tokens (about 200 bytes each) for as long as it lives.
    """
    src = df.select(F.col(key).alias(key), F.col(text).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, pattern, cache_entries)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            n, ids_sha, back_sha, ids = [], [], [], []
            for t in b.column(1):
                joined = enc.encode_joined(t.as_py() or "")
                n.append(joined.count(",") + 1 if joined else 0)
                ids_sha.append(sha(joined.encode()))
                back_sha.append(sha(enc.decode_joined(joined)))
                if keep_ids:
                    ids.append(np.array(joined.split(","), np.int32) if joined else np.empty(0, np.int32))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = src.schema[key].dataType.simpleString()
    return map_arrow(src, run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)
