"""Compressed tries over byte strings, and their spread over Spark partitions by adaptive prefixes.

``TextTrie`` is a radix trie: every edge holds a run of bytes, a terminal holds
the smallest id of its text and the places it was seen at.

``cut`` finds prefixes that deal texts into ranges of bounded bytes, round by
round: in every range that is still too heavy, the longest common prefix of its
texts is skipped, a few texts are drawn, and the shortest prefixes that tell
neighbours in the sample apart become bounds.  A prefix that the sample
shows twice is a range of its own, so the next round looks beyond it; a range
whose texts are all equal is done.  The driver holds the bounds, whose number follows
that of the partitions; samples stay in Spark.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Bytes beyond the common prefix that a drawn text shows in the first round (doubled every round), and texts drawn a range.
WINDOW, DRAWN = 256, 6
#: What a text weighs beside its bytes.
ROW = 16


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] isn't
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Node:
    __slots__ = ("label", "children", "low", "seen")

    def __init__(self, label: bytes):
        self.label, self.children, self.low, self.seen = label, {}, None, None


class TextTrie:
    """Radix trie; a node with ``seen`` is a terminal."""

    def __init__(self):
        self.root, self.bytes = Node(b""), 0

    def insert(self, text: bytes, low) -> Node:
        """The terminal of ``text``, its smallest id brought up to date (``None`` is no id)."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += n - at
                node, at = child, n
            elif text.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                k = common(child.label, text[at:at + len(child.label)])
                upper = node.children[text[at]] = Node(child.label[:k])
                child.label = child.label[k:]
                upper.children[child.label[0]] = child
                node, at = upper, at + k
        if node.seen is None:
            node.seen = []
        if low is not None and (node.low is None or low < node.low):
            node.low = low
        return node

    def terminals(self):
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.seen is not None:
                yield node
            stack.extend(node.children.values())


@dataclass
class Cut:
    """Ranges of texts: each opened node has its depth, the sorted bounds beyond it, and what follows each bound."""

    depth: list[int] = field(default_factory=lambda: [0])
    bounds: list[list[bytes]] = field(default_factory=lambda: [[b""]])
    follow: list[list[tuple[bool, int]]] = field(default_factory=lambda: [[]])  # (a node, its number) or (a range, its partition)
    reach: list[int] = field(default_factory=lambda: [0])  # bytes that the longest bound compares
    partitions: int = 0

    def route(self, text: bytes) -> tuple[int, int, int]:
        """``(node, range in it, partition)`` of a text; the partition is -1 while the node's ranges aren't weighed."""
        node = 0
        while True:
            at = self.depth[node]
            i = bisect_right(self.bounds[node], text[at:at + self.reach[node]]) - 1
            if not self.follow[node]:
                return node, i, -1
            inner, to = self.follow[node][i]
            if not inner:
                return node, i, to
            node = to

    def open(self, depth: int, bounds: list[bytes]) -> int:
        self.depth.append(depth)
        self.bounds.append([b"", *bounds])
        self.follow.append([])
        self.reach.append(max(map(len, bounds), default=0))
        return len(self.depth) - 1


def _after(prefix: bytes) -> bytes | None:
    """The first string beyond all that begin with ``prefix`` (``None``: there is none)."""
    kept = prefix.rstrip(b"\xff")
    return kept[:-1] + bytes([kept[-1] + 1]) if kept else None


def _bounds(texts: DataFrame, cut: Cut, heavy: dict[tuple[int, int], tuple[int, float]], window: int) -> dict[tuple[int, int], list[bytes]]:
    """Bounds for the ranges ``heavy``: ``(node, range) -> (depth, share of its texts to draw)``."""

    def draw(batches):
        out = []
        for b in batches:
            for t in b.column(0).to_pylist():
                node, i, _ = cut.route(t)
                if (found := heavy.get((node, i))) and zlib.crc32(t[found[0]:], window) < found[1] * 2**32:
                    key = t[found[0]:found[0] + window]
                    out.append((node, i, key, len(t) <= found[0] + window))
        yield pa.RecordBatch.from_pylist([dict(zip(("node", "slot", "key", "ends"), r)) for r in out], schema=pa.schema(
            [("node", pa.int32()), ("slot", pa.int32()), ("key", pa.binary()), ("ends", pa.bool_())]))

    def pick(batches):
        last, out, n = None, [], 0
        for b in batches:
            for node, slot, key, ends in zip(*(c.to_pylist() for c in b.columns)):
                if last is None or last[:2] != (node, slot):
                    n = 0
                    out.append((node, slot, key))
                elif key == last[2]:  # a hot prefix or text: from it to what follows all that begin with it
                    out.append((node, slot, key))
                    if (upper := key + b"\0" if ends and last[3] else _after(key)) is not None:
                        out.append((node, slot, upper))
                elif n % DRAWN == 1:
                    out.append((node, slot, key[:common(last[2], key) + 1]))
                last, n = (node, slot, key, ends), n + 1
        out = sorted(set(out))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary())], ["node", "slot", "key"])

    drawn = map_arrow(texts, draw, "node int, slot int, key binary, ends boolean")
    dealt = drawn.repartitionByRange("node", "slot", "key").sortWithinPartitions("node", "slot", "key", "ends")
    found: dict[tuple[int, int], set] = {k: set() for k in heavy}
    for r in map_arrow(dealt, pick, "node int, slot int, key binary").collect():
        found[r.node, r.slot].add(bytes(r.key))
    return {k: sorted(v - {b""}) for k, v in found.items()}


def _weights(texts: DataFrame, cut: Cut, target: int) -> DataFrame:
    """Per range that isn't weighed yet: bytes, texts, the longest text, and (where heavy) two strings with its common prefix."""

    def weigh(batches):
        seen: dict[tuple[int, int], list] = {}
        for b in batches:
            for t in b.column(0).to_pylist():
                node, i, part = cut.route(t)
                if part >= 0:
                    continue
                had = seen.get((node, i))
                if had is None:
                    seen[node, i] = [len(t) - cut.depth[node] + ROW, 1, len(t), t[cut.depth[node]:]]
                else:
                    had[0] += len(t) - cut.depth[node] + ROW
                    had[1] += 1
                    had[2] = max(had[2], len(t))
                    if not t.startswith(had[3], cut.depth[node]):
                        had[3] = had[3][:common(had[3], t[cut.depth[node]:cut.depth[node] + len(had[3])])]
        keys, rows = list(seen), list(seen.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32())]
            + [pa.array([r[j] for r in rows], pa.int64()) for j in range(3)] + [pa.array([r[3] for r in rows], pa.binary())],
            ["node", "slot", "weight", "n", "longest", "shared"])

    rows = map_arrow(texts, weigh, "node int, slot int, weight long, n long, longest long, shared binary")
    one = rows.groupBy("node", "slot").agg(
        F.sum("weight").alias("weight"), F.sum("n").alias("n"), F.max("longest").alias("longest"), F.min("shared").alias("a"), F.max("shared").alias("b"))
    heavy = F.col("weight") > target
    return one.select("node", "slot", "weight", "n", "longest", F.when(heavy, F.col("a")).alias("a"), F.when(heavy, F.col("b")).alias("b"))


def cut(texts: DataFrame, target: int) -> Cut:
    """Prefixes that deal ``texts`` (one binary column) into ranges of about ``target`` bytes, equal texts together.

    Rounds grow with the logarithm of the longest prefix shared by a heavy range, not with the number of texts.
    """
    out, window, room = Cut(), WINDOW, 0
    fresh = {0}
    while fresh:
        found = {(r.node, r.slot): r for r in _weights(texts, out, target).collect()}
        heavy: dict[tuple[int, int], tuple[int, float]] = {}
        for k, r in found.items():
            if r.weight > target:
                depth = out.depth[r.node] + common(bytes(r.a), bytes(r.b))
                if depth < r.longest:  # else all its texts are equal
                    heavy[k] = (depth, DRAWN * 2 * r.weight / target / r.n)
        bounds = _bounds(texts, out, heavy, window) if heavy else {}
        before, fresh = sorted(fresh), set()
        for node in before:
            for slot in range(len(out.bounds[node])):
                r = found.get((node, slot))
                if (node, slot) in heavy:
                    fresh.add(to := out.open(heavy[node, slot][0], bounds[node, slot]))
                    out.follow[node].append((True, to))
                else:
                    if out.partitions == 0 or (r is not None and room < r.weight):  # light neighbours share a partition
                        out.partitions, room = out.partitions + 1, target
                    room -= r.weight if r is not None else 0
                    out.follow[node].append((False, out.partitions - 1))
        window *= 2
    return out
