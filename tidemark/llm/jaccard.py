"""Exact n-gram Jaccard self-join with set-relation skipping.

A document's set holds its distinct ``k``-word shingles as 64-bit hashes.
Two sets link when ``100 * |x & y| >= percent * |x | y|``.

1. *Sets that can have a partner.*  In hash order, of each set the first
   ``sent_shingles`` meet by range.  Linked sets have at least
   ``shared_shingles`` in common among those, so a set with fewer that another
   set has too links with nothing and goes no further: its shingles are never
   written.  The others are marked in a bitmap whose size follows their number
   (``Marks``); a set that is marked by mistake only costs work.
2. *Frequencies.*  Shingle counts over the marked sets, by 32-bit key, give a
   bitmap of keys that occur in two sets or more (fixed size) and the counts
   of the most frequent keys (fixed number).  They only set the global order
   of a set's shingles (rare first); any order gives exact answers.
3. *Index lists.*  Of each set the prefix that any partner must share goes to
   the index, without the shingles that no other set has.  Equal sets count
   once.
4. *Answers of a similar set first.*  Each index list names its most central
   set; every set is compared with the central set that most of its lists
   name.  Linked sets take over that set's answers: within a component no
   further pair is needed, so a family of thousands of near copies costs one
   comparison each, not all pairs.
5. *What is left.*  Lists that still hold several components are joined by
   blocks of set size; a posting's position bounds the overlap, which skips
   the blocks that it cannot reach, and the known distances to a common
   central set skip pairs by the triangle inequality.  Every pair that
   remains is verified exactly.
6. Components of all links.

Tables and shuffle files of a step are deleted as soon as the next one has
been written; what the result reads is a row of hashes and ids a set and a row.

Documents without words have the empty set and link with nothing; with fewer
than ``k`` words the whole sequence is one shingle.  Null texts are empty, a
null id is kept, repeated rows are equal sets, ties between central sets are
broken by size and then by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, blocks, discard, map_arrow, mix, tidy_shuffles, words_of, written
from .components import components

#: Bits of ``Marks`` for each marked set, and at most: 32 MB.
MARK_BITS = 16
MAX_MARKS = 1 << 28
#: Ranges of the 32-bit keys; a counting task holds 2^32 / RANGES counters.
RANGES = 1024
#: Keys that share one bit of the bitmap: 2^32 / 64 bits are 8 MB.
KEYS_PER_BIT = 64
#: Most frequent keys with known counts: 8 MB at most.
HEAVY_KEYS = 1 << 20
HEAVY_COUNT = 8

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, starts, ends, counts = words_of(texts)
    if not len(starts):
        return [np.empty(0, np.uint64)] * len(texts)
    h = Hasher(data).hash(starts, ends)
    n = len(h)
    grams = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k if n >= k else 0):
        grams = grams * _STEP + h[j : n - k + 1 + j]
    grams = mix(grams + np.uint64(k))
    out, at = [], 0
    for c in counts.tolist():
        if c == 0:
            out.append(np.empty(0, np.uint64))
        elif c < k:
            whole = np.zeros(1, np.uint64)
            for w in h[at : at + c]:
                whole = whole * _STEP + w
            out.append(mix(whole + np.uint64(c)))
        else:
            out.append(np.unique(grams[at : at + c - k + 1]))
        at += c
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed longs."""
    a = int(mix(s).sum(dtype=np.uint64)) if len(s) else 0
    b = int(mix(s ^ _STEP).sum(dtype=np.uint64)) if len(s) else 0
    return tuple(x - (1 << 64) if x >> 63 else x for x in (a, b))


def sent_shingles(n: int, percent: int) -> int:
    """How many shingles of a set of ``n`` meet other sets' before it is known whether the set can have a partner."""
    return min(n, n + shared_shingles(n, percent) - (percent * n + 99) // 100)


def shared_shingles(n: int, percent: int) -> int:
    """How many of these any partner has among its own.

    With ``t = percent / 100`` a link of sets x and y has ``c >= ceil(t * max(x, y))`` common shingles.  Where x's part of the
    order ends first, ``c - (x - sent(x)) = c - ceil(t * x) + ceil(t * x / 3)`` of them at least are in both parts.  That
    is ``ceil(t * x / 3)`` or more, and as ``ceil(z) - ceil(z / 3)`` never falls, also ``ceil(t * y / 3)`` or more where y is larger.
    """
    return max(1, -(-percent * n // 300))


#: Least sizes of the classes by which a size is told, the last for all above.
_SIZES = [1]
while _SIZES[-1] < 1 << 31:
    _SIZES.append(max(_SIZES[-1] + 1, _SIZES[-1] * 9 // 8))
_SIZES = np.array(_SIZES)
#: A shingle sent: 32 bits beside its range, and its set (40 bits and the size class); the set of a shingle of several sets is told at once.
_SENT = np.dtype([("key", "<u4"), ("lo", "<u4"), ("hi", "<u2")])
_SET = np.dtype([("lo", "<u4"), ("hi", "<u2")])
_SEVERAL = (1 << 48) - 1


def set_ids(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """40 bits of each set's key and 8 of its size class; sets with one id only count together."""
    cls = np.searchsorted(_SIZES, sizes, "right").astype(np.uint64) - np.uint64(1)
    return (keys & np.uint64((1 << 40) - 1)) | (cls << np.uint64(40))


def _packed(ids: np.ndarray, keys: np.ndarray | None = None) -> np.ndarray:
    out = np.empty(len(ids), _SET if keys is None else _SENT)
    out["lo"], out["hi"] = ids & np.uint64(0xFFFFFFFF), ids >> np.uint64(32)
    if keys is not None:
        out["key"] = keys
    return out


def _ids(packed: np.ndarray) -> np.ndarray:
    return packed["lo"].astype(np.uint64) | (packed["hi"].astype(np.uint64) << np.uint64(32))


def _by_range(parts: np.ndarray, rows: np.ndarray, ranges: int) -> list[bytes | None]:
    """The bytes of ``rows`` of every range, None where there are none."""
    by = np.argsort(parts.astype(np.uint16), kind="stable")
    rows, edges = rows[by], np.searchsorted(parts[by], np.arange(ranges + 1))
    return [rows[a:b].tobytes() if a < b else None for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def _sent_rows(k: int, percent: int, ranges: int, flush: int = 1 << 21):
    low = np.uint64(ranges - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, sizes = [], [], []
        size, seen = 0, set()

        def spread():
            tokens = np.concatenate(held)
            sets = np.repeat(set_ids(np.array(ids, np.int64).view(np.uint64), np.array(sizes)), [len(h) for h in held])
            by = np.argsort(tokens)
            tokens, sets = tokens[by], sets[by]
            same = np.flatnonzero(tokens[1:] == tokens[:-1])
            several = np.zeros(len(tokens), bool)
            several[same] = several[same + 1] = True
            once = np.ones(len(tokens), bool)
            once[same + 1] = False
            told = _by_range(tokens[several] & low, _packed(sets[several]), ranges)
            sets[several] = _SEVERAL
            tokens, sets = tokens[once], sets[once]
            sent = _by_range(tokens & low, _packed(sets, (tokens >> np.uint64(24)) & np.uint64(0xFFFFFFFF)), ranges)
            at = [r for r in range(ranges) if sent[r] is not None]  # a shingle that is told is sent too
            return pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([sent[r] for r in at], pa.binary()), pa.array([told[r] for r in at], pa.binary())], ["part", "sent", "told"]
            )

        for _, _, _, texts in blocks(batches, 0):
            for s in shingle_sets(texts, k):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)  # equal sets count once in a task
                held.append(s[: sent_shingles(len(s), percent)])
                ids.append(key[0])
                sizes.append(len(s))
                size += len(held[-1])
            if size >= flush:
                yield spread()
                held, ids, sizes, size = [], [], [], 0
        if held:
            yield spread()

    return run


def _of_several(sent: np.ndarray) -> np.ndarray:
    """The set ids of those rows of one range whose shingle another set has sent too, once for a shingle and set."""
    by = np.sort((sent["key"].astype(np.uint64) << np.uint64(32)) | np.arange(len(sent), dtype=np.uint64))
    key, ids = by >> np.uint64(32), _ids(sent)[by & np.uint64(0xFFFFFFFF)]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    lengths = np.diff(starts, append=len(key))
    hit = np.repeat(np.logical_or.reduceat(ids != np.repeat(ids[starts], lengths), starts), lengths) & (ids != np.uint64(_SEVERAL))
    key, ids = key[hit], ids[hit]
    by = np.lexsort((ids, key))
    key, ids = key[by], ids[by]
    return ids[np.append(True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]))[: len(ids)]]


def _told_rows(ranges: int, flush: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by range, one range in memory: the sets of shingles that several sets have, by ranges of set ids."""
        now, sent, found, size = None, [], [], 0

        def spread():
            ids = np.concatenate(found)
            data = _by_range(ids & np.uint64(ranges - 1), _packed(ids), ranges)
            at = [r for r in range(ranges) if data[r] is not None]
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([data[r] for r in at], pa.binary())], ["part", "told"])

        for b in batches:
            for part, data, told in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if part != now:
                    if sent:
                        found.append(_of_several(np.concatenate(sent)))
                        size += len(found[-1])
                    now, sent = part, []
                sent.append(np.frombuffer(data.as_buffer(), _SENT).copy())
                if told.is_valid:
                    found.append(_ids(np.frombuffer(told.as_buffer(), _SET)))
                    size += len(found[-1])
                if size >= flush:
                    yield spread()
                    found, size = [], 0
        if sent:
            found.append(_of_several(np.concatenate(sent)))
            size += len(found[-1])
        if size:
            yield spread()

    return run


def _marked_rows(percent: int):
    need = np.array([shared_shingles(int(n), percent) for n in _SIZES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by range: of each range the sets that are told often enough to have a partner."""
        now, held = None, []

        def close():
            ids, n = np.unique(np.concatenate(held), return_counts=True)
            ids = ids[n >= need[(ids >> np.uint64(40)).astype(np.int64)]]
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([ids.tobytes()], pa.binary())], ["part", "n", "ids"])

        for b in batches:
            for part, told in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if part != now:
                    if held:
                        yield close()
                    now, held = part, []
                held.append(_ids(np.frombuffer(told.as_buffer(), _SET)))
        if held:
            yield close()

    return run


def _mark_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The piece of ``Marks`` of each range."""
        for b in batches:
            pieces = []
            for data in b.column(1):
                bits = np.zeros(width, bool)
                for at in _marks(np.frombuffer(data.as_buffer(), np.uint64), width):
                    bits[at] = True
                pieces.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(pieces, pa.binary())], ["part", "bits"])

    return run


def _marks(ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each id in its range's piece."""
    h = mix(ids)
    return tuple((x & np.uint64(width - 1)).astype(np.int64) for x in (h, h >> np.uint64(32)))


class Marks:
    """The sets that can have a partner: all of them and, by chance, some others."""

    def __init__(self, rows, ranges: int, width: int):
        self.ranges, self.width = ranges, width
        self.bits = np.zeros(ranges * width // 8, np.uint8)
        for r in rows:
            self.bits[r.part * width // 8 : (r.part + 1) * width // 8] = np.frombuffer(r.bits, np.uint8)

    def has(self, ids: np.ndarray) -> np.ndarray:
        out, start = np.ones(len(ids), bool), (ids & np.uint64(self.ranges - 1)).astype(np.int64) * self.width
        for at in _marks(ids, self.width):
            at = at + start
            out &= ((self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
        return out


def _marked(src: DataFrame, k: int, percent: int, slots: int, tag: str) -> Marks:
    """``src (t)`` -> the sets that can have a partner."""
    ranges = min(1 << 16, max(RANGES, 1 << (4 * slots - 1).bit_length()))
    by_range = lambda df: df.repartition(min(slots, ranges), "part").sortWithinPartitions("part")
    sent = map_arrow(src, _sent_rows(k, percent, ranges), "part int, sent binary, told binary")
    told = written(map_arrow(by_range(sent), _told_rows(ranges), "part int, told binary"), tag)
    ids = written(map_arrow(by_range(told), _marked_rows(percent), "part int, n bigint, ids binary"), tag)
    discard(told)
    n = ids.agg(F.sum("n")).first()[0] or 0
    width = max(64, min(MAX_MARKS, 1 << max(0, MARK_BITS * n - 1).bit_length()) // ranges)
    marks = Marks(map_arrow(ids.select("part", "ids"), _mark_rows(width), "part int, bits binary").collect(), ranges, width)  # MAX_MARKS bits at most
    discard(ids)
    return marks


def _arrays(sets: list[np.ndarray | None], of: pa.DataType) -> pa.Array:
    """A list column without a detour over Python's numbers."""
    none = np.array([s is None for s in sets], bool)
    offsets = np.append(0, np.cumsum([0 if s is None else len(s) for s in sets])).astype(np.int32)
    values = [s for s in sets if s is not None]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else [], of), mask=pa.array(none))


def _set_rows(k: int, marks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b, at, to, texts in blocks(batches, 1):
            sets = shingle_sets(texts, k)
            n, keys = [len(s) for s in sets], [set_key(s) for s in sets]
            ids = set_ids(np.array([a for a, _ in keys], np.int64).view(np.uint64), np.array(n))
            members = []
            for s, key, marked in zip(sets, keys, marks.value.has(ids).tolist(), strict=True):
                wanted = marked and len(s) > 0 and key not in seen
                if wanted:
                    seen.add(key)
                members.append(s.view(np.int64) if wanted else None)
            a, c = zip(*keys, strict=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, to - at), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(c, pa.int64()), _arrays(members, pa.int64())],
                ["doc", "n", "sid_a", "sid_b", "members"],
            )

    return run


def _sets_of(column: pa.ListArray) -> list[np.ndarray]:
    """The sets of a list column without nulls."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _count_rows(flush: int = 1 << 21):
    shift = 32 - RANGES.bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def spread():
            keys = np.sort(np.concatenate(held))
            edges = np.searchsorted(keys >> np.uint32(shift), np.arange(RANGES + 1))
            at = np.flatnonzero(np.diff(edges))
            data = [keys[edges[r] : edges[r + 1]].tobytes() for r in at]
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(data, pa.binary())], ["part", "keys"])

        for b in batches:
            for s in _sets_of(b.column(0)):
                held.append((s >> np.uint64(32)).astype(np.uint32))
                size += len(s)
                if size >= flush:
                    yield spread()
                    held, size = [], 0
        if held:
            yield spread()

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by range: the bitmap piece and the most frequent keys of each range, one range in memory."""
    width = (1 << 32) // RANGES
    counts = np.zeros(width, np.uint32)

    def close(part: int):
        bits = np.packbits((counts >= 2).reshape(-1, KEYS_PER_BIT).any(axis=1))
        heavy = np.flatnonzero(counts >= HEAVY_COUNT)
        most = HEAVY_KEYS // RANGES
        if len(heavy) > most:
            heavy = np.sort(heavy[np.argpartition(counts[heavy], -most)[-most:]])
        keys = (heavy + part * width).astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([bits.tobytes()], pa.binary()), pa.array([keys.tobytes()], pa.binary()), pa.array([counts[heavy].tobytes()], pa.binary())],
            ["part", "bits", "keys", "counts"],
        )

    now = None
    for b in batches:
        for part, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if part != now:
                if now is not None:
                    yield close(now)
                    counts[:] = 0
                now = part
            keys, n = np.unique(np.frombuffer(data.as_buffer(), np.uint32), return_counts=True)
            counts[keys - np.uint32(part * width)] += n.astype(np.uint32)
    if now is not None:
        yield close(now)


class Order:
    """The global order of shingles: known to be single, then unknown, then by known count."""

    def __init__(self, rows):
        size = (1 << 32) // RANGES // KEYS_PER_BIT // 8
        self.bits = np.zeros(size * RANGES, np.uint8)
        keys, counts = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
        for r in sorted(rows, key=lambda r: r.part):
            self.bits[r.part * size : (r.part + 1) * size] = np.frombuffer(r.bits, np.uint8)
            keys.append(np.frombuffer(r.keys, np.uint32))
            counts.append(np.frombuffer(r.counts, np.uint32))
        self.keys, self.counts = np.concatenate(keys), np.concatenate(counts)

    def rank(self, s: np.ndarray) -> np.ndarray:
        """0 for shingles of this set alone, else 1 or the known number of sets."""
        key = (s >> np.uint64(32)).astype(np.uint32)
        bit = key // np.uint32(KEYS_PER_BIT)
        out = (self.bits[bit >> np.uint32(3)] >> (np.uint32(7) - (bit & np.uint32(7)))) & np.uint32(1)
        if len(self.keys) and out.any():
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out = np.where(self.keys[at] == key, np.maximum(out, self.counts[at]), out)
        return out


def _list_rows(percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of = order.value.rank
        for b in batches:
            at, central, tokens, positions = [], [], [], []
            for i, s in enumerate(_sets_of(b.column(2))):
                n, rank = len(s), rank_of(s)
                prefix = n - (percent * n + 99) // 100 + 1
                if n - np.count_nonzero(rank) < prefix:
                    by = np.argsort(rank, kind="stable")[:prefix]
                    pos = np.flatnonzero(rank[by])
                    at.append(i)
                    central.append(float(np.log1p(rank).mean()))
                    tokens.append(s.view(np.int64)[by[pos]])
                    positions.append(pos.astype(np.int32))
            kept = [b.column(c).take(pa.array(at, pa.int64())) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(central, pa.float64()), _arrays(tokens, pa.int64()), _arrays(positions, pa.int32())], ["node", "n", "central", "tokens", "positions"]
            )

    return run


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs (x, y)`` with both sizes and the exact overlap."""
    a = sets.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("members").alias("sx"))
    b = sets.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("members").alias("sy"))
    return pairs.join(a, "x").join(b, "y").select("x", "y", "nx", "ny", F.size(F.array_intersect("sx", "sy")).cast("long").alias("both"))


def similarity_classes(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 75, tag: str = "jaccard") -> DataFrame:
    """One row per input row: ``key``, ``n_shingles``, ``component_id`` (smallest key reachable by links)."""
    with tidy_shuffles(df.sparkSession):
        rows, classes = _classes(df, key, text, k, percent, tag)
    sid = ["sid_a", "sid_b", "n"]
    found = rows.where("n > 0").join(classes, sid).select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id")
    none = rows.where("n = 0").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"))
    return found.unionByName(none)


def _classes(df: DataFrame, key: str, text: str, k: int, percent: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """The rows ``(doc, sid_a, sid_b, n)`` and the ``component_id`` of every set."""
    spark = df.sparkSession
    sc = spark.sparkContext
    kind = df.schema[key].dataType.simpleString()
    src = df.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    marks = sc.broadcast(_marked(src.select("t"), k, percent, slots, tag))
    every_row = written(
        map_arrow(src, _set_rows(k, marks), f"doc {kind}, n bigint, sid_a bigint, sid_b bigint, members array<bigint>").withColumn("row", F.monotonically_increasing_id()), tag
    )
    marks.destroy()  # used by that pass alone
    sid = ["sid_a", "sid_b", "n"]
    every = written(
        every_row.where("n > 0").groupBy(*sid).agg(F.min("row").alias("node"), F.min("doc").alias("low"), F.first("members", ignorenulls=True).alias("members")), tag
    )
    rows = written(every_row.select("doc", *sid), tag)
    discard(every_row)
    sets = every.where("members IS NOT NULL").select("node", "n", "members")

    parts = map_arrow(sets.select("members"), _count_rows(), "part int, keys binary")
    sums = map_arrow(parts.repartition(min(slots, RANGES), "part").sortWithinPartitions("part"), _sum_rows, "part int, bits binary, keys binary, counts binary")
    order = sc.broadcast(Order(sums.collect()))  # at most RANGES rows of bounded size
    lists = written(map_arrow(sets, _list_rows(percent, order), "node bigint, n bigint, central double, tokens array<bigint>, positions array<int>"), tag)
    order.destroy()

    postings = lists.select("node", "n", "central", F.explode(F.arrays_zip("tokens", "positions")).alias("p")).select("node", "n", "central", F.col("p.tokens").alias("token"), F.col("p.positions").alias("pos"))
    fits = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)

    # the central set that most lists of a set name
    named = postings.groupBy("token").agg(F.max(F.struct("central", "n", "node")).alias("c"), F.count("*").alias("size")).where("size > 1")
    votes = (
        postings.join(named.select("token", F.col("c.node").alias("to"), F.col("c.n").alias("n_to"), F.col("c.central").alias("c_to")), "token")
        .where((F.col("node") != F.col("to")) & fits(F.col("n"), F.col("n_to")))
        .groupBy("node", "to").agg(F.count("*").alias("votes"), F.max("c_to").alias("c_to"))
    )
    first = votes.groupBy("node").agg(F.max(F.struct("votes", "c_to", "to")).alias("v")).select(F.col("node").alias("x"), F.col("v.to").alias("y"))
    linked = 100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))
    first = written(_overlaps(first, sets).withColumn("linked", linked), tag)
    part = components(first.where("linked").select(F.col("x").alias("u"), F.col("y").alias("v")), tag)

    # lists that still hold several components
    far = first.select(F.col("x").alias("node"), F.col("y").alias("to"), (1 - F.col("both") / (F.col("nx") + F.col("ny") - F.col("both"))).alias("dist"))
    place = lists.select("node").join(part, "node", "left").join(far, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "to", "dist")
    placed = written(postings.drop("central").join(place, "node"), tag)
    mixed = placed.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("token")
    open_lists = placed.join(mixed, "token")
    # an overlap that begins at this posting holds n - pos shingles at most, so partners have at most this size
    most = F.floor(((100 + percent) * (F.col("n") - F.col("pos")) - percent * F.col("n")) / percent)
    block = lambda c: F.floor(F.log(c.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    low, high = F.ceil(F.col("n") * percent / 100), F.least(F.floor(F.col("n") * 100 / percent), most)
    near = open_lists.withColumn("low", low).withColumn("high", high).where("high >= low AND high >= 1")
    a = near.select("token", F.explode(F.sequence(block(F.col("low")), block(F.col("high")))).alias("block"), *[F.col(c).alias(f"a_{c}") for c in ("node", "n", "pos", "component", "to", "dist", "low", "high")])
    b = near.select("token", block(F.col("n")).alias("block"), *[F.col(c).alias(f"b_{c}") for c in ("node", "n", "pos", "component", "to", "dist", "low", "high")])
    limit = (100 - percent) / 100 + 1e-9
    pairs = (
        a.join(
            b,
            (a["token"] == b["token"]) & (a["block"] == b["block"]) & (F.col("a_component") < F.col("b_component"))
            & F.col("b_n").between(F.col("a_low"), F.col("a_high")) & F.col("a_n").between(F.col("b_low"), F.col("b_high"))
            & ((100 + percent) * F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos")) >= percent * (F.col("a_n") + F.col("b_n")))
            & ~F.coalesce((F.col("a_to") == F.col("b_to")) & (F.abs(F.col("a_dist") - F.col("b_dist")) > limit), F.lit(False))
            & ~F.coalesce(F.col("a_to") == F.col("b_node"), F.lit(False)) & ~F.coalesce(F.col("b_to") == F.col("a_node"), F.lit(False)),
        )
        .select(F.col("a_node").alias("x"), F.col("b_node").alias("y"))
        .distinct()
    )
    more = _overlaps(pairs, sets).where(linked)
    label = place.select("node", "component")
    joined = (
        more.join(label.select(F.col("node").alias("x"), F.col("component").alias("u")), "x")
        .join(label.select(F.col("node").alias("y"), F.col("component").alias("v")), "y").select("u", "v")
    )
    merged = components(joined, tag)
    discard(placed, first, lists)
    final = every.drop("members").join(part, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    final = final.join(merged.select(F.col("node").alias("c"), F.col("component").alias("top")), "c", "left").withColumn("top", F.coalesce("top", "c"))
    # written, so that the join reads plain shuffles, which the runtime splits where one component has a large share of all sets
    lowest = written(final.groupBy("top").agg(F.min("low").alias("component_id")), tag)
    classes = written(final.join(lowest, "top").select(*sid, "component_id"), tag)
    discard(every, lowest)
    return rows, classes
