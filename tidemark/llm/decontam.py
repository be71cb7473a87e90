"""Benchmark decontamination by template canonicalisation.

A word without outer punctuation is one token.  Numbers, names (title-case
words) and units become typed placeholders, other words stay literal (A-Z
lowered), so a question keeps its template when its parameters change.
Windows of template tokens are hashed and joined between benchmark items and
documents, and beside them, with another seed, plain windows of the lowered
words themselves: a case-changed copy has other placeholders but the same
words.  Either kind covers a position of the item; plain windows need no
literal tokens and no slot check.  Along one alignment (document position minus item position) the
slots must be consistent: the document value of a benchmark value is the one
that most of its places have (of equally many the unchanged one, else none),
and windows with another value don't count.  Unchanged windows always do.  An item leaks into a document when consistent windows make up
``min_share`` of the item's template windows (of its plain ones, where it has
no template window), or when one alignment has a run of consecutive consistent
windows over ``min_run`` tokens, however long the item is; the leak is ``exact`` if every slot kept its value, else
``reparameterised``.

Items with fewer tokens than a window are one window of their own length;
items with fewer than ``min_tokens`` tokens match nothing.  A template window needs
``min_literal`` literal tokens (a short item: half of its tokens).  Null and empty texts have no
windows.  Rows with equal document ids are judged together, a null id is an
id of its own; repeated items are one item.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Hasher, blocks, map_arrow, mix, words_of

UNITS = (
    "kg g mg lb lbs oz t km m cm mm mi mile miles ft foot feet inch inches yd l ml gallon gallons "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degrees celsius fahrenheit kelvin dollars dollar euros euro cents pounds yen "
    "meter meters metre metres kilometer kilometers gram grams kilogram kilograms liter liters litre litres watts volts mph kmh"
).split()

#: Windows of the benchmark up to this number are a bitmap in every task; beyond it the join alone decides.
BITMAP_WINDOWS = 1 << 22
BITMAP_BITS = 24

_CLASS = np.zeros(256, np.uint8)  # 1 digit, 2 upper, 4 lower or not ASCII
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[97:123] = 4
_CLASS[128:] = 4
_NUM, _NAME, _UNIT = (np.uint64(x) for x in (0xA11CE5EED0000001, 0xA11CE5EED0000002, 0xA11CE5EED0000003))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_PLAIN = np.uint64(0x5EED0000B10C0DE5)  # seed of the plain windows


def _unit_hashes() -> np.ndarray:
    data, s, e, _ = words_of([" ".join(UNITS).encode()])
    return np.sort(Hasher(data).hash(s, e))


_UNIT_HASHES = _unit_hashes()


def templates(texts: list[bytes]):
    """``(codes, values, literal, counts)`` of all tokens: template codes, value hashes, whether literal, tokens per text."""
    raw, s, e, counts = words_of(texts, lower=False)
    n = len(raw)
    if not len(s):
        return np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool), np.zeros(len(texts), np.int64)
    kind = _CLASS[raw]
    place = np.arange(n)
    after = np.minimum.accumulate(np.where(kind > 0, place, n)[::-1])[::-1]
    before = np.maximum.accumulate(np.where(kind > 0, place, -1))
    first, last = after[s], before[e - 1] + 1
    real = first < last
    real &= (first < e) & (last > s)
    text = np.repeat(np.arange(len(texts)), counts)[real]
    s, e = first[real], last[real]
    lowered = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    values = Hasher(lowered).hash(s, e)
    upper = np.zeros(n + 1, np.int32)
    np.cumsum(kind == 2, out=upper[1:])
    number = kind[s] == 1
    name = (kind[s] == 2) & (upper[e] - upper[s] == 1) & (e - s > 1)
    unit = _UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, values), len(_UNIT_HASHES) - 1)] == values
    codes = np.where(number, _NUM, np.where(name, _NAME, np.where(unit, _UNIT, values)))
    return codes, values, ~(number | name | unit), np.bincount(text, minlength=len(texts))


def _windows(codes: np.ndarray, literal: np.ndarray, width: int, least: int, seed: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of the windows with ``least`` literal tokens."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = h * _STEP + codes[j : j + n]
    have = np.cumsum(np.concatenate([[0], literal]))
    at = np.flatnonzero(have[width:] - have[:-width] >= least)
    return at, mix((h[at] + np.uint64(width)) ^ seed)


def window_rows(df: DataFrame, key: str, text: str, width: int, least: int, min_tokens: int, items: bool, lengths: list[int] | None = None, bitmap=None) -> DataFrame:
    """``id, hash, pos, total, plain, counted, slots, places``: the template and the plain windows of every text.

    Of an item (``items``): its windows, or the whole of a short one.  Of a
    document: windows of ``width`` and of each of the short ``lengths``, only
    those that the bitmap, if any, lets through.  ``slots`` are the value hashes of
    the placeholders in order, ``places`` their positions; ``total`` is the number of positions that count
    for the share: those of template windows, without any those of plain ones.
    """
    src = df.select(F.col(key).alias("id"), F.col(text).alias("t"))
    types = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = ["id", "hash", "pos", "total", "plain", "counted", "slots", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = bitmap.value if bitmap is not None else None
        for b, at, to, texts in blocks(batches, 1):
            codes, values, literal, counts = templates(texts)
            edges = np.concatenate([[0], np.cumsum(counts)])
            owner, rows = [], tuple([] for _ in types)
            all_windows = []  # width, whether plain, starts, hashes, texts, total, whether counted
            both = lambda w, span: (
                (False, *_windows(codes[span], literal[span], w, least if w == width else (w + 1) // 2)),
                (True, *_windows(values[span], literal[span], w, 0, _PLAIN)),
            )
            if not items:  # hashed over the block at once, windows across texts are dropped below
                for w in {width, *(lengths or ())}:
                    for plain, p, h in both(w, slice(None)):
                        doc = np.searchsorted(edges, p, side="right") - 1
                        good = p + w <= edges[doc + 1]
                        if passes is not None:
                            bit = h >> np.uint64(64 - BITMAP_BITS)
                            good &= (passes[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                        p = p[good]
                        all_windows.append((w, plain, p, h[good], doc[good], len(p), np.ones(len(p), bool)))
            for i in range(len(texts) if items else 0):
                n = int(counts[i])
                if n < min_tokens:
                    continue
                w = min(n, width)
                (_, p, _), (_, every, _) = found = both(w, slice(edges[i], edges[i + 1]))
                positions = p if len(p) else every
                for plain, x, h in found:
                    all_windows.append((w, plain, x + edges[i], h, np.full(len(x), i), len(positions), np.isin(x, positions)))
            for w, plain, p, h, doc, total, counted in all_windows:
                for x, y, i, c in zip(p.tolist(), h.view(np.int64).tolist(), doc.tolist(), counted.tolist(), strict=True):
                    slot = np.flatnonzero(~literal[x : x + w]) + x
                    owner.append(at + i)
                    for row, v in zip(rows, (y, x - int(edges[i]), total, plain, c, values[slot].view(np.int64), slot - edges[i]), strict=True):
                        row.append(v)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), *[pa.array(r, t) for r, t in zip(rows, types, strict=True)]], names)

    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, run, f"id {kind}, hash bigint, pos int, total int, plain boolean, counted boolean, slots array<bigint>, places array<int>")


def consistent(windows: list[dict]) -> dict[int, tuple[bool, int]]:
    """``position: (whether it counts, whether unchanged)`` of the consistent windows of one alignment."""
    places = {}  # each place votes once, however many windows hold it
    for w in windows:
        for place, b, d in zip(w["places"], w["item_slots"], w["item_slots"] if w["plain"] else w["slots"], strict=True):
            places[place, d] = b
    votes = defaultdict(Counter)
    for (_, d), b in places.items():
        votes[b][d] += 1
    value = {}
    for b, n in votes.items():
        most = [d for d, k in n.items() if k == max(n.values())]
        value[b] = most[0] if len(most) == 1 else b if b in most else None
    out = {}
    for w in windows:
        if w["same"] or all(value[b] == d for b, d in zip(w["item_slots"], w["slots"], strict=True)):
            out[w["item_pos"]] = w["counted"], max(w["same"], out.get(w["item_pos"], (False, 0))[1])
    return out


def longest_run(positions: Iterable[int]) -> int:
    """The most consecutive positions."""
    best = run = 0
    last = None
    for p in sorted(positions):
        run = run + 1 if last is not None and p == last + 1 else 1
        best, last = max(best, run), p
    return best


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int32(), pa.bool_(), pa.int64(), pa.int32()]
    for b in batches:
        owner, rows = [], ([], [], [], [])
        for at in range(b.num_rows):
            found = consistent(b.column(3)[at].as_py())
            run = longest_run(found)
            for pos, (counted, same) in found.items():
                owner.append(at)
                for row, v in zip(rows, (pos, counted, same, run), strict=True):
                    row.append(v)
        take = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays([*[b.column(i).take(take) for i in range(3)], *[pa.array(r, t) for r, t in zip(rows, types, strict=True)]], ["doc", "item", "n_item_windows", "item_pos", "counted", "same", "run"])


def leaks(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 8, min_literal: int = 4, min_tokens: int = 4, min_share: float = 0.5, min_run: int = 13,
) -> DataFrame:
    """One row per document and item that leaks into it: ``key, item, n_windows, n_item_windows, n_exact, kind``."""
    spark = docs.sparkSession
    wanted = window_rows(benchmark, item, item_text, width, min_literal, min_tokens, True).dropDuplicates(["id", "hash", "pos"])
    wanted = wanted.select(F.col("id").alias("item"), "hash", F.col("pos").alias("item_pos"), F.col("total").alias("n_item_windows"), "plain", "counted", F.col("slots").alias("item_slots"), "places").cache()
    try:
        # the lengths of short items, width - min_tokens different ones at most
        n_tokens = F.size(F.expr(f"filter(split(coalesce(`{item_text}`, ''), '[ \\\\t-\\\\r]+'), w -> w rlike '[A-Za-z0-9]|[^\\\\x00-\\\\x7F]')"))
        short = benchmark.select(n_tokens.alias("n")).where(F.col("n").between(min_tokens, width - 1)).distinct()
        lengths = sorted(r.n for r in short.collect())
        bitmap = None
        if wanted.count() <= BITMAP_WINDOWS:
            bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
            for r in wanted.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).alias("bit")).distinct().toLocalIterator():
                bits[r.bit >> 3] |= np.uint8(1 << (r.bit & 7))
            bitmap = spark.sparkContext.broadcast(bits)
    finally:
        wanted.unpersist()
    found = window_rows(docs, key, text, width, min_literal, min_tokens, False, lengths, bitmap).select(F.col("id").alias("doc"), "hash", "pos", "slots").dropDuplicates(["doc", "hash", "pos"])
    hits = found.join(wanted, "hash").withColumn("shift", F.col("pos") - F.col("item_pos")).withColumn("same", (F.col("plain") | (F.col("slots") == F.col("item_slots"))).cast("long"))

    # an alignment has as many windows as the item at most
    windows = F.collect_list(F.struct("item_pos", "plain", "counted", "same", "slots", "item_slots", "places"))
    lines = hits.groupBy("doc", "item", "shift").agg(windows.alias("windows"), F.max("n_item_windows").alias("n_item_windows")).select("doc", "item", "n_item_windows", "windows")
    kinds = [hits.schema[c].dataType.simpleString() for c in ("doc", "item")]
    sound = map_arrow(lines, _judged, f"doc {kinds[0]}, item {kinds[1]}, n_item_windows int, item_pos int, counted boolean, same bigint, run int")
    per_window = sound.groupBy("doc", "item", "item_pos").agg(F.max("same").alias("same"), F.max("n_item_windows").alias("n_item_windows"), F.max("counted").alias("counted"), F.max("run").alias("run"))
    per_item = per_window.groupBy("doc", "item").agg(
        F.count_if("counted").alias("n_windows"), F.max("n_item_windows").cast("long").alias("n_item_windows"),
        F.coalesce(F.sum(F.when(F.col("counted"), F.col("same"))), F.lit(0)).alias("n_exact"), F.min("same").alias("all_same"), F.max("run").alias("run"),
    )
    out = per_item.where((F.col("n_windows") >= min_share * F.col("n_item_windows")) | (F.col("run") >= max(min_run - width + 1, 1)))
    return out.select(
        F.col("doc").alias(key), F.col("item").alias(item), "n_windows", "n_item_windows", "n_exact",
        F.when(F.col("all_same") == 1, "exact").otherwise("reparameterised").alias("kind"),
    )
