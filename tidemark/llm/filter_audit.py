"""How filters interact: what each removes, repeats or loses, in every order.

A document gets a mask of the filters that it fails.  The text filters are
row-local; the duplicate filter compares whole texts by radix tries
(``text_trie``), never by a hash:

1. every task folds its own copies in a trie and writes one row a distinct text
   (``ref``: task and number), with its filters, its smallest id and its rows;
2. texts are dealt to partitions by adaptive prefixes and put into tries that
   hold the smallest id at each terminal; of a text that several tasks
   have, the references come back with the smallest id of all;
3. rows whose id is larger than that fail the duplicate filter; labels are
   joined by id, and masks are counted per part.

The counts of at most 32 masks a part then answer every order and step.

A null text is empty, a null part the empty string.  A null id neither fails the
duplicate filter nor makes another fail; rows with equal ids and texts don't
fail by each other.  Of repeated labels any 1 counts.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written
from .text_trie import Cut, TextTrie, cut

_NOT_FIRST = bytes(range(0x80, 0xC0))  # bytes of a code point after its first one
_CAPITALS = bytes(range(65, 91))
_MARKS = re.compile(rb"[#$%&*|]")

#: Text filters: whether a text (UTF-8) with these words fails.
FILTERS: dict[str, Callable[[bytes, list[bytes]], bool]] = {
    "A": lambda t, w: len(w) < 50,
    "B": lambda t, w: 100 * len(set(w)) < 65 * len(w),
    "C": lambda t, w: 100 * (len(t) - len(t.translate(None, _CAPITALS))) > 5 * len(t.translate(None, _NOT_FIRST)),
    "D": lambda t, w: _MARKS.search(t) is not None,
}
#: The letter of the duplicate filter.
DUPLICATE = "E"

#: A task folds copies among so many bytes of text or rows, then starts a new trie.
FOLD_BYTES, FOLD_ROWS = 32 << 20, 100_000


def folded(df: DataFrame, doc_id: str, part: str, text: str, filters: dict = FILTERS) -> DataFrame:
    """``(ref, text, low, fails, members)``: one row a distinct text and fold, ``members`` its rows ``(doc_id, part)``."""
    rows = df.select(F.col(text).cast("binary").alias("text"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    tests = list(filters.values())

    def fold(batches):
        number = TaskContext.get().partitionId() << 33
        trie, held = TextTrie(), 0

        def out():
            nonlocal number, trie, held
            found, size = [], 0
            for node in trie.terminals():
                found.append(node)
                size += len(node.seen[0][0])
                if size > 1 << 20:
                    yield batch(found)
                    found, size = [], 0
            if found:
                yield batch(found)
            trie, held = TextTrie(), 0

        def batch(nodes):
            nonlocal number
            texts = [n.seen[0][0] for n in nodes]
            fails = []
            for t in texts:
                words = t.split()  # ASCII white space
                fails.append(sum(1 << i for i, test in enumerate(tests) if test(t, words)))
            sizes = np.array([len(n.seen) for n in nodes])
            ids = pa.array([s[1] for n in nodes for s in n.seen], pa.int64())
            parts = pa.array([s[2] for n in nodes for s in n.seen], pa.string())
            members = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.StructArray.from_arrays([ids, parts], ["doc_id", "part"]))
            refs = pa.array(np.arange(number, number + len(nodes)))
            number += len(nodes)
            return pa.RecordBatch.from_arrays(
                [refs, pa.array(texts, pa.binary()), pa.array([n.low for n in nodes], pa.int64()), pa.array(fails, pa.int32()), members],
                ["ref", "text", "low", "fails", "members"])

        for b in batches:
            for t, i, p in zip(*(c.to_pylist() for c in b.columns)):
                t = t or b""
                node = trie.insert(t, i)
                node.seen.append((t if not node.seen else None, i, p))
                held += 1
            if trie.bytes > FOLD_BYTES or held > FOLD_ROWS:
                yield from out()
        yield from out()

    return map_arrow(rows, fold, "ref long, text binary, low long, fails int, members array<struct<doc_id: long, part: string>>")


def smallest_ids(texts: DataFrame, target: int | None = None) -> DataFrame:
    """``(ref, low_all)`` of the texts ``(ref, text, low)`` that occur under more than one ``ref``.

    ``target``: bytes of text in a partition's tries; by default what the
    session's shuffle partitions make of the total, between 1 and 256 MB.
    """
    spark = texts.sparkSession
    if target is None:
        total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
        target = min(256 << 20, max(1 << 20, total // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    plan: Cut = cut(texts.select("text"), target)

    def deal(batches):
        for b in batches:
            refs, body, lows = (c.to_pylist() for c in b.columns)
            nodes, parts, rest = [], [], []
            for t in body:
                node, _, part = plan.route(t)
                nodes.append(node)
                parts.append(part)
                rest.append(t[plan.depth[node]:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(nodes, pa.int32()), pa.array(rest, pa.binary()), pa.array(refs, pa.int64()), pa.array(lows, pa.int64())],
                ["slot", "node", "rest", "ref", "low"])

    def build(batches):
        tries: dict[int, TextTrie] = {}
        for b in batches:
            for node, rest, ref, low in zip(*(c.to_pylist() for c in b.columns[1:])):
                tries.setdefault(node, TextTrie()).insert(rest, low).seen.append(ref)
        refs, lows = [], []
        for trie in tries.values():
            for t in trie.terminals():
                if len(t.seen) > 1:
                    refs += t.seen
                    lows += [t.low] * len(t.seen)
        for at in range(0, len(refs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(refs[at:at + 100_000], pa.int64()), pa.array(lows[at:at + 100_000], pa.int64())], ["ref", "low_all"])

    dealt = map_arrow(texts.select("ref", "text", "low"), deal, "slot int, node int, rest binary, ref long, low long")
    return map_arrow(dealt.repartitionById(max(1, plan.partitions), "slot"), build, "ref long, low_all long")


def masks(df: DataFrame, doc_id: str = "doc_id", part: str = "source", text: str = "text", filters: dict = FILTERS, target: int | None = None) -> DataFrame:
    """``(doc_id, part, mask)`` of every row; bit i: it fails the i-th filter, the last bit: the duplicate filter."""
    texts = written(folded(df, doc_id, part, text, filters), "audit-texts")
    low = smallest_ids(texts, target)
    rows = texts.select("ref", "low", "fails", "members").join(low, "ref", "left")
    each = rows.select("fails", F.coalesce("low_all", "low").alias("low"), F.explode("members").alias("m"))
    copy = F.when(F.col("m.doc_id") > F.col("low"), F.lit(1 << len(filters))).otherwise(0)
    return each.select("m.doc_id", "m.part", (F.col("fails") + copy).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(part, mask, n, good, toxic)``: rows, and those labelled so."""
    known = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic"))
    return rows.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def interactions(counts: DataFrame, letters: str = "".join(FILTERS) + DUPLICATE) -> DataFrame:
    """Per part, order of the filters and step: what is kept, removed, redundant, failed by this filter alone, lost."""
    k = len(letters)
    orders = list(permutations(range(k)))
    names = ["".join(letters[i] for i in o) for o in orders]
    each = np.arange(1 << k)
    fails = np.array([each >> i & 1 for i in range(k)], bool)
    before, here = [], []  # masks that a step meets, and removes
    for o in orders:
        left = np.ones(1 << k, bool)
        for i in o:
            here.append(left & fails[i])
            before.append(left)
            left = left & ~fails[i]
    here, before = np.array(here, np.int64), np.array(before, np.int64)
    which = np.array([i for o in orders for i in o])
    failing, alone = fails[which].astype(np.int64), (each[None, :] == 1 << which[:, None]).astype(np.int64)

    def expand(batches):
        for b in batches:
            for part, found in zip(*(c.to_pylist() for c in b.columns)):
                n = np.zeros((3, 1 << k), np.int64)
                for x in found:
                    n[:, x["mask"]] += (x["n"], x["good"], x["toxic"])
                removed = here @ n[0]
                whole = np.array([removed[which == i].sum() for i in range(k)])
                out = [before @ n[0] - removed, removed, failing @ n[0] - removed, alone @ n[0], here @ n[1], here @ n[2], whole[which]]
                size = len(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * size, pa.string()), pa.array([x for x in names for _ in range(k)]), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(orders)))]
                    + [pa.array(x) for x in out],
                    ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])

    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))  # a mask each, 32 at most
    return map_arrow(parts, expand, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")


def audit(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", part: str = "source", text: str = "text", filters: dict = FILTERS, target: int | None = None) -> DataFrame:
    """The interactions of ``filters`` and the duplicate filter over ``df``; labels ``(doc_id, quality, toxic)``."""
    return interactions(mask_counts(masks(df, doc_id, part, text, filters, target), labels, doc_id), "".join(filters) + DUPLICATE)
