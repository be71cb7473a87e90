"""Conversation prefixes as a z-fast trie of turns.

A conversation is a path of turns, each turn a hash; a prefix is known by the
hash of its turns (128 bits, collisions are not checked).  The trie holds
compacted nodes only: the root, every prefix where a conversation ends and
every prefix where two go apart.  A node's edge spans the depths ``(low,
extent]``; it is found under two keys, the prefix hash at its handle (the
2-fattest number of that span) and the one at its first turn.

``locate`` finds where conversations leave the trie by fat binary search:
each round looks up the prefix at the 2-fattest depth of what is left of the
search, so paths of n turns take log2(n) joins.  ``insert`` takes a batch of
distinct conversations: those that leave the trie inside an edge split it;
the parts beyond their exits become new edges.  Among the batch's own new
prefixes a node is one that ends a conversation or has two different next
turns, and along an edge all prefixes have the same smallest conversation, so
two aggregations (by prefix, by smallest conversation) give the new edges.

Copies are folded before they are inserted, joins have one row a key on one
side, and all aggregations have partial sums, so a turn or a conversation
that a third of all rows share is no hot spot.  A conversation's turns are held
as one row of 16-byte hashes; texts are read once and never collected.

Rows without a conversation id belong to no conversation.  Turns are ordered by
number (null first), ties by role and text; a null role or text is empty.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, written

ROOT = bytes(16)
#: Batches by share of the distinct conversations; each is located in the trie of those before it.
BATCHES = (0.125, 0.875)
_EDGE = "array<struct<hash: binary, words: int>>"
_NODE = f"id binary, extent int, low int, parent binary, rep long, edge {_EDGE}, first binary, handle binary"


def fattest(low: int, high: int) -> int:
    """The number in ``(low, high]`` with the most trailing zero bits."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


def _fattest(low: str, high: str):
    """``fattest`` of two columns."""
    bits = f"length(bin({low} ^ {high})) - 1"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _hash_at(d, path: str = "path"):
    """The prefix hash at depth ``d`` of a path (null beyond its end)."""
    d = d if not isinstance(d, int) else F.lit(d)
    return F.when(d == 0, F.lit(ROOT)).when(d > 0, F.try_element_at(F.col(path), d)["hash"])


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation has from its family's first one."""
    return zlib.crc32(str(conv_id).encode()) % 4


# ---------------------------------------------------------------- conversations
def turn_lists(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: each conversation's turns in order, as hash and number of words."""
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), role_.alias("role"), text_.alias("text"))

    def short(batches):
        for b in batches:
            roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
            hashes, words = [], []
            for r, t in zip(roles, texts):
                t, r = t.encode(), r.encode()
                hashes.append(hashlib.blake2b(b"%d:%s" % (len(r), r) + t, digest_size=16).digest())
                words.append(len(t.split()))
            order = [r.encode() + b"\\0" + t.encode()[:64] for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(order, pa.binary()), pa.array(hashes, pa.binary()), pa.array(words, pa.int32())], ["conv_id", "turn", "tie", "hash", "words"])

    slim = map_arrow(rows, short, "conv_id long, turn long, tie binary, hash binary, words int")
    one = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "tie", "hash", "words"))).alias("all"))
    return one.select("conv_id", F.transform("all", lambda x: F.struct(x["hash"].alias("hash"), x["words"].alias("words"))).alias("turns"))


def rebuilt(turns: DataFrame, family: int = 20) -> DataFrame:
    """``(conv_id, path)`` of prefix hashes: the first h turns of the family's first conversation, then the own ones after h."""
    base = turns.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base_id"), F.slice("turns", 1, 3).alias("head"))
    both = turns.join(base, F.col("conv_id") - F.pmod("conv_id", F.lit(family)) == F.col("base_id"), "left").select("conv_id", "turns", "head")

    def paths(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            out = []
            for c, own, head in zip(ids, b.column(1).to_pylist(), b.column(2).to_pylist()):
                h, at, path = shared_turns(c), ROOT, []
                for t in (head or [])[:h] + own[h:]:
                    at = hashlib.blake2b(at + t["hash"], digest_size=16).digest()
                    path.append({"hash": at, "words": t["words"]})
                out.append(path)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.struct([("hash", pa.binary()), ("words", pa.int32())])))], ["conv_id", "path"])

    return map_arrow(both, paths, f"conv_id long, path {_EDGE}")


def distinct(paths: DataFrame) -> DataFrame:
    """``(id, conv_id, n_convs, path)``: one row a distinct conversation, under its smallest id."""
    end = _hash_at(F.size("path"))
    per = paths.select(end.alias("id"), "conv_id").groupBy("id").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    return per.join(paths, "conv_id").select("id", "conv_id", "n_convs", "path")


def end_digests(paths: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """``(id, ends_sha256)``: the digest of the ascending ids of the conversations that end at each prefix.

    Ids are written into strings of about ``chunk`` bytes where they lie sorted;
    one pass a prefix then hashes its strings in order, without holding them.
    """
    rows = paths.select(_hash_at(F.size("path")).alias("id"), "conv_id")
    dealt = rows.repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")

    def join(batches):
        now, first, ids, size, out = None, 0, [], 0, []
        for b in batches:
            for key, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if key != now or size > chunk:
                    if ids:
                        out.append((now, first, ",".join(ids)))
                    now, first, ids, size = key, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            yield from flush(out)
            out = []
        if ids:
            out.append((now, first, ",".join(ids)))
        yield from flush(out)

    def flush(out):
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out])], ["id", "first", "ids"])

    def digest(batches):
        now, h, out = None, None, []
        for b in batches:
            for key, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if key != now:
                    if h:
                        out.append((now, h.hexdigest()))
                    now, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], ["id", "ends_sha256"])
            out = []
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([h.hexdigest()])], ["id", "ends_sha256"])

    strings = map_arrow(dealt, join, "id binary, first long, ids string")
    return map_arrow(strings.repartition("id").sortWithinPartitions("id", "first"), digest, "id binary, ends_sha256 string")


# ------------------------------------------------------------------------- trie
def empty_trie(spark) -> DataFrame:
    """The root alone."""
    return spark.createDataFrame([(ROOT, 0, -1, None, None, [], None, ROOT)], _NODE)


def locate(trie: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """Where conversations ``(id, conv_id, path)`` leave the trie: adds ``at`` (the lowest node on the path: its
    extent), ``exit`` (the node in whose edge the path ends or goes apart, null: none) and ``depth`` (turns in common)."""
    state = convs.select("id", "conv_id", "path", F.lit(0).alias("low_"), F.size("path").alias("high_"))
    keys = trie.where("extent > 0").select(F.col("handle").alias("h_"), F.col("extent").alias("e_"), F.col("id").alias("n_"))
    for _ in range(longest.bit_length()):
        asked = state.withColumn("f_", F.when(F.col("low_") < F.col("high_"), _fattest("low_", "high_")))
        found = asked.withColumn("k_", _hash_at(F.col("f_"))).join(keys, F.col("k_") == F.col("h_"), "left")
        on_path = F.col("n_").isNotNull() & _hash_at(F.col("e_")).eqNullSafe(F.col("n_"))
        # a key that isn't there, or whose edge the path leaves: all nodes on the path lie above
        state = found.select(
            "id", "conv_id", "path", F.when(on_path, F.col("e_")).otherwise(F.col("low_")).alias("low_"),
            F.when(F.col("f_").isNull() | on_path, F.col("high_")).otherwise(F.col("f_") - 1).alias("high_"))
    low = F.col("low_")
    edges = trie.where("extent > 0").select(F.col("first").alias("f_"), F.col("id").alias("exit"), F.col("edge").alias("edge_"))
    out = state.withColumn("k_", _hash_at(low + 1)).join(edges, F.col("k_") == F.col("f_"), "left")
    pairs = F.arrays_zip(F.slice("path", low + 1, F.size("path")).alias("a"), F.coalesce("edge_", F.array().cast(_EDGE)).alias("b"))
    same = F.size(F.filter(pairs, lambda x: x["a"]["hash"] == x["b"]["hash"]))  # prefix hashes agree up to where the paths part
    return out.select("id", "conv_id", "path", low.alias("at"), "exit", (low + same).alias("depth"))


def _nodes(rows: DataFrame) -> DataFrame:
    """Node rows from ``(rep, top, base, path, low, extent)``: ``path`` begins below depth ``top``, where the hash is ``base``."""
    at = lambda d: F.when(d == F.col("top"), F.col("base")).otherwise(F.try_element_at(F.col("path"), d - F.col("top"))["hash"])
    low, extent = F.col("low"), F.col("extent")
    return rows.select(
        at(extent).alias("id"), "extent", "low", at(low).alias("parent"), "rep", F.slice("path", low - F.col("top") + 1, extent - low).alias("edge"),
        at(low + 1).alias("first"), at(_fattest("low", "extent")).alias("handle"))


def _spans(start, ends):
    """``(low, extent)`` of the edges between ascending depths."""
    return F.transform(ends, lambda d, i: F.struct(F.when(i == 0, start).otherwise(F.try_element_at(ends, i)).alias("low"), d.alias("extent")))


def insert(trie: DataFrame, convs: DataFrame, longest: int) -> DataFrame:
    """The trie with a batch of distinct conversations ``(id, conv_id, path)``."""
    where = written(locate(trie, convs, longest), "trie-exits")
    size = F.size("path")
    # prefixes beyond the exits: a node ends a conversation or has two next turns
    beyond = where.where(F.col("depth") < size).select(
        "conv_id", F.posexplode(F.transform(F.sequence(F.col("depth") + 1, size), lambda d: F.struct(
            d.alias("d"), _hash_at(d).alias("hash"), _hash_at(d + 1).alias("next")))).alias("i", "p")).select("conv_id", "p.*")
    prefixes = beyond.groupBy("hash", "d").agg(
        F.min("conv_id").alias("rep"), F.min("next").alias("a"), F.max("next").alias("b"), F.max(F.col("next").isNull()).alias("ends"))
    is_node = F.col("ends") | (F.col("a") != F.col("b"))
    per = prefixes.groupBy("rep").agg((F.min("d") - 1).alias("start"), F.sort_array(F.collect_list(F.when(is_node, F.col("d")))).alias("nodes"))
    fresh = per.join(where.select(F.col("conv_id").alias("rep"), "path"), "rep").select("rep", "path", F.explode(_spans(F.col("start"), F.col("nodes"))).alias("s"))
    fresh = fresh.select("rep", F.lit(0).alias("top"), F.lit(ROOT).alias("base"), "path", "s.low", "s.extent")
    # edges that conversations leave or end inside
    cuts = where.where(F.col("exit").isNotNull() & (F.col("depth") > F.col("at"))).groupBy(F.col("exit").alias("id")).agg(F.collect_set("depth").alias("cuts"))
    old = trie.join(cuts, "id", "left")
    kept = old.where(F.col("cuts").isNull()).drop("cuts")
    inner = F.array_sort(F.filter("cuts", lambda d: (d > F.col("low")) & (d < F.col("extent"))))
    split = old.where(F.col("cuts").isNotNull()).select(
        "rep", F.col("low").alias("top"), F.col("parent").alias("base"), F.col("edge").alias("path"), F.explode(_spans(F.col("low"), F.concat(inner, F.array("extent")))).alias("s"))
    split = split.select("rep", "top", "base", "path", "s.low", "s.extent")
    return kept.unionByName(_nodes(split)).unionByName(_nodes(fresh))


def build(convs: DataFrame, batches=BATCHES) -> DataFrame:
    """The trie of distinct conversations ``(id, conv_id, path)``, inserted batch by batch."""
    longest = convs.agg(F.max(F.size("path"))).first()[0] or 0
    trie, low = empty_trie(convs.sparkSession), 0.0
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)
    for share in batches:
        trie = written(insert(trie, convs.where((draw >= low) & (draw < low + share)), longest), "trie")
        low += share
    return trie


# ------------------------------------------------------------------- statistics
def subtree_totals(trie: DataFrame, convs: DataFrame) -> DataFrame:
    """Node rows with ``conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` and the saved tokens of the subtree (``saved``).

    Sums over subtrees by pointer doubling: after round k a node has the sums of
    its descendants less than 2^k edges away and knows its ancestor 2^k edges up.
    """
    ends = convs.select("id", "n_convs", "conv_id")
    children = trie.where("extent > 0").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    now = trie.select("id", "extent", F.when(F.col("extent") > 0, F.col("parent")).alias("up")).join(ends, "id", "left").join(children, "id", "left").select(
        "id", "up", F.col("conv_id").alias("low_id"), F.coalesce("n_convs", F.lit(0)).alias("n"),
        F.col("n_children").isNull().cast("long").alias("leaves"), F.coalesce("n_children", F.lit(0)).alias("n_children"))
    now = _doubled(written(now, "trie-totals"), {"low_id": F.min, "n": F.sum, "leaves": F.sum})
    counted = written(trie.join(now.withColumnRenamed("low_id", "conv_id"), "id").withColumnRenamed("n", "n_convs").withColumnRenamed("leaves", "n_leaves"), "trie-counts")
    words = F.aggregate("edge", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    saved = counted.select("id", F.when(F.col("extent") > 0, F.col("parent")).alias("up"), ((F.col("n_convs") - 1) * words).alias("saved"))
    return counted.join(_doubled(written(saved, "trie-saved"), {"saved": F.sum}).select("id", "saved"), "id")


def _doubled(now: DataFrame, sums: dict) -> DataFrame:
    while now.where(F.col("up").isNotNull()).limit(1).count():
        give = now.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("id")).agg(*[f(c).alias(f"g_{c}") for c, f in sums.items()])
        merged = {c: F.least(c, f"g_{c}") if f is F.min else F.col(c) + F.coalesce(f"g_{c}", F.lit(0)) for c, f in sums.items()}
        kept = [c for c in now.columns if c not in sums and c != "up"]
        summed = now.join(give, "id", "left").select(*kept, "up", *[v.alias(c) for c, v in merged.items()])
        above = now.select(F.col("id").alias("a_"), F.col("up").alias("up2_"))
        deep = summed.where(F.col("up") != F.lit(ROOT)).join(above, F.col("up") == F.col("a_")).drop("a_", "up").withColumnRenamed("up2_", "up")
        top = summed.where(F.col("up").isNull() | (F.col("up") == F.lit(ROOT))).withColumn("up", F.lit(None).cast("binary"))
        now = written(deep.unionByName(top), "trie-doubled")
    return now


def expanded(totals: DataFrame, digests: DataFrame) -> DataFrame:
    """One row a prefix: every edge's depths, with the statistics of its node."""
    above = totals.select(F.col("id").alias("p_"), F.col("conv_id").alias("above_"))
    rows = totals.join(digests, "id", "left").join(above, F.col("parent") == F.col("p_"), "left")
    own = F.col("n_convs") - 1
    # saved holds the edge's own turns too; prefix d of the edge has those of d and below
    steps = F.transform("edge", lambda x, i: F.struct((F.col("low") + i + 1).alias("depth"), F.aggregate(F.slice("edge", 1, i), F.lit(0).cast("long"), lambda a, y: a + y["words"]).alias("before")))
    every = F.when(F.col("extent") == 0, F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("before")))).otherwise(steps)
    each = rows.where("n_convs > 0").select("*", F.explode(every).alias("s"))
    d = F.col("s.depth")
    last = d == F.col("extent")
    none = hashlib.sha256(b"").hexdigest()
    return each.select(
        "conv_id", d.cast("long").alias("depth"),
        F.when(d > F.col("low") + 1, F.col("conv_id")).when(F.col("extent") > 0, F.col("above_")).alias("parent_conv_id"),
        "n_convs", F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - own * F.col("s.before")).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(none))).otherwise(none).alias("ends_sha256"))


def prefixes(df: DataFrame, family: int = 20, batches=BATCHES, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every distinct prefix of the rebuilt conversations with its statistics."""
    paths = written(rebuilt(written(turn_lists(df, conv_id, turn, role, text), "trie-turns"), family), "trie-paths")
    convs = written(distinct(paths), "trie-conversations")
    return expanded(subtree_totals(build(convs, batches), convs), end_digests(paths))
