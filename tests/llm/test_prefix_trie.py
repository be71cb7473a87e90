"""The prefix trie against dictionaries of whole prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie


def _brute(rows, family=20):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append(((t is not None, t or 0), r or "", x or ""))
    convs = {c: [(r, x) for _, r, x in sorted(v)] for c, v in convs.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = convs.get(c - c % family, [])[:h] + own[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p, m in members.items())


def _rows(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3000), n):
        c -= 200  # some negative
        kind = rng.random()
        size = rng.choice([0, 1, 2, 3, 5, 8, 13]) if kind < 0.8 else rng.randint(20, 45)
        word = rng.choice("ab") if kind < 0.9 else str(c)
        for t in range(size):
            rows.append((c, t if rng.random() < 0.97 else None, rng.choice(["user", None]) if rng.random() < 0.05 else "user", rng.choice([word, word + " x", None]) if rng.random() < 0.15 else word))
    rows += [(c, t, "user", "hot turn") for c in range(5000, 5150) for t in range(3)]  # copies
    rows += [(c, t, "user", f"same {t}") for c in range(6000, 6040) for t in range(c - 6000)]  # each a prefix of the next
    rows += [(None, 1, "user", "x"), (7000, 1, "a", "tie"), (7000, 1, "b", "tie"), (7000, 1, "a", "tie")]
    return rows


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"id": F.lit(1), "path": F.lit("x"), "hash": F.lit(2)})
    out = prefix_trie.prefixes(df.repartition(5), **kw)
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in out.collect()), key=lambda r: (r[0], r[1], r[2] or 0, *r[3:]))


@pytest.mark.parametrize("batches", [(0.125, 0.875), (0.3, 0.3, 0.4), (1.0,)])
def test_against_brute_force(spark, batches):
    rows = _rows()
    assert _run(spark, rows, batches=batches) == sorted(_brute(rows), key=lambda r: (r[0], r[1], r[2] or 0, *r[3:]))


def test_empty_and_turnless(spark):
    assert _run(spark, []) == []
    c = next(c for c in range(1, 20) if prefix_trie.shared_turns(c) == 3)
    assert _run(spark, [(c, 0, "u", "a b")]) == _brute([(c, 0, "u", "a b")]) and len(_brute([(c, 0, "u", "a b")])) == 1


def test_fattest():
    for low in range(70):
        for high in range(low + 1, 70):
            assert prefix_trie.fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: x & -x)


def test_handles_are_unique_and_nodes_compact(spark):
    df = spark.createDataFrame(_rows(150, 3), "conv_id long, turn long, role string, text string")
    convs = prefix_trie.distinct(prefix_trie.rebuilt(prefix_trie.turn_lists(df)))
    trie = prefix_trie.build(convs).collect()
    assert len({r.handle for r in trie}) == len(trie) == len({r.id for r in trie})
    below = defaultdict(int)
    for r in trie:
        if r.extent:
            below[bytes(r.parent)] += 1
            f = prefix_trie.fattest(r.low, r.extent)
            assert len(r.edge) == r.extent - r.low and r.edge[-1]["hash"] == r.id and r.edge[f - r.low - 1]["hash"] == r.handle
    ends = {bytes(r.id) for r in convs.collect()}
    assert all(below[bytes(r.id)] != 1 or bytes(r.id) in ends or not r.extent for r in trie)
