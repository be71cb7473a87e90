"""The filter audit against a plain count, and the tries against dictionaries."""

import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import all_texts, words
from tidemark.llm import filter_audit, text_trie


def _mask(t: str) -> int:
    w, t = words(t), t or ""
    a, b = len(w) < 50, 100 * len(set(w)) < 65 * len(w)
    c, d = 100 * sum("A" <= x <= "Z" for x in t) > 5 * len(t), any(x in "#$%&*|" for x in t)
    return a + 2 * b + 4 * c + 8 * d


def _brute(rows, labels):
    lab = {}
    for i, q, t in labels:
        had = lab.get(i, (0, 0))
        lab[i] = (max(had[0], int(q == 1)), max(had[1], int(t == 1)))
    low = {}
    for i, t, _ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    docs = [(p or "", _mask(t) + (16 if i is not None and i > low[t or ""] else 0), *(lab.get(i, (0, 0)) if i is not None else (0, 0))) for i, t, p in rows]
    out = set()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        steps = []
        for o in permutations("ABCDE"):
            left = mine
            for s, f in enumerate(o):
                bit = 1 << "ABCDE".index(f)
                gone = [d for d in left if d[1] & bit]
                left = [d for d in left if not d[1] & bit]
                steps.append((part, "".join(o), s + 1, len(left), len(gone), sum(bool(d[1] & bit) for d in mine) - len(gone), sum(d[1] == bit for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        for x in steps:
            out.add((*x, sum(y[4] for y in steps if y[1][y[2] - 1] == x[1][x[2] - 1])))
    return out


def _texts():
    rng = random.Random(3)
    license_ = "Shared license line " * 300  # longer than a window
    long = [" ".join(rng.choice(["the", "of", "Cat", "dog", "x#", "é", "sun", "sea"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(40, 90))) for _ in range(60)]
    texts = all_texts(80) + long + [license_ + x for x in long[:25]] + [license_, license_[:-1], license_ + "\x00"]
    return texts + rng.choices(texts, k=150) + ["hot copy of words " * 20] * 120


def _run(spark, rows, labels, parts=6, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"mask": F.lit(1), "part": F.lit("x"), "ref": F.lit(2), "low": F.lit(3)})
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(9))
    return {tuple(r) for r in filter_audit.audit(df.repartition(parts, "source", "doc_id"), lab, **kw).collect()}


@pytest.mark.parametrize("target", [200, 5000, None])
def test_against_brute_force(spark, target):
    rng = random.Random(1)
    rows = [(rng.randint(0, 300) if rng.random() < 0.95 else None, t, rng.choice(["a", "b", None, ""])) for t in _texts()]
    rows += rows[:5]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    got = _run(spark, rows, labels, target=target)
    assert got == _brute(rows, labels)
    assert len(got) == 600 * 3


def test_empty_and_single(spark):
    assert _run(spark, [], []) == set()
    one = _run(spark, [(1, None, None)], [(1, 1, 1)])
    assert one == _brute([(1, None, None)], [(1, 1, 1)]) and len(one) == 600


def test_trie_holds_every_text_once():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(0, 12))) for _ in range(500)]
    trie, low = text_trie.TextTrie(), {}
    for i, t in enumerate(texts):
        trie.insert(t, 1000 - i).seen.append(t)
        low[t] = 1000 - i
    assert {n.seen[0]: n.low for n in trie.terminals()} == low
    assert all(len(set(n.seen)) == 1 for n in trie.terminals())
    for a in texts[:40]:
        for b in texts[:40]:
            k = text_trie.common(a, b)
            assert a[:k] == b[:k] and (k == min(len(a), len(b)) or a[k] != b[k])


def test_cut_bounds_partitions_under_a_shared_prefix(spark):
    rng = random.Random(2)
    shared = b"p" * 9000
    texts = [shared + bytes(rng.choice(b"abcdefgh") for _ in range(20)) for _ in range(400)] + [b"other %d" % i for i in range(200)]
    plan = text_trie.cut(spark.createDataFrame([(t,) for t in texts], "text binary").repartition(4), 3000)
    load, place = {}, {}
    for t in texts:
        node, _, part = plan.route(t)
        assert 0 <= part < plan.partitions
        load[part] = load.get(part, 0) + len(t) - plan.depth[node] + 16
        place.setdefault(t, set()).add(part)
    assert max(load.values()) <= 3 * 3000 and all(len(p) == 1 for p in place.values())
    assert max(plan.depth) >= 9000


def test_cut_of_near_copies_and_hot_texts(spark):
    """Thousands of copies with an edit each, and a text that many tasks hold: few rounds, bounded ranges, equal texts together."""
    rng = random.Random(4)
    base = bytes(rng.choice(b"abcdefghij ") for _ in range(3000))
    near = [base[:k] + b"#" + base[k + 1:] for k in (rng.randrange(3000) for _ in range(1500))]
    texts = near + [b"hot text"] * 500 + [base] * 50 + [b""] * 40 + [b"\xff\xff"] * 30
    plan = text_trie.cut(spark.createDataFrame([(t,) for t in texts], "text binary").repartition(4), 200_000)
    load, place = {}, {}
    for t in texts:
        node, _, part = plan.route(t)
        load[part] = load.get(part, 0) + len(t) - plan.depth[node] + 16
        place.setdefault(t, set()).add(part)
    assert max(load.values()) <= 3 * 200_000 and all(len(p) == 1 for p in place.values())
    assert text_trie._after(b"a\xff") == b"b" and text_trie._after(b"\xff") is None
