"""Jaccard self-join against all pairs."""

import os
import random
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import jaccard
from tidemark.llm.components import components
from tests.llm.helpers import all_texts

SCHEMA = "doc_id long, text string, n long, node long, token string"


def brute(rows):
    """(n_shingles, component) per row by comparing all pairs."""

    def grams(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return sorted(((k, len(s), low.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(k, t, 1, 2, "x") for k, t in rows], SCHEMA).repartition(3)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similarity_classes(df).collect()), key=str)


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    texts = []
    passage = [rng.choice(vocab) for _ in range(40)]
    for size, words, edits in ((60, 120, 3), (30, 60, 4), (25, 200, 12), (20, 45, 2)):
        texts += family(rng, [rng.choice(vocab) for _ in range(words)], size, edits)
    # documents that share one passage, from a little to nearly all of them; and chains of near copies
    texts += [" ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(0, 30))]) for _ in range(40)]
    chain = [f"c{i}" for i in range(80)]
    texts += [" ".join(chain[i : i + 50]) for i in range(0, 30, 2)]
    texts += ["THE QUICK Brown fox", "the quick brown fox", "the quick brown", " ", "", None, "same words here now again", "Same words here now again"] * 2
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (7, texts[1]), (7, texts[-1])]
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_odd_texts(spark):
    rows = list(enumerate(all_texts(60)))
    rows += [(5000, "long " + " ".join(f"t{i}" for i in range(30_000))), (4000, " ".join(f"t{i}" for i in range(30_000)))]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, [(1, None)]) == [(1, 0, 1)]
    assert jaccard.similarity_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_word_hash_is_by_content():
    a, b = jaccard.shingle_sets([b"a b c d e f", b"x  A\tb C\nd e"], 5)
    assert len(np.intersect1d(a, b)) == 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 5)] + [(100, i) for i in range(101, 180)] + [(i, i + 1) for i in range(200, 240)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got[4] == 1 and got[12] == 10 and got[179] == 100 and got[240] == 200
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_any_link_shows_among_the_shingles_sent():
    rng = np.random.default_rng(3)
    for percent in (50, 75, 90):
        for size in [*range(1, 25)] * 8 + [97, 400]:
            x = rng.choice(10**9, size, replace=False)
            for cut in range(size):
                y = np.concatenate([x[cut:], 10**9 + rng.choice(10**6, int(rng.integers(0, size + 1)), replace=False) * int(rng.choice([-1, 1]))])
                both = len(np.intersect1d(x, y))
                if 100 * both < percent * (len(x) + len(y) - both):
                    continue
                parts = [np.sort(s)[: jaccard.sent_shingles(len(s), percent)] for s in (x, y)]
                assert len(np.intersect1d(*parts)) >= max(jaccard.shared_shingles(len(s), percent) for s in (x, y))


def test_only_shingles_of_several_sets_count():
    a, b, c = jaccard.set_ids(np.array([7, 8, 9], np.uint64), np.array([5, 5, 300]))
    several = np.uint64(jaccard._SEVERAL)
    sent = [(1, a), (1, a), (2, a), (2, b), (2, b), (3, c), (4, several), (4, several), (5, several), (5, c), (6, b)]
    keys, ids = (np.array(x, np.uint64) for x in zip(*sent, strict=True))
    assert sorted(jaccard._of_several(jaccard._packed(ids, keys)).tolist()) == sorted([int(a), int(b), int(c)])


@pytest.mark.parametrize("stage", [False, True])
def test_sets_without_partner_are_not_written(spark, monkeypatch, tmp_path, stage):
    """As in a large corpus, where hardly a 32-bit key is known to be of one set only."""
    init, keep, tables = jaccard.Order.__init__, jaccard.written, []

    def full(self, rows):
        init(self, rows)
        self.bits[:] = 255

    def size(path):
        return sum(p.stat().st_size for p in Path(path.removeprefix("file:")).glob("*.parquet"))

    def kept(df, tag):
        out = keep(df, tag)
        path = os.path.dirname(out.inputFiles()[0].replace("file://", "file:")) if out.inputFiles() else ""
        tables.append((path, size(path) if path else 0))
        return out

    monkeypatch.setattr(jaccard.Order, "__init__", full)
    monkeypatch.setattr(jaccard, "written", kept)
    rng = random.Random(5)
    line = [f"p{i}" for i in range(30)]
    texts = [" ".join([f"w{rng.randrange(10**6)}" for _ in range(400)] + line) for _ in range(500)]
    texts += family(rng, texts[0].split(), 8, 5)
    rows = list(enumerate(texts))
    length = sum(map(len, texts))
    if stage:  # of the pipeline
        spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/docs")
        got = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), "")
        assert sorted(r.doc_id for r in got.select("doc_id").collect()) == list(range(500))
    else:
        got = run(spark, rows)
        low = {c for k, _, c in got if k == 0 or k >= 500}
        assert low == {0} and all(c == k for k, _, c in got if 0 < k < 500)
    assert len(tables) > 3 and max(n for _, n in tables) < length / 4
    assert sum(size(path) for path, _ in tables if path) < length / 4
