"""Leaf-wise boosting against a plain grower, continued runs, and the MLlib model made of the trees."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import boosting as B

COLS = ["a", "b", "c", "d"]
PARAMS = B.GrowParams(num_leaves=8, min_rows=10, feature_fraction=0.75, bagging_fraction=1.0, fold=3)


def _data(n=1000, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 30, n), rng.integers(0, 5, n), rng.normal(size=n).round(1), rng.integers(0, 2, n)]).astype(float)
    return x, 3 * (x[:, 0] % 7) + x[:, 1] ** 2 + 4 * x[:, 2] * x[:, 3] + rng.normal(size=n) * 0.1, np.arange(n) >= 0.8 * n


def _frame(spark, data):
    return spark.createDataFrame([(*map(float, r), float(t), bool(h)) for r, t, h in zip(*data)], "a double, b double, c double, d double, y double, held boolean")


def _plain(x, y, cuts, rounds, p):
    """Best-first trees by looking at every cut of every leaf again."""
    rest, trees = y - y.mean(), []
    for rnd in range(rounds):
        features = B.chosen_features(x.shape[1], rnd, p)
        leaves = [np.arange(len(y))]
        splits = []
        while len(leaves) < p.num_leaves:
            best = None
            for i, rows in enumerate(leaves):
                for f in features:
                    for cut in cuts[f]:
                        left = x[rows, f] <= cut
                        n = left.sum()
                        if min(n, len(rows) - n) >= p.min_rows:
                            g = rest[rows]
                            gain = g[left].sum() ** 2 / n + g[~left].sum() ** 2 / (len(rows) - n) - g.sum() ** 2 / len(rows)
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, i, f, cut)
            if best is None:
                break
            gain, i, f, cut = best
            rows = leaves.pop(i)
            left = x[rows, f] <= cut
            leaves += [rows[left], rows[~left]]
            splits.append((int(f), float(cut), int(left.sum()), round(gain, 4)))
        step = np.zeros(len(y))
        for rows in leaves:
            step[rows] = rest[rows].mean()
        rest = rest - p.step * step
        trees.append(splits)
    return trees, y - rest


def _splits(run, tree):
    return sorted((tree.feature[n], float(run.cuts[tree.feature[n]][tree.bin[n]]), tree.rows[tree.left[n]], round(tree.gain[n], 4)) for n in range(len(tree.feature)) if tree.feature[n] >= 0)


def test_trees_equal_a_plain_grower(spark):
    x, y, held = _data()
    run = B.Boosting(_frame(spark, (x, y, held)), COLS, "y", "held", PARAMS)
    assert run.run(6) == 6
    want, fitted = _plain(x[~held], y[~held], run.cuts, 6, PARAMS)
    assert [_splits(run, t) for t in run.trees] == [sorted(t) for t in want]
    assert all(sum(f < 0 for f in t.feature) <= PARAMS.num_leaves for t in run.trees)
    ready = VectorAssembler(inputCols=COLS, outputCol="features").transform(_frame(spark, (x, y, held)).where("not held"))
    got = sorted((round(r.y, 9), round(r.prediction, 6)) for r in run.model().transform(ready).collect())
    assert got == sorted(zip(y[~held].round(9), fitted.round(6)))
    run.close()


def test_going_on_gives_the_trees_of_one_run(spark):
    p = B.GrowParams(num_leaves=6, min_rows=5, fold=2)
    df = _frame(spark, _data(600, 1)).persist()
    long = B.Boosting(df, COLS, "y", "held", p)
    long.run(9)
    first = B.Boosting(df, COLS, "y", "held", p)
    first.run(4)
    more = B.Boosting(df, COLS, "y", "held", p, trees=first.trees)
    more.run(9)
    assert [t.arrays()[0].tolist() for t in more.trees] == [t.arrays()[0].tolist() for t in long.trees]
    assert np.allclose(np.concatenate([t.value for t in more.trees]), np.concatenate([t.value for t in long.trees]))
    assert more.errors[-1] == pytest.approx(long.errors[-1])


def test_rounds_are_best_plus_patience_and_errors_are_the_models(spark):
    rng = np.random.default_rng(3)
    x, _, held = _data(500, 2)
    df = _frame(spark, (x, rng.normal(size=500), held))  # nothing to learn: the best round comes early
    run = B.Boosting(df, COLS, "y", "held", B.GrowParams(num_leaves=6))
    best = run.run(100, patience=7)
    assert len(run.trees) == best + 7 < 100 and len(run.errors) == best + 7
    assert run.errors[best - 1] == min(run.errors)
    ready = VectorAssembler(inputCols=COLS, outputCol="features").transform(df.where("held"))
    for rounds in (1, best, best + 7):
        mse = run.model(rounds).transform(ready).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
        assert mse == pytest.approx(run.errors[rounds - 1])


def test_many_blocks_and_reducers_give_the_same_trees(spark, monkeypatch):
    p = B.GrowParams(num_leaves=6, bagging_fraction=1.0)
    df = _frame(spark, _data(900, 4))
    one = B.Boosting(df, COLS, "y", "held", p)
    one.run(3)
    monkeypatch.setattr(B, "BLOCK_ROWS", 20)
    monkeypatch.setattr(B, "FAN_IN", 3)
    many = B.Boosting(df, COLS, "y", "held", p)
    assert one.tasks == 1 and many.tasks > 3  # one task grows trees itself, many send sums to reducers
    many.run(3)
    assert [_splits(many, t) for t in many.trees] == [_splits(one, t) for t in one.trees]
    with pytest.raises(ValueError):
        B.Boosting(df.where("held"), COLS, "y", "held", p)


def test_depth_limit(spark):
    run = B.Boosting(_frame(spark, _data(500, 5)), COLS, "y", "held", B.GrowParams(num_leaves=31, min_rows=5, max_depth=2))
    run.run(2)
    assert all(2 < sum(f < 0 for f in t.feature) <= 4 for t in run.trees)


def test_constant_target_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 5.0, False), (2.0, None, 5.0, False)] * 30, "a double, b double, y double, held boolean")
    run = B.Boosting(df, ["a", "b"], "y", "held", B.GrowParams())
    assert run.run(2) == 2 and all(t.feature == [-1] for t in run.trees)
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features", handleInvalid="keep").transform(df)
    assert {round(r.prediction, 9) for r in run.model().transform(ready).collect()} == {5.0}
