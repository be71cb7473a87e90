"""Exact quantiles by narrowing, and numbering over ranges, against plain Python and the indexer."""

import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.operators.numbering import category_dictionary, numbered, with_category_index
from tidemark.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.01, 0.3, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("limit", [1, 7, 100_000])
def test_quantiles(spark, limit):
    rng = np.random.default_rng(5)
    cols = {
        "spread": rng.normal(size=4000) * 10.0 ** rng.integers(-30, 30, 4000),
        "ties": rng.integers(0, 3, 4000).astype(float),
        "hot": np.where(rng.random(4000) < 0.6, 7.0, rng.normal(7, 1e-9, 4000)),
        "ends": np.repeat([-1e300, 1e300], 2000),
    }
    data = [tuple(float(cols[c][i]) for c in cols) + (None if i % 3 else float("nan"),) for i in range(4000)]
    df = spark.createDataFrame([*data, (None,) * 5], ", ".join(f"{c} double" for c in (*cols, "none")))
    got = {(r["column"], r.prob): r.value for r in exact_quantiles(df, [*cols, "none"], PROBS, limit).collect()}
    for c, values in cols.items():
        for p in PROBS:
            assert got[c, p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=0), (c, p)
    assert all(got["none", p] is None for p in PROBS)


def test_quantiles_of_nothing(spark):
    df = spark.range(0).withColumn("x", F.lit(1.0))
    assert [r.value for r in exact_quantiles(df, ["x"]).collect()] == [None] * 3
    assert exact_quantiles(df, []).count() == 0


@pytest.mark.parametrize("n", [0, 1, 500])
def test_numbering(spark, n):
    values = [random.Random(n).randrange(100) for _ in range(n)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    got = [(r.v, r.i) for r in numbered(df, [F.desc("v"), "i"], "n", 1, 7).orderBy("n").collect()]
    assert got == sorted(((v, i) for i, v in enumerate(values)), key=lambda x: (-x[0], x[1]))
    assert [r.n for r in numbered(df, ["v", "i"], "n", 1, 7).orderBy("n").collect()] == list(range(1, n + 1))


def test_category_index_equals_the_indexer(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 30 + [f"l{i}" for i in range(60)] + [None]), 1) for _ in range(2000)]
    df = spark.createDataFrame(rows, "label string, label_idx int")  # the new column takes its name's place
    got = with_category_index(df, "label", category_dictionary(df, "label", 5))
    fitted = StringIndexer(inputCol="label", outputCol="idx", stringOrderType="frequencyDesc", handleInvalid="keep").fit(df.drop("label_idx"))
    want = {r.label: r.idx for r in fitted.transform(df.drop("label_idx")).distinct().collect()}
    found = got.collect()
    assert len(found) == 2000 and got.columns == ["label", "label_idx"] and all(r.label_idx == want[r.label] for r in found)
    fresh = with_category_index(spark.createDataFrame([("new",), (None,)], "label string"), "label", category_dictionary(df, "label"))
    assert {r.label_idx for r in fresh.collect()} == {float(len(fitted.labels))}
    assert with_category_index(df, "label", category_dictionary(df.limit(0), "label")).where("label_idx <> 0").count() == 0
