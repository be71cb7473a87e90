import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.operators import model
from tidemark.session import scratch_dir
from tidemark.sources import tables


def test_indexer_keeps_null_and_unseen(spark):
    df = spark.createDataFrame([("CA", "F", "F_1"), ("CA", "H", "H_1"), ("TX", "F", "F_1")],
                               "state_id string, cat_id string, dept_id string")
    fitted = model.category_indexer().fit(df)
    new = spark.createDataFrame([("CA", None, "F_1"), ("WI", "F", "X")], "state_id string, cat_id string, dept_id string")
    rows = fitted.transform(new).orderBy("state_id").collect()
    assert rows[0]["state_id_idx"] == 0.0 and rows[0]["cat_id_idx"] == 2.0  # NULL -> number of labels
    assert rows[1]["state_id_idx"] == 2.0 and rows[1]["dept_id_idx"] == 2.0  # unseen -> number of labels


def test_time_split_is_by_time(spark):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(minutes=15 * i),) for i in range(10)], "timestamp_15min timestamp_ntz")
    marked = model.with_split(df).orderBy("timestamp_15min").collect()
    flags = [r[model.SPLIT_COL] for r in marked]
    assert flags == [False] * 8 + [True] * 2


def test_train_save_load_score(spark, sf_small):
    ml, feats, target = ft.prepare_features_for_ml(ft.demand_features(tables.demand_5min(spark, sf_small)))
    fitted, metrics, test_pred = model.train_model(ml, feats, target, 0.2, model.GBTParams(max_iter=8, patience=3))
    m = metrics.first()
    assert m["test_rmse"] is not None and m["train_mae"] >= 0
    root = scratch_dir(spark, "t-models")
    p1 = model.save_model(fitted, metrics, root, "demand_gbt_model_20240101_000000")
    p2 = model.save_model(fitted, None, root, "demand_gbt_model_20240102_000000")
    assert model.latest_model(spark, root) == p2
    loaded, saved_metrics = model.load_model(spark, p1)
    assert saved_metrics.count() == 1
    assert model.load_model(spark, p2)[1] is None
    res = model.score_batch(loaded, ml.limit(50), target)
    assert res.columns == ["item_id", "store_id", "timestamp", "actual_demand", "predicted_demand",
                           "prediction_error", "absolute_error"]
    assert res.filter(F.col("predicted_demand").isNull()).count() == 0
    raw = spark.createDataFrame(
        [(str(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * i)), "view", "CA_1", float(i % 9)) for i in range(40)],
        "timestamp string, item_id string, store_id string, demand double")
    scored = model.predict_batch(loaded, raw)
    assert sorted((str(r["timestamp"]), r["actual_demand"]) for r in scored.collect()) == sorted(
        (str(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=5 * i)), float(i % 9)) for i in range(40))
    assert scored.filter(F.col("predicted_demand").isNull()).count() == 0
    imp = model.feature_importance(fitted, feats, k=5)
    assert imp.count() == 5
    with pytest.raises(FileNotFoundError):
        model.load_model(spark, root + "/missing")


def test_absent_features_raise_unless_allowed(spark, sf_small):
    ml, feats, target = ft.prepare_features_for_ml(ft.demand_features(tables.demand_5min(spark, sf_small)))
    fitted = model.build_pipeline(feats, target, model.GBTParams(max_iter=2, early_stopping=False)).fit(ml)
    wanted = model.assembled_inputs(fitted)
    assert set(wanted) == set(feats)
    partial = ml.drop("demand_15min_total_lag_24", "cat_id")
    with pytest.raises(ValueError, match="cat_id"):
        model.predict(fitted, partial)
    assert model.predict(fitted, partial, allow_missing=True).filter(F.col("prediction").isNull()).count() == 0
    with pytest.raises(ValueError, match="none of the model's"):
        model.predict(fitted, ml.select("item_id", "store_id"), allow_missing=True)


def test_boosting_boosts_on_a_learnable_target(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * i), float(i % 17), float(i % 5), (i % 17) * 3.0 + (i % 5) ** 2) for i in range(1500)]
    df = spark.createDataFrame(rows, "timestamp_15min timestamp_ntz, a double, b double, target_x double")
    fitted, metrics, _ = model.train_model(df, ["a", "b"], "target_x", 0.2, model.GBTParams(max_iter=40, patience=10, max_depth=2))
    one, single, _ = model.train_model(df, ["a", "b"], "target_x", 0.2, model.GBTParams(max_iter=1, early_stopping=False, max_depth=2))
    assert len(fitted.stages[-1].trees) > 10 and len(one.stages[-1].trees) == 1
    assert metrics.first()["test_rmse"] < 0.5 * single.first()["test_rmse"]
