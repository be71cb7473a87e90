import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.sources import tables

from .test_rollup import demand_rows


def test_feature_count_is_49(spark, sf_small):
    df = ft.demand_features(tables.demand_5min(spark, sf_small))
    ml, feats, target = ft.prepare_features_for_ml(df)
    assert len(feats) == 49
    assert target == "target_demand_15min_total_next_1"
    assert ml.filter(F.col(target).isNull()).count() == 0


def test_short_series_lag_and_mean(spark):
    rows = [("i", "CA_1", dt.datetime(2024, 1, 1, 0, 0), 2), ("i", "CA_1", dt.datetime(2024, 1, 1, 0, 15), 6)]
    agg = ft.rollup_15min(demand_rows(spark, rows))
    out = ft.add_series_features(agg, lags=[3], windows=[48], stats=("avg",)).orderBy("timestamp_15min").collect()
    assert [r["demand_15min_total_lag_3"] for r in out] == [None, None]
    assert [r["demand_15min_total_rolling_avg_48"] for r in out] == [2.0, 4.0]


def test_nan_demand_is_missing_in_rolling(spark):
    df = spark.createDataFrame(
        [("i", "s", dt.datetime(2024, 1, 1, 0, 0), 1.0), ("i", "s", dt.datetime(2024, 1, 1, 0, 15), float("nan")),
         ("i", "s", dt.datetime(2024, 1, 1, 0, 30), 3.0)],
        "item_id string, store_id string, timestamp_15min timestamp_ntz, d double")
    out = ft.add_series_features(df, target_col="d", lags=[], windows=[3], stats=("avg", "max"))
    last = out.orderBy(F.desc("timestamp_15min")).first()
    assert last["d_rolling_avg_3"] == 2.0 and last["d_rolling_max_3"] == 3.0


def test_exclusion_by_substring():
    cols = ["item_id", "updated_flag", "x_date_y", "hour", "target_a", "Timestamp_x", "store_id_idx"]
    # the rule is by substring: "updated_flag" holds "date" and is dropped too
    assert ft.feature_columns(cols) == ["hour"]


def test_state_one_hot_from_store_prefix(spark):
    df = spark.createDataFrame([("TX_2",), ("WI_1",)], "store_id string")
    rows = ft.state_one_hot(df).orderBy("store_id").collect()
    assert [(r["state_id_CA"], r["state_id_TX"], r["state_id_WI"]) for r in rows] == [(0, 1, 0), (0, 0, 1)]


def test_scoring_rows_share_training_features(spark):
    """15-minute scoring rows featurised through the shared chain equal P-22's
    single-observation statistics and the training lags."""
    base = dt.datetime(2024, 1, 1)
    score = spark.createDataFrame(
        [(str(base + dt.timedelta(minutes=15 * i)), "ITEM_1", "CA_1", float(i % 5)) for i in range(30)],
        "timestamp string, item_id string, store_id string, demand double")
    rows = ft.scoring_demand_rows(score)
    feats = ft.demand_features(rows, value="demand_5min")
    single = ft.single_observation_aggregates(
        ft.rollup_15min(rows).select("item_id", "store_id", "timestamp_15min",
                                     F.col("demand_15min_total").alias("demand")))
    j = feats.join(single.select("timestamp_15min", F.col("demand_15min_avg").alias("a")), "timestamp_15min")
    assert j.filter(F.col("a") != F.col("demand_15min_avg")).count() == 0
    assert feats.filter(F.col("demand_15min_count") != 1).count() == 0
    ordered = feats.orderBy("timestamp_15min").collect()
    assert ordered[5]["demand_15min_total_lag_1"] == ordered[4]["demand_15min_total"]


def test_missing_required_column_raises(spark):
    import pytest

    df = spark.createDataFrame([("a",)], "item_id string")
    with pytest.raises(ValueError, match="no column .timestamp"):
        ft.scoring_demand_rows(df)


def test_step_by_step_chain_equals_one_pass(spark, sf_small):
    from tidemark.operators.rollup import time_window_aggregations

    dem = tables.demand_5min(spark, sf_small)
    _agg5, agg15 = time_window_aggregations(dem)
    step = ft.create_lag_features(agg15)
    step = ft.create_rolling_features(step)
    step = ft.create_calendar_features(step)
    step = ft.create_target_variable(step)
    one = ft.demand_features(dem)
    assert sorted(step.columns) == sorted(one.columns)
    assert step.select(one.columns).exceptAll(one).count() == 0
    ml_a, feats_a, target_a = ft.prepare_features_for_ml(step)
    ml_b, feats_b, target_b = ft.prepare_features_for_ml(one)
    assert sorted(feats_a) == sorted(feats_b) and len(feats_a) == 49 and target_a == target_b


def test_recomputing_a_step_replaces_columns(spark, sf_small):
    agg = ft.rollup_15min(tables.demand_5min(spark, sf_small))
    once = ft.create_lag_features(agg)
    twice = ft.create_lag_features(once)
    assert twice.columns == once.columns
    assert twice.exceptAll(once).count() == 0
