import datetime as dt

from tidemark.operators import evaluate as ev


def test_zero_actual_mape_floor(spark):
    df = spark.createDataFrame(
        [("i", "s", dt.datetime(2024, 1, 1), 0.0, 1.0)],
        "item_id string, store_id string, timestamp_15min timestamp_ntz, a double, p double")
    res = ev.prediction_table(df, "a", "p")
    m = ev.forecast_metrics(res).first()
    assert abs(m["mape"] - 1e8) < 1e-3
    assert m["mae"] == 1.0 and m["rmse"] == 1.0


def test_persistence_forecast_drops_first(spark):
    df = spark.createDataFrame(
        [("i", "s", dt.datetime(2024, 1, 1, 0, 15 * k), 2 * k) for k in range(3)],
        "item_id string, store_id string, timestamp_15min timestamp_ntz, demand_15min_total long")
    rows = ev.persistence_forecast(df).orderBy("timestamp").collect()
    assert [(r["actual_demand"], r["predicted_demand"], r["prediction_error"]) for r in rows] == [(2, 0, 2), (4, 2, 2)]
