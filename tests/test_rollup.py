import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import timecols as tc
from tidemark.operators import features as ft
from tidemark.operators import rollup
from tidemark.sources.schemas import DEMAND_5MIN_SCHEMA


def demand_rows(spark, rows):
    """rows: (item, store, timestamp, demand)."""
    full = []
    for item, store, ts, d in rows:
        full.append((item, store, store.split("_")[0], "FOODS", "FOODS_1", ts, ts.date() if ts else None,
                     ts.hour if ts else None, ts.weekday() if ts else None, ts.month if ts else None,
                     ts.year if ts else None, d, (ts.hour * 12 + ts.minute // 5) if ts else None))
    return spark.createDataFrame(full, DEMAND_5MIN_SCHEMA)


def test_single_row_bucket_std_null_then_zero(spark):
    df = demand_rows(spark, [("i", "CA_1", dt.datetime(2024, 1, 1, 0, 7), 5)])
    agg = rollup.rollup_15min(df).collect()[0]
    assert agg["demand_15min_std"] is None and agg["demand_15min_count"] == 1
    ml, feats, _ = ft.prepare_features_for_ml(
        ft.demand_features(df, horizons=(1,)).withColumn("target_demand_15min_total_next_1", F.lit(1))
    )
    assert ml.collect()[0]["demand_15min_std"] == 0.0


def test_bucket_edges_and_total(spark):
    rows = [("i", "CA_1", dt.datetime(2024, 1, 1, 0, m), 1) for m in (0, 5, 14, 15, 29, 59)]
    agg = rollup.rollup_15min(demand_rows(spark, rows)).orderBy("timestamp_15min").collect()
    assert [(r["timestamp_15min"].minute, r["demand_15min_total"]) for r in agg] == [(0, 3), (15, 2), (45, 1)]


def test_null_timestamp_row_kept(spark):
    df = demand_rows(spark, [("i", "CA_1", None, 4), ("i", "CA_1", dt.datetime(2024, 1, 1), 1)])
    agg = rollup.rollup_15min(df).collect()
    assert sorted(r["demand_15min_total"] for r in agg) == [1, 4]


def test_repeated_autumn_hour_two_buckets(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(1320568200,), (1320571800,)], "s long").select(
            F.timestamp_seconds("s").alias("ts"))
        b = df.select(tc.bucket_start("ts", "15 minutes", df.schema["ts"].dataType).alias("b"))
        assert b.distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ntz_bucket_independent_of_session_zone(spark):
    ts = dt.datetime(2024, 7, 1, 13, 52, 30)
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = []
        for z in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            out.append(df.select(tc.bucket_start("ts", "15 minutes").alias("b")).collect()[0]["b"])
        assert out == [dt.datetime(2024, 7, 1, 13, 45)] * 3
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        seven = df.select(tc.bucket_start("ts", "7 minutes").alias("b")).collect()[0]["b"]
        epoch_min = int((ts - dt.datetime(1970, 1, 1)).total_seconds() // 60)
        assert seven == dt.datetime(1970, 1, 1) + dt.timedelta(minutes=epoch_min - epoch_min % 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_window_sum_width(spark):
    rows = [("i", "CA_1", dt.datetime(2024, 1, 1, 0, m), 2) for m in (0, 29, 30)]
    out = rollup.window_sum(demand_rows(spark, rows), "30 minutes").orderBy("window_start").collect()
    assert [r["demand_30min"] for r in out] == [4, 2]
    assert out[0]["window_end"] == dt.datetime(2024, 1, 1, 0, 30)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(
    secs=st.lists(st.integers(min_value=-2_000_000_000, max_value=4_000_000_000), min_size=1, max_size=40),
    width=st.sampled_from([60, 300, 420, 900, 1800, 3600, 5400, 86400]),
)
def test_bucket_start_is_epoch_floor(spark, secs, width):
    epoch = dt.datetime(1970, 1, 1)
    rows = [(epoch + dt.timedelta(seconds=s, microseconds=123),) for s in secs]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r["b"] for r in df.select(tc.bucket_start("ts", width).alias("b")).collect()]
    want = [epoch + dt.timedelta(seconds=s - s % width) for s in secs]
    assert got == want
