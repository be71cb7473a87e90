"""The chunked series window equals a plain per-series loop."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import series as S

BASE = dt.datetime(2024, 1, 1)


def brute(rows, lags, windows, leads):
    """rows: list of (key, ts, value) -> dict[(key, ts)] -> feature tuple."""
    out = {}
    by = {}
    for k, t, v in rows:
        by.setdefault(k, []).append((t, v))
    for k, seq in by.items():
        seq.sort()
        vals = [v for _, v in seq]
        for i, (t, v) in enumerate(seq):
            feats = []
            for L in lags:
                feats.append(vals[i - L] if i - L >= 0 else None)
            for n in windows:
                frame = [x for x in vals[max(0, i - n + 1): i + 1] if x is not None]
                feats.append(sum(frame) / len(frame) if frame else None)
                if len(frame) >= 2:
                    m = sum(frame) / len(frame)
                    feats.append(math.sqrt(sum((x - m) ** 2 for x in frame) / (len(frame) - 1)))
                else:
                    feats.append(None)
                feats.append(min(frame) if frame else None)
            for h in leads:
                feats.append(vals[i + h] if i + h < len(vals) else None)
            out[(k, t)] = tuple(feats)
    return out


def exprs(lags, windows, leads):
    e = [S.lag_expr("v", L, f"lag_{L}") for L in lags]
    for n in windows:
        e.append(S.rolling_expr(F.avg, "v", n, f"avg_{n}"))
        e.append(S.rolling_expr(F.stddev_samp, "v", n, f"std_{n}"))
        e.append(S.rolling_expr(F.min, "v", n, f"min_{n}"))
    e += [S.lead_expr("v", h, f"lead_{h}") for h in leads]
    return e


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(a))


series_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.integers(min_value=0, max_value=60 * 24 * 12),  # minutes over 12 days
        st.one_of(st.none(), st.integers(min_value=0, max_value=50)),
    ),
    min_size=1,
    max_size=120,
    unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=12, deadline=None)
@given(rows=series_rows, chunk=st.sampled_from([0.05, 0.5, 1, 3]), levels=st.integers(min_value=1, max_value=3))
def test_chunked_matches_loop(spark, rows, chunk, levels):
    lags, windows, leads = [1, 3], [2, 5], [1, 2]
    data = [(k, BASE + dt.timedelta(minutes=m), None if v is None else float(v)) for k, m, v in rows]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v double")
    got = S.over_series(df, ["k"], "t", exprs(lags, windows, leads), chunk=chunk,
                        levels=levels, fanout=2)
    names = [e.name for e in exprs(lags, windows, leads)]
    res = {(r["k"], r["t"]): tuple(r[n] for n in names) for r in got.collect()}
    want = brute(data, lags, windows, leads)
    assert len(got.collect()) == len(data)
    assert set(res) == set(want)
    for key, feats in want.items():
        assert all(close(a, b) for a, b in zip(res[key], feats)), (key, res[key], feats)


def test_direct_and_chunked_agree_on_fixture(spark, sf_small):
    from tidemark.operators import features as ft
    from tidemark.sources import tables

    dem = tables.demand_5min(spark, sf_small)
    a = ft.demand_features(dem)
    b = ft.demand_features(dem, plain=True)
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_numeric_order_and_null_order(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("a", 30, 4.0)],
                               "k string, t int, v double")
    got = S.over_series(df, ["k"], "t", [S.lag_expr("v", 1, "lag")], chunk=5)
    rows = sorted(got.collect(), key=lambda r: (r["t"] is not None, r["t"] or 0))
    assert [r["lag"] for r in rows] == [None, 1.0, 2.0, 3.0]


def test_shuffle_reuse_in_plan(spark, sf_small):
    """Both branches read the chunk shuffle once (reused exchange)."""
    from tidemark.operators import features as ft
    from tidemark.sources import tables

    df = ft.demand_features(tables.demand_5min(spark, sf_small))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1


def test_one_hot_series_spreads_over_tasks(spark):
    """A single series over 200 days is windowed by many tasks, not one."""
    base = dt.datetime(2024, 1, 1)
    df = (
        spark.range(0, 200 * 96)
        .select(F.lit("hot").alias("k"),
                F.timestamp_add("MINUTE", F.col("id") * 15, F.lit(base).cast("timestamp_ntz")).alias("t"),
                (F.col("id") % 7).cast("double").alias("v"))
    )
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = S.over_series(df, ["k"], "t", [S.lag_expr("v", 1, "lag"), S.rolling_expr(F.avg, "v", 48, "avg48")])
        per_task = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in per_task) == 200 * 96
        assert max(r["count"] for r in per_task) < 200 * 96 / 2
        direct = S.over_series(df, ["k"], "t", [S.lag_expr("v", 1, "lag"), S.rolling_expr(F.avg, "v", 48, "avg48")],
                               plain=True)
        assert out.exceptAll(direct).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_one_plan_at_every_size(spark, sf_small):
    from tidemark.operators import features as ft

    tiny = spark.createDataFrame([("a", "b", BASE, 1)], "item_id string, store_id string, timestamp_15min timestamp_ntz, demand_15min_total long")
    plan = ft.create_lag_features(tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "__tm_chunk" in plan and "Union" in plan


def test_ties_are_numbered_alike(spark):
    """Rows with equal order keys follow their other columns, in chunks as in one window."""
    rows = [("a", BASE + dt.timedelta(hours=i // 3), float(i * 37 % 11), i * 7 % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double, w int").repartition(5)
    e = [S.lag_expr("v", 2, "lag"), S.lead_expr("v", 1, "lead"), S.rolling_expr(F.avg, "v", 4, "avg")]
    plain = S.over_series(df, ["k"], "t", e, plain=True)
    for chunk, levels in ((0.1, 1), (0.25, 2), (1, 1)):
        got = S.over_series(df, ["k"], "t", e, chunk=chunk, levels=levels, fanout=2)
        assert got.exceptAll(plain).count() == 0 and got.count() == 200


def test_min_max_are_exact_beyond_doubles(spark):
    from tidemark.operators import features as ft

    big = 2**53 + 1
    rows = [("i", "s", BASE + dt.timedelta(minutes=15 * i), big - (i % 3)) for i in range(9)]
    df = spark.createDataFrame(rows, "item_id string, store_id string, timestamp_15min timestamp_ntz, demand_15min_total long")
    out = ft.create_rolling_features(df, windows=[3], stats=("min", "max")).orderBy("timestamp_15min").collect()
    assert out[-1]["demand_15min_total_rolling_max_3"] == big and out[-1]["demand_15min_total_rolling_min_3"] == big - 2
