"""Series state, refreshed feature store, sliding windows and gaps against full recomputation and plain loops."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import features as ft
from tidemark.operators import profile, rollup, state
from tidemark.session import scratch_dir

START = dt.datetime(2024, 1, 1)
KW = {"lags": (1, 3), "windows": (4,), "horizons": (1,)}


def _rows(n=900, seed=1, series=(("a", "CA_1"), ("b", "CA_1"), ("b", "TX_1"))):
    """Sparse 5-minute rows over ten weeks with long gaps."""
    rng, rows = random.Random(seed), []
    for item, store in series:
        t = 0
        for _ in range(n // len(series)):
            t += rng.choice([1, 1, 2, 3, 7, 50]) if rng.random() < 0.98 else 4000
            rows.append((item, store, store[:2], "F", "F_1", START + dt.timedelta(minutes=5 * t), rng.randint(0, 50)))
    return rows


def _demand(spark, rows):
    df = spark.createDataFrame(rows, "item_id string, store_id string, state_id string, cat_id string, dept_id string, timestamp timestamp_ntz, demand_5min long")
    t = F.col("timestamp")
    return df.withColumns({"date": t.cast("date"), "hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t), "year": F.year(t),
                           "interval_5min": (F.hour(t) * 12 + F.floor(F.minute(t) / 5)).cast("int")})


def _same(a, b):
    cols = [F.round(c, 9).alias(c) if dict(a.dtypes)[c] == "double" else F.col(c) for c in sorted(a.columns)]  # sums in another order
    a, b = a.select(cols), b.select(cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_from_tails_equal_the_full_history(spark):
    agg = rollup.rollup_15min(_demand(spark, _rows())).persist()
    cut = F.lit(START + dt.timedelta(days=20)).cast("timestamp_ntz")
    before, after = agg.where(F.col(ft.TIME_COL) < cut), agg.where(F.col(ft.TIME_COL) >= cut)
    tails = state.series_tails(before, 5)
    assert tails.groupBy("item_id", "store_id").count().agg(F.max("count")).first()[0] == 5
    _same(state.features_from_state(tails, after, **KW), ft.features_of_rollup(agg, **KW).where(F.col(ft.TIME_COL) >= cut))
    _same(state.updated_tails(tails, after, 5), state.series_tails(agg, 5))


def test_late_and_new_series_in_a_batch(spark):
    agg = rollup.rollup_15min(_demand(spark, _rows())).persist()
    only = agg.where("item_id = 'a'")
    tails = state.series_tails(only, 5)
    late = state.late_buckets(tails, agg)
    assert late.count() == only.select("item_id", "store_id", ft.TIME_COL).distinct().count()
    new = agg.where("item_id = 'b'")  # series without a tail
    _same(state.features_from_state(tails, agg, **KW), ft.features_of_rollup(new, **KW))


def test_refresh_equals_a_rebuild_and_leaves_other_chunks_alone(spark):
    rows = _rows()
    rng = random.Random(2)
    late = [r for r in rows if r[0] == "a"][100:110]
    fresh = [r for r in rows if r[1] == "TX_1"]
    first = [r for r in rows if r not in late and r not in fresh]
    store = state.FeatureStore(spark, scratch_dir(spark, "t-store"), days=7, **KW)
    written = store.refresh(_demand(spark, rng.sample(first, len(first))))
    assert store.exists() and len(written) > 3

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{store.path}/features") for f in fs if f.endswith(".parquet")}

    for part in (late, fresh):
        had = files()
        redone = store.refresh(_demand(spark, part))
        kept = {f for f in had if int(f.split("chunk=")[1].split("/")[0]) not in redone}
        assert {f: had[f] for f in kept}.items() <= files().items()
        if part is late:
            assert 1 <= len(redone) < len(written)
    _same(store.features(), ft.demand_features(_demand(spark, rows), **KW))
    assert store.refresh(_demand(spark, [])) == []


@pytest.mark.parametrize("width,slide", [("60 minutes", "5 minutes"), ("30 minutes", "20 minutes"), ("10 minutes", "30 minutes")])
def test_sliding_windows(spark, width, slide):
    rows = _rows(200) + [("a", "CA_1", "CA", "F", "F_1", None, 5), ("a", "CA_1", "CA", "F", "F_1", dt.datetime(1969, 12, 31, 23, 59), 7)]
    w, s = (int(x.split()[0]) * 60 for x in (width, slide))
    want = {}
    for item, st, *_, t, v in rows:
        if t is None:
            continue
        e = int((t - dt.datetime(1970, 1, 1)).total_seconds())
        k = e // s
        while k * s + w > e:
            key = (item, st, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=k * s))
            want[key] = want.get(key, 0) + v
            k -= 1
    df = _demand(spark, rows)
    got = rollup.sliding_sum(df, width, slide, out="total")
    assert {(r.item_id, r.store_id, r.window_start): r.total for r in got.collect()} == want
    zoned = rollup.sliding_sum(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")), width, slide, out="total")
    assert sum(r.total for r in zoned.collect()) == sum(want.values())


def test_missing_buckets(spark):
    agg = rollup.rollup_15min(_demand(spark, _rows(300)))
    times = {}
    for r in agg.collect():
        times.setdefault((r.item_id, r.store_id), set()).add(r.timestamp_15min)
    step, want = dt.timedelta(minutes=15), set()
    for k, ts in times.items():
        ts = sorted(ts)
        want |= {(*k, a + step, b - step, (b - a) // step - 1) for a, b in zip(ts, ts[1:]) if b - a > step}
    for chunk in (28, 0.25):
        assert {tuple(r) for r in profile.missing_buckets(agg, chunk=chunk).collect()} == want


def test_column_types_of_an_empty_table(spark):
    rows = profile.column_types(spark.createDataFrame([], "a long, b array<string>")).collect()
    assert sorted(tuple(r) for r in rows) == [(0, "a", "bigint"), (1, "b", "array<string>")]
