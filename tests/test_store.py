from tidemark.operators import features as ft
from tidemark.session import scratch_dir
from tidemark.sources import store, tables


def test_partitioned_roundtrip_and_pruning(spark, sf_small):
    feats = ft.demand_features(tables.demand_5min(spark, sf_small))
    path = scratch_dir(spark, "t-store")
    store.write_partitioned(feats, path)
    back = store.read_partitioned(spark, path)
    assert back.count() == feats.count()
    assert back.select(feats.columns).exceptAll(feats).count() == 0
    day = feats.agg({"date": "min"}).first()[0]
    one = store.read_partitioned(spark, path, start=day, end=day)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one.count() == feats.filter(feats.date == day).count()
