"""Command line: batch training, scoring and feed streams.

    python -m tidemark.cli train --sf /root/testdata/sf0.01 --models /shared/models --max-iter 50
    python -m tidemark.cli score --sf /root/testdata/sf0.01 --models /shared/models --out /shared/scores
    python -m tidemark.cli stream --env production --root /shared/feeds --feeds calendar sales prices
    python -m tidemark.cli features --sf /root/testdata/sf0.01 --out /shared/features

``--demand PATH`` reads an intraday demand table of your own (13 declared
columns, Parquet) in place of the view that ``--sf`` derives; ``train --features
PATH`` trains from a table that ``features`` has written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from .operators import evaluate
from .operators import features as ft
from .operators import model
from .session import build_session, get_profile
from .sources import store, tables
from .streaming import runner


def _inputs(p) -> None:
    p.add_argument("--sf", help="folder of the Parquet tables")
    p.add_argument("--demand", help="an intraday demand table, in place of --sf")


def _demand(spark, a):
    if not (a.demand or a.sf):
        raise SystemExit("--sf or --demand is needed")
    return tables.read_demand(spark, a.demand) if a.demand else tables.demand_5min(spark, a.sf)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    _inputs(t)
    t.add_argument("--features", help="a feature table written by the features command")
    t.add_argument("--models", required=True)
    t.add_argument("--max-iter", type=int, default=1000)
    t.add_argument("--test-size", type=float, default=0.2)
    s = sub.add_parser("score")
    _inputs(s)
    s.add_argument("--models", required=True)
    s.add_argument("--out", required=True)
    r = sub.add_parser("stream")
    r.add_argument("--env", default="development", help="development | production | testing")
    r.add_argument("--root", required=True, help="folder with input/, output/, checkpoints/")
    r.add_argument("--feeds", nargs="+", default=list(runner.FEEDS))
    r.add_argument("--format", default="csv")
    r.add_argument("--available-now", action="store_true")
    r.add_argument("--table-prefix", help="append to the named tables PREFIX + feed")
    f = sub.add_parser("features", help="write the 15-minute feature table partitioned by date")
    _inputs(f)
    f.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = build_session("tidemark", profile=getattr(a, "env", None))
    if a.cmd == "train":
        features = store.read_partitioned(spark, a.features) if a.features else ft.demand_features(_demand(spark, a))
        path, metrics = model.train_and_save(features, a.models, model.GBTParams(max_iter=a.max_iter), a.test_size)
        print(path)
        metrics.show(truncate=False)
    elif a.cmd == "score":
        fitted, _ = model.load_model(spark, model.latest_model(spark, a.models))
        ml, _, target = ft.prepare_features_for_ml(ft.demand_features(_demand(spark, a)))
        model.score_batch(fitted, ml, target).write.mode("overwrite").parquet(a.out)
        scored = spark.read.parquet(a.out)
        evaluate.forecast_metrics(scored).withColumn("rows", F.lit(scored.count())).show(truncate=False)
    elif a.cmd == "features":
        store.write_partitioned(ft.demand_features(_demand(spark, a)), a.out)
    else:
        prof = get_profile(a.env)
        names = {feed: a.table_prefix + feed for feed in a.feeds} if a.table_prefix else None
        runner.run_streams(spark, a.root, prof, a.feeds, a.format, available_now=a.available_now, tables=names,
                           on_progress=lambda progress: progress.show(truncate=False))


if __name__ == "__main__":
    main()
