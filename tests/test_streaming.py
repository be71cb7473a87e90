import os

from pyspark.sql import functions as F

from tidemark.operators import feeds
from tidemark.session import scratch_dir
from tidemark.sources import tables
from tidemark.streaming import runner, sinks


def _drop(view, path, fmt="csv", n=3):
    w = view.repartition(n).write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.json(path) if fmt == "json" else w.parquet(path))


def test_stream_equals_batch_and_restart_adds_nothing(spark, sf_small):
    root = scratch_dir(spark, "t-stream")
    p = runner.feed_paths(root, "calendar")
    view = tables.calendar(spark, sf_small)
    _drop(view, p.input)
    q = runner.start_feed(spark, "calendar", root, "testing", sink_format="parquet", available_now=True)
    q.awaitTermination()
    assert q.lastProgress is not None
    batches = len(q.recentProgress)
    assert batches == 3  # one file per trigger
    out = spark.read.parquet(p.output).drop("processed_timestamp")
    batch = feeds.transform_calendar(view, with_time=False)
    assert out.count() == batch.count()
    assert out.exceptAll(batch).count() == 0
    q2 = runner.start_feed(spark, "calendar", root, "testing", sink_format="parquet", available_now=True)
    q2.awaitTermination()
    assert spark.read.parquet(p.output).count() == batch.count()


def test_first_failure_is_raised_and_all_streams_stop(spark, sf_small):
    import pytest

    root = scratch_dir(spark, "t-fail")
    _drop(tables.prices(spark, sf_small), runner.feed_paths(root, "prices").input)
    with pytest.raises(Exception):  # no sales drop: the second feed can't start
        runner.run_streams(spark, root, "testing", feeds=("prices", "sales"))
    assert not spark.streams.active
    bad = runner.feed_paths(root, "calendar").input
    os.makedirs(bad)
    with open(os.path.join(bad, "a.csv"), "w") as f:
        f.write("not,the,header\n1,2,3\n")
    with pytest.raises(Exception, match="a.csv"):  # fails while it runs, beside one that never ends
        runner.run_streams(spark, root, "testing", feeds=("prices", "calendar"), timeout_s=120)
    assert not spark.streams.active


def test_run_with_a_missing_drop_can_be_started_again(spark, sf_small):
    import pytest

    root = scratch_dir(spark, "t-again")
    prices = tables.prices(spark, sf_small)
    _drop(prices, runner.feed_paths(root, "prices").input)
    for _ in range(3):
        with pytest.raises(Exception):
            runner.run_streams(spark, root, "testing", feeds=("prices", "sales"))
    assert not os.path.exists(runner.feed_paths(root, "prices").checkpoint)  # nothing was started
    _drop(tables.sales_wide(spark, sf_small), runner.feed_paths(root, "sales").input)
    runner.run_streams(spark, root, "testing", feeds=("prices", "sales"), available_now=True)
    assert spark.read.parquet(runner.feed_paths(root, "prices").output).count() == prices.count()


def test_start_interrupted_at_any_time_can_be_started_again(spark, sf_small):
    import time

    prices = tables.prices(spark, sf_small)
    for wait in (0.0, 0.05, 0.1, 0.2, 0.3, 0.5):
        root = scratch_dir(spark, "t-cut")
        p = runner.feed_paths(root, "prices")
        _drop(prices, p.input)
        q = runner.start_feed(spark, "prices", root, "testing", sink_format="parquet", available_now=True)
        time.sleep(wait)
        q.stop()  # without grace
        runner.start_feed(spark, "prices", root, "testing", sink_format="parquet", available_now=True).awaitTermination()
        assert spark.read.parquet(p.output).count() == prices.count()


def test_only_unplanned_offsets_are_cleared(spark):
    root = scratch_dir(spark, "t-clear")
    offsets = os.path.join(root, "offsets")
    os.makedirs(offsets)
    open(os.path.join(offsets, ".0.cut.tmp"), "w").close()
    assert runner.clear_unplanned(spark, root) == [".0.cut.tmp"] and not os.listdir(offsets)
    open(os.path.join(offsets, ".1.cut.tmp"), "w").close()
    open(os.path.join(offsets, "0"), "w").close()
    assert runner.clear_unplanned(spark, root) == [] and len(os.listdir(offsets)) == 2


def test_named_tables_and_progress(spark, sf_small):
    from dataclasses import replace

    from tidemark.session import get_profile

    root = scratch_dir(spark, "t-named")
    _drop(tables.prices(spark, sf_small), runner.feed_paths(root, "prices").input)
    seen = []
    prof = replace(get_profile("testing"), monitoring=True, monitoring_interval_s=1)
    runner.run_streams(spark, root, prof, feeds=("prices",), tables={"prices": "tm_named_prices"}, timeout_s=10, on_progress=seen.append)
    assert spark.table("tm_named_prices").count() == tables.prices(spark, sf_small).count()
    assert seen and seen[0].first()["name"] == "prices_feed"
    spark.sql("DROP TABLE tm_named_prices")


def test_sales_stream_header_schema_and_memory_sink(spark, sf_small):
    root = scratch_dir(spark, "t-sales")
    p = runner.feed_paths(root, "sales")
    _drop(tables.sales_wide(spark, sf_small), p.input)
    df = runner.feed_stream(spark, "sales", p.input, "csv", max_files_per_trigger=1)
    q = sinks.to_memory(df, "tm_sales_mem").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("tm_sales_mem")
    assert got.count() == tables.sales_wide(spark, sf_small).count() * 12
    assert got.filter(F.col("data_source") != "sales").count() == 0


def test_run_streams_progress_and_dashboard(spark, sf_small):
    root = scratch_dir(spark, "t-run")
    views = {"calendar": tables.calendar(spark, sf_small), "sales": tables.sales_wide(spark, sf_small),
             "prices": tables.prices(spark, sf_small)}
    for feed, v in views.items():
        _drop(v, runner.feed_paths(root, feed).input)
    qs = runner.run_streams(spark, root, "testing", available_now=True)
    prog = runner.progress_table(spark, qs).collect()
    assert sorted(r["name"] for r in prog) == ["calendar_feed", "prices_feed", "sales_feed"]
    assert not any(r["is_active"] for r in prog)
    outs = {f: spark.read.parquet(runner.feed_paths(root, f).output) for f in views}
    view = runner.monitor_view(spark, outs, "tm_test_monitor")
    dash = {r["data_source"]: r["record_count"] for r in runner.dashboard(spark, view).collect()}
    assert dash["calendar"] == views["calendar"].count()
    assert dash["sales"] == views["sales"].count() * 12


def test_console_and_table_writers_build(spark, sf_small):
    root = scratch_dir(spark, "t-json")
    p = runner.feed_paths(root, "prices")
    _drop(tables.prices(spark, sf_small), p.input, "json")
    df = runner.feed_stream(spark, "prices", p.input, "json")
    assert df.isStreaming
    w = sinks.to_console(df)
    assert w is not None
    q = sinks.start_to_table(df, "tm_prices_tbl", os.path.join(root, "ckpt_tbl"), {"availableNow": True},
                             output_path=os.path.join(root, "tbl"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(root, "tbl")).count() == tables.prices(spark, sf_small).count()
    assert sinks.table_format(spark) in ("delta", "parquet")


def test_parquet_and_json_sales_streams_equal_batch(spark, sf_small):
    sw = tables.sales_wide(spark, sf_small)
    batch = feeds.transform_sales(sw, with_time=False)
    for fmt in ("parquet", "json"):
        root = scratch_dir(spark, f"t-sales-{fmt}")
        _drop(sw, runner.feed_paths(root, "sales").input, fmt)
        q = runner.start_feed(spark, "sales", root, "testing", fmt, sink_format="parquet", available_now=True)
        q.awaitTermination()
        out = spark.read.parquet(runner.feed_paths(root, "sales").output).drop("processed_timestamp")
        assert out.count() == batch.count() and out.exceptAll(batch).count() == 0


def test_restart_processes_only_new_files(spark, sf_small):
    root = scratch_dir(spark, "t-incr")
    p = runner.feed_paths(root, "prices")
    prices = tables.prices(spark, sf_small)
    first = prices.filter(F.col("wm_yr_wk") < 199501)
    second = prices.filter(F.col("wm_yr_wk") >= 199501)
    first.write.option("header", True).csv(p.input)
    q = runner.start_feed(spark, "prices", root, "testing", sink_format="parquet", available_now=True)
    q.awaitTermination()
    n1 = spark.read.parquet(p.output).count()
    second.write.mode("append").option("header", True).csv(p.input)
    q = runner.start_feed(spark, "prices", root, "testing", sink_format="parquet", available_now=True)
    q.awaitTermination()
    assert n1 == first.count()
    assert spark.read.parquet(p.output).count() == prices.count()


def test_processing_time_trigger_bounded_run(spark, sf_small):
    root = scratch_dir(spark, "t-trigger")
    _drop(tables.calendar(spark, sf_small), runner.feed_paths(root, "calendar").input)
    qs = runner.run_streams(spark, root, "testing", feeds=("calendar",), timeout_s=8)
    assert not qs[0].isActive
    assert spark.read.parquet(runner.feed_paths(root, "calendar").output).count() == tables.calendar(spark, sf_small).count()
