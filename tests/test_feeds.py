import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import feeds
from tidemark.sources import files, schemas, tables


def cal_row(date, wday=3, n1=None, t1=None, n2=None, t2=None):
    return (date, 201101, "Monday", wday, 1, 2011, "d_1", n1, t1, n2, t2, 1, 0, 1)


def test_bad_date_is_null_row_kept(spark):
    df = spark.createDataFrame([cal_row("2011-13-40"), cal_row("2011-01-29")], schemas.CALENDAR_SCHEMA)
    out = feeds.transform_calendar(df, with_time=False).orderBy(F.col("date").asc_nulls_first()).collect()
    assert len(out) == 2 and out[0]["date"] is None and out[0]["day_of_week"] is None
    assert out[1]["day_of_week"] == 7  # Saturday, Sun=1 convention
    assert out[1]["snap_CA"] is True and out[1]["snap_TX"] is False


def test_weekend_and_event_flags(spark):
    df = spark.createDataFrame([cal_row("2011-01-29", 1, "SuperBowl", "Sporting"), cal_row("2011-01-31", None)],
                               schemas.CALENDAR_SCHEMA)
    out = feeds.transform_calendar(df).orderBy("date").collect()
    assert (out[0]["is_weekend"], out[0]["has_event"]) == (True, True)
    assert (out[1]["is_weekend"], out[1]["has_event"]) == (False, False)
    assert out[0]["data_source"] == "calendar" and out[0]["processed_timestamp"] is not None


def test_sales_unpivot_and_bad_quantity(spark):
    schema = schemas.sales_schema(schemas.SALES_KEYS + ["d_1", "d_2"])
    df = spark.createDataFrame([("I", "D", "C", "S", "CA", "3", "x"), ("J", "D", "C", "S", "CA", None, "4")], schema)
    out = feeds.transform_sales(df, with_time=False).orderBy("item_id", "day").collect()
    assert [(r["item_id"], r["day"], r["sales_quantity"]) for r in out] == [
        ("I", "d_1", 3), ("I", "d_2", None), ("J", "d_1", None), ("J", "d_2", 4)]


def test_no_day_columns_is_an_error(spark):
    with pytest.raises(ValueError, match="d_"):
        schemas.sales_schema(schemas.SALES_KEYS)
    df = spark.createDataFrame([("I", "D", "C", "S", "CA")], schemas.SALES_KEY_SCHEMA)
    with pytest.raises(ValueError, match="d_"):
        feeds.transform_sales(df)


def drop(spark, tag, **files_):
    from tidemark.session import scratch_dir

    d = scratch_dir(spark, tag)
    for name, text in files_.items():
        with open(os.path.join(d, name.replace("_", ".")), "w") as f:
            f.write(text)
    return d


def long_rows(df):
    out = feeds.transform_sales(df, with_time=False)
    return sorted((r["item_id"], r["state_id"], r["day"], r["sales_quantity"]) for r in out.collect() if r["sales_quantity"] is not None)


def test_sales_csv_keeps_columns_in_place(spark):
    d = drop(spark, "t-csv", a_csv="id,item_id,dept_id,cat_id,store_id,state_id,d_1,d_2\nX_val,I,D,C,CA_1,CA,7,8\n")
    assert long_rows(files.read_sales(spark, d)) == [("I", "CA", "d_1", 7), ("I", "CA", "d_2", 8)]


def test_sales_csv_files_with_different_headers(spark):
    d = drop(
        spark, "t-csv2", a_csv="item_id,dept_id,cat_id,store_id,state_id,d_1\nI,D,C,CA_1,CA,1\n",
        b_csv='d_3,"state_id",item_id,dept_id,cat_id,store_id,d_2\n5,TX,J,D,C,TX_1,6\n')
    got = long_rows(files.read_sales(spark, d))
    assert got == [("I", "CA", "d_1", 1), ("J", "TX", "d_2", 6), ("J", "TX", "d_3", 5)]
    assert feeds.transform_sales(files.read_sales(spark, d)).count() == 6
    with pytest.raises(ValueError, match="one header"):
        files.open_sales_stream(spark, d)


def test_header_mismatch_raises(spark):
    d = drop(spark, "t-csv3", a_csv="item_id,store_id,wm_yr_wk,sell_price\nI,S,1,2.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_feed(spark, d, schemas.PRICES_SCHEMA).collect()


def test_sales_json_keeps_late_and_null_columns(spark):
    keys = '"item_id":"%s","dept_id":"D","cat_id":"C","store_id":"CA_1","state_id":"CA"'
    d = drop(
        spark, "t-json", a_json="{" + keys % "I" + ',"d_1":1,"d_2":null}\n', b_json="{" + keys % "J" + ',"d_1":2,"d_3":"5"}\n\n')
    assert long_rows(files.read_sales(spark, d, "json")) == [("I", "CA", "d_1", 1), ("J", "CA", "d_1", 2), ("J", "CA", "d_3", 5)]
    assert feeds.transform_sales(files.read_sales(spark, d, "json")).count() == 6  # absent cells are empty ones


def test_sales_json_stream_keeps_a_column_of_a_late_file(spark):
    from tidemark.session import scratch_dir
    from tidemark.streaming import runner

    root = scratch_dir(spark, "t-late")
    p = runner.feed_paths(root, "sales")
    os.makedirs(p.input)
    row = '{"item_id":"%s","dept_id":"D","cat_id":"C","store_id":"CA_1","state_id":"CA","%s":%d}\n'
    for i, day in enumerate(("d_1", "d_9")):
        with open(os.path.join(p.input, f"{i}.json"), "w") as f:
            f.write(row % (f"I{i}", day, i + 4))
        q = runner.start_feed(spark, "sales", root, "testing", "json", sink_format="parquet", available_now=True)
        q.awaitTermination()
        runner.raise_failure([q])
    out = spark.read.parquet(p.output).where("sales_quantity IS NOT NULL")
    assert sorted((r["item_id"], r["day"], r["sales_quantity"]) for r in out.collect()) == [("I0", "d_1", 4), ("I1", "d_9", 5)]


def test_sales_drop_without_keys_or_days(spark):
    with pytest.raises(ValueError, match="key columns"):
        files.read_sales(spark, drop(spark, "t-bad", a_csv="item_id,d_1\nI,1\n"))
    with pytest.raises(ValueError, match="d_"):
        files.read_sales(spark, drop(spark, "t-bad2", a_csv="item_id,dept_id,cat_id,store_id,state_id\nI,D,C,S,S\n"))


def test_unknown_format_raises(spark):
    with pytest.raises(ValueError, match="Unsupported"):
        files.open_stream(spark, "/nonexistent", schemas.PRICES_SCHEMA, "orc")
    with pytest.raises(ValueError, match="Unsupported"):
        files.read_feed(spark, "/nonexistent", schemas.PRICES_SCHEMA, "orc")


def test_prices_missing_flag(spark):
    df = spark.createDataFrame([("S", "I", 201101, None), ("S", "J", 201101, 2.5)], schemas.PRICES_SCHEMA)
    out = dict((r["item_id"], r["price_missing"]) for r in feeds.transform_prices(df).collect())
    assert out == {"I": True, "J": False}


def test_views_have_feed_layout(spark, sf_small):
    cal = tables.calendar(spark, sf_small)
    assert cal.schema == schemas.CALENDAR_SCHEMA or [f.name for f in cal.schema] == schemas.CALENDAR_SCHEMA.names
    sw = tables.sales_wide(spark, sf_small)
    assert sw.columns[:5] == schemas.SALES_KEYS and schemas.day_columns(sw.columns) == [f"d_{i}" for i in range(1, 13)]
    assert tables.prices(spark, sf_small).columns == schemas.PRICES_SCHEMA.names
    assert tables.demand_5min(spark, sf_small).columns == schemas.DEMAND_5MIN_SCHEMA.names


def test_sales_json_and_parquet_equal_the_table(spark, sf_small):
    from tidemark.session import scratch_dir

    sw = tables.sales_wide(spark, sf_small)
    want = feeds.transform_sales(sw, with_time=False)
    for fmt in ("json", "parquet"):
        d = scratch_dir(spark, f"t-sales-{fmt}")
        getattr(sw.repartition(2).write.mode("overwrite"), fmt)(d)
        out = feeds.transform_sales(files.read_sales(spark, d, fmt), with_time=False)
        assert out.count() == want.count() and out.exceptAll(want).count() == 0
