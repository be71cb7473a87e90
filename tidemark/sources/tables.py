"""Readers for the star-schema Parquet tables and the four demand views.

The views re-shape the given tables into the demand-analytics inputs
(intraday demand, calendar, wide sales, weekly prices).  They are plain
projections and aggregations of the Parquet scans, so Catalyst prunes
columns and pushes filters into the scans, and every aggregate is
partial (map-side) before its shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import timecols as tc

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The store of a user / supplier, the category of an event
# type or part, and the department suffix.
STORES = ["CA_1", "TX_1", "WI_1"]
CATEGORIES = ["FOODS", "HOUSEHOLD", "HOBBIES"]
EVENT_CATEGORY = {"view": "FOODS", "click": "FOODS", "purchase": "HOUSEHOLD"}
EVENT_DEPT_2 = ["click", "error"]


def _store_of(key: Column) -> Column:
    m = key % 3
    return F.when(m == 0, F.lit(STORES[0])).when(m == 1, F.lit(STORES[1])).otherwise(F.lit(STORES[2]))


def demand_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday demand rows (13 typed columns) derived from ``events``."""
    ev = table(spark, sf_dir, "events")
    store = _store_of(F.col("user_id"))
    cat = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in EVENT_CATEGORY.items() for x in kv]), F.col("event_type")),
        F.lit("HOBBIES"),
    )
    dept = F.concat(cat, F.when(F.col("event_type").isin(EVENT_DEPT_2), F.lit("_2")).otherwise(F.lit("_1")))
    ts = F.col("ts")
    return ev.select(
        F.col("event_type").alias("item_id"),
        store.alias("store_id"),
        tc.state_of(store).alias("state_id"),
        cat.alias("cat_id"),
        dept.alias("dept_id"),
        ts.alias("timestamp"),
        ts.cast("date").alias("date"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        F.get_json_object("props", "$.k").try_cast("int").alias("demand_5min"),
        tc.interval_5min(ts).alias("interval_5min"),
    )


# Calendar events by (month, day).
EVENTS_1 = [((12, 25), "Christmas", "Religious"), ((1, 1), "NewYear", "National"),
            ((7, 4), "IndependenceDay", "National"), ((9, 1), "LaborDay", "National")]
EVENT_2_NYE = ((12, 31), "NewYearsEve", "Cultural")
EVENT_2_ORTHODOX = ((12, 25), "OrthodoxChristmas", "Religious")  # even years only
# SNAP days of the month per state.
SNAP_CA_MAX_DAY = 10
SNAP_TX_DAYS = [1, 3, 5, 6, 7, 9, 11, 12, 13, 15]
SNAP_WI_DAYS = [2, 3, 5, 6, 8, 9, 11, 12, 14, 15]


def _on(dt: Column, md: tuple[int, int]) -> Column:
    return (F.month(dt) == md[0]) & (F.dayofmonth(dt) == md[1])


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar row per distinct order date, in the 14-column feed layout.

    The distinct is a partial aggregate over ``orders`` (bounded by the
    number of days, not by the order volume).  The ``d_N`` sequence number
    is a row number over those days: a single ordered pass over at most a
    few thousand rows.
    """
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("dt")).distinct()
    dt = F.col("dt")
    name1 = F.lit(None).cast("string")
    type1 = F.lit(None).cast("string")
    for md, n, t in reversed(EVENTS_1):
        name1 = F.when(_on(dt, md), F.lit(n)).otherwise(name1)
        type1 = F.when(_on(dt, md), F.lit(t)).otherwise(type1)
    even = F.year(dt) % 2 == 0
    name2 = (F.when(_on(dt, EVENT_2_NYE[0]), F.lit(EVENT_2_NYE[1]))
             .when(_on(dt, EVENT_2_ORTHODOX[0]) & even, F.lit(EVENT_2_ORTHODOX[1])))
    type2 = (F.when(_on(dt, EVENT_2_NYE[0]), F.lit(EVENT_2_NYE[2]))
             .when(_on(dt, EVENT_2_ORTHODOX[0]) & even, F.lit(EVENT_2_ORTHODOX[2])))
    dom = F.dayofmonth(dt)
    return days.select(
        dt.cast("string").alias("date"),
        (F.year(dt) * 100 + F.weekofyear(dt)).cast("int").alias("wm_yr_wk"),
        F.date_format(dt, "EEEE").alias("weekday"),
        (F.dayofweek(dt) % 7 + 1).alias("wday"),
        F.month(dt).alias("month"),
        F.year(dt).alias("year"),
        F.concat(F.lit("d_"), F.row_number().over(Window.orderBy(dt)).cast("string")).alias("d"),
        name1.alias("event_name_1"),
        type1.alias("event_type_1"),
        name2.alias("event_name_2"),
        type2.alias("event_type_2"),
        (dom <= SNAP_CA_MAX_DAY).cast("int").alias("snap_CA"),
        dom.isin(SNAP_TX_DAYS).cast("int").alias("snap_TX"),
        dom.isin(SNAP_WI_DAYS).cast("int").alias("snap_WI"),
    )


def _item_of(partkey: Column) -> Column:
    return F.concat(F.lit("ITEM_"), F.lpad((partkey % 500).cast("string"), 4, "0"))


def _cat_of(partkey: Column) -> Column:
    m = partkey % 500 % 3
    return F.when(m == 0, F.lit(CATEGORIES[0])).when(m == 1, F.lit(CATEGORIES[1])).otherwise(F.lit(CATEGORIES[2]))


def _sales_keys(li: DataFrame) -> list[Column]:
    store = _store_of(F.col("l_suppkey"))
    cat = _cat_of(F.col("l_partkey"))
    return [
        _item_of(F.col("l_partkey")).alias("item_id"),
        F.concat(cat, F.lit("_1")).alias("dept_id"),
        cat.alias("cat_id"),
        store.alias("store_id"),
        tc.state_of(store).alias("state_id"),
    ]


N_SALES_DAYS = 12


def sales_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sales: one row per (item, store), quantity per month in ``d_1..d_12``.

    A conditional-sum pivot with the column list fixed up front: one
    partial+final hash aggregate, no pivot-value discovery job.
    """
    li = table(spark, sf_dir, "lineitem")
    keyed = li.select(*_sales_keys(li), F.month("l_shipdate").alias("_m"), "l_quantity")
    aggs = [
        F.sum(F.when(F.col("_m") == i, F.col("l_quantity"))).cast("int").alias(f"d_{i}")
        for i in range(1, N_SALES_DAYS + 1)
    ]
    return keyed.groupBy("item_id", "dept_id", "cat_id", "store_id", "state_id").agg(*aggs)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sell price per (store, item): the lowest discounted unit price."""
    li = table(spark, sf_dir, "lineitem")
    store = _store_of(F.col("l_suppkey")).alias("store_id")
    item = _item_of(F.col("l_partkey")).alias("item_id")
    week = (F.year("l_shipdate") * 100 + F.weekofyear("l_shipdate")).cast("int").alias("wm_yr_wk")
    unit = F.when(F.col("l_discount") > 0, F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))
    return (
        li.select(store, item, week, unit.alias("_unit"))
        .groupBy("store_id", "item_id", "wm_yr_wk")
        .agg(F.min("_unit").alias("sell_price"))
    )


def typed_demand(df: DataFrame) -> DataFrame:
    """Cast an intraday demand table to the declared 13-column schema."""
    from .schemas import DEMAND_5MIN_SCHEMA

    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DEMAND_5MIN_SCHEMA.fields])


def read_demand(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A user's intraday demand table (Parquet, or CSV with header) in the declared types."""
    from .schemas import DEMAND_5MIN_SCHEMA, require_columns

    df = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return typed_demand(require_columns(df, DEMAND_5MIN_SCHEMA.names))
