"""Time-bucket rollups of intraday demand.

Every rollup is a ``groupBy`` on the series keys plus a bucket start, so
Spark plans a partial (map-side) hash aggregate before the shuffle: a hot
series is folded to one row per bucket per map task before anything moves.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc

# The keys of every rollup, by role.
SERIES_KEYS = ["item_id", "store_id"]
CATEGORY_KEYS = ["state_id", "cat_id", "dept_id"]
TIME_PARTS = ["hour", "day_of_week", "month", "year"]


def with_intervals(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the 15-minute slot index and the 5- and 15-minute bucket starts."""
    dtype = df.schema[ts].dataType
    return df.withColumns(
        {
            "interval_15min": tc.interval_15min("interval_5min"),
            "timestamp_5min": tc.bucket_start(ts, "5 minutes", dtype),
            "timestamp_15min": tc.bucket_start(ts, "15 minutes", dtype),
        }
    )


def _group_keys(bucket: str) -> list[str]:
    return SERIES_KEYS + CATEGORY_KEYS + ["date", bucket] + TIME_PARTS


def rollup_5min(df: DataFrame, value: str = "demand_5min") -> DataFrame:
    """5-minute rollup: total, mean, count, sample stddev per series bucket."""
    v = F.col(value)
    return with_intervals(df).groupBy(*_group_keys("timestamp_5min")).agg(
        F.sum(v).alias("demand_5min_total"),
        F.avg(v).alias("demand_5min_avg"),
        F.count(v).alias("demand_5min_count"),
        F.stddev_samp(v).alias("demand_5min_std"),
    )


def rollup_15min(df: DataFrame, value: str = "demand_5min") -> DataFrame:
    """15-minute rollup: total, mean, count, sample stddev, min, max."""
    v = F.col(value)
    return with_intervals(df).groupBy(*_group_keys("timestamp_15min")).agg(
        F.sum(v).alias("demand_15min_total"),
        F.avg(v).alias("demand_15min_avg"),
        F.count(v).alias("demand_15min_count"),
        F.stddev_samp(v).alias("demand_15min_std"),
        F.min(v).alias("demand_15min_min"),
        F.max(v).alias("demand_15min_max"),
    )


def time_window_aggregations(df: DataFrame, value: str = "demand_5min") -> tuple[DataFrame, DataFrame]:
    """Both rollups of one intraday table, as the batch chain expects."""
    return rollup_5min(df, value), rollup_15min(df, value)


def window_sum(
    df: DataFrame,
    width: str = "30 minutes",
    ts: str = "timestamp",
    value: str = "demand_5min",
    keys: list[str] | None = None,
    out: str | None = None,
) -> DataFrame:
    """Sum of ``value`` per series and tumbling window of any width."""
    keys = keys or SERIES_KEYS
    secs = tc.width_seconds(width)
    out = out or f"demand_{secs // 60}min"
    start = tc.bucket_start(ts, width, df.schema[ts].dataType)
    return (
        df.groupBy(*keys, start.alias("window_start"))
        .agg(F.sum(value).alias(out))
        .select(*keys, "window_start",
                F.timestamp_add("SECOND", F.lit(secs), F.col("window_start")).alias("window_end"), out)
    )


def sliding_sum(
    df: DataFrame,
    width: str = "60 minutes",
    slide: str = "5 minutes",
    ts: str = "timestamp",
    value: str = "demand_5min",
    keys: list[str] | None = None,
    out: str | None = None,
) -> DataFrame:
    """Sum of ``value`` per series and sliding window, ``[start, start + width)`` every ``slide`` from the epoch.

    Rows are folded once into panes (the greatest common divisor of width and
    slide) before anything moves; a window adds up its panes.  Every window that
    holds a row comes back; rows without a time belong to none.
    """
    keys = keys or SERIES_KEYS
    w, s = tc.width_seconds(width), tc.width_seconds(slide)
    pane = math.gcd(w, s)
    out = out or f"demand_{w // 60}min"
    dtype = df.schema[ts].dataType
    at = F.floor(tc.epoch_micros(ts, dtype) / F.lit(pane * 1_000_000)).cast("long")
    panes = df.groupBy(*keys, at.alias("__tm_pane")).agg(F.sum(value).alias("__tm_sum")).where(F.col("__tm_pane").isNotNull())
    p = F.col("__tm_pane") * pane
    last = F.floor(p / F.lit(s)).cast("long")  # the last window that starts at or before the pane
    first = F.floor((p - w) / F.lit(s)).cast("long") + 1
    windows = F.when(first <= last, F.sequence(first, last))  # none between windows that leave gaps
    each = panes.select(*keys, F.explode(windows).alias("__tm_w"), "__tm_sum")
    start = F.timestamp_seconds(F.col("__tm_w") * s)
    if not isinstance(dtype, T.TimestampType):
        start = F.timestamp_add("SECOND", F.col("__tm_w") * s, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return each.groupBy(*keys, "__tm_w").agg(F.sum("__tm_sum").alias(out)).select(
        *keys, start.alias("window_start"), F.timestamp_add("SECOND", F.lit(w), start).alias("window_end"), out)
