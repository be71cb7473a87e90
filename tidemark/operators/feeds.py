"""Cleaning and enrichment of the three feeds.

Each transform is a pure DataFrame -> DataFrame projection, so the same
code runs on a batch read and on a file stream.  Dirty cells become NULL
(``try_*`` functions) instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..sources.files import CELLS
from ..sources.schemas import SALES_KEYS, day_columns

# The output columns of the three transforms are fixed values (the feeds' contract).

# Calendar ``wday`` codes of the weekend (Sat=1, Sun=2).
WEEKEND_WDAY = [1, 2]


def _lineage(source: str, with_time: bool) -> list:
    cols = [F.lit(source).alias("data_source")]
    if with_time:
        cols.insert(0, F.current_timestamp().alias("processed_timestamp"))
    return cols


def transform_calendar(df: DataFrame, with_time: bool = True, keep=()) -> DataFrame:
    """Calendar feed: typed date, boolean SNAP flags, derived day features; ``keep``: columns of ``df`` put behind them."""
    d = tc.parse_date("date")
    return df.select(
        d.alias("date"),
        "wm_yr_wk", "weekday", "wday", "month", "year", "d",
        "event_name_1", "event_type_1", "event_name_2", "event_type_2",
        F.col("snap_CA").cast("boolean").alias("snap_CA"),
        F.col("snap_TX").cast("boolean").alias("snap_TX"),
        F.col("snap_WI").cast("boolean").alias("snap_WI"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        F.coalesce(F.col("wday").isin(WEEKEND_WDAY), F.lit(False)).alias("is_weekend"),
        (F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()).alias("has_event"),
        *_lineage("calendar", with_time),
        *keep,
    )


def unpivot_sales(df: DataFrame) -> DataFrame:
    """Wide ``d_*`` columns to long ``(day, sales_quantity)`` rows.

    Every cell becomes a row, NULL cells included.  Map-side only: the
    row expansion happens inside the scan's task, nothing is shuffled.
    """
    if CELLS in df.columns:  # JSON records: a map of day cells
        return df.select(*SALES_KEYS, F.explode(CELLS).alias("day", "sales_quantity"))
    days = day_columns(df.columns)
    if not days:
        raise ValueError("sales input has no d_* day columns")
    typed = df.select(*SALES_KEYS, *[F.col(c).cast("string").alias(c) for c in days])
    return typed.unpivot(SALES_KEYS, days, "day", "sales_quantity")


def transform_sales(df: DataFrame, with_time: bool = True) -> DataFrame:
    """Sales feed: unpivot, then quantities to integers (bad cells -> NULL)."""
    long = unpivot_sales(df)
    return long.select(
        *SALES_KEYS,
        "day",
        F.col("sales_quantity").try_cast("int").alias("sales_quantity"),
        *_lineage("sales", with_time),
    )


def transform_prices(df: DataFrame, with_time: bool = True, keep=()) -> DataFrame:
    """Prices feed: flag missing prices; ``keep``: columns of ``df`` put behind them."""
    return df.select(
        "store_id", "item_id", "wm_yr_wk", "sell_price",
        F.col("sell_price").isNull().alias("price_missing"),
        *_lineage("prices", with_time),
        *keep,
    )


TRANSFORMS = {"calendar": transform_calendar, "sales": transform_sales, "prices": transform_prices}
