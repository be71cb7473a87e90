"""Declared schemas of the three feeds and of the intraday demand table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns and types of the three feeds and of the demand table.
CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("wm_yr_wk", T.IntegerType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("wday", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("d", T.StringType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
        T.StructField("event_name_2", T.StringType()),
        T.StructField("event_type_2", T.StringType()),
        T.StructField("snap_CA", T.IntegerType()),
        T.StructField("snap_TX", T.IntegerType()),
        T.StructField("snap_WI", T.IntegerType()),
    ]
)

SALES_KEYS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]

SALES_KEY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in SALES_KEYS])

PRICES_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.IntegerType()),
        T.StructField("sell_price", T.DoubleType()),
    ]
)

DEMAND_5MIN_SCHEMA = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("state_id", T.StringType()),
        T.StructField("cat_id", T.StringType()),
        T.StructField("dept_id", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("demand_5min", T.IntegerType()),
        T.StructField("interval_5min", T.IntegerType()),
    ]
)

DAY_PREFIX = "d_"


def day_columns(columns: list[str]) -> list[str]:
    """The wide sales columns, by the ``d_`` name prefix, in file order."""
    return [c for c in columns if c.startswith(DAY_PREFIX)]


def check_sales_columns(columns: list[str]) -> None:
    """Raise unless all five keys and at least one day column are there."""
    if not day_columns(columns):
        raise ValueError("sales input has no d_* day columns")
    missing = [c for c in SALES_KEYS if c not in columns]
    if missing:
        raise ValueError(f"sales input lacks key columns: {missing}")


def sales_schema(columns: list[str]) -> T.StructType:
    """All columns of one header, in its order, as strings.

    CSV applies a schema by position, so every header column stays in place;
    the transform selects by name.  Day cells are cast with ``try_cast``
    later, so a dirty cell becomes NULL rather than failing the batch.
    """
    check_sales_columns(columns)
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Raise ``ValueError`` naming the first required column that is absent."""
    present = set(df.columns)
    for c in required:
        if c not in present:
            raise ValueError(f"input has no column {c!r}, which this step needs")
    return df
