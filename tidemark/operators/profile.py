"""Profiling of the calendar table: shape, gaps, duplicates, events,
seasonality, SNAP days and correlations.

Every report is one aggregate (partial before its shuffle) returning a
small DataFrame; nothing is collected to the driver.  Grouped counts drop
the NULL group, as frequency tables do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.stats import safe_corr
from .rollup import SERIES_KEYS
from .series import lead_expr, over_series

SNAP_COLS = ["snap_CA", "snap_TX", "snap_WI"]
WEEKEND_WDAY = [1, 2]
# Holiday name patterns looked up in the event names.
MAJOR_HOLIDAYS = ["Christmas", "Thanksgiving", "NewYear", "Independence", "LaborDay"]
CORRELATION_COLUMNS = ["month", "quarter", "wday", "is_weekend", "snap_CA", "snap_TX", "snap_WI"]


def with_date(df: DataFrame) -> DataFrame:
    """The calendar with ``date`` parsed (bad strings become NULL, rows kept)."""
    if isinstance(df.schema["date"].dataType, T.StringType):
        return df.withColumn("date", tc.parse_date("date"))
    return df


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def column_types(df: DataFrame) -> DataFrame:
    """Position, name and Spark type of every column, long form; an empty table has its schema's types."""
    wide = df.agg(*[F.coalesce(F.max(F.typeof(f.name)), F.lit(f.dataType.simpleString())).alias(f.name) for f in df.schema.fields])
    long = wide.unpivot([], df.columns, "column", "type")
    place = F.array_position(F.array(*[F.lit(c) for c in df.columns]), F.col("column"))
    return long.select((place - 1).cast("int").alias("position"), "column", "type")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, long form ``(column, nulls)``, one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "nulls")


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles (interpolated), max per numeric column.

    One exact percentile buffer per column holds a count per distinct value:
    meant for columns of few distinct values such as the calendar's.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats += [
            F.count(x).cast("double").alias(f"{c}|count"),
            F.avg(x).alias(f"{c}|mean"),
            F.stddev_samp(x).alias(f"{c}|std"),
            F.min(x).alias(f"{c}|min"),
            F.percentile(x, [0.25, 0.5, 0.75]).alias(f"{c}|q"),
            F.max(x).alias(f"{c}|max"),
        ]
    wide = df.agg(*stats)
    for i, q in enumerate(("q25", "q50", "q75")):
        wide = wide.withColumns({f"{c}|{q}": F.col(f"{c}|q")[i] for c in columns})
    wide = wide.drop(*[f"{c}|q" for c in columns])
    long = wide.unpivot([], wide.columns, "key", "value")
    parts = F.split("key", r"\|")
    return (
        long.select(parts[0].alias("column"), parts[1].alias("stat"), "value")
        .groupBy("column")
        .pivot("stat", ["count", "mean", "std", "min", "q25", "q50", "q75", "max"])
        .agg(F.first("value"))
    )


def date_span(df: DataFrame) -> DataFrame:
    d = with_date(df)
    return d.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date")).withColumn(
        "total_days", F.datediff("max_date", "min_date")
    )


def missing_dates(df: DataFrame) -> DataFrame:
    """Days between the first and last date that have no calendar row.

    One scan: the present days are a distinct (partial aggregate); each
    day is compared with the previous present day and every gap is
    expanded into its missing days.  The ordered pass runs over distinct
    days only, so its size is the span in days, not the table size.
    """
    days = with_date(df).select("date").filter(F.col("date").isNotNull()).distinct()
    prev = days.withColumn("prev", F.lag("date").over(Window.orderBy("date")))
    gaps = prev.filter(F.datediff("date", "prev") > 1)
    return gaps.select(F.explode(F.sequence(F.date_add("prev", 1), F.date_sub("date", 1))).alias("date"))


def missing_buckets(rollup: DataFrame, time_col: str = "timestamp_15min", width: str = "15 minutes", keys=SERIES_KEYS, **series_kw) -> DataFrame:
    """Gaps of each series: the buckets between two present ones that have no row, ``(keys, first_missing, last_missing, buckets)``.

    Each bucket is compared with the next one of its series in time chunks
    (``over_series``), so no task orders a whole series, and a gap is one row
    however long it is.
    """
    secs = tc.width_seconds(width)
    present = rollup.where(F.col(time_col).isNotNull()).groupBy(*keys, time_col).agg(F.lit(1).alias("__tm_one")).drop("__tm_one")
    following = over_series(present, list(keys), time_col, [lead_expr(time_col, 1, "next_")], **series_kw)
    dtype = rollup.schema[time_col].dataType
    apart = ((tc.epoch_micros("next_", dtype) - tc.epoch_micros(time_col, dtype)) / F.lit(secs * 1_000_000)).cast("long")
    gaps = following.withColumn("buckets", apart - 1).where("buckets > 0")
    return gaps.select(
        *keys, F.timestamp_add("SECOND", F.lit(secs), F.col(time_col)).alias("first_missing"),
        F.timestamp_add("SECOND", F.lit(-secs), F.col("next_")).alias("last_missing"), "buckets")


def duplicate_dates(df: DataFrame) -> DataFrame:
    """Rows repeating an earlier date (a repeated NULL counts too)."""
    d = with_date(df)
    return d.agg(
        (
            F.count(F.lit(1))
            - F.count_distinct("date")
            - F.when(F.count(F.lit(1)) > F.count("date"), 1).otherwise(0)
        ).alias("duplicate_dates")
    )


def frequency(df: DataFrame, key: str) -> DataFrame:
    """Value counts of one column, sorted by value, NULL dropped."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(key)


def snap_totals(df: DataFrame) -> DataFrame:
    return df.agg(*[F.sum(c).alias(c) for c in SNAP_COLS])


def snap_by(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(c).alias(c) for c in SNAP_COLS]).orderBy(key)


def _has_event():
    return F.col("event_name_1").isNotNull() | F.col("event_name_2").isNotNull()


def event_share(df: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    ev = F.count_if(_has_event())
    return df.agg(
        ev.alias("event_days"),
        n.alias("total_days"),
        F.round(F.try_divide(ev * 100.0, n), 2).alias("event_pct"),
    )


def event_types(df: DataFrame) -> DataFrame:
    """Frequency of event types over both type columns, most frequent first."""
    both = df.select(F.explode(F.array("event_type_1", "event_type_2")).alias("event_type"))
    return (
        both.filter(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def events_by_month(df: DataFrame) -> DataFrame:
    return (
        df.filter(_has_event())
        .filter(F.col("year").isNotNull() & F.col("month").isNotNull())
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("year", "month")
    )


def month_wday_crosstab(df: DataFrame) -> DataFrame:
    """Days per month (rows) and ``wday`` 1..7 (columns ``wday_1..wday_7``), zero-filled."""
    cells = [F.count_if(F.col("wday") == w).alias(f"wday_{w}") for w in range(1, 8)]
    return (
        df.filter(F.col("month").isNotNull() & F.col("wday").isNotNull())
        .groupBy("month")
        .agg(*cells)
        .orderBy("month")
    )


def holiday_impact(df: DataFrame, holidays: list[str] = MAJOR_HOLIDAYS) -> DataFrame:
    """Per holiday pattern: matching days, distinct months, distinct years.

    A pattern is a regular expression searched in either event name (a NULL
    name never matches).  The pattern list is applied per row (array filter
    + explode), so no join with the list is needed; holidays without a match
    are absent.
    """
    pats = F.array(*[F.lit(h) for h in holidays])

    def hit(h):
        return F.coalesce(F.regexp_like(F.col("event_name_1"), h), F.lit(False)) | F.coalesce(
            F.regexp_like(F.col("event_name_2"), h), F.lit(False)
        )

    matched = df.select("month", "year", F.explode(F.filter(pats, hit)).alias("holiday"))
    return (
        matched.groupBy("holiday")
        .agg(
            F.count(F.lit(1)).alias("count"),
            _joined_sorted("month").alias("months"),
            _joined_sorted("year").alias("years"),
        )
        .orderBy("holiday")
    )


def _joined_sorted(c: str):
    """Distinct values in numeric order, as one comma-separated string."""
    return F.array_join(F.transform(F.sort_array(F.collect_set(c)), lambda x: x.cast("string")), ",")


def enhanced(df: DataFrame) -> DataFrame:
    """Calendar plus quarter, day/week of year, weekend, exact month edges."""
    d = with_date(df)
    return d.withColumns(
        {
            "quarter": F.quarter("date"),
            "day_of_year": F.dayofyear("date"),
            "week_of_year": F.weekofyear("date"),
            "is_weekend": tc.flag(F.col("wday").isin(WEEKEND_WDAY)),
            "is_month_end": tc.exact_month_end("date"),
            "is_month_start": tc.exact_month_start("date"),
        }
    )


def feature_correlations(df: DataFrame, columns: list[str] = CORRELATION_COLUMNS) -> DataFrame:
    """Pearson correlation of every column pair, long form ``(a, b, r)``."""
    e = enhanced(df)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = e.agg(*[safe_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = wide.unpivot([], wide.columns, "pair", "r").select(F.split("pair", r"\|").alias("p"), "r")
    # each pair once, mirrored afterwards; a column with itself stays one row
    both = F.when(F.col("p")[0] == F.col("p")[1], F.array("p")).otherwise(F.array("p", F.reverse("p")))
    return long.select(F.explode(both).alias("p"), "r").select(F.col("p")[0].alias("a"), F.col("p")[1].alias("b"), "r")


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, first and last date (days since 1970), duplicates, weekend/weekday days, event coverage, nulls per column."""
    d = with_date(df)
    epoch = F.lit("1970-01-01").cast("date")
    n = F.count(F.lit(1))
    weekend = F.col("wday").isin(WEEKEND_WDAY)
    metrics = {
        "total_rows": n,
        "first_date": F.datediff(F.min("date"), epoch),
        "last_date": F.datediff(F.max("date"), epoch),
        "duplicate_dates": n - F.count_distinct("date") - F.when(n > F.count("date"), 1).otherwise(0),
        "weekend_days": F.count_if(weekend),
        "weekday_days": F.count_if(~weekend),
        "event_coverage": F.count("event_name_1") + F.count("event_name_2"),
    }
    metrics |= {f"missing_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    wide = d.agg(*[v.cast("long").alias(k) for k, v in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value")


def insight_summary(df: DataFrame) -> DataFrame:
    """Computed summary figures: days covered and events identified."""
    d = with_date(df)
    wide = d.agg(
        F.datediff(F.max("date"), F.min("date")).cast("long").alias("days_covered"),
        F.count("event_name_1").cast("long").alias("events_identified"),
    )
    return wide.unpivot([], ["days_covered", "events_identified"], "topic", "value")


def head(df: DataFrame, n: int = 5, order: str = "date") -> DataFrame:
    """First ``n`` rows by ``order`` (a top-n sort, not a full sort)."""
    return df.orderBy(order).limit(n)
