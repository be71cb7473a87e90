"""Intraday demand features: lags, rolling statistics, calendar flags, targets.

All series features of one chain are added by a single ``over_series`` call,
so the whole chain costs one shuffle of the 15-minute table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.stats import nan_to_null
from . import series as S
from .rollup import CATEGORY_KEYS, SERIES_KEYS, rollup_15min

TIME_COL = "timestamp_15min"
TARGET_COL = "demand_15min_total"
# Default lags, rolling frames (rows) and statistics.
LAG_PERIODS = [1, 2, 3, 6, 12, 24]
ROLLING_WINDOWS = [3, 6, 12, 24, 48]
ROLLING_STATS = {"avg": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
# Name fragments that keep a column out of the feature list.
NON_FEATURE_FRAGMENTS = ["timestamp", "date", "target_", "item_id", "store_id"]
CATEGORICAL = CATEGORY_KEYS


def lag_name(target: str, k: int) -> str:
    return f"{target}_lag_{k}"


def rolling_name(target: str, stat: str, n: int) -> str:
    return f"{target}_rolling_{stat}_{n}"


def target_name(target: str, h: int) -> str:
    return f"target_{target}_next_{h}"


def lag_exprs(target: str, lags) -> list[S.SeriesExpr]:
    return [S.lag_expr(target, k, lag_name(target, k)) for k in lags]


def rolling_exprs(target: str, windows, stats=tuple(ROLLING_STATS), dtype: T.DataType | None = None):
    """Rolling statistics of ``target``; NaN counts as missing.

    Mean and deviation read the cleaned double copy; minimum and maximum the
    target itself, so a long beyond 2^53 comes back exactly.
    """
    floating = isinstance(dtype, (T.FloatType, T.DoubleType))
    out = []
    for n in windows:
        for s in stats:
            exact = s in ("min", "max") and not floating
            cast_to = dtype if s in ("min", "max") and floating else None
            out.append(S.rolling_expr(ROLLING_STATS[s], target if exact else f"__tm_v_{target}", n, rolling_name(target, s, n), cast_to))
    return out


def lead_exprs(target: str, horizons) -> list[S.SeriesExpr]:
    return [S.lead_expr(target, h, target_name(target, h)) for h in horizons]


def _with_clean_value(df: DataFrame, target: str) -> DataFrame:
    """Double copy of the target for rolling statistics; NaN counts as missing.

    One double input for every rolling aggregate also keeps the shuffle
    input identical across the two branches of ``over_series``, so Spark
    reuses that exchange instead of recomputing it.
    """
    return df.withColumn(f"__tm_v_{target}", nan_to_null(F.col(target).cast("double")))


def add_series_features(
    df: DataFrame,
    time_col: str = TIME_COL,
    target_col: str = TARGET_COL,
    lags=LAG_PERIODS,
    windows=ROLLING_WINDOWS,
    stats=tuple(ROLLING_STATS),
    horizons=(),
    keys=SERIES_KEYS,
    **series_kw,
) -> DataFrame:
    """Lags, rolling statistics and lead targets in one pass per series."""
    dtype = df.schema[target_col].dataType
    exprs = (lag_exprs(target_col, lags) + rolling_exprs(target_col, windows, stats, dtype)
             + lead_exprs(target_col, horizons))
    base = _with_clean_value(df, target_col) if windows else df
    out = S.over_series(base, list(keys), time_col, exprs, **series_kw)
    names = [e.name for e in exprs]
    ordered = [c for c in df.columns if c not in names] + names
    return out.select(*ordered)


def create_lag_features(df, time_col=TIME_COL, target_col=TARGET_COL, lag_periods=LAG_PERIODS, **kw):
    return add_series_features(df, time_col, target_col, lags=lag_periods, windows=(), **kw)


def create_rolling_features(df, time_col=TIME_COL, target_col=TARGET_COL, windows=ROLLING_WINDOWS,
                            stats=tuple(ROLLING_STATS), **kw):
    return add_series_features(df, time_col, target_col, lags=(), windows=windows, stats=stats, **kw)


def span_name(target: str, stat: str, span: str) -> str:
    return f"{target}_last_{span.replace(' ', '_')}_{stat}"


def create_time_range_features(df: DataFrame, time_col: str = TIME_COL, target_col: str = TARGET_COL, spans=("1 hour", "3 hours", "12 hours"),
                               stats=tuple(ROLLING_STATS), keys=SERIES_KEYS, **series_kw) -> DataFrame:
    """Rolling statistics over the last hours instead of the last rows: gaps in a series shorten no span.

    Values are read as in the row-based statistics (NaN counts as missing).
    """
    dtype = df.schema[target_col].dataType
    floating = isinstance(dtype, (T.FloatType, T.DoubleType))
    clean = f"__tm_v_{target_col}"
    exprs = []
    for span in spans:
        for stat in stats:
            exact = stat in ("min", "max") and not floating
            exprs.append(S.span_expr(ROLLING_STATS[stat], target_col if exact else clean, span, span_name(target_col, stat, span), dtype if stat in ("min", "max") and floating else None))
    return S.over_time(_with_clean_value(df, target_col), list(keys), time_col, exprs, **series_kw).drop(clean)


def create_target_variable(df, target_col=TARGET_COL, horizon=1, time_col=TIME_COL, **kw):
    horizons = [horizon] if isinstance(horizon, int) else list(horizon)
    return add_series_features(df, time_col, target_col, lags=(), windows=(), horizons=horizons, **kw)


def _calendar_columns(time_col: str) -> dict:
    """``timestamp_dt`` (the bucket time the flags are read from; never a
    feature, by its name) and the ten calendar features."""
    return {"timestamp_dt": F.col(time_col)} | tc.calendar_feature_columns(time_col, "day_of_week", "month")


def create_calendar_features(df: DataFrame, time_col: str = TIME_COL) -> DataFrame:
    """Ten calendar features of the bucket start (row-local, no shuffle)."""
    return df.withColumns(_calendar_columns(time_col))


def add_business_hours(df: DataFrame, hour_col: str = "hour") -> DataFrame:
    return df.withColumn("is_business_hours", tc.is_business_hours(hour_col))


def demand_features(
    demand: DataFrame,
    value: str = "demand_5min",
    lags=LAG_PERIODS,
    windows=ROLLING_WINDOWS,
    horizons=(1,),
    **series_kw,
) -> DataFrame:
    """Intraday rows -> 15-minute rollup -> series features -> calendar -> target.

    Column order: rollup columns, lags, rolling statistics, calendar
    features, targets.
    """
    return features_of_rollup(rollup_15min(demand, value), lags, windows, horizons, **series_kw)


def features_of_rollup(agg: DataFrame, lags=LAG_PERIODS, windows=ROLLING_WINDOWS, horizons=(1,), **series_kw) -> DataFrame:
    """The chain from the 15-minute rollup on."""
    feats = add_series_features(agg, TIME_COL, TARGET_COL, lags=lags, windows=windows, horizons=horizons, **series_kw)
    cal = _calendar_columns(TIME_COL)
    targets = [target_name(TARGET_COL, h) for h in horizons]
    head = [c for c in feats.columns if c not in targets]
    return feats.select(*head, *[v.alias(k) for k, v in cal.items()], *targets)


def feature_columns(columns: list[str]) -> list[str]:
    """Every column whose lower-cased name holds none of the excluded fragments."""
    return [c for c in columns if not any(x in c.lower() for x in NON_FEATURE_FRAGMENTS)]


def target_column(columns: list[str]) -> str:
    targets = [c for c in columns if c.startswith("target_")]
    if not targets:
        raise ValueError("no target_ column")
    return targets[0]


def numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]


def prepare_features_for_ml(df: DataFrame) -> tuple[DataFrame, list[str], str]:
    """Keys + features + target, rows with a target only, numeric NULLs as 0."""
    feats = feature_columns(df.columns)
    target = target_column(df.columns)
    ml = df.select("item_id", "store_id", TIME_COL, *feats, target).filter(F.col(target).isNotNull())
    ml = ml.fillna(0, subset=numeric_columns(ml, feats))
    return ml, feats, target


def select_available(df: DataFrame, wanted: list[str], allow_missing: bool = False) -> list[str]:
    """The wanted feature columns; an absent one is an error unless ``allow_missing``, and so are none at all."""
    have = set(df.columns)
    cols = [c for c in wanted if c in have]
    if not cols:
        raise ValueError("none of the model's feature columns is in the table")
    if len(cols) < len(wanted) and not allow_missing:
        raise ValueError(f"the table lacks feature columns: {sorted(set(wanted) - have)}")
    return cols


# The states given a binary indicator column.
STATES = ["CA", "TX", "WI"]


def state_one_hot(df: DataFrame, store_col: str = "store_id", state_col: str = "state_id") -> DataFrame:
    """Binary indicator per state; the state comes from the store prefix when absent."""
    state = F.col(state_col) if state_col in df.columns else tc.state_of(store_col)
    return df.withColumns({f"state_id_{s}": tc.flag(state == s) for s in STATES})


def single_observation_aggregates(df: DataFrame, value: str = "demand") -> DataFrame:
    """Bucket statistics for rows that are one observation each."""
    v = F.col(value)
    return df.withColumns(
        {
            "demand_15min_avg": v.cast("double"),
            "demand_15min_count": F.lit(1).cast("long"),
            "demand_15min_std": F.lit(0.0),
            "demand_15min_min": v,
            "demand_15min_max": v,
        }
    )


def scoring_demand_rows(df: DataFrame) -> DataFrame:
    """Map a scoring input (timestamp, item_id, store_id, [state_id], demand)
    onto intraday demand rows so that scoring reuses the training features."""
    from ..sources.schemas import require_columns

    require_columns(df, ["timestamp", "item_id", "store_id", "demand"])
    ts = tc.parse_timestamp("timestamp", df.schema["timestamp"].dataType)
    state = F.col("state_id") if "state_id" in df.columns else tc.state_of("store_id")
    cat = F.col("cat_id") if "cat_id" in df.columns else F.lit(None).cast("string")
    dept = F.col("dept_id") if "dept_id" in df.columns else F.lit(None).cast("string")
    t = F.col("timestamp")
    return df.withColumn("timestamp", ts).select(
        "item_id", "store_id", state.alias("state_id"), cat.alias("cat_id"), dept.alias("dept_id"),
        t.alias("timestamp"), t.cast("date").alias("date"), F.hour(t).alias("hour"),
        F.weekday(t).alias("day_of_week"), F.month(t).alias("month"), F.year(t).alias("year"),
        nan_to_null(F.col("demand").cast("double")).alias("demand_5min"),
        tc.interval_5min(t).alias("interval_5min"),
    )
