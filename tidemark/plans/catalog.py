"""Registered queries: ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the given Parquet tables (through the demand views of
``sources.tables``) so its work grows with them.  Floating results that two
engines may compute in a different order (means, deviations, correlations,
quantiles, error metrics) are rounded to 6 decimals at the end, here and in
the oracle SQL alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evaluate as ev
from ..operators import features as ft
from ..operators import feeds, model, profile
from ..operators.boosting import Boosting, GrowParams
from ..operators.numbering import category_dictionary, with_category_index
from ..operators.quantiles import exact_quantiles
from ..operators.rollup import rollup_5min, rollup_15min, sliding_sum, window_sum, with_intervals
from ..operators.state import FeatureStore, features_from_state, series_tails, updated_tails
from ..session import scratch_dir
from ..sources import files, tables
from ..sources.schemas import CALENDAR_SCHEMA, SALES_KEYS
from ..streaming import batches, runner

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
KEYS = ["item_id", "store_id", "timestamp_15min"]
T15 = ft.TARGET_COL


def query(name: str):
    def reg(fn):
        QUERIES[name] = fn
        return fn

    return reg


def rounded(df: DataFrame, digits: int = 6, skip: tuple = ()) -> DataFrame:
    """Round every double column (except ``skip``) to ``digits`` decimals."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _agg15(spark, d):
    return rollup_15min(tables.demand_5min(spark, d))


# ---------------------------------------------------------------- rollups
@query("agg_5min")
def q_agg_5min(spark, d):
    return rounded(rollup_5min(tables.demand_5min(spark, d)))


@query("agg_15min")
def q_agg_15min(spark, d):
    return rounded(_agg15(spark, d))


@query("agg_30min")
def q_agg_30min(spark, d):
    return window_sum(tables.demand_5min(spark, d), "30 minutes")


@query("agg_60min")
def q_agg_60min(spark, d):
    return window_sum(tables.demand_5min(spark, d), "60 minutes")


# ---------------------------------------------------------------- series features
@query("lag_features")
def q_lag_features(spark, d):
    out = ft.create_lag_features(_agg15(spark, d))
    return out.select(*KEYS, T15, *[ft.lag_name(T15, k) for k in ft.LAG_PERIODS])


def _rolling(spark, d, stat):
    out = ft.create_rolling_features(_agg15(spark, d), stats=(stat,))
    return rounded(out.select(*KEYS, T15, *[ft.rolling_name(T15, stat, n) for n in ft.ROLLING_WINDOWS]))


for _stat in ft.ROLLING_STATS:
    query(f"rolling_{_stat}")(lambda spark, d, _s=_stat: _rolling(spark, d, _s))


T5 = "demand_5min_total"
LAGS_5MIN = [1, 2, 3]
WINDOWS_5MIN = [3, 12]


@query("lag_features_5min")
def q_lag_features_5min(spark, d):
    """Lags with a custom time column, target and periods (the 5-minute rollup)."""
    agg5 = rollup_5min(tables.demand_5min(spark, d))
    out = ft.create_lag_features(agg5, time_col="timestamp_5min", target_col=T5, lag_periods=LAGS_5MIN)
    return out.select("item_id", "store_id", "timestamp_5min", T5, *[ft.lag_name(T5, k) for k in LAGS_5MIN])


@query("rolling_features_5min")
def q_rolling_features_5min(spark, d):
    """Rolling statistics with custom frames on the 5-minute rollup."""
    agg5 = rollup_5min(tables.demand_5min(spark, d))
    out = ft.create_rolling_features(agg5, time_col="timestamp_5min", target_col=T5, windows=WINDOWS_5MIN)
    names = [ft.rolling_name(T5, s_, n) for n in WINDOWS_5MIN for s_ in ft.ROLLING_STATS]
    return rounded(out.select("item_id", "store_id", "timestamp_5min", T5, *names))


@query("target_lead")
def q_target_lead(spark, d):
    out = ft.create_target_variable(_agg15(spark, d), horizon=1)
    return out.select(*KEYS, T15, ft.target_name(T15, 1))


MULTI_HORIZONS = [1, 2, 4]


@query("target_multi_horizon")
def q_target_multi(spark, d):
    out = ft.create_target_variable(_agg15(spark, d), horizon=MULTI_HORIZONS)
    return out.select(*KEYS, T15, *[ft.target_name(T15, h) for h in MULTI_HORIZONS])


CAL_FEATURES = ["hour_of_day", "day_of_month", "day_of_year", "week_of_year", "quarter", "is_weekend",
                "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end"]


@query("calendar_features")
def q_calendar_features(spark, d):
    out = ft.create_calendar_features(_agg15(spark, d))
    return out.select(*KEYS, "day_of_week", "month", *CAL_FEATURES)


@query("business_hours")
def q_business_hours(spark, d):
    return ft.add_business_hours(_agg15(spark, d)).select(*KEYS, "hour", "is_business_hours")


@query("demand_features")
def q_demand_features(spark, d):
    return rounded(ft.demand_features(tables.demand_5min(spark, d)))


@query("demand_features_chunked")
def q_demand_features_chunked(spark, d):
    """The same chain with 6-hour chunks: about 120 chunk edges per series."""
    return rounded(ft.demand_features(tables.demand_5min(spark, d), chunk=0.25))


@query("demand_features_two_levels")
def q_demand_features_two_levels(spark, d):
    """6-hour chunks whose edge rows are solved by a second level of chunks."""
    return rounded(ft.demand_features(tables.demand_5min(spark, d), chunk=0.25, levels=2, fanout=8))


@query("typed_demand_table")
def q_typed_demand_table(spark, d):
    """A demand table written as CSV text, read back in the declared types, rolled up."""
    path = scratch_dir(spark, "demand-table")
    tables.demand_5min(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return rounded(rollup_15min(tables.read_demand(spark, path, "csv")))


@query("interval_slots")
def q_interval_slots(spark, d):
    """Rows per 5- and 15-minute slot of the day."""
    slots = with_intervals(tables.demand_5min(spark, d))
    return slots.groupBy("interval_5min", "interval_15min").agg(F.count(F.lit(1)).alias("rows"))


def ml_table(spark, d):
    ml, feats, target = ft.prepare_features_for_ml(ft.demand_features(tables.demand_5min(spark, d)))
    return ml, feats, target


@query("ml_features")
def q_ml_features(spark, d):
    return rounded(ml_table(spark, d)[0])


@query("state_one_hot")
def q_state_one_hot(spark, d):
    out = ft.state_one_hot(_agg15(spark, d).drop("state_id"))
    return out.select(*KEYS, "state_id_CA", "state_id_TX", "state_id_WI")


@query("single_observation_aggregates")
def q_single_obs(spark, d):
    rows = _agg15(spark, d).select(*KEYS, F.col(T15).alias("demand"))
    return ft.single_observation_aggregates(rows)


# ---------------------------------------------------------------- feeds (batch)
@query("calendar_feed")
def q_calendar_feed(spark, d):
    return feeds.transform_calendar(tables.calendar(spark, d), with_time=False)


@query("sales_feed")
def q_sales_feed(spark, d):
    return feeds.transform_sales(tables.sales_wide(spark, d), with_time=False)


@query("prices_feed")
def q_prices_feed(spark, d):
    return feeds.transform_prices(tables.prices(spark, d), with_time=False)


@query("calendar_csv_feed")
def q_calendar_csv_feed(spark, d):
    """Calendar dropped as CSV, read back as a batch with the declared schema, then transformed."""
    path = scratch_dir(spark, "calendar-csv")
    tables.calendar(spark, d).write.mode("overwrite").option("header", True).csv(path)
    return feeds.transform_calendar(files.read_feed(spark, path, CALENDAR_SCHEMA, "csv"), with_time=False)


@query("source_monitor")
def q_source_monitor(spark, d):
    outs = {
        "calendar": feeds.transform_calendar(tables.calendar(spark, d)),
        "sales": feeds.transform_sales(tables.sales_wide(spark, d)),
        "prices": feeds.transform_prices(tables.prices(spark, d)),
    }
    return runner.summary(runner.monitor_union(outs)).select("data_source", "record_count")


def _sales_drops(spark, d, fmt):
    """Two drops of one sales table: one with a leading extra column, its keys reordered and days 1 to 8,
    the other with days 5 to 12."""
    wide = tables.sales_wide(spark, d)
    path = scratch_dir(spark, f"sales-drops-{fmt}")
    first = wide.where("store_id = 'CA_1'").select(
        F.concat("item_id", F.lit("_x")).alias("id"), "store_id", "item_id", "cat_id", "dept_id", "state_id", *[f"d_{i}" for i in range(1, 9)])
    second = wide.where("store_id <> 'CA_1'").select(*SALES_KEYS, *[f"d_{i}" for i in range(5, 13)])
    for part in (first, second):
        w = part.write.mode("append")
        (w.option("header", True).csv if fmt == "csv" else getattr(w, fmt))(path)
    return feeds.transform_sales(files.read_sales(spark, path, fmt), with_time=False)


for _fmt in files.FORMATS:
    query(f"sales_drops_{_fmt}")(lambda spark, d, _f=_fmt: _sales_drops(spark, d, _f))


@query("sales_feed_dirty")
def q_sales_feed_dirty(spark, d):
    """Cells that are no numbers and categories that are missing."""
    wide = tables.sales_wide(spark, d)
    odd = F.col("item_id").endswith("7")
    dirty = wide.withColumns({"d_1": F.when(odd, F.lit("x")).otherwise(F.col("d_1").cast("string")), "cat_id": F.when(~odd, F.col("cat_id"))})
    return feeds.transform_sales(dirty, with_time=False)


# ---------------------------------------------------------------- calendar profile
def _cal(spark, d):
    return tables.calendar(spark, d)


PROFILE_QUERIES = {
    "table_shape": profile.shape,
    "date_span": profile.date_span,
    "missing_dates": profile.missing_dates,
    "duplicate_dates": profile.duplicate_dates,
    "null_counts": profile.null_counts,
    "quality_report": profile.quality_report,
    "insight_summary": profile.insight_summary,
    "column_types": profile.column_types,
    "snap_totals": profile.snap_totals,
    "event_share": profile.event_share,
    "event_types": profile.event_types,
    "events_by_month": profile.events_by_month,
    "month_wday_crosstab": profile.month_wday_crosstab,
    "holiday_impact": profile.holiday_impact,
    "head_rows": profile.head,
    "freq_weekday": lambda df: profile.frequency(df, "weekday"),
    "freq_month": lambda df: profile.frequency(df, "month"),
    "freq_year": lambda df: profile.frequency(df, "year"),
    "freq_wday": lambda df: profile.frequency(df, "wday"),
    "snap_by_month": lambda df: profile.snap_by(df, "month"),
    "snap_by_wday": lambda df: profile.snap_by(df, "wday"),
    "describe_numeric": lambda df: rounded(profile.describe_numeric(df)),
    "feature_correlations": lambda df: rounded(profile.feature_correlations(df)),
    "exact_month_edges": lambda df: profile.enhanced(df).select(
        "date", "quarter", "day_of_year", "week_of_year", "is_weekend", "is_month_start", "is_month_end"
    ),
}

for _name, _fn in PROFILE_QUERIES.items():
    query(_name)(lambda spark, d, _f=_fn: _f(_cal(spark, d)))


def _dirty_cal(spark, d):
    """The calendar with all days of February a second time, the tenth of them with a date that doesn't exist."""
    cal = _cal(spark, d)
    again = cal.where("month = 2").withColumn("date", F.when(F.col("date").endswith("-10"), F.lit("2011-13-40")).otherwise(F.col("date")))
    return cal.unionByName(again)


DIRTY_QUERIES = {
    "duplicate_dates_dirty": profile.duplicate_dates,
    "quality_report_dirty": profile.quality_report,
    "date_span_dirty": profile.date_span,
    "calendar_feed_dirty": lambda df: feeds.transform_calendar(df, with_time=False),
}

for _name, _fn in DIRTY_QUERIES.items():
    query(_name)(lambda spark, d, _f=_fn: _f(_dirty_cal(spark, d)))


@query("duplicate_order_dates")
def q_duplicate_order_dates(spark, d):
    """Orders that share their date with another one."""
    return profile.duplicate_dates(tables.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("date")))


# ---------------------------------------------------------------- model inputs, evaluation
@query("category_index")
def q_category_index(spark, d):
    path = scratch_dir(spark, "rollup")  # rolled up once, read for the fit and for the result
    _agg15(spark, d).write.mode("overwrite").parquet(path)
    agg = spark.read.parquet(path)
    fitted = model.category_indexer().fit(agg)
    return fitted.transform(agg).select(*KEYS, *ft.CATEGORICAL, *model.index_names(ft.CATEGORICAL))


@query("time_split_counts")
def q_time_split(spark, d):
    return model.split_counts(ml_table(spark, d)[0])


@query("forecast_errors")
def q_forecast_errors(spark, d):
    return rounded(ev.persistence_forecast(_agg15(spark, d)))


@query("forecast_metrics")
def q_forecast_metrics(spark, d):
    # MAPE reaches ~1e7 once zero actuals hit the 1e-6 floor: two decimals
    # there keep 10 significant digits, within what a float sum over all rows
    # preserves in any summation order.
    m = ev.forecast_metrics(ev.persistence_forecast(_agg15(spark, d)))
    return rounded(m.withColumn("mape", F.round("mape", 2)))


# ---------------------------------------------------------------- streams
def _drop_time(df: DataFrame) -> DataFrame:
    return df.drop("processed_timestamp")


def run_feed_stream(spark, view: DataFrame, feed: str, fmt: str = "csv") -> DataFrame:
    """Drop ``view`` as files (one per task that makes it), stream them through the feed transform
    (``availableNow``, the production budget per trigger) into a checkpointed Parquet sink
    in the shared scratch folder, and return what the sink holds."""
    root = scratch_dir(spark, f"stream-{feed}")
    paths = runner.feed_paths(root, feed)
    w = view.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(paths.input)
    elif fmt == "json":
        w.json(paths.input)
    else:
        w.parquet(paths.input)
    q = runner.start_feed(spark, feed, root, "production", fmt, sink_format="parquet", available_now=True)
    q.awaitTermination()
    runner.raise_failure([q])
    schema = runner.feed_stream(spark, feed, paths.input, fmt).schema
    return _drop_time(spark.read.schema(schema).parquet(paths.output))


@query("stream_calendar")
def q_stream_calendar(spark, d):
    return run_feed_stream(spark, tables.calendar(spark, d), "calendar", "csv")


@query("stream_sales")
def q_stream_sales(spark, d):
    return run_feed_stream(spark, tables.sales_wide(spark, d), "sales", "csv")


@query("stream_prices")
def q_stream_prices(spark, d):
    return run_feed_stream(spark, tables.prices(spark, d), "prices", "csv")


@query("stream_json")
def q_stream_json(spark, d):
    return run_feed_stream(spark, tables.calendar(spark, d), "calendar", "json")


@query("stream_parquet")
def q_stream_parquet(spark, d):
    return run_feed_stream(spark, tables.prices(spark, d), "prices", "parquet")


@query("stream_sales_json")
def q_stream_sales_json(spark, d):
    return run_feed_stream(spark, tables.sales_wide(spark, d), "sales", "json")


@query("stream_sales_parquet")
def q_stream_sales_parquet(spark, d):
    return run_feed_stream(spark, tables.sales_wide(spark, d), "sales", "parquet")


@query("stream_progress")
def q_stream_progress(spark, d):
    root = scratch_dir(spark, "stream-progress")
    paths = runner.feed_paths(root, "prices")
    tables.prices(spark, d).write.option("header", True).csv(paths.input)
    q = runner.start_feed(spark, "prices", root, "production", "csv", sink_format="parquet", available_now=True)
    q.awaitTermination()
    return runner.progress_table(spark, [q])


# ---------------------------------------------------------------- model training and scoring
TRAIN_PARAMS = model.GBTParams()
_MODELS: dict[tuple[str, str], str] = {}


def _trained(spark, d) -> str:
    """Path of the model trained on ``d``; fitted and saved once per application and input."""
    at = (spark.sparkContext.applicationId, d)
    if at not in _MODELS:
        _MODELS[at], _ = model.train_and_save(ft.demand_features(tables.demand_5min(spark, d)), scratch_dir(spark, "models"), TRAIN_PARAMS)
    return _MODELS[at]


@query("train_metrics")
def q_train_metrics(spark, d):
    _MODELS.pop((spark.sparkContext.applicationId, d), None)  # this query is the training
    return model.load_model(spark, _trained(spark, d))[1]


def _scored(spark, d):
    fitted, _ = model.load_model(spark, _trained(spark, d))
    ml, _, target = ml_table(spark, d)
    return model.score_batch(fitted, ml, target)


@query("score_batch")
def q_score_batch(spark, d):
    """Every row of the prepared table, scored by the saved model."""
    return _scored(spark, d)


@query("score_batch_checks")
def q_score_batch_checks(spark, d):
    """Rows scored, rows without a prediction, and rows whose errors don't follow from actual and predicted."""
    e = F.col("actual_demand") - F.col("predicted_demand")
    off = (e != F.col("prediction_error")) | (F.abs(e) != F.col("absolute_error"))
    return _scored(spark, d).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted_demand").isNull()).alias("unscored"),
        F.count_if(off).alias("wrong_errors"), F.sum("actual_demand").cast("long").alias("actual_sum"))


def _batch_rows(spark, d):
    return tables.demand_5min(spark, d).select(
        "timestamp", "item_id", "store_id", "state_id", "cat_id", "dept_id", F.col("demand_5min").alias("demand"))


@query("predict_batch")
def q_predict_batch(spark, d):
    """Raw scoring rows, several to a bucket: one result row each."""
    fitted, _ = model.load_model(spark, _trained(spark, d))
    return model.predict_batch(fitted, _batch_rows(spark, d))


@query("predict_batch_rows")
def q_predict_batch_rows(spark, d):
    """Keys, time and actual demand of the same result, and whether each row has a prediction."""
    out = q_predict_batch(spark, d)
    return out.select("item_id", "store_id", "timestamp", "actual_demand", F.col("predicted_demand").isNotNull().alias("scored"))


@query("feature_importance")
def q_feature_importance(spark, d):
    fitted, _ = model.load_model(spark, _trained(spark, d))
    return model.feature_importance(fitted, ml_table(spark, d)[1], k=10)


@query("train_quality")
def q_train_quality(spark, d):
    """Hold-out rows, the persistence forecast's error on them, and whether the trained model beats it and stopped in time."""
    _, metrics = model.load_model(spark, _trained(spark, d))
    ml, _, target = ml_table(spark, d)
    m, p = metrics.first(), TRAIN_PARAMS
    held = model.with_split(ml).where(model.SPLIT_COL).agg(F.count(F.lit(1)).alias("test_rows"), F.avg(F.abs(F.col(target) - F.col(T15))).alias("mae"))
    in_time = m.rounds_fitted == min(p.max_iter, m.rounds + p.patience)
    return held.select("test_rows", F.round("mae", 6).alias("persistence_mae"), (F.lit(m.test_mae) < F.col("mae")).alias("beats_persistence"), F.lit(in_time).alias("stopped_in_time"))


#: Columns of few values, whose histograms hold every cut.
SPLIT_FEATURES = ["hour", "day_of_week", "month", "is_weekend", "is_month_start", "is_month_end"]


@query("first_split")
def q_first_split(spark, d):
    """The root of the first tree, feature by feature: best cut, rows on its left, gain."""
    ml, _, target = ml_table(spark, d)
    run = Boosting(model.with_split(ml), SPLIT_FEATURES, target, model.SPLIT_COL, GrowParams(bagging_fraction=1.0))
    gains = run.split_gains()
    run.close()
    return gains.select("feature", "cut", "rows_left", F.round("gain", 3).alias("gain"))


# ---------------------------------------------------------------- series state
def _days(spark, d):
    """Rollup before and on the last day, and that day."""
    agg = rollup_15min(tables.demand_5min(spark, d))
    day = agg.agg(F.max("date")).first()[0]
    return agg.where(F.col("date") < F.lit(day)), agg.where(F.col("date") == F.lit(day)), day


@query("features_from_state")
def q_features_from_state(spark, d):
    """The last day's features from the tails of the days before, which were brought up to date by one more day."""
    before, last, day = _days(spark, d)
    eve = before.agg(F.max("date")).first()[0]
    path = scratch_dir(spark, "tails")
    series_tails(before.where(F.col("date") < F.lit(eve))).write.mode("overwrite").parquet(f"{path}/0")
    updated_tails(spark.read.parquet(f"{path}/0"), before.where(F.col("date") == F.lit(eve))).write.mode("overwrite").parquet(f"{path}/1")
    return rounded(features_from_state(spark.read.parquet(f"{path}/1"), last))


@query("predict_from_state")
def q_predict_from_state(spark, d):
    """The last day's raw rows scored from the tails: keys, actual demand, and whether the prediction is that over the full history."""
    fitted, _ = model.load_model(spark, _trained(spark, d))
    before, _, day = _days(spark, d)
    path = scratch_dir(spark, "tails")
    series_tails(before).write.mode("overwrite").parquet(path)
    rows = _batch_rows(spark, d)
    last = F.to_date("timestamp") == F.lit(day)
    keys = ["item_id", "store_id", "timestamp", "actual_demand"]
    by_state = model.predict_batch(fitted, rows.where(last), spark.read.parquet(path)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.avg("predicted_demand").alias("a"))
    whole = model.predict_batch(fitted, rows).where(last).groupBy(*keys).agg(F.avg("predicted_demand").alias("b"))
    return by_state.join(whole, keys).select(*keys, "rows", (F.abs(F.col("a") - F.col("b")) < 1e-6).alias("same"))


@query("refreshed_features")
def q_refreshed_features(spark, d):
    """The feature store after three refreshes: all but the late rows, the late ones, and a series that was missing."""
    rows = tables.demand_5min(spark, d)
    new_series = (F.col("item_id") == "click") & (F.col("store_id") == "TX_1")
    late = F.hour("timestamp") == 7
    store = FeatureStore(spark, scratch_dir(spark, "features"))
    for part in (rows.where(~new_series & ~late), rows.where(~new_series & late), rows.where(new_series)):
        store.refresh(part)
    return rounded(store.features())


@query("sliding_60min")
def q_sliding_60min(spark, d):
    return sliding_sum(tables.demand_5min(spark, d), "60 minutes", "5 minutes")


@query("missing_buckets")
def q_missing_buckets(spark, d):
    return profile.missing_buckets(rollup_15min(tables.demand_5min(spark, d)))


@query("time_range_features")
def q_time_range_features(spark, d):
    out = ft.create_time_range_features(_agg15(spark, d))
    return rounded(out.select(*KEYS, T15, *[ft.span_name(T15, s, w) for w in ("1 hour", "3 hours", "12 hours") for s in ft.ROLLING_STATS]))


def _price_batches(spark, d) -> str:
    """Prices with a letter in every seventh week, dropped as CSV and streamed into a batch table; returns its folder."""
    root = scratch_dir(spark, "stream-batches")
    week = F.when(F.col("wm_yr_wk") % 7 == 0, F.concat(F.lit("w"), "wm_yr_wk")).otherwise(F.col("wm_yr_wk").cast("string"))
    tables.prices(spark, d).withColumn("wm_yr_wk", week).write.option("header", True).csv(f"{root}/input")
    batches.start_batches(spark, "prices", f"{root}/input", f"{root}/table", f"{root}/checkpoint", "production", available_now=True).awaitTermination()
    return f"{root}/table"


@query("stream_batches")
def q_stream_batches(spark, d):
    return _drop_time(batches.read_rows(spark, _price_batches(spark, d), "prices"))


@query("stream_set_aside")
def q_stream_set_aside(spark, d):
    cells = F.split("record", ",")
    bad = batches.read_set_aside(spark, _price_batches(spark, d), "prices")
    return bad.select("reason", cells[0].alias("store_id"), cells[1].alias("item_id"), cells[2].alias("week"))


@query("batch_monitor")
def q_batch_monitor(spark, d):
    """The monitor's figures, and whether its times are those of the stored rows."""
    path = _price_batches(spark, d)
    at = F.col("processed_timestamp")
    stored = batches.read_rows(spark, path, "prices").groupBy("data_source").agg(F.max(at).alias("last"), F.min(at).alias("first"))
    same = (F.col("last") == F.col("last_processed")) & (F.col("first") == F.col("first_processed"))
    return batches.monitor(spark, {"prices": path}).join(stored, "data_source").select("data_source", "record_count", "set_aside", same.alias("times_match"))


@query("price_quantiles")
def q_price_quantiles(spark, d):
    return exact_quantiles(tables.prices(spark, d), ["sell_price", "wm_yr_wk"], (0.01, 0.25, 0.5, 0.75, 0.99), limit=1000).withColumn("value", F.round("value", 6))


@query("part_ranks")
def q_part_ranks(spark, d):
    """Every part as a category: its index by frequency, joined back and summed a line number."""
    lines = tables.table(spark, d, "lineitem").select("l_partkey", "l_linenumber")
    ranked = with_category_index(lines, "l_partkey", category_dictionary(lines, "l_partkey"))
    return ranked.groupBy("l_linenumber").agg(F.sum("l_partkey_idx").cast("long").alias("index_sum"), F.count_distinct("l_partkey_idx").alias("labels"))


NO_ORACLE = {"stream_progress", "train_metrics", "score_batch", "predict_batch", "feature_importance"}
