"""Distributed boosted-tree forecasting on MLlib.

The feature table never leaves the executors: categories are indexed by one
multi-column ``StringIndexer``, features assembled by ``VectorAssembler`` and
the trees grown leaf by leaf over binned rows (``boosting``).  The result is one
``PipelineModel`` with MLlib's boosted-tree model, which is saved, loaded and
applied as a unit (training and scoring cannot drift apart).
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..session import fs_exists, fs_list, shared_root
from .boosting import Boosting, GrowParams
from .features import (CATEGORICAL, TIME_COL, demand_features, feature_columns, prepare_features_for_ml,
                       scoring_demand_rows, select_available)
from .evaluate import prediction_table
from .rollup import SERIES_KEYS, rollup_15min
from .state import features_from_state

MODEL_PREFIX = "demand_gbt_model"
SPLIT_COL = "__tm_is_test"


@dataclass
class GBTParams:
    """Boosting parameters.

    ``max_iter`` caps the rounds.  With ``early_stopping`` the rounds are
    chosen on the hold-out rows: the round with the lowest squared error that
    no later one of the next ``patience`` rounds beats.  Trees have at most
    ``num_leaves`` leaves of ``min_rows`` rows; rows are drawn anew every
    ``bagging_every`` rounds, features for every tree.
    """

    max_iter: int = 1000
    patience: int = 100
    num_leaves: int = 31
    min_rows: int = 20
    bagging_every: int = 5
    max_depth: int = 0  # 0: no limit
    step_size: float = 0.1
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"
    seed: int = 42
    early_stopping: bool = True
    max_bins: int = 64
    checkpoint_interval: int = 10
    extra: dict = field(default_factory=dict)

    def growing(self) -> GrowParams:
        return GrowParams(
            num_leaves=self.num_leaves, min_rows=self.min_rows, step=self.step_size, feature_fraction=float(self.feature_subset),
            bagging_fraction=self.subsampling_rate, bagging_every=self.bagging_every, max_depth=self.max_depth, max_bins=self.max_bins,
            seed=self.seed, fold=self.checkpoint_interval,
        )


def index_names(cols: list[str]) -> list[str]:
    return [f"{c}_idx" for c in cols]


def category_indexer(cols: list[str] = CATEGORICAL, order: str = "frequencyDesc") -> StringIndexer:
    """One indexer for all category columns; unseen or NULL labels get the extra index."""
    return StringIndexer(inputCols=cols, outputCols=index_names(cols), handleInvalid="keep", stringOrderType=order)


def model_inputs(feature_cols: list[str]) -> tuple[list[str], list[str]]:
    cats = [c for c in feature_cols if c in CATEGORICAL]
    assembled = [f"{c}_idx" if c in CATEGORICAL else c for c in feature_cols]
    return cats, assembled


def build_pipeline(feature_cols: list[str], target: str, params: GBTParams = GBTParams()) -> Pipeline:
    """MLlib's own level-wise boosting as one pipeline (all rounds, no early stopping)."""
    cats, assembled = model_inputs(feature_cols)
    stages = []
    if cats:
        stages.append(category_indexer(cats))
    stages.append(VectorAssembler(inputCols=assembled, outputCol="features", handleInvalid="keep"))
    gbt = GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="prediction",
        maxIter=params.max_iter, maxDepth=params.max_depth or 5, stepSize=params.step_size,
        subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
        seed=params.seed, maxBins=params.max_bins, checkpointInterval=params.checkpoint_interval,
        **params.extra,
    )
    stages.append(gbt)
    return Pipeline(stages=stages)


def time_counts(df: DataFrame, ts: str = TIME_COL) -> DataFrame:
    """Rows per bucket time, ``(us, rows)``: one pass, bounded by the number of distinct bucket times."""
    us = tc.epoch_micros(ts, df.schema[ts].dataType)
    return df.groupBy(us.alias("us")).agg(F.count(F.lit(1)).alias("rows"))


def split_cutoff(df: DataFrame, ts: str = TIME_COL, test_size: float = 0.2) -> DataFrame:
    """One-row frame with the time cutoff: the (1 - test_size) quantile, exact (interpolated).

    Its buffer holds one count per distinct time, so ``ts`` should be a bucket time.
    """
    return time_counts(df, ts).agg(F.percentile("us", F.lit(1 - test_size), F.col("rows")).alias("cutoff_us"))


def with_split(df: DataFrame, ts: str = TIME_COL, test_size: float = 0.2, cutoff: float | None = None) -> DataFrame:
    """Mark rows after the cutoff as test (time-ordered hold-out).

    The cutoff is one scalar from a distributed exact-percentile aggregate
    (its buffer holds one count per distinct bucket time); it comes back as
    a literal, so marking the rows is a plain projection.
    """
    if cutoff is None:
        cutoff = split_cutoff(df, ts, test_size).first()["cutoff_us"]
    us = tc.epoch_micros(ts, df.schema[ts].dataType)
    return df.withColumn(SPLIT_COL, us > F.lit(cutoff))


def split_counts(df: DataFrame, ts: str = TIME_COL, test_size: float = 0.2) -> DataFrame:
    """Train and test rows; the table is read once, as rows per bucket time."""
    per = time_counts(df, ts)
    cut = F.percentile("us", F.lit(1 - test_size), F.col("rows")).alias("cut")
    both = per.agg(cut, F.collect_list(F.struct("us", "rows")).alias("each"))  # bounded by the bucket times
    one = both.select("cut", F.explode("each").alias("e"))
    return one.groupBy(F.when(F.col("e.us") > F.col("cut"), "test").otherwise("train").alias("split")).agg(
        F.sum("e.rows").alias("rows")
    )


def metrics_of(pred: DataFrame, target: str) -> DataFrame:
    """MAE and RMSE on train and test rows, one row."""
    err = F.col(target) - F.col("prediction")
    test = F.col(SPLIT_COL)
    return pred.agg(
        F.avg(F.when(~test, F.abs(err))).alias("train_mae"),
        F.sqrt(F.avg(F.when(~test, err * err))).alias("train_rmse"),
        F.avg(F.when(test, F.abs(err))).alias("test_mae"),
        F.sqrt(F.avg(F.when(test, err * err))).alias("test_rmse"),
    )


def fit_boosting(marked: DataFrame, feature_cols: list[str], target: str, params: GBTParams, goes_on: Boosting | None = None) -> tuple[PipelineModel, Boosting]:
    """Boost on the training rows of ``marked`` (those without the hold-out mark); the run comes back with the model.

    With early stopping the model has the rounds that are best on the hold-out;
    the run has fitted ``patience`` rounds more, and no round twice.
    ``goes_on`` is an earlier run over the same rows to add rounds to.  The
    category indexer sees training rows only; a label that is new in the hold-out gets the extra index.
    """
    cats, assembled = model_inputs(feature_cols)
    first, ready = [], marked
    if cats:
        first.append(category_indexer(cats).fit(marked.where(~F.col(SPLIT_COL))))
        ready = first[0].transform(marked)
    run = goes_on or Boosting(ready, assembled, target, SPLIT_COL, params.growing())
    rounds = run.run(params.max_iter, params.patience if params.early_stopping else None)
    first.append(VectorAssembler(inputCols=assembled, outputCol="features", handleInvalid="keep"))
    return PipelineModel([*first, run.model(rounds)]), run


def train_model(ml: DataFrame, feature_cols: list[str], target: str, test_size: float = 0.2,
                params: GBTParams = GBTParams()):
    """Fit on the time-ordered first part, measure on both parts.

    Returns ``(model, metrics_df, test_predictions_df)``.  The feature table
    is persisted (memory, spilling to disk; rebuilt from lineage if an
    executor is lost) while the cutoff pass, the fit and the metrics read
    it, and released afterwards.  The metrics are one row of four errors, the
    model's rounds and the rounds fitted to find them; the test predictions stay lazy.
    """
    shared_root(ml.sparkSession)
    cached = ml.persist()
    try:
        cutoff = split_cutoff(cached, TIME_COL, test_size).first()["cutoff_us"]
        marked = with_split(cached, TIME_COL, test_size, cutoff)
        model, run = fit_boosting(marked, feature_cols, target, params)
        run.close()
        row = (*metrics_of(model.transform(marked), target).first(), len(model.stages[-1].trees), len(run.trees))
    finally:
        cached.unpersist()
    spark = ml.sparkSession
    metrics = spark.createDataFrame(
        [row], "train_mae double, train_rmse double, test_mae double, test_rmse double, rounds int, rounds_fitted int"
    )
    pred = model.transform(with_split(ml, TIME_COL, test_size, cutoff))
    return model, metrics, pred.filter(F.col(SPLIT_COL))


def timestamped_name(prefix: str = MODEL_PREFIX, now: _dt.datetime | None = None) -> str:
    return f"{prefix}_{(now or _dt.datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def save_model(model: PipelineModel, metrics: DataFrame | None, root: str, name: str | None = None) -> str:
    """Write the fitted pipeline and, next to it, its metrics table."""
    name = name or timestamped_name()
    path = os.path.join(root, name)
    model.write().overwrite().save(path)
    if metrics is not None:
        metrics.withColumn("model_name", F.lit(name)).write.mode("overwrite").parquet(path + "_metrics")
    return path


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame | None]:
    """Load a pipeline; its metrics table if present."""
    if not fs_exists(spark, path):
        raise FileNotFoundError(f"Model not found: {path}")
    model = PipelineModel.load(path)
    mpath = path + "_metrics"
    metrics = spark.read.parquet(mpath) if fs_exists(spark, mpath) else None
    return model, metrics


def model_registry(spark: SparkSession, root: str, prefix: str = MODEL_PREFIX) -> DataFrame:
    """Saved models under ``root`` (one directory listing; names only)."""
    names = sorted(n for n in fs_list(spark, root) if n.startswith(prefix) and not n.endswith("_metrics"))
    return spark.createDataFrame([(n, os.path.join(root, n)) for n in names], "model_name string, path string")


def latest_model(spark: SparkSession, root: str, prefix: str = MODEL_PREFIX) -> str:
    reg = model_registry(spark, root, prefix).orderBy(F.desc("model_name")).limit(1).collect()
    if not reg:
        raise FileNotFoundError(f"no model under {root}")
    return reg[0]["path"]


def assembled_inputs(model: PipelineModel) -> list[str]:
    """Input columns the fitted pipeline reads from the table (not made by an earlier stage)."""
    produced, wanted = set(), []
    for stage in model.stages:
        if stage.hasParam("inputCols") and stage.isDefined("inputCols"):
            wanted += [c for c in stage.getOrDefault("inputCols") if c not in produced]
        if stage.hasParam("outputCols") and stage.isDefined("outputCols"):
            produced |= set(stage.getOrDefault("outputCols"))
    return list(dict.fromkeys(wanted))


def predict(model: PipelineModel, df: DataFrame, allow_missing: bool = False) -> DataFrame:
    """Apply the fitted pipeline (runs on the executors).

    A feature column that the model needs and ``df`` lacks is an error; with
    ``allow_missing`` it enters as the fill value (0, or an unseen category).
    """
    wanted = assembled_inputs(model)
    have = select_available(df, wanted, allow_missing)
    missing = [c for c in wanted if c not in have]
    if missing:
        df = df.withColumns(
            {c: F.lit(None).cast("string") if c in CATEGORICAL else F.lit(0.0) for c in missing}
        )
    return model.transform(df)


def score_batch(model: PipelineModel, features: DataFrame, actual: str) -> DataFrame:
    """Score a prepared feature table into the 7-column result."""
    return prediction_table(predict(model, features), actual, "prediction")


def predict_batch(model: PipelineModel, rows: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """Raw scoring rows (timestamp, item_id, store_id, [state_id, cat_id, dept_id], demand) ->
    the 7-column result, one row per input row.

    Predictions come from the same rollup and feature chain as training, per
    bucket; each is joined back to every row of its bucket, which keeps its own
    time and its own demand as ``actual_demand``.  With ``tails`` (``state.series_tails``
    of the history) the rows continue that history, of which only the tails
    are read; a row that is not later than its series' tail has no prediction then.
    """
    observed = scoring_demand_rows(rows)
    if tails is None:
        feats = demand_features(observed, value="demand_5min")
    else:
        feats = features_from_state(tails, rollup_15min(observed))
    numeric = [c for c in feature_columns(feats.columns) if c not in CATEGORICAL]
    feats = feats.fillna(0, subset=[c for c in numeric if c in feats.columns])
    keys = [*SERIES_KEYS, *CATEGORICAL, TIME_COL]
    by_bucket = predict(model, feats).select(*[F.col(k).alias(f"__tm_{k}") for k in keys], "prediction")
    own = observed.withColumn(TIME_COL, tc.bucket_start("timestamp", "15 minutes", observed.schema["timestamp"].dataType))
    same = [F.col(k).eqNullSafe(F.col(f"__tm_{k}")) for k in keys]
    joined = own.join(by_bucket, reduce(and_, same), "left")
    return prediction_table(joined, "demand_5min", "prediction", "timestamp")


def feature_importance(model: PipelineModel, feature_cols: list[str], k: int | None = None) -> DataFrame:
    """Importance per input feature of the fitted trees, largest first."""
    spark = SparkSession.getActiveSession()
    gbt = model.stages[-1]
    _, assembled = model_inputs(feature_cols)
    imp = gbt.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(assembled, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return df.limit(k) if k else df


def train_and_save(features: DataFrame, model_root: str, params: GBTParams = GBTParams(), test_size: float = 0.2,
                   name: str | None = None) -> tuple[str, DataFrame]:
    """A feature table (also a stored one) -> ML table -> fit, measure -> save."""
    ml, feats, target = prepare_features_for_ml(features)
    fitted, metrics, _ = train_model(ml, feats, target, test_size, params)
    return save_model(fitted, metrics, model_root, name), metrics


def run_training(demand: DataFrame, model_root: str, params: GBTParams = GBTParams(), test_size: float = 0.2,
                 name: str | None = None) -> tuple[str, DataFrame]:
    """Intraday demand rows -> features -> fit, measure -> save.

    Returns the saved model path and its one-row metrics table.
    """
    return train_and_save(demand_features(demand), model_root, params, test_size, name)
