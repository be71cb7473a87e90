"""Forecast results and error metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats as st
from . import series as S
from .features import TARGET_COL, TIME_COL
from .rollup import SERIES_KEYS


def prediction_table(df: DataFrame, actual: str, predicted: str, ts: str = TIME_COL) -> DataFrame:
    """The 7-column result: keys, time, actual, predicted, signed and absolute error."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.select(
        "item_id", "store_id", F.col(ts).alias("timestamp"),
        a.alias("actual_demand"), p.alias("predicted_demand"),
        st.signed_error(a, p).alias("prediction_error"),
        st.absolute_error(a, p).alias("absolute_error"),
    )


def persistence_forecast(agg15: DataFrame, **series_kw) -> DataFrame:
    """Predict each bucket's total by the previous bucket of the same series."""
    lagged = S.over_series(
        agg15, SERIES_KEYS, TIME_COL, [S.lag_expr(TARGET_COL, 1, "_pred")], **series_kw
    ).filter(F.col("_pred").isNotNull())
    return prediction_table(lagged, TARGET_COL, "_pred")


def forecast_metrics(results: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE (denominator floored at 1e-6), mean actual and predicted."""
    return results.agg(
        st.mae("prediction_error").alias("mae"),
        st.rmse("prediction_error").alias("rmse"),
        st.mape("actual_demand", "predicted_demand").alias("mape"),
        F.avg("actual_demand").alias("mean_actual"),
        F.avg("predicted_demand").alias("mean_predicted"),
    )
