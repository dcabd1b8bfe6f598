"""Demand forecast: evaluation on a holdout, the forecast table, and the run record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.forecast import (
    compare_models,
    fit_seasonal,
    holdout_split,
    naive_baseline,
    predict_seasonal,
)

MODEL, BASELINE = "seasonal", "naive"


def evaluate(series: DataFrame, n: int = 30) -> DataFrame:
    """MAPE of the seasonal model and of last week's value on the last ``n`` days."""
    train, holdout = holdout_split(series, n=n)
    preds = {
        MODEL: predict_seasonal(holdout.select("ds"), fit_seasonal(train)),
        BASELINE: naive_baseline(series),
    }
    return compare_models(holdout, preds, baseline=BASELINE)


def run_record(evaluation: DataFrame, forecast: DataFrame) -> DataFrame:
    """The run's key figures as one row; both inputs shrink to one row before they meet."""

    def of(model: str, col: str):
        return F.max(F.when(F.col("model") == model, F.col(col)))

    quality = evaluation.agg(
        of(MODEL, "mape").alias("model_mape"),
        of(BASELINE, "mape").alias("naive_mape"),
        of(MODEL, "beats_baseline").alias("model_beats_naive"),
    )
    output = forecast.agg(
        F.count(F.lit(1)).alias("output_rows"),
        F.count_if(~F.col("is_future")).alias("historical_rows"),
        F.count_if("is_future").alias("future_rows"),
    )
    both = quality.unionByName(output, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])
