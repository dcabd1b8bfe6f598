"""Daily-series forecasting in relational aggregates.

The model is a straight trend plus a day-of-week effect. Both, and the residual
spread, follow from the moments of (day, value) within each weekday, so fitting any
number of series is one partially aggregated shuffle down to seven rows per series;
no series is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def _day(ds: str) -> Column:
    return F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double")


def prepare_series(df: DataFrame, ds: str, y: str, series: Sequence[str] = ()) -> DataFrame:
    """``(series…, ds DATE, y)`` from any daily table."""
    return df.select(*series, F.col(ds).cast("date").alias("ds"), F.col(y).alias("y"))


def holdout_split(
    df: DataFrame, ds: str = "ds", n: int = 30, series: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(train, holdout)``: per series, the last ``n`` observed days are the holdout.

    Ranking is cut to ``n`` rows per series before the shuffle; the training side is
    then everything older than the first holdout day.
    """
    newest = Window.partitionBy(*series).orderBy(F.desc(ds))
    holdout = df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")
    if series:
        first_held = holdout.groupBy(*series).agg(F.min(ds).alias("_cutoff"))
        older = df.join(first_held, list(series), "inner").filter(F.col(ds) < F.col("_cutoff"))
        return older.drop("_cutoff"), holdout
    first_held = holdout.agg(F.min(ds).alias("_cutoff"))
    return df.filter(F.col(ds) < first_held.scalar()), holdout


def fit_seasonal(df: DataFrame, ds: str = "ds", y: str = "y", series: Sequence[str] = ()) -> DataFrame:
    """Seven rows per series: ``_weekday, _slope, _level, _sigma, _last_day``.

    ``_level`` already contains intercept and weekday effect; a weekday without any
    observation gets the bare trend. The moments within each weekday come from the
    numerically stable ``regr_*`` aggregates and are then merged per series.
    """
    t, v = _day(ds), F.col(y).cast("double")
    usable = df.filter(F.col(y).isNotNull() & F.col(ds).isNotNull())
    weekly = usable.groupBy(*series, F.dayofweek(ds).alias("_wd")).agg(
        F.count(F.lit(1)).cast("double").alias("_n"),
        F.avg(t).alias("_mean_t"),
        F.avg(v).alias("_mean_v"),
        F.regr_sxx(v, t).alias("_tt"),
        F.regr_sxy(v, t).alias("_tv"),
        F.regr_syy(v, t).alias("_vv"),
        F.max(ds).alias("_last"),
    )
    n = F.col("_n")
    merged = weekly.groupBy(*series).agg(
        # At most seven entries.
        F.collect_list(F.struct("_wd", "_n", "_mean_t", "_mean_v", "_tt", "_tv", "_vv")).alias("_parts"),
        F.sum(n).alias("_days"),
        (F.sum(n * F.col("_mean_t")) / F.sum(n)).alias("_centre_t"),
        (F.sum(n * F.col("_mean_v")) / F.sum(n)).alias("_centre_v"),
        F.max("_last").alias("_last_day"),
    )
    t0, v0, b = F.col("_centre_t"), F.col("_centre_v"), F.col("_slope")

    def over_parts(term) -> Column:
        return F.aggregate("_parts", F.lit(0.0), lambda acc, p: acc + term(p))

    joint = over_parts(lambda p: p["_tv"] + p["_n"] * (p["_mean_t"] - t0) * (p["_mean_v"] - v0))
    spread = over_parts(lambda p: p["_tt"] + p["_n"] * (p["_mean_t"] - t0) * (p["_mean_t"] - t0))
    left_over = over_parts(lambda p: p["_vv"] - 2 * b * p["_tv"] + b * b * p["_tt"])
    fitted = (
        merged.filter("_days > 0")
        .withColumn("_slope", F.coalesce(F.try_divide(joint, spread), F.lit(0.0)))
        .withColumn("_sigma", F.sqrt(F.greatest(F.try_divide(left_over, F.col("_days") - 1), F.lit(0.0))))
        .withColumn("_weekday", F.explode(F.sequence(F.lit(1), F.lit(7))))
    )
    seen = F.get(F.filter("_parts", lambda p: p["_wd"] == F.col("_weekday")), F.lit(0))
    level = F.coalesce(seen["_mean_v"] - b * seen["_mean_t"], v0 - b * t0)
    return fitted.select(*series, "_weekday", "_slope", level.alias("_level"), "_sigma", "_last_day")


def predict_seasonal(days: DataFrame, fit: DataFrame, ds: str = "ds", series: Sequence[str] = ()) -> DataFrame:
    """Add ``yhat`` and the residual spread ``_sigma`` to a frame of days."""
    by_weekday = fit.select(*series, "_weekday", "_slope", "_level", "_sigma")
    if not series:
        by_weekday = F.broadcast(by_weekday)  # seven rows
    joined = days.withColumn("_weekday", F.dayofweek(ds)).join(by_weekday, [*series, "_weekday"], "left")
    yhat = F.col("_level") + F.col("_slope") * _day(ds)
    return joined.withColumn("yhat", yhat).drop("_weekday", "_slope", "_level")


def future_days(fit: DataFrame, horizon: int, ds: str = "ds", series: Sequence[str] = ()) -> DataFrame:
    """The ``horizon`` days after the last observed day of each series."""
    ahead = F.sequence(F.date_add("_last_day", 1), F.date_add("_last_day", horizon))
    return fit.filter("_weekday = 1").select(*series, F.explode(ahead).alias(ds))


def seasonal_forecast(
    df: DataFrame,
    ds: str = "ds",
    y: str = "y",
    series: Sequence[str] = (),
    horizon: int = 30,
    interval: float = 0.80,
) -> DataFrame:
    """Fit on all days; return fitted history plus ``horizon`` future days with bounds."""
    fit = fit_seasonal(df, ds, y, series)
    history = df.select(*series, ds, F.col(y).alias("_actual"))
    ahead = future_days(fit, horizon, ds, series).withColumn("_actual", F.lit(None).cast(df.schema[y].dataType))
    z = NormalDist().inv_cdf(0.5 + interval / 2)
    out = predict_seasonal(history.unionByName(ahead), fit, ds, series)
    band = F.lit(z) * F.col("_sigma")
    return out.select(
        *series,
        F.col(ds).alias("forecast_date"),
        F.col("_actual").alias("actual_trip_count"),
        F.col("yhat").alias("predicted_trip_count"),
        (F.col("yhat") - band).alias("predicted_lower_bound"),
        (F.col("yhat") + band).alias("predicted_upper_bound"),
        F.col("_actual").isNull().alias("is_future"),
    )


def naive_baseline(
    df: DataFrame, ds: str = "ds", y: str = "y", lag_days: int = 7, series: Sequence[str] = ()
) -> DataFrame:
    """Add ``yhat``: the actual value exactly ``lag_days`` calendar days earlier.

    The lookup is by date, so a missing day gives NULL instead of shifting the series.
    """
    earlier = df.select(*series, F.date_add(ds, lag_days).alias(ds), F.col(y).alias("yhat"))
    return df.join(earlier, [*series, ds], "left")


def mape(df: DataFrame, actual: str = "y", pred: str = "yhat") -> DataFrame:
    """Mean absolute percentage error over scorable rows, and how many were not."""
    a, p = F.col(actual).cast("double"), F.col(pred).cast("double")
    error = F.abs(F.try_divide(a - p, a))
    return df.agg(
        (F.avg(error) * 100).alias("mape"),
        F.count(error).alias("scored_days"),
        F.count_if(error.isNull()).alias("unscored_days"),
    )


def compare_models(
    holdout: DataFrame,
    preds: Mapping[str, DataFrame],
    baseline: str,
    ds: str = "ds",
    y: str = "y",
    series: Sequence[str] = (),
) -> DataFrame:
    """One row per model: MAPE on the holdout days and whether it beats ``baseline``."""
    keys = [*series, ds]
    actuals = holdout.select(*keys, F.col(y).alias("_y"))
    scored = None
    for model, frame in preds.items():
        aligned = actuals.join(frame.select(*keys, "yhat"), keys, "inner")
        row = mape(aligned, "_y", "yhat").withColumn("model", F.lit(model))
        scored = row if scored is None else scored.unionByName(row)
    # One row per model from here on.
    reference = F.max(F.when(F.col("model") == baseline, F.col("mape"))).over(Window.partitionBy())
    beats = F.coalesce(F.col("mape") < reference, F.lit(False))
    return scored.select("model", "mape", "scored_days", "unscored_days", beats.alias("beats_baseline"))
