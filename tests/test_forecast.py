import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import forecast as fc
from harborline.plans import marts

START = dt.date(2023, 1, 1)


def series(spark, values, start=START, skip=()):
    rows = [(start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values) if i not in skip]
    return spark.createDataFrame(rows, "ds date, y double")


def test_exact_pattern_is_recovered(spark):
    values = [100 + 2 * i + (10 if i % 7 == 0 else 0) for i in range(70)]
    got = fc.seasonal_forecast(series(spark, values), horizon=14).orderBy("forecast_date").collect()
    assert len(got) == 84 and sum(r.is_future for r in got) == 14
    assert got[-1].forecast_date == START + dt.timedelta(days=83)
    # Weekday and trend are not exactly separable over a finite window, but nearly.
    for i, r in enumerate(got):
        expected = 100 + 2 * i + (10 if i % 7 == 0 else 0)
        assert abs(r.predicted_trip_count - expected) < 1.0
        assert r.predicted_lower_bound <= r.predicted_trip_count <= r.predicted_upper_bound
        assert (r.actual_trip_count is None) == r.is_future


def test_fit_matches_a_plain_least_squares_computation(spark):
    rng = random.Random(5)
    values = [50 + 0.3 * i + rng.gauss(0, 4) for i in range(90)]
    fit = fc.fit_seasonal(series(spark, values)).collect()
    t = np.array([(START + dt.timedelta(days=i) - dt.date(1970, 1, 1)).days for i in range(90)], float)
    y = np.array(values)
    slope = np.polyfit(t - t.mean(), y, 1)[0]
    weekday = np.array([(START + dt.timedelta(days=i)).isoweekday() % 7 + 1 for i in range(90)])
    residual = y.copy()
    assert len(fit) == 7
    for r in fit:
        days = weekday == r._weekday
        level = (y[days] - slope * t[days]).mean()
        assert r._slope == pytest.approx(slope, rel=1e-9) and r._level == pytest.approx(level, rel=1e-9)
        residual[days] = y[days] - slope * t[days] - level
    assert fit[0]._sigma == pytest.approx(residual.std(ddof=1), rel=1e-9)


def test_unseen_weekday_gets_the_bare_trend(spark):
    mondays = [START + dt.timedelta(days=1 + 7 * i) for i in range(6)]
    df = spark.createDataFrame([(d, 10.0 + i) for i, d in enumerate(mondays)], "ds date, y double")
    ahead = fc.seasonal_forecast(df, horizon=7).filter("is_future").orderBy("forecast_date").collect()
    assert len(ahead) == 7 and all(r.predicted_trip_count is not None for r in ahead)
    assert ahead[-1].predicted_trip_count == pytest.approx(16.0)


def test_one_day_series_predicts_itself(spark):
    got = fc.seasonal_forecast(series(spark, [5]), horizon=2).orderBy("forecast_date").collect()
    assert [r.predicted_trip_count for r in got] == [5.0, 5.0, 5.0]


def test_series_are_fitted_independently(spark):
    a = series(spark, range(30)).withColumn("name", F.lit("a"))
    b = series(spark, [7] * 30).withColumn("name", F.lit("b"))
    both = fc.seasonal_forecast(a.unionByName(b), series=["name"], horizon=3)
    alone = fc.seasonal_forecast(series(spark, range(30)), horizon=3)
    pick = lambda df: [round(r.predicted_trip_count, 9) for r in df.orderBy("forecast_date").collect()]
    assert pick(both.filter("name = 'a'")) == pick(alone)
    assert set(pick(both.filter("name = 'b'"))) == {7.0}


def test_holdout_is_positional(spark):
    df = series(spark, range(20), skip={15, 16})
    train, holdout = fc.holdout_split(df, n=5)
    assert [r.y for r in holdout.orderBy("ds").collect()] == [13.0, 14.0, 17.0, 18.0, 19.0]
    assert train.count() == 13 and train.agg(F.max("y")).first()[0] == 12.0


def test_holdout_per_series(spark):
    a = series(spark, range(6)).withColumn("name", F.lit("a"))
    b = series(spark, range(3)).withColumn("name", F.lit("b"))
    train, holdout = fc.holdout_split(a.unionByName(b), n=2, series=["name"])
    assert train.groupBy("name").count().orderBy("name").collect()[0]["count"] == 4
    assert holdout.count() == 4 and train.count() == 5


def test_naive_looks_up_by_date_not_position(spark):
    df = series(spark, range(20), skip={5})
    got = {r.ds: r.yhat for r in fc.naive_baseline(df).collect()}
    assert got[START + dt.timedelta(days=12)] is None
    assert got[START + dt.timedelta(days=13)] == 6.0


def test_mape_skips_zero_and_missing_and_says_so(spark):
    df = spark.createDataFrame([(100.0, 90.0), (0.0, 5.0), (50.0, None), (200.0, 220.0)], "y double, yhat double")
    assert tuple(fc.mape(df).first()) == (pytest.approx(10.0), 2, 2)


def test_compare_models(spark):
    df = series(spark, [10 + (i % 7) for i in range(60)])
    train, holdout = fc.holdout_split(df, n=14)
    preds = {"seasonal": fc.predict_seasonal(holdout.select("ds"), fc.fit_seasonal(train)), "naive": fc.naive_baseline(df)}
    got = {r.model: r for r in fc.compare_models(holdout, preds, baseline="naive").collect()}
    assert got["naive"].mape == 0.0 and got["naive"].beats_baseline is False
    assert got["seasonal"].scored_days == 14 and got["seasonal"].beats_baseline is False


def test_forecast_mart_guards_its_error(spark):
    df = spark.createDataFrame([(10.0, 12.0, False), (0.0, 5.0, False), (None, 5.0, True)],
                               "actual_trip_count double, predicted_trip_count double, is_future boolean")
    assert [r.pct_error for r in marts.mart_demand_forecast(df).collect()] == [0.2, None, None]
