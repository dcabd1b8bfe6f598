import datetime as dt

import pytest

from harborline.plans import marts

D1, D2, D3 = (dt.date(2023, 1, i) for i in (1, 2, 3))


def daily(spark):
    return spark.createDataFrame(
        [(D1, 10, 1.0, 0.0, 0.0, 1.0, 0.0), (D2, 20, 2.0, 4.0, 0.0, 1.0, 0.0), (D3, 5, 1.0, 0.0, 0.0, 1.0, 0.0)],
        "pickup_date date, trip_count bigint, total_revenue double, precipitation_mm double, snowfall_cm double, "
        "temp_max_c double, temp_min_c double",
    )


def sla(spark):
    return spark.createDataFrame(
        [(D1, 1, 8, 4, 4, 0.5, 10.0), (D1, 2, 2, 2, 0, 1.0, None), (D2, 1, 20, 5, 15, 0.25, 30.0)],
        "pickup_date date, pickup_location_id bigint, total_trips bigint, on_time_trips bigint, delayed_trips bigint, "
        "on_time_rate double, avg_delay_minutes double",
    )


def weather(spark):
    return spark.createDataFrame(
        [(D1, "Clear", 10, 6, 4, 0.6, 10.0), (D2, "Rain", 20, 5, 15, 0.25, 30.0)],
        "pickup_date date, weather_severity string, total_trips bigint, on_time_trips bigint, delayed_trips bigint, "
        "on_time_rate double, avg_delay_minutes double",
    )


def test_daily_performance_keeps_every_day_and_uses_ratio_of_sums(spark):
    got = {r.pickup_date: r for r in marts.int_daily_performance(daily(spark), sla(spark), weather(spark)).collect()}
    assert set(got) == {D1, D2, D3}
    assert got[D1].on_time_rate == 0.6 and got[D1].avg_delay_minutes == 10.0
    assert got[D3].sla_total_trips is None and got[D3].weather_severity is None


def test_two_severities_on_a_day_break_the_contract_and_fan_out(spark):
    doubled = weather(spark).unionByName(weather(spark).limit(1))
    assert marts.int_daily_performance(daily(spark), sla(spark), doubled).count() == 4


def test_correlation_mart(spark):
    perf = marts.int_daily_performance(daily(spark), sla(spark), weather(spark))
    got = {r.weather_severity: r for r in marts.mart_weather_delay_correlation(perf).collect()}
    assert set(got) == {"Clear", "Rain", None}  # a day without weather keeps its own group
    assert got["Rain"].delay_lift_vs_clear_minutes == 20.0
    assert got["Rain"].on_time_rate_delta_vs_clear == pytest.approx(-0.35)
    assert got["Clear"].corr_precipitation_delay == pytest.approx(1.0)
    assert got["Clear"].corr_snowfall_delay is None  # all-zero snowfall has no correlation


def test_correlation_mart_without_baseline_days(spark):
    perf = marts.int_daily_performance(daily(spark), sla(spark), weather(spark)).filter("weather_severity = 'Rain'")
    got = marts.mart_weather_delay_correlation(perf).collect()
    assert len(got) == 1 and got[0].delay_lift_vs_clear_minutes is None


def test_no_cross_join_in_the_correlation_mart(spark):
    perf = marts.int_daily_performance(daily(spark), sla(spark), weather(spark))
    plan = marts.mart_weather_delay_correlation(perf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_review_analytics_uses_unweighted_monthly_means(spark):
    monthly = spark.createDataFrame(
        [("a", "2020-01", 100, 5.0, 1.0), ("a", "2020-02", 1, 1.0, 0.0), ("a", "2021-01", 1, 3.0, None)],
        "category string, review_month string, review_count bigint, avg_rating double, verified_purchase_pct double",
    )
    got = {r.review_year: r for r in marts.mart_review_analytics(marts.stg_review_summary(monthly)).collect()}
    assert got[2020].avg_rating == 3.0 and got[2020].review_count == 101
    assert got[2020].lifetime_avg_rating == 3.0 and got[2020].lifetime_review_count == 102
    assert got[2020].lifetime_avg_verified_pct == 0.5 and got[2021].avg_verified_purchase_pct is None


def test_vendor_performance(spark):
    ts = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame(
        [("o1", 1, 10.0, "delivered", ts), ("o2", 1, 20.0, "cancelled", ts), ("o3", 2, None, "in_transit", ts)],
        "order_id string, vendor_id bigint, order_value double, current_status string, last_event_timestamp timestamp",
    )
    got = {r.vendor_id: r for r in marts.mart_vendor_performance(orders).collect()}
    assert (got[1].total_orders, got[1].delivered_rate, got[1].avg_order_value) == (2, 0.5, 15.0)
    assert (got[2].delivered_orders, got[2].cancelled_rate, got[2].total_order_value) == (0, 0.0, None)


def test_there_are_29_staging_contracts():
    kinds = [r.name for rules in marts.staging_contracts().values() for r in rules]
    assert len(kinds) == 29
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 15, "unique": 3, "accepted_range": 9, "accepted_values": 2}
