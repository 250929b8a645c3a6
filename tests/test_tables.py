"""Silver, gold and feature tables on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waybill.operators import contracts, dedup, scd, tracks
from waybill.plans import features, gold, silver
from waybill.schemas import ORDERS

GPS = ("event_id int, order_id int, driver_id int, latitude double, longitude double, accuracy double, "
       "event_timestamp timestamp, ingestion_timestamp timestamp")
ORDER = ("order_id int, driver_id int, order_type string, created_at timestamp, pickup_lat double, pickup_lon double, "
         "delivery_lat double, delivery_lon double, expected_delivery_minutes int, actual_delivery_minutes int")


def order(i, driver=1, at=datetime(2024, 1, 1, 8), expected=10, actual=12):
    return (i, driver, "standard", at, 40.7, -74.0, 40.8, -73.9, expected, actual)


def test_dedup_keeps_the_first_arrival_whatever_the_partitioning(spark, ts):
    rows = [
        (1, 10, 1, 40.0, -74.0, 5.0, ts(5), ts(60)),
        (1, 11, 1, 41.0, -74.0, 5.0, ts(3), ts(60)),   # same arrival: earlier event wins
        (1, 12, 1, 42.0, -74.0, 5.0, ts(1), ts(61)),
        (2, 13, 1, 42.0, -74.0, 5.0, ts(1), ts(61)),
    ]
    for n in (1, 3):
        df = spark.createDataFrame(rows, GPS).repartition(n)
        got = {r.event_id: r.order_id for r in silver.gps_events(df).collect()}
        assert got == {1: 11, 2: 13}
    stats = dedup.dedup_summary(spark.createDataFrame(rows, GPS), "event_id", "gps").first()
    assert (stats.rows_input, stats.rows_output, stats.duplicates_removed, stats.duplicate_ratio) == (4, 2, 2, 50.0)


def test_content_dedup_and_merge(spark, ts):
    rows = [(5, 1, 1, 40.0, -74.0, 1.0, ts(1), ts(9)), (3, 1, 1, 40.0, -74.0, 2.0, ts(1), ts(9)), (4, 1, 1, 40.0, -74.0, 3.0, ts(2), ts(9))]
    df = spark.createDataFrame(rows, GPS).drop("ingestion_timestamp")
    kept = dedup.content_dedup(df, ["order_id", "driver_id", "latitude", "longitude", "event_timestamp"], "event_id")
    assert {(r.event_id, r.accuracy) for r in kept.collect()} == {(3, 2.0), (4, 3.0)}
    full = spark.createDataFrame(rows, GPS)
    merged = dedup.merge_first_arrivals(full.where("event_id = 5"), full, "event_id", "ingestion_timestamp")
    assert sorted(r.event_id for r in merged.collect()) == [3, 4, 5]


def test_contract_quarantine(spark):
    raw = spark.createDataFrame(
        [("1", "7", "2024-01-01 00:00:00", "10"), ("2", None, "2024-01-01", "x"), (None, "7", "2024-01-01", "1"),
         ("3", "7", "no date", "1"), ("4", "7", None, "1")],
        "order_id string, driver_id string, created_at string, actual_delivery_minutes string",
    )
    tagged = contracts.tagged(raw, ORDERS, ["order_id", "driver_id", "created_at"])
    reasons = [r[contracts.REASON] for r in tagged.collect()]
    assert reasons == [None, "no driver_id", "no order_id", "bad created_at", "no created_at"]
    assert dict(contracts.accepted(tagged).dtypes)["actual_delivery_minutes"] == "int"
    assert contracts.accepted(tagged).count() + contracts.quarantined(tagged).count() == 5
    assert contracts.meets_silver(raw, "orders") and contracts.meets_silver(raw, "other")
    assert not contracts.meets_silver(raw, "gps_events") and not contracts.meets_bronze(raw)
    assert contracts.schema_report(raw)["order_id"] == "string"


def test_nan_becomes_null_on_the_way_in(spark):
    raw = spark.createDataFrame([(1.0,), (float("nan"),)], "pickup_lat double")
    assert [r.pickup_lat for r in contracts.tagged(raw, ORDERS, []).collect()] == [1.0, None]


CHANGE = "driver_id int, vehicle string, risk double, change_ts timestamp"


def versions(df):
    return [tuple(r) for r in df.orderBy("driver_id", "effective_date").collect()]


def test_scd2(spark):
    day = lambda d: datetime(2024, 1, d)
    changes = spark.createDataFrame(
        [(1, "van", None, day(1)), (1, "van", None, day(2)), (1, "van", 0.1, day(3)), (1, "bike", 0.1, day(9)), (2, "car", 0.2, day(1))],
        CHANGE,
    )
    first = scd.build_history(changes, "driver_id", ["vehicle", "risk"], "change_ts")
    assert versions(first) == [
        (1, "van", None, day(1), day(3), False), (1, "van", 0.1, day(3), day(9), False), (1, "bike", 0.1, day(9), None, True),
        (2, "car", 0.2, day(1), None, True),
    ]
    late = spark.createDataFrame([(1, "truck", 0.1, day(5)), (3, "car", 0.3, day(4)), (1, "bike", 0.1, day(10))], CHANGE)
    second = scd.upsert(first, late, "driver_id", ["vehicle", "risk"], "change_ts")
    assert [v[1] for v in versions(second) if v[0] == 1] == ["van", "van", "truck", "bike"]
    stats = scd.upsert_summary(first, second, "driver_id").first()
    assert (stats.rows_inserted, stats.rows_updated, stats.records_closed) == (2, 1, 0)
    again = scd.upsert(second, late, "driver_id", ["vehicle", "risk"], "change_ts")
    assert versions(again) == versions(second)


def test_deliveries_and_summary(spark):
    table = gold.deliveries(spark.createDataFrame([order(1), order(2, actual=16), order(3, actual=None)], ORDER))
    assert table.columns == gold.DELIVERY_COLUMNS
    rows = {r.order_id: r for r in table.collect()}
    assert rows[1].delay_flag == 0 and rows[2].delay_flag == 1 and rows[3].delay_flag == 0
    assert rows[3].delay_minutes is None and rows[3].traffic_score is None
    s = gold.deliveries_summary(table).first()
    assert (s.rows_created, s.avg_delay_minutes, s.on_time_ratio) == (3, 4.0, 66.67)


def test_driver_daily(spark, ts):
    orders = [order(1), order(2, actual=16), order(3, actual=None), order(4, driver=2), order(5, driver=None)]
    gps = [(1, 1, 1, 40.0, -74.0, 5.0, ts(9), ts(99)), (2, 1, 1, 40.0, -74.0, 5.0, ts(9), ts(99)), (3, 1, None, 40.0, -74.0, 5.0, ts(9), ts(99))]
    out = gold.driver_daily(spark.createDataFrame(orders, ORDER), spark.createDataFrame(gps, GPS), with_distance=True)
    rows = {r.driver_id: r for r in out.collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].metric_date, rows[1].deliveries_completed, rows[1].on_time_ratio) == (date(2024, 1, 1), 3, 33.33)
    assert rows[1].avg_delay_minutes == 4.0 and rows[1].gps_points_count == 2 and rows[2].gps_points_count is None
    assert rows[1].total_distance_km == pytest.approx(3 * rows[1].avg_route_distance_km)
    s = gold.driver_daily_summary(out).first()
    assert (s.rows_created, s.drivers_count, s.avg_daily_deliveries) == (2, 2, 2.0)


def test_region_hours(spark, ts):
    gps = [
        (1, 1, 1, 40.8, -73.8, 5.0, ts(5), ts(99)), (2, 1, 1, 40.8, -73.8, 5.0, ts(59), ts(99)),
        (3, 1, 2, 40.8, -73.8, 5.0, ts(59), ts(99)), (4, 1, None, 40.8, -73.8, 5.0, ts(60), ts(99)),
    ]
    table = gold.region_hourly(spark.createDataFrame(gps, GPS))
    got = {(r.region, r.metric_hour): (r.active_drivers, r.gps_events_count) for r in table.collect()}
    assert got == {("North_East", ts(0)): (2, 3), ("North_East", ts(60)): (0, 1)}
    full = gold.region_hourly_full(spark.createDataFrame(gps, GPS), spark.createDataFrame([order(1, at=ts(0))], ORDER))
    assert full.count() == 3  # the delivery ended in another region
    assert gold.region_hourly_summary(table).first().regions_count == 1


DRIVER = ("driver_id int, vehicle_type string, experience_years int, accident_history int, weather_sensitivity double, "
          "accident_risk double, region string")


def test_feature_tables(spark, ts):
    orders = spark.createDataFrame(
        [order(i, driver=1, actual=a) for i, a in enumerate([10, 10, 10, 10, 10, 100])] + [order(9, driver=2, actual=30), order(10, driver=None)],
        ORDER,
    )
    drivers = spark.createDataFrame([(1, "van", 3, 1, 0.05, 0.001, "North")], DRIVER)
    gps = spark.createDataFrame([(1, 1, 1, 40.0, -74.0, 4.0, ts(1), ts(9)), (2, 1, 1, 40.0, -74.0, 6.0, ts(1), ts(9))], GPS)

    delay = features.delay_features(orders, drivers)
    assert delay.columns == features.DELAY_FEATURES and delay.count() == 8
    row = delay.where("order_id = 0").first()
    assert (row.order_hour, row.order_dayofweek, row.order_month, row.experience_years) == (8, 0, 1, 3)

    eta = {r.order_id: r for r in features.eta_features(orders, drivers).collect()}
    assert eta[0].driver_eta_bias == pytest.approx(25.0 - 10.0) and eta[9].driver_eta_bias == pytest.approx(20.0)
    assert eta[10].driver_eta_bias is None and eta[0].is_peak_hour == 1

    risk = {r.driver_id: r for r in features.driver_risk_features(orders, drivers, gps).collect()}
    assert risk[1].delay_ratio == pytest.approx(1 / 6)
    assert risk[1].speed_variance == pytest.approx(36.742346, abs=1e-5)
    assert (risk[2].delay_ratio, risk[2].speed_variance) == (0.0, 0.0)
    assert (risk[None].delay_ratio, risk[None].speed_variance) == (None, 0.0)
    assert (risk[1].gps_accuracy_mean, risk[1].gps_accuracy_std) == (5.0, pytest.approx(2**0.5))
    assert risk[2].gps_accuracy_mean is None

    s = features.feature_summary("x", delay, "delay_flag").first()
    assert (s.feature_rows, s.feature_columns, s.unique_drivers) == (8, 13, 2)
    assert s.positive_target_ratio == pytest.approx(2 / 8)


def test_delay_features_with_history_and_weather(spark, ts):
    orders = spark.createDataFrame([order(1, at=ts(0)), order(2, at=ts(30)), order(3, at=ts(90), actual=40)], ORDER)
    drivers = spark.createDataFrame([(1, "van", 3, 1, 0.05, 0.001, "North")], DRIVER)
    weather = spark.createDataFrame(
        [(1, "storm", 5, ts(20), ts(60), "North"), (2, "snow", 4, ts(80), ts(100), "South")],
        "weather_event_id int, weather_type string, severity int, start_time timestamp, end_time timestamp, affected_region string",
    )
    out = features.delay_features(orders, drivers, weather, with_history=True)
    got = {r.order_id: (r.historical_orders_count, r.weather_impact_score) for r in out.collect()}
    assert got == {1: (0, 0), 2: (1, 10), 3: (2, 0)}
    assert out.columns[-1] == "delay_flag" and len(out.columns) == 15


def test_tracks(spark, ts):
    gps = [
        (1, 1, 1, 40.70, -74.0, 5.0, ts(0), ts(1)), (2, 1, 1, 40.71, -74.0, 5.0, ts(10), ts(2)),
        (3, 1, 1, 40.72, -74.0, 5.0, ts(5), ts(3)), (4, 2, 1, 40.72, -74.0, 5.0, ts(5), ts(3)),
    ]
    df = spark.createDataFrame(gps, GPS)
    flags = {r.event_id: r.is_out_of_order for r in tracks.out_of_order(df, ["order_id"], "ingestion_timestamp").collect()}
    assert flags == {1: False, 2: False, 3: True, 4: False}
    profile = {r.order_id: r for r in tracks.speed_profile(df, ["driver_id", "order_id"]).collect()}
    assert profile[1].legs == 2 and profile[2].legs == 0 and profile[2].speed_mean_kmh is None
    assert profile[1].speed_max_kmh == pytest.approx(26.687, abs=1e-2)
    orders = spark.createDataFrame([order(1, at=ts(0), actual=10)], ORDER)
    off = {r.event_id: r for r in tracks.route_deviation(df, orders).collect()}
    assert off[1].deviation_km == pytest.approx(0.0) and off[1].route_share == 0.0 and off[2].route_share == 1.0
    assert off[4].deviation_km is None


def test_late_tags_and_retention(spark, ts):
    gps = spark.createDataFrame([(1, 1, 1, 40.0, -74.0, 5.0, ts(28), ts(99)), (2, 1, 1, 40.0, -74.0, 5.0, ts(27), ts(99)), (3, 7, 1, 40.0, -74.0, 5.0, ts(500), ts(999))], GPS)
    orders = spark.createDataFrame([order(1, at=ts(0), actual=12)], ORDER)
    got = {r.event_id: (r.is_late, r.late_minutes) for r in silver.late_tagged(gps, orders).collect()}
    assert got == {1: (True, 16.0), 2: (False, None), 3: (False, None)}
    assert silver.within_retention(gps, "event_timestamp", "2025-12-31").count() == 3
    assert silver.within_retention(gps, "event_timestamp", "2026-01-01").count() == 0


def test_empty_inputs_give_empty_tables(spark):
    orders, gps = spark.createDataFrame([], ORDER), spark.createDataFrame([], GPS)
    drivers = spark.createDataFrame([], DRIVER)
    for table in (gold.deliveries(orders), gold.driver_daily(orders, gps), gold.region_hourly(gps), silver.gps_events(gps),
                  features.delay_features(orders, drivers), features.eta_features(orders, drivers),
                  features.driver_risk_features(orders, drivers, gps)):
        assert table.count() == 0
    assert gold.deliveries_summary(gold.deliveries(orders)).first().rows_created == 0
    assert dedup.dedup_summary(gps, "event_id", "gps").first().duplicate_ratio is None
    assert features.feature_summary("x", features.delay_features(orders, drivers), "delay_flag").select(F.col("feature_rows")).first()[0] == 0
