"""What the physical plans must and must not contain."""

import re

import pytest

from checks.views import SparkViews
from waybill.operators import drift, history, ordered, weather
from waybill.plans import features, gold, silver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def v(spark):
    return SparkViews(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_python(text):
    return not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


def windows_over_one_partition(text):
    """Windows whose input is gathered in a single partition."""
    return re.findall(r"Window [^\n]*\n(?:[^\n]*(?:Sort|WholeStage|Project|InputAdapter)[^\n]*\n)*[^\n]*Exchange SinglePartition", text)


def test_dedup_limits_groups_before_the_shuffle(v):
    text = plan(silver.gps_events(v["gps_bronze"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text and no_python(text)
    partial = text.index("Partial", text.index("WindowGroupLimit"))
    assert text.index("Exchange hashpartitioning") < partial  # the partial limit lies below the exchange


def test_scans_read_only_needed_columns(v):
    text = plan(gold.region_hourly_summary(gold.region_hourly(v["gps_bronze"])))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in schema and "value" not in schema


def test_retention_reaches_the_scan(v):
    text = plan(silver.within_retention(v["gps_bronze"], "event_timestamp", "2026-01-10"))
    assert re.search(r"PushedFilters: \[[^\]]*ts", text) or re.search(r"DataFilters: \[[^\]]*ts", text)


def test_no_cartesian_products_python_or_single_partition_windows(v):
    tables = {
        "deliveries": gold.deliveries(v["orders_l"]),
        "weather": weather.delivery_weather(v["orders_l"], v["drivers"], v["weather"]),
        "history": history.trailing_history(v["orders_l"]),
        "delay": features.delay_features(v["orders_l"], v["drivers"]),
        "eta": features.eta_features(v["orders_l"], v["drivers"]),
        "risk": features.driver_risk_features(v["orders_l"], v["drivers"], v["gps_bronze"]),
        "daily": gold.driver_daily(v["orders_l"], v["gps_bronze"]),
        "hourly": gold.region_hourly_full(v["gps_bronze"], v["orders_l"]),
    }
    for name, table in tables.items():
        text = plan(table)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert no_python(text), name
        assert not windows_over_one_partition(text), name


def test_history_has_no_sliding_frame_and_no_pairs(v):
    text = plan(history.trailing_history(v["orders_l"]))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "TakeOrderedAndProject" not in text and "Limit" not in text.replace("WindowGroupLimit", "")
    frames = re.findall(r"specifiedwindowframe\(([^)]*\(\)[^)]*)\)", text.replace("$", ""))
    assert frames and all("unboundedpreceding" in f for f in frames)


def test_drift_never_orders_all_rows(v):
    sample = v["drift_sample"]
    text = plan(drift.ks_statistics(sample.where("is_current"), sample.where("NOT is_current"), ["value"]))
    assert not windows_over_one_partition(text)
    assert "hashpartitioning(column" in text


def test_small_lookups_are_broadcast_by_size_only(spark, v):
    lookup = features.delay_features(v["orders_l"], v["drivers"])
    assert "BroadcastHashJoin" in plan(lookup)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(features.delay_features(v["orders_l"], v["drivers"]))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def small_thresholds(spark):
    """Make a few thousand rows count as skew, and keep joins from being broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, value in wanted.items():
        spark.conf.set(k, value)
    yield
    for k, value in before.items():
        spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_joins_split_a_hot_key(spark, small_thresholds):
    """A third of the GPS rows belongs to one order, a third of the orders to one driver."""
    from pyspark.sql import functions as F

    hot = lambda column: F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    start = F.lit("2024-01-01").cast("timestamp")
    gps = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("event_id"), hot("id").alias("order_id"), (F.col("id") % 50).alias("driver_id"),
        F.rand(1).alias("latitude"), F.rand(2).alias("longitude"), start.alias("event_timestamp"),
    )
    orders = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("order_id"), hot("id").alias("driver_id"), start.alias("created_at"),
        F.lit(10).alias("expected_delivery_minutes"), F.lit(12).alias("actual_delivery_minutes"), F.lit("express").alias("order_type"),
        *(F.rand(i).alias(c) for i, c in enumerate(["pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon"])),
    )
    drivers = spark.range(0, 60_000, 1, 8).select(
        F.col("id").alias("driver_id"), F.lit("van").alias("vehicle_type"), F.lit(1).alias("experience_years"),
        F.lit(1).alias("accident_history"), F.lit(0.1).alias("weather_sensitivity"),
    )
    for name, table, rows in [
        ("late", silver.late_tagged(gps, orders), 60_000),
        ("delay", features.delay_features(orders, drivers), 60_000),
        ("eta", features.eta_features(orders, drivers), 60_000),
    ]:
        table.write.format("noop").mode("overwrite").save()
        assert table.count() == rows, name
        execution = table.groupBy().agg(F.max(F.hash(*table.columns)))._jdf.queryExecution()
        execution.toRdd().count()  # runs the plan, so that AQE settles it
        assert "skew=true" in execution.executedPlan().toString(), name
