"""Gold tables: deliveries, driver days, region hours, and their one-row summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.geo import assign_region, haversine_km
from waybill.functions.timing import (
    delay_flag,
    delay_minutes,
    delivered_at,
    hour_floor,
    on_time_flag,
    percentage,
    traffic_score,
)
from waybill.operators import weather as weather_ops

# Columns of the deliveries table.
DELIVERY_COLUMNS = [
    "order_id", "driver_id", "order_type", "created_at", "delay_minutes", "delay_flag",
    "route_distance_km", "weather_impact_score", "traffic_score",
]


def _route_km():
    return haversine_km("pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon")


def _measured(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "delay_minutes": delay_minutes(),
            "delay_flag": delay_flag(delay_minutes()),
            "route_distance_km": _route_km(),
            "traffic_score": traffic_score(),
        }
    )


def deliveries(orders: DataFrame) -> DataFrame:
    """Per order: delay, flag, route length and traffic score; the weather score is 0 here."""
    return _measured(orders).withColumn("weather_impact_score", F.lit(0)).select(*DELIVERY_COLUMNS)


def deliveries_with_weather(orders: DataFrame, drivers: DataFrame, weather: DataFrame) -> DataFrame:
    """The same with the weather met in the driver's region while under way."""
    return _measured(weather_ops.delivery_weather(orders, drivers, weather)).select(*DELIVERY_COLUMNS)


def deliveries_summary(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rows_created"),
        F.bround(F.avg("delay_minutes"), 2).alias("avg_delay_minutes"),
        percentage(1 - F.avg("delay_flag")).alias("on_time_ratio"),
        F.bround(F.avg("route_distance_km"), 2).alias("avg_route_distance_km"),
    )


def driver_daily(orders: DataFrame, gps: DataFrame, with_distance: bool = False) -> DataFrame:
    """Per driver and day: deliveries, on-time percentage, mean delay and GPS points.

    Both inputs are aggregated before they meet; a day without GPS keeps a null count.
    """
    key = ["driver_id", "metric_date"]
    delay = delay_minutes()
    extra = (
        [F.avg(_route_km()).alias("avg_route_distance_km"), F.sum(_route_km()).alias("total_distance_km")]
        if with_distance
        else []
    )
    days = (
        orders.withColumn("metric_date", F.to_date("created_at"))
        .where("driver_id IS NOT NULL AND metric_date IS NOT NULL")
        .groupBy(*key)
        .agg(
            F.count("order_id").alias("deliveries_completed"),
            percentage(F.avg(on_time_flag(delay))).alias("on_time_ratio"),
            F.avg(delay).alias("avg_delay_minutes"),
            *extra,
        )
    )
    points = (
        gps.withColumn("metric_date", F.to_date("event_timestamp"))
        .where("driver_id IS NOT NULL AND metric_date IS NOT NULL")
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("gps_points_count"))
    )
    return days.join(points, key, "left")


def driver_daily_summary(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rows_created"),
        F.count_distinct("driver_id").alias("drivers_count"),
        F.bround(F.avg("deliveries_completed"), 2).alias("avg_daily_deliveries"),
    )


def region_hourly(gps: DataFrame) -> DataFrame:
    """Per region and hour: distinct drivers and GPS events.

    Spark counts the distinct drivers in two steps keyed by (region, hour, driver) and then by
    (region, hour), so one busy hour is spread over its drivers.
    """
    return (
        gps.select(
            assign_region("latitude", "longitude").alias("region"),
            hour_floor("event_timestamp").alias("metric_hour"),
            "driver_id",
            "event_id",
        )
        .where("metric_hour IS NOT NULL")
        .groupBy("region", "metric_hour")
        .agg(
            F.count_distinct("driver_id").alias("active_drivers"),
            F.count("event_id").alias("gps_events_count"),
        )
    )


def region_hourly_full(gps: DataFrame, orders: DataFrame) -> DataFrame:
    """Region hours with the deliveries that ended there and their mean delay."""
    ended = (
        orders.select(
            assign_region("delivery_lat", "delivery_lon").alias("region"),
            hour_floor(delivered_at()).alias("metric_hour"),
            delay_minutes().alias("delay"),
            "order_id",
        )
        .where("metric_hour IS NOT NULL")
        .groupBy("region", "metric_hour")
        .agg(
            F.count("order_id").alias("deliveries_completed"),
            F.avg("delay").alias("avg_delivery_delay"),
        )
    )
    return region_hourly(gps).join(ended, ["region", "metric_hour"], "full")


def region_hourly_summary(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("rows_created"),
        F.count_distinct("region").alias("regions_count"),
    )
