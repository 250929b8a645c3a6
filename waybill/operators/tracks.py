"""GPS tracks: arrival order, speed per leg, deviation from the straight route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.geo import haversine_km
from waybill.functions.timing import MICROS_PER_HOUR, MICROS_PER_MINUTE, micros
from waybill.operators.ordered import neighbour


def out_of_order(gps: DataFrame, keys: list[str], arrival: str) -> DataFrame:
    """Add the event time of the row that arrived before it on the same track, and a flag when
    the row's own event time is not later."""
    usable = " AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, arrival])
    arrived = neighbour(
        gps.where(usable),
        keys,
        [arrival, "event_id"],
        micros(arrival),
        MICROS_PER_HOUR,
        {"previous_event_timestamp": "event_timestamp"},
    )
    return arrived.withColumn(
        "is_out_of_order",
        F.coalesce(F.col("event_timestamp") <= F.col("previous_event_timestamp"), F.lit(False)),
    )


def legs(gps: DataFrame, keys: list[str]) -> DataFrame:
    """Distance, duration and speed from the previous point of the same track."""
    usable = " AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, "event_timestamp"])
    points = neighbour(
        gps.where(usable),
        keys,
        ["event_timestamp", "event_id"],
        micros("event_timestamp"),
        MICROS_PER_HOUR,
        {"__lat": "latitude", "__lon": "longitude", "__ts": "event_timestamp"},
    )
    hours = (micros("event_timestamp") - micros("__ts")) / F.lit(float(MICROS_PER_HOUR))
    return points.select(
        *gps.columns,
        haversine_km("__lat", "__lon", "latitude", "longitude").alias("leg_km"),
        hours.alias("leg_hours"),
    ).withColumn("speed_kmh", F.col("leg_km") / F.when(F.col("leg_hours") > 0, F.col("leg_hours")))


def speed_profile(gps: DataFrame, keys: list[str]) -> DataFrame:
    """Legs with a speed, and mean, sample deviation and maximum of the speed, per track."""
    return legs(gps, keys).groupBy(*keys).agg(
        F.count("speed_kmh").alias("legs"),
        F.avg("speed_kmh").alias("speed_mean_kmh"),
        F.stddev_samp("speed_kmh").alias("speed_std_kmh"),
        F.max("speed_kmh").alias("speed_max_kmh"),
    )


def route_deviation(gps: DataFrame, orders: DataFrame) -> DataFrame:
    """Distance of each point from where a straight, even drive would be at that time.

    The share of the delivery time gone by is limited to [0, 1]; without a positive duration
    there is no expected place and the deviation is null.
    """
    routes = orders.select(
        "order_id", "created_at", "actual_delivery_minutes",
        "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon",
    )
    duration = F.when(F.col("actual_delivery_minutes") > 0, F.col("actual_delivery_minutes"))
    share = (micros("event_timestamp") - micros("created_at")) / (duration * F.lit(float(MICROS_PER_MINUTE)))
    share = F.when(share < 0, F.lit(0.0)).when(share > 1, F.lit(1.0)).otherwise(share)
    on_route = gps.join(routes, "order_id", "left").withColumn("__share", share)
    lat = F.col("pickup_lat") + (F.col("delivery_lat") - F.col("pickup_lat")) * F.col("__share")
    lon = F.col("pickup_lon") + (F.col("delivery_lon") - F.col("pickup_lon")) * F.col("__share")
    return on_route.select(
        *gps.columns,
        F.col("__share").alias("route_share"),
        haversine_km(lat, lon, F.col("latitude"), F.col("longitude")).alias("deviation_km"),
    )
