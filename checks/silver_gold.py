"""Silver and gold queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Views, query, rounded
from waybill.operators import dedup, scd, tracks
from waybill.operators.contracts import REASON
from waybill.plans import gold, silver

# shared pieces of the SQL side -------------------------------------------------------------
DEDUP = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
  ORDER BY ingestion_timestamp, event_timestamp, order_id, driver_id, latitude, longitude, accuracy) AS rn
  FROM gps_bronze) WHERE rn = 1)"""


def region_sql(lat: str, lon: str) -> str:
    return f"""(CASE WHEN {lat} > 40.75 THEN 'North' WHEN {lat} < 40.65 THEN 'South' ELSE 'Central' END
  || CASE WHEN {lon} > -73.85 THEN '_East' WHEN {lon} < -73.85 THEN '_West' ELSE '' END)"""


def km_sql(a: str, b: str, c: str, d: str) -> str:
    return f"""(2 * 6371 * asin(sqrt(power(sin((radians({c}) - radians({a})) / 2), 2)
  + cos(radians({a})) * cos(radians({c})) * power(sin((radians({d}) - radians({b})) / 2), 2))))"""


ROUTE_KM = km_sql("pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon")
DELAY = "(actual_delivery_minutes - expected_delivery_minutes)"
ENDED = "(created_at + to_minutes(actual_delivery_minutes))"
TRAFFIC = """CASE WHEN expected_delivery_minutes = 0 THEN
    CASE WHEN actual_delivery_minutes > 0 THEN 10.0 WHEN actual_delivery_minutes < 0 THEN 0.0 END
  ELSE round_even(greatest(0.0, least(10.0,
    (CAST(actual_delivery_minutes AS DOUBLE) / CAST(expected_delivery_minutes AS DOUBLE) - 1) * 10)), 1) END"""
# greatest/least skip nulls, so the null case is taken first
TRAFFIC = f"CAST(CASE WHEN actual_delivery_minutes IS NULL THEN NULL ELSE {TRAFFIC} END AS DOUBLE)"

DELIVERIES = f"""SELECT order_id, driver_id, order_type, created_at, {DELAY} AS delay_minutes,
  CASE WHEN {DELAY} > 5 THEN 1 ELSE 0 END AS delay_flag, round({ROUTE_KM}, 6) AS route_distance_km,
  0 AS weather_impact_score, {TRAFFIC} AS traffic_score FROM orders_l"""

DAILY = f"""SELECT o.driver_id, o.metric_date, deliveries_completed, on_time_ratio, avg_delay_minutes, gps_points_count
FROM (SELECT driver_id, CAST(created_at AS DATE) AS metric_date, count(order_id) AS deliveries_completed,
    round_even(avg(CASE WHEN {DELAY} <= 5 THEN 1 ELSE 0 END) * 100, 2) AS on_time_ratio,
    round(avg({DELAY}), 6) AS avg_delay_minutes
  FROM orders_l GROUP BY ALL) o
LEFT JOIN (SELECT driver_id, CAST(event_timestamp AS DATE) AS metric_date, count(*) AS gps_points_count
  FROM {DEDUP} GROUP BY ALL) g ON o.driver_id = g.driver_id AND o.metric_date = g.metric_date"""

HOURLY = f"""SELECT {region_sql('latitude', 'longitude')} AS region, date_trunc('hour', event_timestamp) AS metric_hour,
  count(DISTINCT driver_id) AS active_drivers, count(event_id) AS gps_events_count FROM {DEDUP} GROUP BY ALL"""


# silver -------------------------------------------------------------------------------------
@query("gps_dedup", f"SELECT * FROM {DEDUP}")
def gps_dedup(v: Views):
    return silver.sorted_gps(silver.gps_events(v["gps_bronze"]))


@query(
    "gps_dedup_stats",
    """SELECT 'silver_gps_events' AS dataset, count(*) AS rows_input, count(DISTINCT event_id) AS rows_output,
  count(*) - count(DISTINCT event_id) AS duplicates_removed,
  round_even((count(*) - count(DISTINCT event_id)) / count(*) * 100, 2) AS duplicate_ratio FROM gps_bronze""",
)
def gps_dedup_stats(v: Views):
    return dedup.dedup_summary(v["gps_bronze"], "event_id", "silver_gps_events")


@query(
    "gps_content_dedup",
    """SELECT min(event_id) AS event_id, order_id, driver_id, latitude, longitude, arg_min(accuracy, event_id) AS accuracy,
  event_timestamp FROM gps_content_dups GROUP BY order_id, driver_id, latitude, longitude, event_timestamp""",
)
def gps_content_dedup(v: Views):
    content = ["order_id", "driver_id", "latitude", "longitude", "event_timestamp"]
    return dedup.content_dedup(v["gps_content_dups"], content, "event_id")


@query(
    "gps_out_of_order",
    """SELECT event_id, order_id, driver_id, event_timestamp, ingestion_timestamp, previous_event_timestamp,
  coalesce(event_timestamp <= previous_event_timestamp, false) AS is_out_of_order
FROM (SELECT *, lag(event_timestamp) OVER (PARTITION BY order_id ORDER BY ingestion_timestamp, event_id)
  AS previous_event_timestamp FROM gps_tracks)""",
)
def gps_out_of_order(v: Views):
    points = v["gps_tracks"].select("event_id", "order_id", "driver_id", "event_timestamp", "ingestion_timestamp")
    return tracks.out_of_order(points, ["order_id"], "ingestion_timestamp")


@query(
    "gps_late_tagged",
    f"""SELECT g.*, coalesce(event_timestamp > ended + INTERVAL 15 MINUTE, false) AS is_late,
  CASE WHEN event_timestamp > ended + INTERVAL 15 MINUTE
    THEN (epoch_us(event_timestamp) - epoch_us(ended)) / 60000000 END AS late_minutes
FROM {DEDUP} g LEFT JOIN (SELECT order_id, {ENDED} AS ended FROM orders_l) o ON g.order_id = o.order_id""",
)
def gps_late_tagged(v: Views):
    return silver.late_tagged(silver.gps_events(v["gps_bronze"]), v["orders_l"])


ORDER_COLUMNS = """order_id, driver_id, order_type, TRY_CAST(created_at AS TIMESTAMP) AS created_at, pickup_lat, pickup_lon,
  delivery_lat, delivery_lon, expected_delivery_minutes, actual_delivery_minutes, ingestion_timestamp"""
ORDER_REASON = """CASE WHEN order_id IS NULL THEN 'no order_id' WHEN driver_id IS NULL THEN 'no driver_id'
  WHEN created_at IS NOT NULL AND TRY_CAST(created_at AS TIMESTAMP) IS NULL THEN 'bad created_at'
  WHEN created_at IS NULL THEN 'no created_at' END"""
SILVER_ORDERS = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_timestamp,
  created_at, driver_id, order_type, pickup_lat, pickup_lon, delivery_lat, delivery_lon, expected_delivery_minutes) AS rn
  FROM (SELECT {ORDER_COLUMNS} FROM orders_bronze WHERE {ORDER_REASON} IS NULL)) WHERE rn = 1)"""
SILVER_WEATHER = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY weather_event_id ORDER BY
  ingestion_timestamp, start_time, weather_type, severity, end_time, affected_region) AS rn
  FROM weather_bronze WHERE end_time > start_time) WHERE rn = 1)"""


@query("silver_orders", f"SELECT * FROM {SILVER_ORDERS}")
def silver_orders(v: Views):
    return silver.orders(v["orders_bronze"])


@query("silver_weather", f"SELECT * FROM {SILVER_WEATHER}")
def silver_weather(v: Views):
    return silver.weather(v["weather_bronze"])


@query(
    "dedup_effectiveness",
    f"""SELECT dataset, bronze_rows, silver_rows, bronze_rows - silver_rows AS duplicates_removed,
  round_even((bronze_rows - silver_rows) / bronze_rows * 100, 2) AS duplicate_ratio FROM (
SELECT 'gps_events' AS dataset, (SELECT count(*) FROM gps_bronze) AS bronze_rows, (SELECT count(*) FROM {DEDUP}) AS silver_rows
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders_bronze), (SELECT count(*) FROM {SILVER_ORDERS})
UNION ALL SELECT 'weather', (SELECT count(*) FROM weather_bronze), (SELECT count(*) FROM {SILVER_WEATHER}))""",
)
def dedup_effectiveness(v: Views):
    return dedup.dedup_effectiveness(
        {
            "gps_events": (v["gps_bronze"], silver.gps_events(v["gps_bronze"])),
            "orders": (v["orders_bronze"], silver.orders(v["orders_bronze"])),
            "weather": (v["weather_bronze"], silver.weather(v["weather_bronze"])),
        }
    )


@query(
    "incremental_merge",
    """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id, ingestion_timestamp > TIMESTAMP '2024-01-16'
  ORDER BY ingestion_timestamp, event_timestamp, order_id, driver_id, latitude, longitude, accuracy) AS rn FROM gps_bronze),
firsts AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)
SELECT * FROM firsts WHERE ingestion_timestamp <= TIMESTAMP '2024-01-16'
UNION ALL SELECT * FROM firsts n WHERE ingestion_timestamp > TIMESTAMP '2024-01-16' AND NOT EXISTS (
  SELECT 1 FROM firsts s WHERE s.event_id = n.event_id AND s.ingestion_timestamp <= TIMESTAMP '2024-01-16')""",
)
def incremental_merge(v: Views):
    """Bronze runs up to the 16th are in silver already; later runs are merged into it."""
    arrived = F.col("ingestion_timestamp") <= F.lit("2024-01-16").cast("timestamp")
    existing = silver.gps_events(v["gps_bronze"].where(arrived))
    return dedup.merge_first_arrivals(existing, v["gps_bronze"].where(~arrived), "event_id", "ingestion_timestamp")


@query(
    "scd2_drivers",
    """SELECT driver_id, vehicle_type, change_ts AS effective_date,
  lead(change_ts) OVER (PARTITION BY driver_id ORDER BY change_ts) AS end_date,
  lead(change_ts) OVER (PARTITION BY driver_id ORDER BY change_ts) IS NULL AS is_current
FROM (SELECT *, lag(vehicle_type) OVER (PARTITION BY driver_id ORDER BY change_ts) AS previous FROM driver_changes)
WHERE vehicle_type IS DISTINCT FROM previous""",
)
def scd2_drivers(v: Views):
    """Dimension from the first versions, then an upsert of all the later ones."""
    changes = v["driver_changes"]
    first = scd.build_history(changes.where("version_no = 1"), "driver_id", ["vehicle_type"], "change_ts")
    later = changes.where("version_no > 1")
    return scd.upsert(first, later, "driver_id", ["vehicle_type"], "change_ts").orderBy(
        "driver_id", F.desc("effective_date")
    )


@query(
    "orders_as_of_driver",
    """WITH versions AS (SELECT driver_id, vehicle_type, change_ts AS effective_date
FROM (SELECT *, lag(vehicle_type) OVER (PARTITION BY driver_id ORDER BY change_ts) AS previous FROM driver_changes)
WHERE vehicle_type IS DISTINCT FROM previous)
SELECT order_id, o.driver_id, created_at, vehicle_type, effective_date FROM orders_l o
ASOF LEFT JOIN versions v ON o.driver_id = v.driver_id AND o.created_at >= v.effective_date""",
)
def orders_as_of_driver(v: Views):
    """Every order with the version of its driver that was valid when it was created."""
    versions = scd.build_history(v["driver_changes"], "driver_id", ["vehicle_type"], "change_ts")
    orders = v["orders_l"].select("order_id", "driver_id", "created_at")
    return scd.valid_at(orders, versions, "driver_id", "created_at", ["vehicle_type"])


@query(
    "scd2_upsert_stats",
    """WITH kept AS (SELECT driver_id, version_no, change_ts FROM (SELECT *, lag(vehicle_type) OVER (PARTITION BY driver_id
  ORDER BY change_ts) AS previous FROM driver_changes) WHERE vehicle_type IS DISTINCT FROM previous)
SELECT CAST(count_if(version_no > 1) AS BIGINT) AS rows_inserted, count(DISTINCT CASE WHEN version_no > 1 THEN driver_id END) AS rows_updated,
  count(DISTINCT CASE WHEN version_no > 1 THEN driver_id END) AS records_closed FROM kept""",
)
def scd2_upsert_stats(v: Views):
    changes = v["driver_changes"]
    before = scd.build_history(changes.where("version_no = 1"), "driver_id", ["vehicle_type"], "change_ts")
    after = scd.upsert(before, changes.where("version_no > 1"), "driver_id", ["vehicle_type"], "change_ts")
    return scd.upsert_summary(before, after, "driver_id")


@query(
    "quarantine_split",
    f"""SELECT dataset, quarantine_reason, count(*) AS row_count FROM (
SELECT 'orders' AS dataset, {ORDER_REASON} AS quarantine_reason FROM orders_bronze
UNION ALL SELECT 'weather', CASE WHEN end_time <= start_time THEN 'empty interval' END FROM weather_bronze)
WHERE quarantine_reason IS NOT NULL GROUP BY ALL""",
)
def quarantine_split(v: Views):
    rejected = silver.quarantine(silver.tagged_orders(v["orders_bronze"]), "orders").select("dataset", REASON)
    weather = silver.quarantine(silver.tagged_weather(v["weather_bronze"]), "weather").select("dataset", REASON)
    return rejected.unionAll(weather).groupBy("dataset", REASON).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "retention_pruned",
    """SELECT event_id, driver_id, event_timestamp FROM gps_bronze
WHERE event_timestamp >= CAST(DATE '2026-01-10' - 730 AS TIMESTAMP)""",
)
def retention_pruned(v: Views):
    kept = silver.within_retention(v["gps_bronze"], "event_timestamp", "2026-01-10")
    return kept.select("event_id", "driver_id", "event_timestamp")


# gold ---------------------------------------------------------------------------------------
@query("deliveries", DELIVERIES)
def deliveries(v: Views):
    return rounded(gold.deliveries(v["orders_l"]))


@query(
    "deliveries_summary",
    f"""SELECT count(*) AS rows_created, round_even(avg(delay_minutes), 2) AS avg_delay_minutes,
  round_even((1 - avg(delay_flag)) * 100, 2) AS on_time_ratio,
  round_even(avg(route_distance_km), 2) AS avg_route_distance_km FROM ({DELIVERIES})""",
)
def deliveries_summary(v: Views):
    return gold.deliveries_summary(gold.deliveries(v["orders_l"]))


@query(
    "deliveries_weather",
    f"""SELECT d.* EXCLUDE (weather_impact_score), CAST(coalesce(s.score, 0) AS INT) AS weather_impact_score
FROM ({DELIVERIES}) d LEFT JOIN (
  SELECT order_id, least(10, coalesce(2 * max(severity), 0)) AS score FROM orders_l o JOIN drivers USING (driver_id)
  JOIN weather w ON w.affected_region = region AND o.actual_delivery_minutes > 0
    AND w.start_time < {ENDED} AND w.end_time > o.created_at GROUP BY order_id) s ON d.order_id = s.order_id""",
)
def deliveries_weather(v: Views):
    return rounded(gold.deliveries_with_weather(v["orders_l"], v["drivers"], v["weather"]))


@query("driver_daily", DAILY)
def driver_daily(v: Views):
    return rounded(gold.driver_daily(v["orders_l"], silver.gps_events(v["gps_bronze"])))


@query(
    "driver_daily_distance",
    f"""SELECT d.*, avg_route_distance_km, total_distance_km FROM ({DAILY}) d JOIN (
  SELECT driver_id, CAST(created_at AS DATE) AS metric_date, round(avg({ROUTE_KM}), 6) AS avg_route_distance_km,
    round(sum({ROUTE_KM}), 6) AS total_distance_km FROM orders_l GROUP BY ALL) k
ON d.driver_id = k.driver_id AND d.metric_date = k.metric_date""",
)
def driver_daily_distance(v: Views):
    return rounded(gold.driver_daily(v["orders_l"], silver.gps_events(v["gps_bronze"]), with_distance=True))


@query(
    "driver_daily_summary",
    f"""SELECT count(*) AS rows_created, count(DISTINCT driver_id) AS drivers_count,
  round_even(avg(deliveries_completed), 2) AS avg_daily_deliveries FROM ({DAILY})""",
)
def driver_daily_summary(v: Views):
    return gold.driver_daily_summary(gold.driver_daily(v["orders_l"], silver.gps_events(v["gps_bronze"])))


@query("region_hourly", HOURLY)
def region_hourly(v: Views):
    return gold.region_hourly(silver.gps_events(v["gps_bronze"]))


@query(
    "region_hourly_full",
    f"""SELECT coalesce(h.region, d.region) AS region, coalesce(h.metric_hour, d.metric_hour) AS metric_hour,
  active_drivers, gps_events_count, deliveries_completed, avg_delivery_delay FROM ({HOURLY}) h FULL JOIN (
  SELECT {region_sql('delivery_lat', 'delivery_lon')} AS region, date_trunc('hour', {ENDED}) AS metric_hour,
    count(order_id) AS deliveries_completed, round(avg({DELAY}), 6) AS avg_delivery_delay
  FROM orders_l WHERE actual_delivery_minutes IS NOT NULL GROUP BY ALL) d
ON h.region = d.region AND h.metric_hour = d.metric_hour""",
)
def region_hourly_full(v: Views):
    return rounded(gold.region_hourly_full(silver.gps_events(v["gps_bronze"]), v["orders_l"]))


@query(
    "region_hourly_summary",
    f"SELECT count(*) AS rows_created, count(DISTINCT region) AS regions_count FROM ({HOURLY})",
)
def region_hourly_summary(v: Views):
    return gold.region_hourly_summary(gold.region_hourly(silver.gps_events(v["gps_bronze"])))
