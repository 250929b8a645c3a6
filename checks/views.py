"""Domain views over the given tables, written once for both engines.

Only deterministic integer arithmetic is used, so Spark and DuckDB agree on every value.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ["region", "nation", "customer", "orders", "events", "part"]
EPOCH = 1704067200  # 2024-01-01 UTC


@dataclass(frozen=True)
class Dialect:
    div: str
    prefix: str
    spark: bool

    def t(self, name: str) -> str:
        return self.prefix + name

    def d(self, x) -> str:
        return f"CAST({x} AS DOUBLE)"

    def epoch(self, seconds: str) -> str:
        if self.spark:
            return f"timestamp_seconds({EPOCH} + {seconds})"
        return f"(TIMESTAMP '2024-01-01' + to_seconds({seconds}))"

    def hours(self, n: str) -> str:
        return f"make_dt_interval(0, CAST({n} AS INT))" if self.spark else f"to_hours({n})"

    def micros(self, ts: str) -> str:
        return f"unix_micros({ts})" if self.spark else f"epoch_us({ts})"


SPARK = Dialect("div", "wb_", True)
DUCKDB = Dialect("//", "", False)


def view_sql(x: Dialect) -> dict[str, str]:
    """Name to query, in the order they build on each other."""
    d, t = x.d, x.t
    lat = lambda k, m: f"{d(40.5)} + ({k} * {m} % 4001) / {d(10000.0)}"
    lon = lambda k, m: f"{d(-74.1)} + ({k} * {m} % 4001) / {d(10000.0)}"
    return {
        # a driver is made of all customers of one ten; every seventeenth ten has none, so some joins miss
        "drivers": f"""
SELECT driver_id,
  CASE total % 4 WHEN 0 THEN 'van' WHEN 1 THEN 'truck' WHEN 2 THEN 'bike' ELSE 'car' END AS vehicle_type,
  CAST(top % 16 AS INT) AS experience_years, CAST(total % 3 AS INT) AS accident_history,
  CASE total % 4 WHEN 0 THEN {d(0.05)} WHEN 1 THEN {d(0.02)} WHEN 2 THEN {d(0.15)} ELSE {d(0.08)} END AS weather_sensitivity,
  CASE total % 4 WHEN 0 THEN {d(0.001)} WHEN 1 THEN {d(0.002)} WHEN 2 THEN {d(0.005)} ELSE {d(0.001)} END AS accident_risk,
  CASE region_no WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'West' ELSE 'Central' END AS region
FROM (SELECT CAST(c_custkey {x.div} 10 AS BIGINT) AS driver_id, CAST(sum(c_custkey) AS BIGINT) AS total,
    max(c_custkey) AS top, CAST(sum(r_regionkey) AS BIGINT) % 5 AS region_no
  FROM {t('customer')} JOIN {t('nation')} ON c_nationkey = n_nationkey JOIN {t('region')} ON n_regionkey = r_regionkey
  GROUP BY 1) AS tens
WHERE driver_id % 17 <> 16""",
        "orders_l": f"""
SELECT o_orderkey AS order_id, CAST(o_custkey {x.div} 10 AS BIGINT) AS driver_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'standard' WHEN 1 THEN 'express' WHEN 2 THEN 'scheduled' ELSE 'frozen' END AS order_type,
  {x.epoch('o_orderkey * 7919 % 2592000')} AS created_at,
  {lat('o_orderkey', 7919)} AS pickup_lat, {lon('o_orderkey', 104729)} AS pickup_lon,
  {lat('o_orderkey', 611953)} AS delivery_lat, {lon('o_orderkey', 1299709)} AS delivery_lon,
  CAST(15 + o_orderkey % 226 AS INT) AS expected_delivery_minutes,
  CASE WHEN o_orderkey % 97 = 96 THEN NULL
       ELSE CAST(15 + o_orderkey % 226 + (o_custkey * 31 + o_orderkey * 17) % 41 - 20 AS INT) END AS actual_delivery_minutes
FROM {t('orders')}""",
        "gps_bronze": f"""
SELECT CASE WHEN event_id % 50 = 49 THEN event_id - 1 ELSE event_id END AS event_id, event_id AS order_id,
  user_id AS driver_id, {lat('event_id', 7919)} AS latitude, {lon('event_id', 104729)} AS longitude,
  {d(5.0)} + (event_id % 151) / {d(10.0)} AS accuracy, ts AS event_timestamp,
  date_trunc('day', ts) + INTERVAL '1' DAY AS ingestion_timestamp
FROM {t('events')}""",
        # several points per order, as a delivery has them: 25 consecutive events form one track
        "gps_tracks": f"""
SELECT event_id, (event_id {x.div} 25) * 25 AS order_id, (event_id {x.div} 25) % 149 AS driver_id,
  {lat('event_id', 7919)} AS latitude, {lon('event_id', 104729)} AS longitude,
  {d(5.0)} + (event_id % 151) / {d(10.0)} AS accuracy,
  {x.epoch('(event_id ' + x.div + ' 25) * 25 * 7919 % 2592000 + event_id * 7919 % 25 * 240')} AS event_timestamp,
  {x.epoch('(event_id ' + x.div + ' 25) * 25 * 7919 % 2592000 + event_id % 25 * 240 + 60')} AS ingestion_timestamp
FROM {t('events')}""",
        "gps_content_dups": f"""
SELECT event_id, order_id, driver_id, latitude, longitude, accuracy, event_timestamp FROM {t('gps_bronze')}
UNION ALL
SELECT event_id + 1000000000, order_id, driver_id, latitude, longitude, accuracy, event_timestamp
FROM {t('gps_bronze')} WHERE order_id % 40 = 39""",
        "weather": f"""
SELECT event_id AS weather_event_id,
  CASE event_id % 6 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain' WHEN 2 THEN 'snow' WHEN 3 THEN 'fog' WHEN 4 THEN 'storm' ELSE 'wind' END AS weather_type,
  CASE WHEN event_type = 'error' AND event_id % 5 = 0
       THEN CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 1 WHEN 4 THEN 5 ELSE 1 END
       WHEN event_id % 3 = 0 THEN 0 END AS severity,
  ts AS start_time, ts + {x.hours('1 + event_id % 8')} AS end_time,
  CASE user_id % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' WHEN 3 THEN 'West' ELSE 'Central' END AS affected_region
FROM {t('events')}""",
        # raw copies as they reach bronze: repeated ids, some rows that break the contract
        "orders_bronze": f"""
SELECT CASE WHEN order_id % 211 = 7 THEN NULL ELSE order_id END AS order_id,
  driver_id, order_type, CASE WHEN order_id % 307 = 11 THEN 'unknown' ELSE CAST(created_at AS VARCHAR(30)) END AS created_at,
  pickup_lat, pickup_lon, delivery_lat, delivery_lon, expected_delivery_minutes, actual_delivery_minutes,
  {x.epoch('order_id % 7 * 86400')} AS ingestion_timestamp
FROM {t('orders_l')}
UNION ALL
SELECT order_id, driver_id + 1, order_type, CAST(created_at AS VARCHAR(30)), pickup_lat, pickup_lon, delivery_lat, delivery_lon,
  expected_delivery_minutes, actual_delivery_minutes, {x.epoch('order_id % 5 * 86400')}
FROM {t('orders_l')} WHERE order_id % 30 = 3""",
        "weather_bronze": f"""
SELECT weather_event_id, weather_type, severity, start_time,
  CASE WHEN weather_event_id % 35 = 5 THEN start_time ELSE end_time END AS end_time, affected_region,
  {x.epoch('weather_event_id % 7 * 86400')} AS ingestion_timestamp
FROM {t('weather')}
UNION ALL
SELECT weather_event_id, weather_type, severity, start_time, end_time, affected_region,
  {x.epoch('weather_event_id % 3 * 86400')}
FROM {t('weather')} WHERE weather_event_id % 20 = 0""",
        "driver_changes": f"""
SELECT d.driver_id, CAST(1 + v.region_no AS INT) AS version_no,
  CASE (d.driver_id + (v.region_no * d.driver_id) % 3) % 4 WHEN 0 THEN 'van' WHEN 1 THEN 'truck' WHEN 2 THEN 'bike' ELSE 'car' END AS vehicle_type,
  {x.epoch('(v.region_no * 10 + d.driver_id % 5) * 86400')} AS change_ts
FROM {t('drivers')} d JOIN (
  SELECT driver_id, 0 AS region_no FROM {t('drivers')} UNION ALL SELECT driver_id, 1 FROM {t('drivers')}
  UNION ALL SELECT driver_id, 2 FROM {t('drivers')}) v ON d.driver_id = v.driver_id""",
        "drift_sample": f"""
SELECT value, value * CASE WHEN ts >= {x.epoch('1296000')} THEN {d(1.2)} ELSE {d(1.0)} END AS value_shifted,
  ts >= {x.epoch('1296000')} AS is_current FROM {t('events')}""",
        "predictions": f"""
SELECT order_id, CASE WHEN actual_delivery_minutes - expected_delivery_minutes > 5 THEN 1 ELSE 0 END AS label,
  CASE WHEN order_id * 13 % 7 < 3 THEN 1 ELSE 0 END AS prediction, (order_id * 37 % 1000) / {d(1000.0)} AS score,
  CAST(actual_delivery_minutes AS DOUBLE) AS y, CAST(expected_delivery_minutes + order_id % 5 AS DOUBLE) AS y_hat
FROM {t('orders_l')} WHERE actual_delivery_minutes IS NOT NULL""",
        "model_runs": f"""
SELECT CASE p_partkey % 3 WHEN 0 THEN 'delay_prediction' WHEN 1 THEN 'eta_prediction' ELSE 'driver_risk' END AS model_name,
  CAST(p_partkey AS BIGINT) AS version, {x.epoch('p_partkey')} AS training_timestamp, p_retailprice AS metric
FROM {t('part')}""",
    }


def _needed(sql: str, views: dict[str, str]) -> set[str]:
    """Views a query uses, directly or through other views."""
    words = set(re.findall(r"[a-z_]+", sql))
    found = {v for v in views if v in words}
    for v in list(found):
        found |= _needed(views[v], {k: s for k, s in views.items() if k != v})
    return found


# inferred once per table: inference is a Spark job of its own
_SCHEMAS: dict = {}


class SparkViews(Mapping):
    """The views as DataFrames, each built on first use.

    Timestamps without zone are read as UTC instants.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._sf_dir, self._built = spark, sf_dir, {}
        self._sql = view_sql(SPARK)
        self._names = view_sql(Dialect("", "", True))

    def path(self, name: str) -> str:
        return f"{self._sf_dir}/{name}.parquet"

    def raw_schema(self, name: str):
        path = self.path(name)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return _SCHEMAS[path]

    def base(self, name: str) -> DataFrame:
        if name not in self._built:
            table = self.spark.read.schema(self.raw_schema(name)).parquet(self.path(name))
            zoned = {c: F.col(c).cast("timestamp") for c, kind in table.dtypes if kind == "timestamp_ntz"}
            self._built[name] = table.withColumns(zoned) if zoned else table
        self._built[name].createOrReplaceTempView(SPARK.t(name))
        return self._built[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            text = self._names[name]
            words = set(re.findall(r"[a-z_]+", text))
            for used in words & set(BASE_TABLES):
                self.base(used)
            for used in words & set(self._sql) - {name}:
                self[used].createOrReplaceTempView(SPARK.t(used))
            self._built[name] = self.spark.sql(self._sql[name])
        return self._built[name]

    def __iter__(self):
        return iter(self._sql)

    def __len__(self):
        return len(self._sql)


def with_views(sql: str) -> str:
    """Prefix a DuckDB query by the views it needs as common table expressions."""
    views = view_sql(DUCKDB)
    used = _needed(sql, views)
    ctes = [f"{name} AS ({text})" for name, text in views.items() if name in used]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
