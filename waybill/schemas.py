"""Data model: table schemas, layer contracts and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


DRIVERS = _table(
    driver_id=_S, vehicle_type=_S, experience_years=_I, accident_history=_I,
    weather_sensitivity=_D, accident_risk=_D, region=_S, onboard_timestamp=_TS,
)
ORDERS = _table(
    order_id=_S, driver_id=_S, order_type=_S, status=_S, created_at=_TS,
    pickup_lat=_D, pickup_lon=_D, delivery_lat=_D, delivery_lon=_D,
    expected_delivery_minutes=_I, actual_delivery_minutes=_I,
)
GPS_EVENTS = _table(
    event_id=_S, order_id=_S, driver_id=_S, latitude=_D, longitude=_D, accuracy=_D,
    event_timestamp=_TS,
)
WEATHER_EVENTS = _table(
    weather_event_id=_S, weather_type=_S, severity=_I, start_time=_TS, end_time=_TS,
    affected_region=_S,
)
DATASETS = {
    "drivers": DRIVERS,
    "orders": ORDERS,
    "gps_events": GPS_EVENTS,
    "weather_events": WEATHER_EVENTS,
}
# column that identifies a record; also the key of its JSON message
RECORD_KEYS = {
    "drivers": "driver_id",
    "orders": "order_id",
    "gps_events": "event_id",
    "weather_events": "weather_event_id",
}

# Columns each layer requires (fixed values).
BRONZE_REQUIRED = ["ingestion_timestamp", "ingestion_id"]
SILVER_REQUIRED = {
    "gps_events": ["event_id", "order_id", "driver_id", "event_timestamp"],
    "orders": ["order_id", "driver_id", "created_at"],
    "weather": ["weather_event_id", "weather_type"],
}

# Domain values (fixed values).
WEATHER_SENSITIVITY = {"van": 0.05, "truck": 0.02, "bike": 0.15, "car": 0.08}
ACCIDENT_RISK = {"van": 0.001, "truck": 0.002, "bike": 0.005, "car": 0.001}
WEATHER_SEVERITY = {"clear": 0, "rain": 2, "snow": 4, "fog": 1, "storm": 5, "wind": 1}
MAX_SEVERITY = 5
PEAK_HOURS = [7, 8, 9, 17, 18, 19]

# Defaults (fixed values).
ON_TIME_MINUTES = 5
NULL_THRESHOLD = 0.05
LATE_RATIO_THRESHOLD = 0.15
LATE_GRACE_MINUTES = 15
LINEAGE_VARIANCE = 0.1
HISTORY_DAYS = 90
RETENTION_DAYS = 730
FRESHNESS_HOURS = 24

# Run logs, append-only.
DATA_LINEAGE = _table(
    id=_S, stage=_S, dataset=_S, row_count=_L, partition_path=_S, source_system=_S,
    record_timestamp=_TS, ingestion_id=_S,
)
DQ_METRICS = _table(
    id=_S, check_name=_S, dataset=_S, check_timestamp=_TS, status=_S, metric_name=_S,
    metric_value=_D, threshold=_D, details=_S,
)
MODEL_RUNS = _table(
    id=_S, model_name=_S, version=_S, feature_dataset_hash=_S, training_timestamp=_TS,
    metrics=T.MapType(_S, _D), run_id=_S, status=_S,
)
# Which runs bronze holds, a row for each day of a run, and which of these rows later layers have taken up.
INGESTED_RUNS = _table(
    id=_S, dataset=_S, area=_S, ingestion_id=_S, day=_S, row_count=_L, record_timestamp=_TS,
)
PROCESSED_RUNS = _table(
    id=_S, ingested_id=_S, dataset=_S, ingestion_id=_S, attempt=_S, longest_minutes=_L, record_timestamp=_TS,
)
# What an attempt is about to write, a row for each day of a table; of merged tables also where the new content of the days lies.
ATTEMPTED_DAYS = _table(
    id=_S, attempt=_S, layer=_S, table_name=_S, day=_S, content=_S, record_timestamp=_TS,
)
RUN_LOGS = {
    "data_lineage": DATA_LINEAGE, "dq_metrics": DQ_METRICS, "model_runs": MODEL_RUNS,
    "ingested_runs": INGESTED_RUNS, "processed_runs": PROCESSED_RUNS,
    "attempted_days": ATTEMPTED_DAYS,
}
