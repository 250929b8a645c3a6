"""Silver tables: deduplicated, typed, UTC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waybill.functions.timing import delivered_at, is_late, micros, to_utc
from waybill.operators.contracts import REASON, accepted, quarantined, tagged
from waybill.operators.dedup import first_arrival
from waybill.schemas import GPS_EVENTS, LATE_GRACE_MINUTES, ORDERS, RETENTION_DAYS, WEATHER_EVENTS

# Columns of the GPS table.
GPS_COLUMNS = [
    "event_id", "order_id", "driver_id", "latitude", "longitude", "accuracy", "event_timestamp",
    "ingestion_timestamp",
]
# how ids are held is up to the source: text in the contract, numbers elsewhere
_IDS = {"event_id", "order_id", "driver_id", "weather_event_id"}


def _contract(schema: StructType) -> StructType:
    return StructType([field for field in schema.fields if field.name not in _IDS])


def gps_events(bronze: DataFrame) -> DataFrame:
    """First arrival of every event, event time in UTC."""
    kept = first_arrival(
        bronze.select(*GPS_COLUMNS), "event_id", "ingestion_timestamp", ["event_timestamp", "order_id", "driver_id"]
    )
    return to_utc(kept, "event_timestamp")


def sorted_gps(silver: DataFrame) -> DataFrame:
    """Globally ordered by (event_timestamp, event_id): a range shuffle, not a single task."""
    return silver.orderBy("event_timestamp", "event_id")


def _with_id_faults(df: DataFrame, ids: list[str]) -> DataFrame:
    missing = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in ids))
    return df.withColumn(REASON, F.coalesce(missing, F.col(REASON)))


def tagged_orders(bronze: DataFrame) -> DataFrame:
    return _with_id_faults(tagged(bronze, _contract(ORDERS), ["created_at"]), ["order_id", "driver_id"])


def tagged_gps(bronze: DataFrame) -> DataFrame:
    return _with_id_faults(
        tagged(bronze, _contract(GPS_EVENTS), ["event_timestamp"]), ["event_id", "order_id", "driver_id"]
    )


def tagged_weather(bronze: DataFrame) -> DataFrame:
    """Weather without duration is a fault as well."""
    rows = _with_id_faults(tagged(bronze, _contract(WEATHER_EVENTS), ["weather_type"]), ["weather_event_id"])
    empty = F.when(F.col("end_time") <= F.col("start_time"), F.lit("empty interval"))
    return rows.withColumn(REASON, F.coalesce(F.col(REASON), empty))


def orders(bronze: DataFrame, arrival: str = "ingestion_timestamp") -> DataFrame:
    return first_arrival(accepted(tagged_orders(bronze)), "order_id", arrival, ["created_at"])


def weather(bronze: DataFrame, arrival: str = "ingestion_timestamp") -> DataFrame:
    return first_arrival(accepted(tagged_weather(bronze)), "weather_event_id", arrival, ["start_time"])


def quarantine(tagged_rows: DataFrame, dataset: str) -> DataFrame:
    """Rejected rows with their reason, ready for a table partitioned by dataset."""
    return quarantined(tagged_rows).withColumn("dataset", F.lit(dataset))


def late_tagged(gps: DataFrame, orders_table: DataFrame, grace_minutes: int = LATE_GRACE_MINUTES) -> DataFrame:
    """Add is_late and late_minutes (past the delivery) against the order each event belongs to."""
    ends = orders_table.select("order_id", delivered_at().alias("__ended"))
    joined = gps.join(ends, "order_id", "left")
    late = is_late("event_timestamp", "__ended", grace_minutes)
    over = (micros("event_timestamp") - micros("__ended")) / 60_000_000
    return joined.select(*gps.columns, late.alias("is_late"), F.when(late, over).alias("late_minutes"))


def within_retention(df: DataFrame, ts: str, as_of: str, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows not older than ``days`` at the given date; a plain range test that reaches the scan."""
    first_day = F.date_sub(F.to_date(F.lit(as_of)), days).cast("timestamp")
    return df.where(F.col(ts) >= first_day)
