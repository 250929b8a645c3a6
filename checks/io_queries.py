"""Queries that read and write files: bronze ingest, partitions, Kafka records, storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.registry import Views, query, query_on_files
from waybill.functions import digests
from waybill.functions.timing import partition_path
from waybill.plans import bronze
from waybill.session import scratch_path
from waybill.sources import readers, writers

FIRST_RUN, SECOND_RUN = datetime(2024, 2, 1, 6, 0, 0), datetime(2024, 2, 1, 12, 0, 0)
GPS = ["event_id", "order_id", "driver_id", "latitude", "longitude", "accuracy", "event_timestamp"]


def _schema(df) -> StructType:
    return StructType(df.schema.fields)


def _ingested(spark, v: Views):
    """GPS rows as JSON lines in two files, ingested in two runs, the second one twice."""
    lake = scratch_path(spark, "bronze")
    gps = v["gps_bronze"].select(*GPS)
    early = F.col("event_timestamp") < F.lit("2024-01-20").cast("timestamp")
    for part, at, times in ((gps.where(early), FIRST_RUN, 1), (gps.where(~early), SECOND_RUN, 2)):
        source = f"{lake}/landing/{at:%H}"
        writers.write_jsonl(part, source)
        for _ in range(times):
            target = bronze.ingest_jsonl(spark, "gps_events", source, lake, at, schema=_schema(gps))
    return readers.read_layer(spark, target)


@query_on_files(
    "bronze_partition_counts",
    """SELECT strftime(event_timestamp, 'year=%Y/month=%m/day=%d') AS partition_path, count(*) AS row_count
FROM gps_bronze GROUP BY ALL""",
)
def bronze_partition_counts(spark, sf_dir, v: Views):
    """Round trip over JSON lines; the run that is repeated must not add rows."""
    return bronze.partition_counts(_ingested(spark, v), "event_timestamp")


@query_on_files(
    "bronze_ingest_stats",
    """SELECT 'gps_events' AS dataset, count(*) AS rows_ingested, count(DISTINCT CAST(event_timestamp AS DATE)) AS partitions,
  'accuracy:double,driver_id:bigint,event_id:bigint,event_timestamp:timestamp,ingestion_id:string,ingestion_timestamp:timestamp,latitude:double,longitude:double,order_id:bigint'
  AS column_types FROM gps_bronze""",
)
def bronze_ingest_stats(spark, sf_dir, v: Views):
    return bronze.ingest_summary(_ingested(spark, v), "gps_events", "event_timestamp")


@query_on_files(
    "bronze_incremental",
    """SELECT event_id, order_id, event_timestamp, TIMESTAMP '2024-02-01 12:00:00' AS ingestion_timestamp
FROM gps_bronze WHERE event_timestamp >= TIMESTAMP '2024-01-20'""",
)
def bronze_incremental(spark, sf_dir, v: Views):
    """Rows of the runs after the first one."""
    later = bronze.newer_than(_ingested(spark, v), FIRST_RUN.strftime("%Y%m%d%H%M%S"))
    return later.select("event_id", "order_id", "event_timestamp", "ingestion_timestamp")


@query_on_files(
    "gold_partitioned_roundtrip",
    """SELECT driver_id, CAST(created_at AS DATE) AS metric_date, count(*) AS deliveries_completed FROM orders_l
WHERE created_at >= TIMESTAMP '2024-01-10' AND created_at < TIMESTAMP '2024-01-13' GROUP BY ALL""",
)
def gold_partitioned_roundtrip(spark, sf_dir, v: Views):
    """Driver days written by date and read back for three days, with partition pruning."""
    path = scratch_path(spark, "gold")
    days = v["orders_l"].groupBy("driver_id", F.to_date("created_at").alias("metric_date")).agg(
        F.count(F.lit(1)).alias("deliveries_completed")
    )
    writers.write_gold(days, path)
    return readers.read_layer(
        spark, path, ["driver_id", "metric_date", "deliveries_completed"], datetime(2024, 1, 10), datetime(2024, 1, 12)
    )


@query(
    "partition_paths",
    """SELECT order_id, strftime(created_at, 'year=%Y/month=%m/day=%d') AS day_path,
  strftime(created_at, 'year=%Y/month=%m') AS month_path, strftime(created_at, 'year=%Y') AS year_path FROM orders_l""",
)
def partition_paths(v: Views):
    return v["orders_l"].select(
        "order_id",
        partition_path("created_at").alias("day_path"),
        partition_path("created_at", "year/month").alias("month_path"),
        partition_path("created_at", "year").alias("year_path"),
    )


@query(
    "kafka_records",
    """SELECT CAST(order_id AS VARCHAR) AS key, order_id, driver_id, order_type, created_at, pickup_lat, pickup_lon,
  delivery_lat, delivery_lon, expected_delivery_minutes, actual_delivery_minutes FROM orders_l""",
)
def kafka_records(v: Views):
    """Orders to keyed JSON records and back."""
    orders = v["orders_l"]
    records = writers.kafka_records(orders, "order_id")
    parsed = readers.parse_records(records, _schema(orders))
    return parsed.select(F.col("order_id").cast("string").alias("key"), *orders.columns)


@query_on_files("storage_stats")
def storage_stats(spark, sf_dir, v: Views):
    return readers.storage_stats(spark, sf_dir, "tables", "*.parquet")


@query_on_files("file_hashes")
def file_hashes(spark, sf_dir, v: Views):
    return digests.file_hashes(spark, sf_dir, "*.parquet")
