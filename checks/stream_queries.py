"""Streaming queries: each drains a file stream over the given tables and returns the sink."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.registry import Views, query_on_files
from checks.silver_gold import ENDED, region_sql
from checks.views import SPARK, view_sql
from waybill.plans import bronze, silver
from waybill.plans.bronze import partition_counts
from waybill.plans.silver import GPS_COLUMNS
from waybill.session import scratch_path
from waybill.sources.readers import read_layer
from waybill.sources.writers import write_bronze
from waybill.streaming import jobs

INGEST_DAY = date(2024, 2, 1)


def _stream(v: Views, base: str, view: str):
    """A view of the test data over a stream of one of its base tables.

    The base table's name is bound to the stream while the view's SQL is analysed, and back to
    the batch table afterwards; the other tables stay static.
    """
    v[view]  # registers what the view's SQL names
    batch = v.base(base)
    raw = v.raw_schema(base)
    # a pattern, because a stream source takes folders and patterns but no single file
    stream = jobs.file_stream(v.spark, v.path(base).removesuffix("t") + "[t]", raw)
    stream.select(*(F.col(f.name).cast(batch.schema[f.name].dataType).alias(f.name) for f in raw)).createOrReplaceTempView(
        SPARK.t(base)
    )
    try:
        return v.spark.sql(view_sql(SPARK)[view])
    finally:
        batch.createOrReplaceTempView(SPARK.t(base))


def _in_batches(v: Views, view: str, files: int = 4):
    """A view written as several files and streamed back, one file per batch."""
    path = scratch_path(v.spark, f"files-{view}")
    v[view].repartition(files).write.parquet(path)
    return jobs.file_stream(v.spark, path, v[view].schema, files_per_batch=1)


def _topics(v: Views):
    return {
        "drivers": _in_batches(v, "drivers"),
        "orders": _stream(v, "orders", "orders_l"),
        "gps_events": _stream(v, "events", "gps_bronze"),
        "weather_events": _stream(v, "events", "weather"),
    }


@query_on_files(
    "stream_bronze_counts",
    """SELECT topic, partition_path, count(*) AS row_count FROM (
SELECT 'drivers' AS topic, 'year=2024/month=02/day=01' AS partition_path FROM drivers
UNION ALL SELECT 'orders', strftime(created_at, 'year=%Y/month=%m/day=%d') FROM orders_l
UNION ALL SELECT 'gps_events', strftime(event_timestamp, 'year=%Y/month=%m/day=%d') FROM gps_bronze
UNION ALL SELECT 'weather_events', strftime(start_time, 'year=%Y/month=%m/day=%d') FROM weather) GROUP BY ALL""",
)
def stream_bronze_counts(spark, sf_dir, v: Views):
    """All four topics into date-partitioned bronze; counted from the partitions written."""
    out = None
    for topic, stream in _topics(v).items():
        run = jobs.ingest(stream, f"stream-{topic}", INGEST_DAY)
        written = spark.read.parquet(jobs.whole(run))
        day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
        counts = partition_counts(written.withColumn("__day", day), "__day").select(F.lit(topic).alias("topic"), "*")
        out = counts if out is None else out.unionAll(counts)
    return out


ARRIVED = ", ".join(c for c in GPS_COLUMNS if c != "ingestion_timestamp")


@query_on_files(
    "stream_to_silver",
    f"""SELECT {ARRIVED} FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival, event_timestamp, order_id,
    driver_id, latitude, longitude, accuracy) AS rn
  FROM (SELECT {ARRIVED}, 0 AS arrival FROM gps_bronze WHERE order_id % 3 = 0
    UNION ALL SELECT {ARRIVED}, 1 FROM gps_bronze)) WHERE rn = 1""",
)
def stream_to_silver(spark, sf_dir, v: Views):
    """A batch run and a stream in several batches, both in bronze; silver takes the first arrival over both."""
    gps = v["gps_bronze"].drop("ingestion_timestamp")
    lake = scratch_path(spark, "stream-to-silver")
    first = bronze.with_ingestion(gps.where("order_id % 3 = 0"), datetime(2024, 2, 1))
    write_bronze(first, f"{lake}/raw/gps_events", "event_timestamp")
    files = f"{lake}/landing"
    gps.repartitionByRange(3, "event_id").write.parquet(files)
    stream = jobs.file_stream(spark, files, gps.schema, files_per_batch=1)
    jobs.start_bronze(stream, f"{lake}/raw_stream/gps_events", f"{lake}/checkpoint").awaitTermination()
    both = read_layer(spark, f"{lake}/raw/gps_events").unionByName(read_layer(spark, f"{lake}/raw_stream/gps_events"))
    return silver.gps_events(both).select(*[c for c in GPS_COLUMNS if c != "ingestion_timestamp"])


@query_on_files("stream_dedup", "SELECT DISTINCT event_id FROM gps_bronze")
def stream_dedup(spark, sf_dir, v: Views):
    run = jobs.drain(jobs.dedup(_stream(v, "events", "gps_bronze")), "stream-dedup")
    return jobs.table(spark, run, StructType(v["gps_bronze"].schema.fields)).select("event_id")


# four batches in the order of time, but every tenth event comes with the last one
BATCH_NO = """CASE WHEN order_id % 10 = 0 OR event_timestamp >= TIMESTAMP '2024-01-24' THEN 3
  WHEN event_timestamp >= TIMESTAMP '2024-01-16' THEN 2 WHEN event_timestamp >= TIMESTAMP '2024-01-08' THEN 1 ELSE 0 END"""


@query_on_files(
    "stream_late_side",
    f"""WITH b AS (SELECT event_id, order_id, event_timestamp, {BATCH_NO} AS batch_no FROM gps_bronze),
marks AS (SELECT n.batch_no, max(e.event_timestamp) - INTERVAL 15 MINUTE AS mark FROM (SELECT DISTINCT batch_no FROM b) n
  LEFT JOIN (SELECT batch_no, max(event_timestamp) AS event_timestamp FROM b GROUP BY ALL) e ON e.batch_no < n.batch_no GROUP BY ALL),
told AS (SELECT b.*, mark, coalesce(event_timestamp <= mark, false) AS late FROM b JOIN marks USING (batch_no)),
ranked AS (SELECT *, lag(event_timestamp) OVER w AS before, lag(batch_no) OVER w AS before_no FROM told WHERE NOT late
  WINDOW w AS (PARTITION BY event_id ORDER BY batch_no, event_timestamp))
SELECT event_id, order_id, event_timestamp, 'late' AS arrival FROM told WHERE late
UNION ALL SELECT event_id, order_id, event_timestamp, 'on_time' FROM ranked
WHERE before IS NULL OR (before_no < batch_no AND before + INTERVAL 15 MINUTE <= mark)""",
)
def stream_late_side(spark, sf_dir, v: Views):
    """Events in several batches out of order: those on time once each, and the late ones beside them."""
    gps = v["gps_bronze"].drop("ingestion_timestamp")
    files = scratch_path(spark, "late-side")
    for n in range(4):
        gps.where(F.expr(BATCH_NO) == n).coalesce(1).write.mode("append").parquet(files)
    told = jobs.dedup_with_late(jobs.file_stream(spark, files, gps.schema, files_per_batch=1), buckets=16)
    run = jobs.drain(told, "stream-late-side", ["arrival"])
    return jobs.table(spark, run, told.schema).select("event_id", "order_id", "event_timestamp", "arrival")


@query_on_files(
    "stream_dedup_rows",
    """SELECT event_id, order_id, driver_id, event_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp, order_id) AS rn
FROM gps_bronze) WHERE rn = 1""",
)
def stream_dedup_rows(spark, sf_dir, v: Views):
    """One batch: of every event the earliest row, with all of it."""
    gps = v["gps_bronze"].drop("ingestion_timestamp")
    files = scratch_path(spark, "dedup-rows")
    gps.coalesce(1).write.parquet(files)
    told = jobs.dedup_with_late(jobs.file_stream(spark, files, gps.schema), buckets=16)
    run = jobs.drain(told, "stream-dedup-rows", ["arrival"])
    return jobs.table(spark, run, told.schema).select("event_id", "order_id", "driver_id", "event_timestamp")


@query_on_files(
    "stream_region_hourly",
    f"""SELECT * FROM (SELECT {region_sql('latitude', 'longitude')} AS region, date_trunc('hour', event_timestamp) AS metric_hour,
  count(DISTINCT driver_id) AS active_drivers, count(event_id) AS gps_events_count FROM gps_bronze
GROUP BY ALL) WHERE metric_hour + INTERVAL 1 HOUR
  <= (SELECT max(event_timestamp) FROM gps_bronze) - INTERVAL 15 MINUTE""",
)
def stream_region_hourly(spark, sf_dir, v: Views):
    """Hours closed by the watermark; the last one stays open."""
    hourly = jobs.region_hourly(_stream(v, "events", "gps_bronze"))
    return jobs.table(spark, jobs.drain(hourly, "stream-hourly"), hourly.schema)


@query_on_files(
    "stream_late_split",
    f"""SELECT event_id, g.order_id, coalesce(event_timestamp > ended, false) AS is_late FROM gps_bronze g
LEFT JOIN (SELECT order_id, {ENDED} AS ended FROM orders_l) o ON g.order_id = o.order_id""",
)
def stream_late_split(spark, sf_dir, v: Views):
    tagged = jobs.late_split(_stream(v, "events", "gps_bronze"), v["orders_l"])
    run = jobs.drain(tagged, "stream-late", ["is_late"])
    return jobs.table(spark, run, tagged.schema).select("event_id", "order_id", "is_late")


@query_on_files(
    "stream_enriched",
    """SELECT event_id, order_id, g.driver_id, vehicle_type, region FROM gps_bronze g
LEFT JOIN drivers d ON g.driver_id = d.driver_id""",
)
def stream_enriched(spark, sf_dir, v: Views):
    enriched = jobs.enrich(_stream(v, "events", "gps_bronze"), v["drivers"])
    run = jobs.drain(enriched, "stream-enriched")
    return jobs.table(spark, run, enriched.schema).select("event_id", "order_id", "driver_id", "vehicle_type", "region")


@query_on_files(
    "stream_ingest_stats",
    """SELECT 'orders' AS topic, count(*) AS total_records, CAST(0 AS BIGINT) AS errors FROM orders
UNION ALL SELECT 'gps_events', count(*), 0 FROM events UNION ALL SELECT 'weather_events', count(*), 0 FROM events
UNION ALL SELECT 'drivers', count(*), 0 FROM drivers""",
)
def stream_ingest_stats(spark, sf_dir, v: Views):
    runs = {t: jobs.ingest(stream, f"stats-{t}", INGEST_DAY) for t, stream in _topics(v).items()}
    return jobs.ingest_stats(spark, runs).select("topic", "total_records", "errors")
