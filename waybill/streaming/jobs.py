"""Streaming counterparts of the bronze and silver jobs.

Transformations take and return streaming DataFrames; ``drain`` runs one to the end of what is
there and stops. Files, Kafka topics and tests share the same transformations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

import numpy as np
import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from waybill.functions.geo import assign_region
from waybill.functions.timing import delivered_at, is_late, with_date_levels
from waybill.plans.bronze import RAW_STREAM, note_run, stream_date_column
from waybill.session import scratch_path
from waybill.sources.readers import TOPICS, kafka_table
from waybill.sources.writers import DATE_COLUMNS, Written, write_bronze

# Lateness allowed, hourly windows, pause between runs.
WATERMARK = "15 minutes"
HOUR = "1 hour"
RUN_EVERY = "300 seconds"
BUCKETS = 256  # states over which the keys of a deduplication with late rows are dealt
SLICE = 1 << 14  # rows that such a state sends on at a time


def file_stream(
    spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The files of a folder as a stream; ``files_per_batch`` caps a batch."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def bronze_rows(stream: DataFrame, ingest_date: date) -> DataFrame:
    """Add partition columns from the record's date, or from the ingest date when it has none."""
    column = stream_date_column(stream.columns)
    dated = F.coalesce(F.to_date(column), F.lit(ingest_date)) if column else F.lit(ingest_date)
    return with_date_levels(stream, dated)


def dedup(stream: DataFrame, key: str = "event_id", ts: str = "event_timestamp", delay: str = WATERMARK) -> DataFrame:
    """First row per key within the watermark; later rows than that are dropped and counted."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


ON_TIME, LATE = "on_time", "late"


def late_step(names: list[str], kept_ms: int, whole: bool) -> Callable:
    """The step of a bucket in ``dedup_with_late``; ``whole`` tells keys that are whole numbers from texts."""

    def step(_, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        ids, until, null_until = state.get if state.exists else (b"" if whole else [], b"", None)
        ids, until = np.frombuffer(ids, np.int64) if whole else np.array(ids, object), np.frombuffer(until, np.int64)
        ids, until = ids[until > passed], until[until > passed]
        null_until = None if null_until is None or null_until <= passed else null_until
        parts = [f for f in frames if len(f)]
        if parts:
            rows = pd.concat(parts, ignore_index=True)
            del parts
            at, key_of, null = (rows.pop(c).to_numpy() for c in ("__at", "__id", "__null"))
            order = np.argsort(at, kind="stable")  # moments that are missing come last
            behind = (at <= passed * 1000) & (passed > 0)
            order, late = order[~behind[order]], order[behind[order]]
            nulls, order = order[null[order]], order[~null[order]]
            own_keys = pd.Series(key_of[order])
            fresh = order[~(own_keys.duplicated() | own_keys.isin(ids)).to_numpy()]
            del own_keys, order
            first_null = nulls[:1] if null_until is None else nulls[:0]
            ends = lambda chosen: np.where(np.isnan(at[chosen]), passed, at[chosen] // 1000).astype(np.int64) + kept_ms
            ids, until = np.concatenate([ids, key_of[fresh]]), np.concatenate([until, ends(fresh)])
            null_until = int(ends(first_null)[0]) if len(first_null) else null_until
            for chosen, arrival in ((np.concatenate([fresh, first_null]), ON_TIME), (late, LATE)):
                for i in range(0, len(chosen), SLICE):
                    yield rows.take(chosen[i : i + SLICE])[names].assign(arrival=arrival)
        if len(ids) or null_until is not None:
            state.update((ids.tobytes() if whole else ids.tolist(), until.tobytes(), null_until))
        elif state.exists:
            state.remove()

    return step


def dedup_with_late(
    stream: DataFrame, key: str = "event_id", ts: str = "event_timestamp", delay: str = WATERMARK, buckets: int = BUCKETS
) -> DataFrame:
    """First row per key within the watermark, and every row that comes behind the watermark, told apart by ``arrival``.

    Spark's own deduplication loses late rows without a trace; here they go on, so a sink partitioned by ``arrival`` has them in a side
    table, and on-time rows, late rows and duplicates make up the input. Keys are dealt by hash over ``buckets``, each with one state:
    the keys it has seen and when the watermark will have passed them; with its next rows a bucket drops what has expired, so the state
    holds the keys of about one delay. Whole-number keys and moments are held as bytes of 8 each; a bucket's rows of a batch are held once,
chosen by their places and sent on in slices of SLICE. (Timers would wake a bucket without rows, but keep a run to the end of its input from ending.)
    The rows of a bucket and batch come in any order; the earliest moment of a key stays. A row without a moment is never late
    and remembered as one at the watermark, so in a stream's first batch it is forgotten at once; null is a key.
    """
    names, kept_ms = stream.columns, int(pd.Timedelta(delay).total_seconds() * 1000)
    whole = isinstance(stream.schema[key].dataType, IntegralType)
    none, kind = (F.lit(0).cast("long"), "long") if whole else (F.lit(""), "string")
    own = stream.select(
        *names, F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket"), F.unix_micros(ts).alias("__at"),
        F.coalesce(F.col(key).cast(kind), none).alias("__id"), F.col(key).isNull().alias("__null"),
    )

    out = StructType([*stream.schema.fields, StructField("arrival", StringType())])
    held = f"ids {'binary' if whole else 'array<string>'}, until binary, null_until long"
    marked = own.withWatermark(ts, delay)
    return marked.groupBy("__bucket").applyInPandasWithState(late_step(names, kept_ms, whole), out, held, "append", GroupStateTimeout.NoTimeout)


def region_hourly(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Distinct drivers and events per region and hour, exact, once an hour is closed.

    Two chained windowed aggregations: per (hour, region, driver), then per (hour, region). State
    is spread over drivers, so one busy region does not sit in one task.
    """
    located = stream.withWatermark("event_timestamp", delay).select(
        assign_region("latitude", "longitude").alias("region"), "driver_id", "event_id", "event_timestamp"
    )
    per_driver = located.groupBy(F.window("event_timestamp", HOUR), "region", "driver_id").agg(
        F.count("event_id").alias("events")
    )
    per_region = per_driver.groupBy(F.window(F.window_time("window"), HOUR), "region").agg(
        F.count("driver_id").alias("active_drivers"), F.sum("events").alias("gps_events_count")
    )
    return per_region.select("region", F.col("window.start").alias("metric_hour"), "active_drivers", "gps_events_count")


def region_hourly_estimate(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The same with approximate distinct drivers and constant state per region hour."""
    return (
        stream.withWatermark("event_timestamp", delay)
        .groupBy(F.window("event_timestamp", HOUR), assign_region("latitude", "longitude").alias("region"))
        .agg(F.approx_count_distinct("driver_id").alias("active_drivers"), F.count("event_id").alias("gps_events_count"))
        .select("region", F.col("window.start").alias("metric_hour"), "active_drivers", "gps_events_count")
    )


def late_split(stream: DataFrame, orders: DataFrame, grace_minutes: int = 0) -> DataFrame:
    """Tag events against their order's delivery; the sink is partitioned by the tag."""
    ends = orders.select("order_id", delivered_at().alias("__ended"))
    joined = stream.join(ends, "order_id", "left")
    return joined.withColumn("is_late", is_late("event_timestamp", "__ended", grace_minutes)).drop("__ended")


def enrich(stream: DataFrame, drivers: DataFrame) -> DataFrame:
    """Events with vehicle type and region of their driver (stream-static left join)."""
    return stream.join(drivers.select("driver_id", "vehicle_type", "region"), "driver_id", "left")


@dataclass(frozen=True)
class Drained:
    """Where a finished run wrote, and its per-batch progress."""

    path: str
    total_records: int
    batches_written: int
    rows_dropped_late: int
    errors: int
    failure: str | None = None


def start(
    stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, once: bool = True,
    every: str = RUN_EVERY,
) -> StreamingQuery:
    """Append to a Parquet table, exactly once: all that is there and stop, or every few minutes."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start(path)


def start_bronze(
    stream: DataFrame, path: str, checkpoint: str, once: bool = True, every: str = RUN_EVERY,
    noted: Callable[[Written], None] | None = None,
) -> StreamingQuery:
    """Append a stream to bronze as a batch run would: each batch has one moment and one id of its
    own, and a batch that is repeated replaces its own files. Records without a date fall under the
    day of their batch.

    The id names the writer, which is the checkpoint's query, and its batch: streams never replace
    each other's batches. The moment is the one that Spark has put down for the batch before it ran,
    so a repeated batch gets it again, whenever it runs. ``noted`` is told what each batch wrote.
    """
    timed = stream.withColumn("ingestion_timestamp", F.current_timestamp())
    column = stream_date_column(stream.columns)
    day = F.to_date("ingestion_timestamp")

    def write(batch: DataFrame, number: int) -> None:
        writer = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run = f"stream-{writer}-{number:012d}"
        rows = batch.withColumn("ingestion_id", F.lit(run))
        written = write_bronze(rows, path, F.coalesce(F.to_date(column), day) if column else day, run)
        if noted is not None:
            noted(written)

    writer = timed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()


def drain(
    stream: DataFrame, label: str, partition_by: list[str] | None = None, path: str | None = None,
    checkpoint: str | None = None,
) -> Drained:
    """Run to the end of the available input; sink and checkpoint live in the shared folder."""
    spark = stream.sparkSession
    base = scratch_path(spark, label)
    path, checkpoint = path or f"{base}/table", checkpoint or f"{base}/checkpoint"
    query = start(stream, path, checkpoint, partition_by)
    batches: dict[int, tuple[int, int]] = {}

    def collect() -> None:
        # Spark keeps the last 100 progress entries only, hence the look every second
        for p in query.recentProgress:
            late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
            rows, dropped = batches.get(p.batchId, (0, 0))
            batches[p.batchId] = (max(rows, p.numInputRows), max(dropped, late))

    failure = None
    try:
        while not query.awaitTermination(1):
            collect()
    except StreamingQueryException as broken:  # what its batches had written before stays and is counted
        failure = str(broken)
    collect()
    return Drained(
        path=path,
        total_records=sum(rows for rows, _ in batches.values()),
        batches_written=sum(1 for rows, _ in batches.values() if rows > 0),
        rows_dropped_late=sum(dropped for _, dropped in batches.values()),
        errors=0 if failure is None else 1,
        failure=failure,
    )


def whole(drained: Drained) -> str:
    """The path of a run that came to the end of its input; one that failed on the way has written a part, which is no result."""
    if drained.errors:
        raise RuntimeError(f"the stream into {drained.path} failed, its table is not whole: {drained.failure}")
    return drained.path


def table(spark: SparkSession, drained: Drained, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(whole(drained))


def ingest(stream: DataFrame, label: str, ingest_date: date, path: str | None = None) -> Drained:
    """Topic or file stream into a date-partitioned bronze table."""
    return drain(bronze_rows(stream, ingest_date), label, DATE_COLUMNS, path)


def start_topics(
    spark: SparkSession, servers: str, lake: str, once: bool = True, every: str = RUN_EVERY
) -> dict[str, StreamingQuery]:
    """One query per Kafka topic into ``lake/raw_stream/<topic>``, side by side.

    Batch runs write below ``raw``: a folder that a stream has written shows a batch reader only the
    stream's own files. Unreadable messages stay in bronze with their ``quarantine_reason``: each
    message is parsed once, and silver leaves them out.
    """
    return {topic: start_topic(kafka_table(spark, servers, topic), topic, lake, once, every) for topic in TOPICS}


def start_topic(stream: DataFrame, topic: str, lake: str, once: bool = True, every: str = RUN_EVERY) -> StreamingQuery:
    """One topic's records into ``lake/raw_stream/<topic>``, each batch noted for the daily job."""

    def noted(written: Written) -> None:
        note_run(stream.sparkSession, lake, topic, RAW_STREAM, written)

    return start_bronze(stream, f"{lake}/{RAW_STREAM}/{topic}", f"{lake}/checkpoints/{topic}", once, every, noted)


def ingest_stats(spark: SparkSession, runs: dict[str, Drained]) -> DataFrame:
    """One row per topic: records, batches, errors."""
    rows = [(topic, r.total_records, r.batches_written, r.errors) for topic, r in runs.items()]
    return spark.createDataFrame(rows, "topic string, total_records long, batches_written long, errors long")
