"""Bronze ingest: raw records plus ingestion metadata, partitioned by date and run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.timing import instant, partition_path, run_id
from waybill.operators.contracts import REASON
from waybill.schemas import DATASETS
from waybill.sources.readers import CORRUPT, read_jsonl
from waybill.sources.writers import Written, append_log, write_bronze, write_quarantine

# where batch runs and streams write: a folder that a stream has written shows a batch reader the stream's own files only
AREAS = RAW, RAW_STREAM = "raw", "raw_stream"

# Where a date may be found, in order.
BATCH_DATE_COLUMNS = ["event_timestamp", "created_at", "start_time"]
STREAM_DATE_COLUMNS = ["order_timestamp", "event_timestamp", "created_at", "start_time", "timestamp", "date"]


def batch_date_column(columns: list[str], dataset: str) -> str:
    """The dataset's own timestamp, a common one, any name with date or time in it, or the
    ingestion time."""
    singular = dataset.rstrip("s")
    wanted = [f"{singular}_timestamp", f"{singular}_at", *BATCH_DATE_COLUMNS]
    named = [c for c in wanted if c in columns]
    dateish = [c for c in columns if "date" in c.lower() or "time" in c.lower()]
    return next(iter(named + dateish), "ingestion_timestamp")


def stream_date_column(columns: list[str]) -> str | None:
    return next((c for c in STREAM_DATE_COLUMNS if c in columns), None)


def with_ingestion(df: DataFrame, at: datetime) -> DataFrame:
    """One ingestion time and run id for the whole run."""
    return df.withColumns(
        {
            "ingestion_timestamp": instant(at),
            "ingestion_id": F.lit(run_id(at)),
        }
    )


def bronze_schema(dataset: str) -> T.StructType:
    """The dataset's columns and the ingestion's."""
    own = [T.StructField("ingestion_timestamp", T.TimestampType()), T.StructField("ingestion_id", T.StringType())]
    return T.StructType([*DATASETS[dataset].fields, *own])


def split_corrupt(rows: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    """Readable rows with a partition date, and the others with their reason."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed record").when(F.col(ts).isNull(), f"no {ts}")
    tagged = rows.withColumn(REASON, reason)
    return tagged.where(f"{REASON} IS NULL").drop(REASON, CORRUPT), tagged.where(f"{REASON} IS NOT NULL")


def note_run(spark: SparkSession, lake: str, dataset: str, area: str, written: Written) -> None:
    """Note what a write has added to bronze, for the jobs that take up new runs."""
    rows = [(dataset, area, run, day, written.rows) for run, days in written.days.items() for day in sorted(days)]
    if rows:
        noted = spark.createDataFrame(rows, "dataset string, area string, ingestion_id string, day string, row_count long")
        append_log(noted.withColumn("record_timestamp", F.current_timestamp()).coalesce(1), f"{lake}/logs", "ingested_runs")


def ingest_jsonl(
    spark: SparkSession, dataset: str, source: str, lake: str, at: datetime, quarantine: str | None = None,
    schema=None, fail_on_bad: bool = False,
) -> str:
    """Read JSON lines into ``lake/raw/<dataset>``; returns that path.

    Rejected rows go to ``quarantine`` when given. Without records nothing is written.
    """
    schema = schema or DATASETS[dataset]
    target = f"{lake}/{RAW}/{dataset}"
    rows = with_ingestion(read_jsonl(spark, source, schema, fail_on_bad), at)
    ts = batch_date_column(schema.names, dataset)
    if fail_on_bad:
        note_run(spark, lake, dataset, RAW, write_bronze(rows, target, ts, run_id(at)))
        return target
    good, bad = split_corrupt(rows, ts)
    note_run(spark, lake, dataset, RAW, write_bronze(good, target, ts, run_id(at)))
    if quarantine:
        write_quarantine(bad.withColumn("dataset", F.lit(f"bronze_{dataset}")), quarantine, run_id(at))
    return target


def partition_counts(df: DataFrame, ts: str) -> DataFrame:
    """Rows per date partition."""
    return (
        df.groupBy(F.to_date(ts).alias("__d"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(partition_path("__d").alias("partition_path"), "row_count")
    )


def ingest_summary(bronze: DataFrame, dataset: str, ts: str) -> DataFrame:
    """Rows, partitions and column types of an ingested dataset."""
    source = [c for c in bronze.columns if c not in ("year", "month", "day")]
    types = ",".join(f"{n}:{t}" for n, t in sorted((n, t) for n, t in bronze.dtypes if n in source))
    return bronze.agg(
        F.count(F.lit(1)).alias("rows_ingested"),
        F.count_distinct(F.to_date(ts)).alias("partitions"),
    ).select(F.lit(dataset).alias("dataset"), "rows_ingested", "partitions", F.lit(types).alias("column_types"))


def newer_than(bronze: DataFrame, last_ingestion_id: str) -> DataFrame:
    """Rows of runs after a batch run. Batch runs are told by their id, which is a partition, so older ones are not read; the ids of
    streams have no order among them, so their rows are told by their time. Jobs that take up every run once use ``runs.pending``."""
    if not last_ingestion_id[:14].isdigit():
        raise ValueError(f"{last_ingestion_id} is not the id of a batch run")
    last = datetime.strptime((last_ingestion_id + "-000000")[:21], "%Y%m%d%H%M%S-%f")
    own = F.col("ingestion_id").cast("string")
    batch = own.rlike("^[0-9]")
    return bronze.where((batch & (own > last_ingestion_id)) | (~batch & (F.col("ingestion_timestamp") > instant(last))))
