"""Writers: layer tables, JSON lines, Kafka records, reports and run logs.

Date-partitioned writes are rebalanced by date: AQE merges small dates into one file and splits a
date that holds much of the data over several tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waybill.functions.timing import with_date_levels
from waybill.schemas import RUN_LOGS
from waybill.sources import folders
from waybill.sources.folders import DATE_COLUMNS


def _seen(metrics: Observation, none: dict) -> dict:
    """Observed metrics of a finished write. A plan that Spark has recognised as empty leaves them out; ``none`` is what it saw."""
    try:
        return metrics.get
    except Py4JJavaError as failure:
        if "AssertionError" not in failure.java_exception.toString():
            raise
        return none


def _by_date(df: DataFrame, *more: str) -> DataFrame:
    return df.hint("rebalance", *DATE_COLUMNS, *more)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


@dataclass(frozen=True)
class Written:
    """What a write has put down, counted while it ran."""

    rows: int
    days: dict[str, set[str]]  # per run, the days that hold rows of it


def write_bronze(df: DataFrame, path: str, ts: Column | str, run: str | None = None) -> Written:
    """Append one run's rows below year/month/day/ingestion_id.

    The run id is a partition of its own: other runs of the same day are untouched, and a
    repeated run replaces its own files, those of dates that it has no rows for any more included.
    A run may be named, so that one without any row replaces its files as well.
    """
    spark = df.sparkSession
    seen = Observation()
    rows = with_date_levels(df, ts)
    day = F.struct(F.col("ingestion_id").cast("string").alias("run"), folders.day_of().alias("day"))
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(day).alias("days"))
    (
        _by_date(rows, "ingestion_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_COLUMNS, "ingestion_id")
        .parquet(path)
    )
    found = _seen(seen, {"n": 0, "days": []})
    days: dict[str, set[str]] = {} if run is None else {run: set()}
    for r in found["days"]:
        days.setdefault(r["run"], set()).add(r["day"])
    for name, own in days.items():
        below = f"ingestion_id={name}"
        folders.drop_days(spark, path, folders.held_days(spark, path, below) - own, below)
    return Written(found["n"], days)


def silver_date_column(df: DataFrame) -> str | None:
    return next((c for c in ("event_timestamp", "created_at", "start_time") if c in df.columns), None)


def gold_date_column(df: DataFrame) -> str | None:
    return next((c for c in ("metric_date", "metric_hour") if c in df.columns), None)


def _dated(df: DataFrame, path: str, ts: str, sort: list[str] | None) -> None:
    rows = _by_date(with_date_levels(df, ts)).sortWithinPartitions(*DATE_COLUMNS, *(sort or []))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DATE_COLUMNS)
        .parquet(path)
    )


def write_days(df: DataFrame, path: str, ts: str, days: set[str], sort: list[str] | None = None) -> None:
    """Replace these days by ``df``, which holds all their rows: a day that it has none for goes.

    ``df`` is read twice, so it should be a written table, and none of the files that are replaced.
    """
    _dated(df, path, ts, sort)
    left = folders.days_of(with_date_levels(df.select(ts), ts))
    folders.drop_days(df.sparkSession, path, days - left)


def _write_dated(df: DataFrame, path: str, ts: str | None, sort: list[str], whole: bool) -> None:
    if ts is None:
        df.write.mode("overwrite").parquet(path)
        return
    before = folders.held_days(df.sparkSession, path) if whole else set()
    seen = Observation()
    _dated(with_date_levels(df, ts).observe(seen, F.collect_set(folders.day_of()).alias("days")), path, ts, sort)
    if before:
        folders.drop_days(df.sparkSession, path, before - set(_seen(seen, {"days": []})["days"]))


def write_silver(df: DataFrame, path: str, sort: list[str] | None = None, whole: bool = False) -> None:
    """Replace the dates present in ``df``, or with ``whole`` the table; files are sorted inside.

    Rows that may have moved to another date are merged by key instead (``merge.merge_dated``).
    """
    ts = silver_date_column(df)
    _write_dated(df, path, ts, sort or ([ts] if ts else []), whole)


def write_gold(df: DataFrame, path: str, whole: bool = False, ts: str | None = None) -> None:
    """Dated by ``ts``, metric_date or metric_hour, else one undated table; ``whole`` replaces all dates."""
    _write_dated(df, path, ts or gold_date_column(df), [], whole)


def write_features(df: DataFrame, base: str, name: str, dataset_hash: str) -> str:
    """One snapshot per dataset hash."""
    path = f"{base}/{name}/dataset_hash={dataset_hash}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_jsonl(df: DataFrame, path: str, compression: str = "none", file_rows: int = 0) -> None:
    """One JSON object per line, nulls kept, ISO timestamps; a file has ``file_rows`` lines at most, any number of them when 0. A
    compressed file is read by one task, so it should have a limit."""
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("compression", compression)
        .option("maxRecordsPerFile", file_rows)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .json(path)
    )


def kafka_records(df: DataFrame, key: str) -> DataFrame:
    """Key and JSON value of each row, as the Kafka sink takes them."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns), options).alias("value")
    )


def write_kafka(df: DataFrame, servers: str, topic: str, key: str) -> None:
    (
        kafka_records(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", topic)
        .save()
    )


def write_report(checks: DataFrame, summary: DataFrame, path: str) -> None:
    """Checks and their summary as JSON below one folder."""
    checks.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/checks")
    summary.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/summary")


def write_quarantine(rows: DataFrame, path: str, run: str) -> None:
    """Rejected rows as JSON text with their reason, partitioned by dataset and run.

    Repeating a run replaces its own rejects.
    """
    content = [c for c in rows.columns if c not in ("dataset", "quarantine_reason")]
    packed = rows.select(
        "dataset", F.lit(run).alias("run"), "quarantine_reason", F.to_json(F.struct(*content)).alias("record")
    )
    (
        packed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "run")
        .parquet(path)
    )


def append_log(rows: DataFrame, base: str, log: str) -> None:
    """Append rows to a run-log table; missing columns become null, missing ids are generated."""
    schema = RUN_LOGS[log]
    columns = []
    for field in schema.fields:
        if field.name in rows.columns:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name == "id":
            columns.append(F.uuid().alias("id"))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    rows.select(*columns).write.mode("append").parquet(f"{base}/{log}")


def append_log_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """The same rows into a relational table."""
    rows.write.mode("append").jdbc(url, table, properties=properties)


def read_log(spark: SparkSession, base: str, log: str) -> DataFrame:
    """A run log; one that nothing was written to is empty."""
    if not folders.exists(spark, f"{base}/{log}"):
        return spark.createDataFrame([], RUN_LOGS[log])
    return spark.read.schema(RUN_LOGS[log]).parquet(f"{base}/{log}")
