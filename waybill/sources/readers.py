"""Readers: JSON lines, partitioned Parquet, SQL, Kafka records, storage statistics."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from waybill.operators.contracts import REASON
from waybill.schemas import DATASETS

CORRUPT = "_corrupt_record"
# Kafka source settings (fixed values).
KAFKA_GROUP = "bronze-ingestion-group"
TOPICS = ["drivers", "orders", "gps_events", "weather_events"]


def with_corrupt_column(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])


def read_jsonl(spark: SparkSession, path: str, schema: StructType, fail_on_bad: bool = False) -> DataFrame:
    """One JSON object per line; blank lines are skipped.

    A malformed line stays as a row with its text in ``_corrupt_record``, or ends the read when
    ``fail_on_bad``.
    """
    if fail_on_bad:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return (
        spark.read.schema(with_corrupt_column(schema))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def tag_corrupt(rows: DataFrame) -> DataFrame:
    """Turn the corrupt-record column into a quarantine reason."""
    return rows.withColumn(REASON, F.when(F.col(CORRUPT).isNotNull(), "malformed record"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_layer(
    spark: SparkSession, path: str, columns: list[str] | None = None,
    since: date | None = None, until: date | None = None, schema: StructType | None = None,
) -> DataFrame:
    """A date-partitioned table; a date range prunes partitions before any file is opened.

    With ``schema`` a folder without rows is an empty table.
    """
    reader = spark.read.option("recursiveFileLookup", "false")
    table = (reader.schema(schema) if schema else reader).parquet(path)
    if "ingestion_id" in table.columns:
        table = table.withColumn("ingestion_id", F.col("ingestion_id").cast("string"))
    for limit in date_range(since, until):
        table = table.where(limit)
    return table.select(*columns) if columns else table


def date_range(since: date | None, until: date | None) -> list[Column]:
    """Conditions on year, month and day for [since, until], on partition columns only."""
    ordinal = F.col("year").cast("int") * 10_000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    conditions = []
    if since:
        conditions += [F.col("year") >= since.year, ordinal >= int(since.strftime("%Y%m%d"))]
    if until:
        conditions += [F.col("year") <= until.year, ordinal <= int(until.strftime("%Y%m%d"))]
    return conditions


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Any SQL over named tables."""
    for name, table in (tables or {}).items():
        table.createOrReplaceTempView(name)
    return spark.sql(sql)


def parse_records(raw: DataFrame, schema: StructType) -> DataFrame:
    """Key, value (JSON text or bytes) to typed columns; unreadable values get a reason."""
    text = F.col("value").cast("string")
    parsed = F.from_json(
        text, with_corrupt_column(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    return tag_corrupt(raw.select(parsed.alias("__r")).select("__r.*"))


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """Topic as a stream of raw records, from the latest offsets; ``max_records`` caps a batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("kafka.group.id", KAFKA_GROUP)
        .option("startingOffsets", "latest")
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return reader.load().select("key", "value")


def kafka_table(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return parse_records(kafka_stream(spark, servers, topic), DATASETS[topic])


def storage_stats(spark: SparkSession, path: str, dataset: str, glob: str | None = None) -> DataFrame:
    """Files, bytes and megabytes below a path, from the listing alone (no file is read); no row
    when the path does not exist."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        listing = reader.load(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "dataset string, files long, size_bytes long, size_mb double")
    size = F.coalesce(F.sum("length"), F.lit(0)).cast("long")
    return (
        listing.select("length")
        .agg(F.count(F.lit(1)).alias("files"), size.alias("size_bytes"))
        .select(
            F.lit(dataset).alias("dataset"),
            "files",
            "size_bytes",
            F.round(F.col("size_bytes") / (1024 * 1024), 2).alias("size_mb"),
        )
    )
