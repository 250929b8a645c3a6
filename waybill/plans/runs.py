"""Which runs are in bronze and which of them the later layers have taken up.

Batch ingests and streams both note every run they have written, a row for each of its days. A job takes the rows that no job has
committed yet, reads just those runs on those days, and commits the rows when its tables are written. No order among run ids is
needed, so batch and stream ids go together.

Before it writes, a job notes its attempt: the days of each table that it is going to replace, and for silver the folder with their new
content. A job that breaks off leaves its attempt open. The next one writes that content again before it works out its own merges,
takes the same runs once more, and adds the open attempt's gold days to its own, since runs that are merged again change nothing.
Jobs over one lake run one after another.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.timing import instant
from waybill.operators.contracts import REASON
from waybill.plans.bronze import AREAS, bronze_schema
from waybill.sources import folders
from waybill.sources.merge import Merge, dated_table
from waybill.sources.writers import append_log, read_log

SILVER_LAYER, GOLD_LAYER = "cleaned", "gold"


@dataclass(frozen=True)
class Pending:
    """The rows of the log to take up, a few for each run since the last job; ``repeated`` when one of their runs has been taken up
    before, so that what came of its former content must be built anew; the longest delivery so far; and the open attempts' days."""

    rows: list
    repeated: bool
    longest_minutes: int
    attempted: list

    def of(self, dataset: str) -> list:
        return [r for r in self.rows if r["dataset"] == dataset]

    def gold_days(self) -> dict[str, set[str]]:
        out: dict[str, set[str]] = {}
        for r in self.attempted:
            if r["layer"] == GOLD_LAYER:
                out.setdefault(r["table_name"], set()).add(r["day"])
        return out

    def contents(self) -> dict[tuple[str, str], set[str]]:
        """Days by (table, folder of their content), the earlier attempt first."""
        out: dict[tuple[str, str], set[str]] = {}
        for r in self.attempted:
            if r["content"] is not None:
                out.setdefault((r["table_name"], r["content"]), set()).add(r["day"])
        return out


def pending(spark: SparkSession, base: str) -> Pending:
    logs = f"{base}/logs"
    written, done = read_log(spark, logs, "ingested_runs"), read_log(spark, logs, "processed_runs")
    new = written.join(done.select(F.col("ingested_id").alias("id")), "id", "left_anti")
    before = done.where("ingested_id IS NOT NULL").select("dataset", "ingestion_id", F.lit(True).alias("before")).distinct()
    rows = new.join(before, ["dataset", "ingestion_id"], "left").collect()
    longest = done.agg(F.max("longest_minutes")).first()[0]
    open_days = read_log(spark, logs, "attempted_days").join(done.select("attempt"), "attempt", "left_anti")
    return Pending(rows, any(r["before"] for r in rows), longest or 0, open_days.orderBy("record_timestamp", "attempt").collect())


def begin(spark: SparkSession, base: str, silver: dict[str, Merge], gold: dict[str, set[str]]) -> str:
    """Note what is going to be written; returns the attempt's name."""
    attempt = uuid.uuid4().hex
    rows = [(attempt, SILVER_LAYER, name, day, merge.content) for name, merge in silver.items() for day in sorted(merge.days)]
    rows += [(attempt, GOLD_LAYER, name, day, None) for name, days in gold.items() for day in sorted(days)]
    if rows:
        noted = spark.createDataFrame(rows, "attempt string, layer string, table_name string, day string, content string")
        append_log(noted.withColumn("record_timestamp", F.current_timestamp()).coalesce(1), f"{base}/logs", "attempted_days")
    return attempt


def commit(spark: SparkSession, base: str, taken: Pending, at: datetime, longest_minutes: int, attempt: str | None = None) -> None:
    """The runs are taken up, and this attempt and those before it are closed."""
    closed = sorted({r["attempt"] for r in taken.attempted} | ({attempt} if attempt else set()))
    rows = [(r["id"], r["dataset"], r["ingestion_id"], attempt) for r in taken.rows] + [(None, None, None, a) for a in closed]
    if rows:
        done = spark.createDataFrame(rows, "ingested_id string, dataset string, ingestion_id string, attempt string")
        done = done.withColumn("longest_minutes", F.lit(longest_minutes)).withColumn("record_timestamp", instant(at))
        append_log(done.coalesce(1), f"{base}/logs", "processed_runs")


def _schema(dataset: str) -> T.StructType:
    """Bronze of batches and of streams, whose unreadable records carry their reason."""
    return T.StructType([*bronze_schema(dataset).fields, T.StructField(REASON, T.StringType())])


def read_bronze(spark: SparkSession, base: str, dataset: str, rows: list | None = None) -> DataFrame:
    """A dataset's records from both areas: all, or those of some rows of the log, whose folders alone are opened."""
    out = None
    for area in AREAS:
        own = None if rows is None else [r for r in rows if r["area"] == area]
        table = dated_table(spark, f"{base}/{area}/{dataset}", _schema(dataset))
        if own is not None:
            table = table.where(F.col("ingestion_id").isin([r["ingestion_id"] for r in own]) & folders.on_days({r["day"] for r in own}))
        table = table.select(*_schema(dataset).names)
        out = table if out is None else out.unionByName(table)
    return out
