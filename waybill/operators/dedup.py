"""Removal of repeated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_arrival(df: DataFrame, key: str, arrival: str, order: list[str] | None = None) -> DataFrame:
    """Keep the first arrived row of every key.

    Ties on ``arrival`` are settled by ``order`` and then by all other columns, nulls last,
    so the survivor does not depend on partitioning or replay. ``row_number() = 1`` lets Spark put a group limit
    in front of the shuffle: each map task sends at most one row per key, however many copies
    a key has.
    """
    first = [arrival, *(order or [])]
    ranking = first + [c for c in df.columns if c not in first and c != key]
    copies = Window.partitionBy(key).orderBy(*(F.col(c).asc_nulls_last() for c in ranking))
    return df.withColumn("rn", F.row_number().over(copies)).where("rn = 1").drop("rn")


def dedup_summary(df: DataFrame, key: str, dataset: str) -> DataFrame:
    """Rows in, rows left, rows removed and their percentage, in one aggregation."""
    # a null key forms one group of its own, which count_distinct would skip
    counted = df.agg(
        F.count(F.lit(1)).alias("rows_input"),
        (F.count_distinct(key) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0)))
        .cast("long")
        .alias("rows_output"),
    )
    removed = F.col("rows_input") - F.col("rows_output")
    return counted.select(
        F.lit(dataset).alias("dataset"),
        "rows_input",
        "rows_output",
        removed.alias("duplicates_removed"),
        F.when(F.col("rows_input") > 0, F.bround(removed / F.col("rows_input") * 100, 2)).alias(
            "duplicate_ratio"
        ),
    )


def content_dedup(df: DataFrame, content: list[str], key: str) -> DataFrame:
    """One row per content, the one with the smallest id; copies meet in a map-side combine."""
    rest = [c for c in df.columns if c not in content and c != key]
    # a whole row is compared, so equal ids settle on one row and rows without id come last
    kept = df.groupBy(*content).agg(F.min(F.struct(F.col(key).isNull().alias("__last"), key, *rest)).alias("__first"))
    return kept.select(*content, "__first.*").select(*df.columns)


def not_yet_in(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """New rows whose key the existing table lacks, null being a key; ``new`` should hold one row per key."""
    known = existing.select(F.col(key).alias("__known")).distinct()
    return new.join(known, F.col(key).eqNullSafe(F.col("__known")), "left_anti")


def merge_first_arrivals(silver: DataFrame, batch: DataFrame, key: str, arrival: str) -> DataFrame:
    """Existing rows stay; of a new batch the first arrival of every unknown key is added."""
    return silver.unionByName(not_yet_in(first_arrival(batch, key, arrival), silver, key))


def dedup_effectiveness(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Bronze rows, silver rows, removed rows and ratio per dataset."""
    out = None
    for dataset, (bronze, silver) in pairs.items():
        counts = (
            bronze.select(F.lit(1).alias("b"), F.lit(0).alias("s"))
            .unionAll(silver.select(F.lit(0).alias("b"), F.lit(1).alias("s")))
            .agg(
                F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("bronze_rows"),
                F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("silver_rows"),
            )
            .select(F.lit(dataset).alias("dataset"), "*")
        )
        out = counts if out is None else out.unionAll(counts)
    removed = F.col("bronze_rows") - F.col("silver_rows")
    return out.withColumn("duplicates_removed", removed).withColumn(
        "duplicate_ratio",
        F.when(F.col("bronze_rows") > 0, F.bround(removed / F.col("bronze_rows") * 100, 2)).otherwise(0.0),
    )
