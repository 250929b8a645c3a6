"""Merging rows into a table partitioned by date, when rows may move from one date to another.

A rewrite of the dates that the new rows have is not enough: a row whose date was corrected lies in its old date as well. So the
dates where the table holds the new rows' keys are looked up first, from the key column alone, and old and new dates are rewritten
together. Everything else stays untouched and unread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from waybill.functions.timing import with_date_levels
from waybill.session import materialize, scratch_path
from waybill.sources import folders
from waybill.sources.folders import DATE_COLUMNS
from waybill.sources.writers import write_days

KNOWN, NEW = "__known", "__new"


@dataclass(frozen=True)
class Change:
    """What a merge did to a table: rows that came in, and rows of the same keys that they displaced."""

    added: DataFrame
    displaced: DataFrame

    def rows(self) -> DataFrame:
        """Old and new states of all changed rows."""
        return self.added.unionByName(self.displaced)

    def days(self, ts: Column | str) -> set[str]:
        """The days of a moment of the changed rows, before and after."""
        return folders.days_of(with_date_levels(self.rows().select(F.to_date(ts).alias("__d")), "__d"))


def dated_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A dated table with its date columns as texts; one that doesn't exist is empty."""
    own = [f for f in schema.fields if f.name not in DATE_COLUMNS]
    full = StructType([*own, *(StructField(c, StringType()) for c in DATE_COLUMNS)])
    if not folders.exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def _of_keys(rows: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Rows with (left_semi) or without (left_anti) one of the keys; null is a key."""
    named = keys.select(F.col(key).alias(KNOWN))
    return rows.join(named, F.col(key).eqNullSafe(F.col(KNOWN)), how)


def settled(known: DataFrame, batch: DataFrame, key: str, rank: list[str] | None) -> DataFrame:
    """Of every key the row that stays, with ``__new`` true where it is the batch's.

    With ``rank`` the first row in that order wins, all other columns following as in ``first_arrival``, and of equal rows the known
    one; without it the batch's row wins.
    """
    both = known.withColumn(NEW, F.lit(False)).unionByName(batch.withColumn(NEW, F.lit(True)))
    others = [c for c in batch.columns if c != key and c not in (rank or [])]
    order = [F.col(NEW).desc()] if rank is None else [F.col(c).asc_nulls_last() for c in [*rank, *others]] + [F.col(NEW)]
    ranked = both.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("__rn = 1").drop("__rn")


@dataclass(frozen=True)
class Merge:
    """A merge that is worked out and not yet written: what changes, the days to rewrite, and the folder with all rows of these days."""

    path: str
    ts: str
    sort: list[str] | None
    change: Change
    days: set[str]
    content: str | None

    def apply(self, spark: SparkSession) -> None:
        if self.days:
            write_days(spark.read.parquet(self.content), self.path, self.ts, self.days, self.sort)


def plan_merge(
    path: str, batch: DataFrame, key: str, ts: str, rank: list[str] | None = None, sort: list[str] | None = None
) -> Merge:
    """Work out the merge of rows, one per key, into the table at ``path``.

    Only the dates that gain, lose or change a row are to be rewritten; merging the same rows again changes nothing.
    """
    spark = batch.sparkSession
    batch = materialize(batch, "merge-batch")
    none = batch.limit(0)
    if batch.isEmpty():
        return Merge(path, ts, sort, Change(none, none), set(), None)
    table = dated_table(spark, path, batch.schema)
    keys = batch.select(key)
    # the manifest's old dates: only the key column and the partition values are read here
    homes = folders.days_of(_of_keys(table.select(key, *DATE_COLUMNS), keys, key, "left_semi"))
    if homes:
        known = _of_keys(table.where(folders.on_days(homes)), keys, key, "left_semi").select(*batch.columns)
        known = materialize(known, "merge-known")
        added = settled(known, batch, key, rank).where(NEW).drop(NEW)
        if rank is None:  # a row that is merged again as it is changes nothing
            added = _of_keys(added, known.intersectAll(batch), key, "left_anti")
        added = materialize(added, "merge-added")
        change = Change(added, materialize(_of_keys(known, added, key, "left_semi"), "merge-displaced"))
    else:
        change = Change(batch, none)
    days = change.days(ts)
    content = None
    if days:
        kept = _of_keys(table.where(folders.on_days(days)), change.added, key, "left_anti").select(*batch.columns)
        content = scratch_path(spark, "merge-days")
        kept.unionByName(change.added).write.parquet(content)
    return Merge(path, ts, sort, change, days, content)


def merge_dated(
    path: str, batch: DataFrame, key: str, ts: str, rank: list[str] | None = None, sort: list[str] | None = None
) -> Change:
    """Work out a merge and write it; returns what changed."""
    planned = plan_merge(path, batch, key, ts, rank, sort)
    planned.apply(batch.sparkSession)
    return planned.change
