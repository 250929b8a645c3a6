"""Partition folders of a table: which there are, and the removal of those that a rewrite has left behind.

Spark overwrites the partitions it has rows for. One that has lost all its rows is not among them, so its folder is removed after
the write, through the same Hadoop file layer that Spark itself uses for the store. A job that stops in between leaves the old
folder; the next run of the same rewrite removes it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.timing import date_levels

DATE_COLUMNS = date_levels()
UNDATED = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name for a null
DAY = re.compile("/".join(f"{level}=([^/]+)" for level in DATE_COLUMNS))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; one that doesn't exist is passed over."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)


def day_of() -> Column:
    """The date columns of a row as one text such as ``20240115``; undated rows have a text of their own."""
    return F.coalesce(F.concat(*DATE_COLUMNS), F.lit(UNDATED))


def days_of(rows: DataFrame) -> set[str]:
    """The days that rows with date columns lie in: as many values as there are dates."""
    return {r["day"] for r in rows.select(day_of().alias("day")).distinct().collect()}


def on_days(days: set[str]) -> Column:
    """Whether a row's partition is one of these days; a test of partition columns alone, so other files are not opened."""
    return day_of().isin(sorted(days)) if days else F.lit(False)


def held_days(spark: SparkSession, path: str, below: str = "") -> set[str]:
    """The days whose folder has a partition ``below`` (any day folder when empty), from the names of folders."""
    pattern, store = _folder(spark, "/".join([path, *(f"{level}=*" for level in DATE_COLUMNS), *([below] if below else [])]))
    found = store.globStatus(pattern)
    return {_day(str(status.getPath())) for status in found or []}


def _day(path: str) -> str:
    parts = DAY.search(path).groups()
    return UNDATED if UNDATED in parts else "".join(parts)


def drop_days(spark: SparkSession, path: str, days: set[str], below: str = "") -> None:
    """Remove the partitions of these days (or what they hold ``below``); days without one are passed over."""
    for day in sorted(days):
        parts = [UNDATED] * 3 if day == UNDATED else [day[:4], day[4:6], day[6:]]
        names = [f"{level}={part}" for level, part in zip(DATE_COLUMNS, parts, strict=True)]
        folder, store = _folder(spark, "/".join([path, *names, *([below] if below else [])]))
        if store.exists(folder):
            store.delete(folder, True)
