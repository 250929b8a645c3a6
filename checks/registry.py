"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import SparkViews, with_views
from waybill.session import CHECKPOINT_SETTING, prepare

Views = SparkViews
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def with_folder(spark: SparkSession) -> SparkSession:
    """Name a shared folder for a session on one machine that has none."""
    if not spark.conf.get(CHECKPOINT_SETTING, None) and not spark.sparkContext.getCheckpointDir():
        if spark.sparkContext.master.startswith("local"):
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
    return spark


def query(name: str, sql: str | None = None):
    """Register ``fn(views)`` under a name, with its SQL counterpart when SQL can say it."""

    def register(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(SparkViews(with_folder(prepare(spark)), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def query_on_files(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir, views)`` for queries that stream, write or list files."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir, SparkViews(with_folder(prepare(spark)), sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at more digits than the data carries, so that summation order does not show."""
    return df.select(
        *(F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes)
    )
