"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

from waybill.sources import folders

# Runtime settings that results (time zone) or skew handling (AQE) rely on. All of them can be
# changed on a live session, so a session made by somebody else can be prepared too.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs a further shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # fewer, larger shuffle reads and output files than the default of 64 MB
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)  # the paths of the innermost ``passing`` around

def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "waybill", **settings: str) -> SparkSession:
    """Make (or get) a session; ``settings`` use underscores for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir`` or set on the context."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    from_context = spark.sparkContext.getCheckpointDir()
    if from_context:
        return from_context.rstrip("/")
    raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder for one run's intermediate tables."""
    path = f"{shared_folder(spark)}/waybill/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are removed at its end, so nothing that outlasts it may read them. When it breaks off they
    stay: what a job was writing is written again from them."""
    made: list[str] = []
    around = _made.set(made)
    try:
        yield
    finally:
        _made.reset(around)
    for path in made:
        folders.remove(spark, path)


def materialize(df, label: str):
    """Write a table below the shared folder and read it back: lineage ends there, and a lost
    executor costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
