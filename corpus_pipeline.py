"""A corpus run through five operators, one after another: STAGES names them, run() applies them to `documents`.

Every stage takes all rows that the one before kept and returns the columns of `documents`; the last adds the token ids. Rows with
null or empty texts pass, as rows of their own. Near duplicates are judged by sets of five-word shingles at a similarity of 0.8.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import bpe, decontaminate, jaccard, secrets, toxicity
from waybill.llm.queries import prepared
from waybill.llm.text import fresh
from waybill.session import scratch_path

TOXIC = 0.5  # documents of this score and above go
# Rows go to Python in batches of so many bytes instead of 64 MB: a task holds one in Spark's direct memory and one in its worker, beside
# a heap that earlier stages have filled. A longer row is a batch of its own.
BATCH_BYTES = 256 << 10
PIECES_KEPT = 300_000  # pieces that a worker remembers in the last stage; beside a full heap there is no room for bpe's own number

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session that deals rows out in batches of BATCH_BYTES; the setting stays, as the stage's plan runs later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def toxic_rejected(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled ones."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.kept(docs, model, TOXIC)


@in_small_batches
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays (of equal ones the smallest hash of the text), once.
    Rows without doc_id, and documents without words, are like no other and stay."""
    classes = jaccard.classes(docs, size=5, percent=80).where("doc_id is not null")
    best = classes.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "content")).alias("best")).select("best.*")
    doc, own, key = (fresh(name, docs.columns) for name in ("kept_doc", "kept_content", "content_key"))
    kept = best.unionByName(classes.where("root is null").select("doc_id", "content").distinct()).toDF(doc, own)
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    found = keyed.join(kept, (F.col("doc_id") == F.col(doc)) & (F.col(key) == F.col(own)), "left_semi")
    return found.dropDuplicates(["doc_id", key]).unionByName(keyed.where("doc_id is null")).select(*docs.columns)


@in_small_batches
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to a mark; every document stays, and n_chars follows its text."""
    out = secrets.redacted(docs, secrets.learn(docs))
    changed = F.when(F.col("text").isNotNull(), F.length("text")).cast(out.schema["n_chars"].dataType) if "n_chars" in out.columns else None
    return out if changed is None else out.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))


@in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their number beside every document."""
    return bpe.intact(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), PIECES_KEPT)


STAGES = [
    ("toxicity", toxic_rejected),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("secret scans", secrets_redacted),
    ("byte-level BPE", encoded),
]
ORACLE_SQL = None  # no SQL for these stages: tests/llm holds them against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents after all stages; each stage is written to the shared folder and read again as the next one's input."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
