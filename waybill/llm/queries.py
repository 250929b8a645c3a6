"""One query for each operator, over its whole table."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import bpe, decontaminate, jaccard, language_model, merkle, oracles, pages, piece_bpe, quality, resample, secrets, substrings, token_files, toxicity
from waybill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRINGS,
    "op4_ngram_jaccard": oracles.JACCARD,
    "op5_quality_rules": oracles.QUALITY,
    "op11_merkle_manifest": oracles.MERKLE,
    "op13_importance_resampling": oracles.RESAMPLED,
}


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with a shared folder: the one it names, or on one machine a new one."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir() and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
    return spark


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.checked(token_files.read(spark, path))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), toxicity.fold() == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held))
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query
def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(docs, secrets.learn(docs))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return pages.extracted(rows, pages.learn(rows))


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents"))


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"), size=4, percent=85).drop("content", "root")


@query
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(table(spark, sf_dir, "documents"), language_model.fold())


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


@query
def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
