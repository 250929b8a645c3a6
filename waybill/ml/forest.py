"""Isolation forest for driver risk (Liu, Ting, Zhou 2008).

Each tree is grown from at most 256 sampled rows, so growing is one small task per tree whatever
the table's size, and the whole forest is about 50,000 numbers. Scoring is a vectorised pass over
the rows; ranking the scores stays in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.ml.prepare import SEED, impute_mean, standardize
from waybill.operators.ordered import running_before
from waybill.session import materialize

# Settings (fixed values).
TREES = 100
SAMPLE_ROWS = 256
CONTAMINATION = 0.05

_DEPTH = 8  # log2 of the sample size
_NODES = 2 ** (_DEPTH + 1) - 1
_EULER = 0.5772156649015329
_SCORE_UNITS = 10**15


def expected_path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    longer = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, longer))


def _grow(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree as arrays in heap order: split feature (-1 for a leaf), threshold, path length."""
    feature, threshold, path = np.full(_NODES, -1), np.zeros(_NODES), np.zeros(_NODES)
    members = {0: points}
    for node in range(_NODES):
        inside = members.pop(node, None)
        if inside is None:
            continue
        depth = int(np.log2(node + 1))
        low, high = inside.min(axis=0), inside.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth == _DEPTH or len(splittable) == 0:
            path[node] = depth + expected_path(len(inside))
            continue
        chosen = rng.choice(splittable)
        cut = rng.uniform(low[chosen], high[chosen])
        feature[node], threshold[node] = chosen, cut
        left = inside[:, chosen] <= cut
        members[2 * node + 1], members[2 * node + 2] = inside[left], inside[~left]
    return feature, threshold, path


def _samples(rows: DataFrame, key: str, columns: list[str], n_rows: int, trees: int) -> DataFrame:
    """For every tree the rows with the smallest hash of (key, tree); a pre-test on the hash lets
    about twice the needed rows through, before anything is exploded or shuffled."""
    scale = 1 << 40
    keep = scale if n_rows <= 2 * SAMPLE_ROWS else int(scale * 2 * SAMPLE_ROWS / n_rows) + 1

    def position(tree):
        return F.pmod(F.xxhash64(F.col(key).cast("string"), tree), F.lit(scale))

    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    chosen = F.filter(numbers, lambda tree: position(tree) < keep)
    drawn = rows.select(key, *columns, F.explode(chosen).alias("tree")).withColumn("__at", position(F.col("tree")))
    ranked = Window.partitionBy("tree").orderBy("__at", key)
    return drawn.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= SAMPLE_ROWS)


def grow_forest(rows: DataFrame, key: str, columns: list[str], n_rows: int, trees: int = TREES, seed: int = SEED) -> DataFrame:
    """The forest as a table: one row per tree with its three arrays."""

    def build(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("rn")
        tree = int(sample["tree"].iloc[0])
        grown = _grow(sample[columns].to_numpy(dtype=float), np.random.default_rng([seed, tree]))
        return pd.DataFrame([[tree, *(part.tolist() for part in grown)]], columns=["tree", "feature", "threshold", "path"])

    return (
        _samples(rows, key, columns, n_rows, trees)
        .groupBy("tree")
        .applyInPandas(build, "tree int, feature array<int>, threshold array<double>, path array<double>")
    )


def score(rows: DataFrame, columns: list[str], forest: DataFrame, n_rows: int) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1]; higher is more isolated."""
    grown = forest.orderBy("tree").toPandas()  # one row per tree, 511 nodes each
    feature, threshold, path = (np.vstack(grown[name].to_list()) for name in ("feature", "threshold", "path"))
    normal = float(expected_path(min(SAMPLE_ROWS, n_rows))) or 1.0
    trees = np.arange(len(feature))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch[columns].to_numpy(dtype=float)
            at = np.zeros((len(points), len(trees)), dtype=int)
            for _ in range(_DEPTH):
                used = feature[trees, at]
                goes_right = np.take_along_axis(points, np.maximum(used, 0), axis=1) > threshold[trees, at]
                at = np.where(used < 0, at, 2 * at + 1 + goes_right)
            yield batch.assign(anomaly_score=2.0 ** (-path[trees, at].mean(axis=1) / normal))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInPandas(run, f"{kinds}, anomaly_score double")


def anomaly_cutoff(scored: DataFrame, n_rows: int, contamination: float = CONTAMINATION) -> DataFrame:
    """One row: the lowest score still anomalous, so that the given share lies at or above it.

    Scores are counted per value and accumulated from the top, in slices of the score range.
    """
    counted = scored.groupBy(F.round((1 - F.col("anomaly_score")) * _SCORE_UNITS).cast("long").alias("at")).agg(
        F.count(F.lit(1)).alias("n")
    )
    ranked = running_before(
        counted.withColumn("all", F.lit(0)), ["all"], "at", {"upto": ("sum", "n")}, width=_SCORE_UNITS // 1000, inclusive=True
    )
    return ranked.where(F.col("upto") - 1 < contamination * (n_rows - 1)).agg(F.max("at").alias("at"))


def risk_anomalies(features: DataFrame, key: str = "driver_id", trees: int = TREES, contamination: float = CONTAMINATION) -> DataFrame:
    """Every driver's anomaly score and label (-1 anomalous, 1 normal)."""
    columns = [c for c in features.columns if c != key]
    # imputing and scaling read the features several times
    known = materialize(features.where(F.col(key).isNotNull()), "risk-input")
    scaled = materialize(
        standardize(impute_mean(known, columns), columns), "risk-features"
    )
    n_rows = scaled.count()
    scored = materialize(
        score(scaled, columns, grow_forest(scaled, key, columns, n_rows, trees), n_rows).select(key, "anomaly_score"),
        "risk-scores",
    )
    cutoff = anomaly_cutoff(scored, n_rows, contamination).scalar()
    position = F.round((1 - F.col("anomaly_score")) * _SCORE_UNITS).cast("long")
    return scored.withColumn("label", F.when(position <= cutoff, -1).otherwise(1))


def risk_summary(labelled: DataFrame) -> DataFrame:
    anomalies = F.count_if(F.col("label") == -1)
    return labelled.agg(
        anomalies.alias("n_anomalies"), (anomalies / F.count(F.lit(1))).alias("anomaly_ratio")
    )
