"""Two-sample Kolmogorov-Smirnov drift check over any number of rows and columns."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALPHA = 0.05
# values that one slice should hold at most, and the slices of a small sample
SLICE_ROWS = 1_000_000
LEAST_SLICES = 256
# terms of the Kolmogorov series; they fall like exp(-2 k^2 lambda^2)
_TERMS = 100
# below this lambda the series has not converged and the probability is 1 to 10 digits
_FLAT_LAMBDA = 0.2


NO_STATISTICS = (
    "column string, ks_statistic double, current_rows long, baseline_rows long, baseline_mean double, "
    "current_mean double, baseline_std double, current_std double"
)


def _boundaries(both: DataFrame, columns: list[str], slices: int) -> dict[str, list[float]]:
    """Approximate quantiles of each column as fixed slice boundaries (bounded: slices per column)."""
    shares = [i / slices for i in range(1, slices)]
    found = both.agg(*(F.percentile_approx(c, shares, 10_000).alias(c) for c in columns)).first()
    return {
        c: [-math.inf, *sorted({v for v in (found[c] or []) if math.isfinite(v)}), math.inf] for c in columns
    }


def ks_statistics(current: DataFrame, baseline: DataFrame, columns: list[str], slices: int | None = None) -> DataFrame:
    """Per column: largest distance of the two empirical distributions, sizes, means, deviations.

    Values are counted per (column, value) before any ordering, cut into value slices at fixed
    quantile boundaries, and accumulated inside a slice on top of the totals of the slices
    before it. The slices grow with the rows, SLICE_ROWS each; their totals are one row a slice.
    """
    columns = [c for c in columns if c in current.columns and c in baseline.columns]
    if not columns:  # nothing to compare, nothing drifted
        return current.sparkSession.createDataFrame([], NO_STATISTICS)
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    both = current.select(*clean, F.lit(1).alias("__cur")).unionAll(baseline.select(*clean, F.lit(0).alias("__cur")))

    slices = slices or LEAST_SLICES + both.count() // SLICE_ROWS
    bounds = _boundaries(both, columns, slices)
    sliced = Bucketizer(
        splitsArray=[bounds[c] if len(bounds[c]) > 2 else [-math.inf, 0.0, math.inf] for c in columns],
        inputCols=columns,
        outputCols=[f"__slice_{c}" for c in columns],
        handleInvalid="keep",
    ).transform(both)
    long = sliced.select(
        "__cur",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"__slice_{c}").cast("int").alias("slice"),
                        F.col(c).alias("value"),
                    )
                    for c in columns
                )
            )
        ).alias("__cell"),
    ).select("__cur", "__cell.*").where("value IS NOT NULL")

    cur = F.col("__cur")
    counted = long.groupBy("column", "slice", "value").agg(F.sum(cur).alias("n_cur"), F.sum(1 - cur).alias("n_base"))
    moments = long.groupBy("column").agg(
        F.sum(cur).alias("current_rows"),
        F.sum(1 - cur).alias("baseline_rows"),
        F.avg(F.when(cur == 0, F.col("value"))).alias("baseline_mean"),
        F.avg(F.when(cur == 1, F.col("value"))).alias("current_mean"),
        F.stddev_samp(F.when(cur == 0, F.col("value"))).alias("baseline_std"),
        F.stddev_samp(F.when(cur == 1, F.col("value"))).alias("current_std"),
    )
    before = Window.partitionBy("column").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        counted.groupBy("column", "slice")
        .agg(F.sum("n_cur").alias("n_cur"), F.sum("n_base").alias("n_base"))
        .select(
            "column",
            "slice",
            F.coalesce(F.sum("n_cur").over(before), F.lit(0)).alias("cur_before"),
            F.coalesce(F.sum("n_base").over(before), F.lit(0)).alias("base_before"),
        )
    )
    upto = Window.partitionBy("column", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    steps = counted.select(
        "column", "slice", F.sum("n_cur").over(upto).alias("cur_in"), F.sum("n_base").over(upto).alias("base_in")
    )
    distance = F.abs(
        (F.col("cur_in") + F.col("cur_before")) / F.col("current_rows")
        - (F.col("base_in") + F.col("base_before")) / F.col("baseline_rows")
    )
    two_sided = moments.where("current_rows > 0 AND baseline_rows > 0")
    return (
        steps.join(carried, ["column", "slice"])
        .join(F.broadcast(two_sided.select("column", "current_rows", "baseline_rows")), "column")
        .groupBy("column")
        .agg(F.max(distance).alias("ks_statistic"))
        .join(two_sided, "column")
    )


def ks_probability(statistic, n1, n2):
    """Asymptotic two-sided p-value (Kolmogorov series with the small-sample correction)."""
    effective = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (effective + 0.12 + 0.11 / effective) * statistic
    terms = F.sequence(F.lit(1), F.lit(_TERMS))
    series = F.aggregate(
        terms,
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < _FLAT_LAMBDA, F.lit(1.0)).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def feature_drift(
    current: DataFrame, baseline: DataFrame, columns: list[str], stage: str, alpha: float = ALPHA
) -> DataFrame:
    """One row per checked column; a column drifted when its p-value is below ``alpha``."""
    stats = ks_statistics(current, baseline, columns)
    p = ks_probability(
        F.col("ks_statistic"), F.col("baseline_rows").cast("double"), F.col("current_rows").cast("double")
    )
    return stats.withColumn("p_value", p).select(
        F.lit("feature_drift").alias("check"),
        F.lit(stage).alias("stage"),
        F.col("column"),
        "ks_statistic",
        "p_value",
        (F.col("p_value") < alpha).alias("is_drifted"),
        "baseline_mean",
        "current_mean",
        "baseline_std",
        "current_std",
        F.when(F.col("p_value") < alpha, "WARN").otherwise("PASS").alias("status"),
    )


def drift_result(drift: DataFrame, stage: str, columns: list[str], alpha: float = ALPHA) -> DataFrame:
    """The check row over all columns: WARN when any drifted."""
    return drift.agg(F.count_if("is_drifted").alias("drifted")).select(
        F.lit("feature_drift").alias("check"),
        F.lit(stage).alias("stage"),
        F.when(F.col("drifted") > 0, "WARN").otherwise("PASS").alias("status"),
        F.col("drifted").cast("double").alias("metric_value"),
        F.lit(alpha).alias("threshold"),
        F.lit(f"{len(columns)} columns checked").alias("message"),
    )
