"""Distinct counts and distributions from mergeable sketches: kept at a fine grain, merged to coarser ones without the rows.

A sketch has a bounded size whatever it has seen, and merging sketches gives the sketch of all their rows. So a table of hourly
sketches answers for days, weeks or all regions by reading a few bytes an hour, and a snapshot's distribution can be compared with
a later one after its rows are gone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.geo import assign_region
from waybill.functions.timing import hour_floor
from waybill.operators.drift import ALPHA, ks_probability

LG_BUCKETS = 14  # 2**14 registers: a standard error below one percent
KLL_SIZE = 800  # ranks within RANK_ERROR of the rows
RANK_ERROR = 2.3 / KLL_SIZE**0.9
POINTS = 512  # quantiles of each side at which two stored distributions are compared
DISTANCE_ERROR = 2 * RANK_ERROR + 1 / POINTS
CRITICAL = math.sqrt(-math.log(ALPHA / 2) / 2)


def distinct_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of a distinct count with 2**lg_buckets registers."""
    return 1.04 / math.sqrt(2**lg_buckets)


def region_hour_sketches(gps: DataFrame, lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """(region, metric_hour, gps_events_count, drivers): events, and a sketch of the distinct drivers, combined in the map tasks."""
    located = gps.select(assign_region("latitude", "longitude").alias("region"), hour_floor("event_timestamp").alias("metric_hour"), "driver_id", "event_id")
    return located.where("metric_hour IS NOT NULL").groupBy("region", "metric_hour").agg(
        F.count("event_id").alias("gps_events_count"), F.hll_sketch_agg(F.col("driver_id").cast("string"), F.lit(lg_buckets)).alias("drivers")
    )


def merged(sketches: DataFrame, by: list) -> DataFrame:
    """Hours merged to any coarser groups: events, and the estimated number of distinct drivers."""
    return sketches.groupBy(*by).agg(
        F.sum("gps_events_count").alias("gps_events_count"), F.hll_sketch_estimate(F.hll_union_agg("drivers")).alias("active_drivers")
    )


def daily_drivers(sketches: DataFrame) -> DataFrame:
    """Active drivers per region and day, from the hours' sketches alone."""
    return merged(sketches, ["region", F.to_date("metric_hour").alias("metric_date")])


def distribution(df: DataFrame, columns: list[str], size: int = KLL_SIZE) -> DataFrame:
    """(column, n, mean, deviation, sketch): what a snapshot keeps of its columns, a row each. Nulls and NaN are left out."""
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    parts = [(F.count(c), F.avg(c), F.stddev_samp(c), F.kll_sketch_agg_double(F.col(c), F.lit(size))) for c in columns]
    names = ["n", "mean", "deviation", "sketch"]
    packed = [F.struct(F.lit(c).alias("column"), *(v.alias(n) for v, n in zip(own, names, strict=True))) for c, own in zip(columns, parts, strict=True)]
    row = df.select(*clean).agg(F.array(*packed).alias("all"))
    return row.select(F.inline("all")).where("n > 0")


def critical_distance(n1: str, n2: str) -> Column:
    """The distance from which samples of two sizes count as drifted at the usual level."""
    return CRITICAL * F.sqrt((F.col(n1) + F.col(n2)) / (F.col(n1) * F.col(n2)))


def stored_drift(current: DataFrame, baseline: DataFrame, alpha: float = ALPHA, points: int = POINTS) -> DataFrame:
    """Per column of two stored distributions: the largest distance of their ranks, its p-value, and whether the column drifted.

    Each side is read at equally spaced quantiles, and ranks are compared at all of them. The distance is that of the rows within
    DISTANCE_ERROR. Where there are so many rows that this error alone would count as drift, what it exceeds the critical distance by
    is taken off before the p-value, so it is not held against a column.
    """
    shares = F.array(*(F.lit((i + 0.5) / points) for i in range(points)))
    quantiles = lambda side: side.withColumn("q", F.kll_sketch_get_quantile_double(F.col("sketch"), shares)).drop("sketch")
    names = {"n": "rows", "mean": "mean", "deviation": "std", "q": "q"}
    side = lambda df, of: quantiles(df).select("column", *(F.col(n).alias(f"{of}_{m}") for n, m in names.items()))
    both = side(current, "current").join(side(baseline, "baseline"), "column")
    upto = lambda q, x: F.size(F.filter(q, lambda v: v <= x))
    distances = F.transform(F.concat("current_q", "baseline_q"), lambda x: F.abs(upto(F.col("current_q"), x) - upto(F.col("baseline_q"), x)))
    rows = both.withColumn("ks_statistic", F.array_max(distances) / points)
    noise = F.greatest(F.lit(DISTANCE_ERROR) - critical_distance("baseline_rows", "current_rows"), F.lit(0.0))
    sure = F.greatest(F.col("ks_statistic") - noise, F.lit(0.0))
    p = ks_probability(sure, F.col("baseline_rows").cast("double"), F.col("current_rows").cast("double"))
    rows = rows.withColumn("p_value", p).withColumn("is_drifted", F.col("p_value") < alpha)
    return rows.select("column", "ks_statistic", "p_value", "is_drifted", "baseline_rows", "current_rows", "baseline_mean", "current_mean", "baseline_std", "current_std")
