"""Data-quality checks. Each result is one row: check, stage, status, metric, threshold, message."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.timing import delivered_at, instant, is_late, relative_variance
from waybill.schemas import FRESHNESS_HOURS, LATE_RATIO_THRESHOLD, LINEAGE_VARIANCE, NULL_THRESHOLD

PASS, WARN, FAIL, SKIPPED = "PASS", "WARN", "FAIL", "skipped"


def _result(df: DataFrame, check: str, stage: str, status: Column, metric: Column, threshold, message: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"),
        F.lit(stage).alias("stage"),
        status.alias("status"),
        metric.cast("double").alias("metric_value"),
        F.lit(threshold).cast("double").alias("threshold"),
        message.cast("string").alias("message"),
    )


def row_count(df: DataFrame, stage: str, at_least: int | None = None, at_most: int | None = None) -> DataFrame:
    """FAIL outside the inclusive bounds; with both broken the upper bound's message stays."""
    n = F.col("n")
    below = n < at_least if at_least is not None else F.lit(False)
    above = n > at_most if at_most is not None else F.lit(False)
    message = F.when(
        above, F.concat(F.lit("Row count "), n.cast("string"), F.lit(f" above maximum {at_most}"))
    ).when(below, F.concat(F.lit("Row count "), n.cast("string"), F.lit(f" below minimum {at_least}")))
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return _result(
        counted, "row_count", stage, F.when(above | below, FAIL).otherwise(PASS), n, None, message
    )


def schema_columns(df: DataFrame, expected: dict[str, str], check_types: bool = False) -> DataFrame:
    """One row per expected or present column: missing, unexpected, wrong type or ok."""
    present = dict(df.dtypes)
    rows = []
    for name in sorted({*expected, *present}):
        if name not in present:
            state = "missing"
        elif name not in expected:
            state = "unexpected"
        elif check_types and present[name] != expected[name]:
            state = "wrong type"
        else:
            state = "ok"
        rows.append((name, expected.get(name), present.get(name), state))
    return df.sparkSession.createDataFrame(rows, "column string, expected string, actual string, state string")


def schema(df: DataFrame, expected: dict[str, str], stage: str, check_types: bool = False) -> DataFrame:
    """FAIL on a missing column (or a wrong type when asked); unexpected ones are only reported."""
    named = {
        state: F.array_join(F.array_sort(F.collect_list(F.when(F.col("state") == state, F.col("column")))), ",")
        for state in ("missing", "wrong type", "unexpected")
    }
    states = schema_columns(df, expected, check_types).agg(
        F.count_if(F.col("state").isin("missing", "wrong type")).alias("n"),
        *(text.alias(state.replace(" ", "_")) for state, text in named.items()),
    )
    message = F.concat(
        F.lit("missing: "), F.col("missing"),
        F.lit("; wrong type: "), F.col("wrong_type"),
        F.lit("; unexpected: "), F.col("unexpected"),
    )
    return _result(
        states, "schema", stage, F.when(F.col("n") > 0, FAIL).otherwise(PASS), F.col("n"), 0, message
    )


def null_profile(df: DataFrame, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """Null count and share of every column in a single aggregation; violation above threshold."""
    counted = df.agg(
        F.count(F.lit(1)).alias("__rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns)
    )
    cells = counted.unpivot("__rows", df.columns, "column", "null_count")
    share = F.when(F.col("__rows") > 0, F.col("null_count") / F.col("__rows")).otherwise(0.0)
    return cells.select(
        "column", "null_count", F.round(share, 4).alias("null_pct"), (share > threshold).alias("is_violation")
    )


def null_percentage(df: DataFrame, stage: str, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """FAIL when any column's null share exceeds the threshold."""
    bad = null_profile(df, threshold).agg(
        F.count_if("is_violation").alias("n"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("is_violation"), F.col("column")))), ",").alias("names"),
    )
    return _result(
        bad, "null_percentage", stage, F.when(F.col("n") > 0, FAIL).otherwise(PASS), F.col("n"), threshold,
        F.col("names"),
    )


def late_arrivals(gps: DataFrame, orders: DataFrame, grace_minutes: int = 0) -> DataFrame:
    """Late events, all events and their ratio; events without an order count as not late."""
    ends = orders.select("order_id", delivered_at().alias("__ended"))
    late = is_late("event_timestamp", "__ended", grace_minutes)
    return (
        gps.select("order_id", "event_timestamp")
        .join(ends, "order_id", "left")
        .agg(F.count_if(late).alias("late_count"), F.count(F.lit(1)).alias("total_events"))
        .withColumn(
            "late_ratio",
            F.when(F.col("total_events") > 0, F.col("late_count") / F.col("total_events")),
        )
    )


def late_arrival_ratio(
    gps: DataFrame, orders: DataFrame, stage: str = "silver_gps_events",
    threshold: float = LATE_RATIO_THRESHOLD, grace_minutes: int = 0,
) -> DataFrame:
    """WARN above the threshold; skipped when either side is empty."""
    some_orders = orders.select(F.lit(1).alias("one")).limit(1).agg(F.count("one").alias("n")).scalar()
    ratio = F.when(some_orders > 0, F.col("late_ratio"))
    status = F.when(ratio.isNull(), SKIPPED).when(ratio <= threshold, PASS).otherwise(WARN)
    return _result(
        late_arrivals(gps, orders, grace_minutes), "late_arrival_ratio", stage, status, ratio, threshold,
        F.when(ratio.isNull(), "no data"),
    )


def freshness(
    df: DataFrame, ts: str, stage: str, now: datetime | str, max_age_hours: float = FRESHNESS_HOURS
) -> DataFrame:
    """Age of the latest timestamp at ``now``; WARN when older than allowed, skipped without any."""
    if ts not in df.columns:
        empty = df.sparkSession.range(1)
        return _result(
            empty, "data_freshness", stage, F.lit(SKIPPED), F.lit(None), max_age_hours, F.lit("no timestamp data")
        )
    newest = df.agg(F.max(F.col(ts).cast("timestamp")).alias("t"))
    age = (F.unix_micros(instant(now)) - F.unix_micros("t")) / F.lit(3_600_000_000.0)
    status = F.when(age.isNull(), SKIPPED).when(age <= max_age_hours, PASS).otherwise(WARN)
    message = F.coalesce(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("no timestamp data"))
    return _result(newest, "data_freshness", stage, status, age, max_age_hours, message)


def report(checks: list[DataFrame], at: datetime | None = None) -> DataFrame:
    """All check rows in one table, with the time of the checks when given."""
    rows = reduce(DataFrame.unionByName, checks)
    return rows if at is None else rows.withColumn("timestamp", instant(at))


def summary(checks: DataFrame) -> DataFrame:
    """Counts per status and the worst one; skipped checks count in the total only."""
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == WARN).alias("warned"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    ).withColumn(
        "overall_status",
        F.when(F.col("failed") > 0, FAIL).when(F.col("warned") > 0, WARN).otherwise(PASS),
    )


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of every stage: one scan each, no collected rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(stage).alias("stage"), "row_count")
        for stage, df in stages.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def lineage(
    counts: DataFrame, steps: list[tuple[str, str]], threshold: float = LINEAGE_VARIANCE
) -> DataFrame:
    """Relative change of row counts between stages; valid up to the threshold, and never for a
    stage without a count."""
    pairs = counts.sparkSession.createDataFrame(steps, "source_stage string, target_stage string")
    # a handful of stages: their counts fit one map, computed once as a scalar subquery
    book = counts.agg(F.map_from_entries(F.collect_list(F.struct("stage", "row_count")))).scalar()
    known = pairs.select(
        "source_stage",
        "target_stage",
        F.try_element_at(book, "source_stage").alias("source_rows"),
        F.try_element_at(book, "target_stage").alias("target_rows"),
    )
    variance = relative_variance("source_rows", "target_rows")
    return known.withColumn("variance", variance).withColumn(
        "is_valid", F.coalesce(F.col("variance") <= threshold, F.lit(False))
    )


def lineage_result(steps: DataFrame, stage: str, threshold: float = LINEAGE_VARIANCE) -> DataFrame:
    """The check row over the steps of a lineage: WARN when a stage lost or gained more rows than allowed."""
    worst = steps.agg(F.count_if(~F.col("is_valid")).alias("n"), F.max("variance").alias("v"))
    return _result(worst, "row_count_lineage", stage, F.when(F.col("n") > 0, WARN).otherwise(PASS), F.col("v"), threshold, F.concat(F.col("n").cast("string"), F.lit(" steps beyond the threshold")))
