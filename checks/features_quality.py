"""Feature and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import Views, query, rounded
from checks.silver_gold import DEDUP, DELAY, ENDED, HOURLY, km_sql, region_sql
from waybill.functions import digests
from waybill.functions.geo import assign_region
from waybill.operators import drift, history, quality, sketches, tracks, weather
from waybill.plans import features, gold, silver
from waybill.session import materialize

APART = "sqrt(power(delivery_lat - pickup_lat, 2) + power(delivery_lon - pickup_lon, 2))"
DELAY_FEATURES = f"""SELECT order_id, o.driver_id, order_type, experience_years, accident_history, weather_sensitivity,
  expected_delivery_minutes, round(least({APART} * 111 / 10, 10.0), 6) AS route_complexity,
  CAST(hour(created_at) AS INT) AS order_hour, CAST(isodow(created_at) - 1 AS INT) AS order_dayofweek,
  CAST(month(created_at) AS INT) AS order_month, 0 AS weather_impact_score,
  CASE WHEN {DELAY} > 5 THEN 1 ELSE 0 END AS delay_flag
FROM orders_l o LEFT JOIN drivers d ON o.driver_id = d.driver_id"""
ETA_FEATURES = f"""SELECT order_id, o.driver_id, order_type, vehicle_type, experience_years, expected_delivery_minutes,
  round(avg(actual_delivery_minutes) OVER (PARTITION BY o.driver_id) - avg(expected_delivery_minutes) OVER (), 6) AS driver_eta_bias,
  round({APART}, 6) AS route_distance_proxy, CAST(hour(created_at) AS INT) AS order_hour,
  CASE WHEN hour(created_at) IN (7, 8, 9, 17, 18, 19) THEN 1 ELSE 0 END AS is_peak_hour,
  actual_delivery_minutes AS actual_eta_minutes
FROM orders_l o LEFT JOIN drivers d ON o.driver_id = d.driver_id"""
GPS_QUALITY = f"""SELECT driver_id, round(avg(accuracy), 9) AS gps_accuracy_mean, round(stddev_samp(accuracy), 9) AS gps_accuracy_std
FROM {DEDUP} GROUP BY driver_id"""
RISK_FEATURES = f"""SELECT r.driver_id, accident_history, accident_risk, round(delay_ratio, 9) AS delay_ratio,
  round(coalesce(std, 0), 9) AS speed_variance, gps_accuracy_mean, gps_accuracy_std
FROM (SELECT driver_id, max(std) AS std, CASE WHEN count(*) > 1
    THEN sum(CASE WHEN x > mean + 2 * std THEN 1 ELSE 0 END) / count(*) ELSE 0 END AS delay_ratio
  FROM (SELECT driver_id, actual_delivery_minutes AS x, avg(actual_delivery_minutes) OVER w AS mean,
    stddev_samp(actual_delivery_minutes) OVER w AS std FROM orders_l WINDOW w AS (PARTITION BY driver_id)) GROUP BY driver_id) r
LEFT JOIN drivers d ON r.driver_id = d.driver_id LEFT JOIN ({GPS_QUALITY}) g ON r.driver_id = g.driver_id"""


def history_sql(days: int) -> str:
    return f"""SELECT a.order_id, a.driver_id, a.created_at, count(b.order_id) AS historical_orders_count,
  round(CAST(sum(CASE WHEN b.actual_delivery_minutes - b.expected_delivery_minutes <= 5 THEN 1
    WHEN b.order_id IS NOT NULL THEN 0 END) AS DOUBLE) / count(b.order_id), 6) AS historical_on_time_ratio
FROM orders_l a LEFT JOIN orders_l b ON a.driver_id = b.driver_id AND b.created_at < a.created_at
  AND b.created_at >= a.created_at - INTERVAL {days} DAY GROUP BY a.order_id, a.driver_id, a.created_at"""


@query("delay_features", DELAY_FEATURES)
def delay_features(v: Views):
    return rounded(features.delay_features(v["orders_l"], v["drivers"]))


@query("eta_features", ETA_FEATURES)
def eta_features(v: Views):
    return rounded(features.eta_features(v["orders_l"], v["drivers"]))


@query("driver_risk_features", RISK_FEATURES)
def driver_risk_features(v: Views):
    return rounded(features.driver_risk_features(v["orders_l"], v["drivers"], silver.gps_events(v["gps_bronze"])), 9)


def _history(v: Views, days: int):
    orders = v["orders_l"].select(
        "order_id", "driver_id", "created_at", "actual_delivery_minutes", "expected_delivery_minutes"
    )
    return rounded(history.trailing_history(orders, days)).drop("actual_delivery_minutes", "expected_delivery_minutes")


@query("pit_history", history_sql(90))
def pit_history(v: Views):
    return _history(v, 90)


@query("pit_history_7d", history_sql(7))
def pit_history_7d(v: Views):
    return _history(v, 7)


PIT_WEATHER = """SELECT o.order_id, o.region, CAST(least(10, coalesce(2 * max(severity), 0)) AS INT) AS weather_impact_score
FROM (SELECT order_id, created_at, region FROM orders_l o LEFT JOIN drivers d ON o.driver_id = d.driver_id) o
LEFT JOIN weather w ON w.affected_region = o.region AND w.start_time <= o.created_at AND w.end_time > o.created_at
GROUP BY o.order_id, o.region"""


@query("pit_weather", PIT_WEATHER)
def pit_weather(v: Views):
    orders = v["orders_l"].select("order_id", "driver_id", "created_at")
    return weather.weather_at_creation(orders, v["drivers"], v["weather"]).drop("driver_id", "created_at")


@query(
    "pit_violations",
    """SELECT count(*) AS sources_checked, CAST(count_if(event_timestamp >= created_at) AS BIGINT) AS violations,
  count_if(event_timestamp >= created_at) = 0 AS is_valid FROM gps_bronze g JOIN orders_l o ON g.order_id = o.order_id""",
)
def pit_violations(v: Views):
    """GPS events taken as sources of their order's features: those not older than the order leak."""
    return history.leak_check(v["orders_l"], v["gps_bronze"], "order_id", "created_at", "event_timestamp")


@query("gps_quality", GPS_QUALITY)
def gps_quality(v: Views):
    return rounded(features.gps_quality(silver.gps_events(v["gps_bronze"])), 9)


LEGS = f"""(SELECT driver_id, order_id, km / CASE WHEN hours > 0 THEN hours END AS speed FROM (
  SELECT driver_id, order_id, {km_sql('lat0', 'lon0', 'latitude', 'longitude')} AS km,
    (epoch_us(event_timestamp) - epoch_us(ts0)) / CAST(3600000000 AS DOUBLE) AS hours
  FROM (SELECT *, lag(latitude) OVER w AS lat0, lag(longitude) OVER w AS lon0, lag(event_timestamp) OVER w AS ts0
    FROM gps_tracks WINDOW w AS (PARTITION BY driver_id, order_id ORDER BY event_timestamp, event_id))))"""


@query(
    "gps_speed_profile",
    f"""SELECT driver_id, order_id, count(speed) AS legs, round(avg(speed), 6) AS speed_mean_kmh,
  round(stddev_samp(speed), 6) AS speed_std_kmh, round(max(speed), 6) AS speed_max_kmh FROM {LEGS} GROUP BY ALL""",
)
def gps_speed_profile(v: Views):
    return rounded(tracks.speed_profile(v["gps_tracks"], ["driver_id", "order_id"]))


@query(
    "route_deviation",
    f"""SELECT event_id, order_id, round(share, 6) AS route_share, round({km_sql(
        '(pickup_lat + (delivery_lat - pickup_lat) * share)', '(pickup_lon + (delivery_lon - pickup_lon) * share)',
        'latitude', 'longitude')}, 6) AS deviation_km
FROM (SELECT g.*, pickup_lat, pickup_lon, delivery_lat, delivery_lon, CASE WHEN actual_delivery_minutes > 0 THEN
    greatest(0.0, least(1.0, (epoch_us(event_timestamp) - epoch_us(created_at))
      / (actual_delivery_minutes * CAST(60000000 AS DOUBLE)))) END AS share
  FROM gps_tracks g LEFT JOIN orders_l o ON g.order_id = o.order_id)""",
)
def route_deviation(v: Views):
    return rounded(tracks.route_deviation(v["gps_tracks"], v["orders_l"])).select(
        "event_id", "order_id", "route_share", "deviation_km"
    )


@query(
    "feature_summaries",
    f"""SELECT 'delay_model_features_v1' AS dataset, count(*) AS feature_rows, 13 AS feature_columns,
  round(avg(delay_flag), 6) AS positive_target_ratio, count(DISTINCT driver_id) AS unique_drivers FROM ({DELAY_FEATURES})
UNION ALL SELECT 'eta_model_features_v1', count(*), 11, NULL, count(DISTINCT driver_id) FROM ({ETA_FEATURES})
UNION ALL SELECT 'driver_risk_features_v1', count(*), 7, NULL, count(DISTINCT driver_id) FROM ({RISK_FEATURES})""",
)
def feature_summaries(v: Views):
    delay = features.delay_features(v["orders_l"], v["drivers"])
    eta = features.eta_features(v["orders_l"], v["drivers"])
    risk = features.driver_risk_features(v["orders_l"], v["drivers"], silver.gps_events(v["gps_bronze"]))
    return rounded(
        features.feature_summary("delay_model_features_v1", delay, "delay_flag")
        .unionAll(features.feature_summary("eta_model_features_v1", eta))
        .unionAll(features.feature_summary("driver_risk_features_v1", risk))
    )


@query(
    "dataset_fingerprint",
    """SELECT n AS n_rows, 13 AS n_columns, substr(sha256(n || '_13_' || n), 1, 16) AS dataset_hash
FROM (SELECT count(*) AS n FROM orders_l)""",
)
def dataset_fingerprint(v: Views):
    return digests.dataset_fingerprint(features.delay_features(v["orders_l"], v["drivers"]))


@query(
    "dataset_content_hash",
    """SELECT count(*) AS n_rows, CAST(sum(CAST(CAST('0x' || substr(md5(list_aggregate(list_transform([CAST(accident_history AS VARCHAR),
    CAST(CAST(round(accident_risk, 6) AS DECIMAL(38, 6)) AS VARCHAR), CAST(driver_id AS VARCHAR), CAST(experience_years AS VARCHAR),
    region, vehicle_type, CAST(CAST(round(weather_sensitivity, 6) AS DECIMAL(38, 6)) AS VARCHAR)],
    lambda x: coalesce(length(x) || ':' || x, 'null')), 'string_agg', '|')), 1, 15) AS BIGINT) AS HUGEINT))
  AS VARCHAR) AS content_hash FROM drivers""",
)
def dataset_content_hash(v: Views):
    return digests.content_hash(v["drivers"])


@query(
    "row_signature",
    """SELECT driver_id, sha256('{"accident_history": ' || accident_history || ', "driver_id": ' || driver_id
  || ', "experience_years": ' || experience_years || ', "region": "' || region || '", "vehicle_type": "' || vehicle_type || '"}')
  AS signature FROM drivers""",
)
def row_signature(v: Views):
    names = ["driver_id", "vehicle_type", "experience_years", "accident_history", "region"]
    return v["drivers"].select("driver_id", digests.row_signature(v["drivers"], names).alias("signature"))


# quality ------------------------------------------------------------------------------------
ROW_COUNT = """SELECT 'row_count' AS "check", 'orders' AS stage, 'PASS' AS status, CAST(count(*) AS DOUBLE) AS metric_value,
  CAST(NULL AS DOUBLE) AS threshold, CAST(NULL AS VARCHAR) AS message FROM orders_l
UNION ALL SELECT 'row_count', 'drivers', 'FAIL', count(*), NULL, 'Row count ' || count(*) || ' below minimum 1000000' FROM drivers
UNION ALL SELECT 'row_count', 'weather', 'FAIL', count(*), NULL, 'Row count ' || count(*) || ' above maximum 1' FROM weather"""


def _row_counts(v: Views):
    return quality.report(
        [
            quality.row_count(v["orders_l"], "orders", at_least=1),
            quality.row_count(v["drivers"], "drivers", at_least=1_000_000),
            quality.row_count(v["weather"], "weather", at_most=1),
        ]
    )


@query("dq_row_count", ROW_COUNT)
def dq_row_count(v: Views):
    return _row_counts(v)


GPS_EXPECTED = {
    "event_id": "bigint", "order_id": "bigint", "driver_id": "bigint", "latitude": "double", "longitude": "double",
    "accuracy": "double", "event_timestamp": "timestamp", "altitude": "double",
}


def schema_row(name: str, expected: str | None, actual: str | None, state: str) -> str:
    text = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
    nulls = f"count(*) - count({name})" if actual else "nullif(count(*), count(*))"
    return f"""SELECT '{name}' AS "column", {text(expected)} AS expected, {text(actual)} AS actual, '{state}' AS state,
  {nulls} AS null_count FROM gps_bronze"""


@query(
    "dq_schema",
    "\nUNION ALL ".join(
        [schema_row(c, k, None if c == "altitude" else k, "missing" if c == "altitude" else "ok") for c, k in GPS_EXPECTED.items()]
        + [schema_row("ingestion_timestamp", None, "timestamp", "unexpected")]
    ),
)
def dq_schema(v: Views):
    """Column states with the nulls found in each column."""
    states = quality.schema_columns(v["gps_bronze"], GPS_EXPECTED, check_types=True)
    return states.join(quality.null_profile(v["gps_bronze"]).select("column", "null_count"), "column", "left")


def null_row(name: str) -> str:
    return f"""SELECT '{name}' AS "column", count(*) - count({name}) AS null_count,
  round((count(*) - count({name})) / count(*), 4) AS null_pct, (count(*) - count({name})) / count(*) > 0.005 AS is_violation FROM orders_l"""


@query(
    "dq_null_profile",
    "\nUNION ALL ".join(
        null_row(c)
        for c in ["order_id", "driver_id", "order_type", "created_at", "pickup_lat", "pickup_lon", "delivery_lat",
                  "delivery_lon", "expected_delivery_minutes", "actual_delivery_minutes"]
    ),
)
def dq_null_profile(v: Views):
    return quality.null_profile(v["orders_l"], threshold=0.005)


def ks_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", round(max(abs(c / nc - b / nb)), 6) AS ks_statistic,
  (SELECT round(avg({name}), 6) FROM drift_sample WHERE NOT is_current) AS baseline_mean,
  (SELECT round(avg({name}), 6) FROM drift_sample WHERE is_current) AS current_mean,
  (SELECT round(stddev_samp({name}), 6) FROM drift_sample WHERE NOT is_current) AS baseline_std,
  (SELECT round(stddev_samp({name}), 6) FROM drift_sample WHERE is_current) AS current_std
FROM (SELECT sum(CAST(is_current AS INT)) OVER w AS c, sum(CAST(NOT is_current AS INT)) OVER w AS b,
    sum(CAST(is_current AS INT)) OVER () AS nc, sum(CAST(NOT is_current AS INT)) OVER () AS nb
  FROM drift_sample WHERE {name} IS NOT NULL WINDOW w AS (ORDER BY {name} RANGE UNBOUNDED PRECEDING))"""


def exact_ks_sql(name: str) -> str:
    """The statistic with all its digits, for what is computed from it."""
    return ks_sql(name).replace("round(max(abs(c / nc - b / nb)), 6)", "max(abs(c / nc - b / nb))")


def _drift(v: Views):
    sample = v["drift_sample"]
    return drift.feature_drift(
        sample.where("is_current"), sample.where("NOT is_current"), ["value", "value_shifted"], "features"
    )


@query("dq_drift", ks_sql("value") + "\nUNION ALL " + ks_sql("value_shifted"))
def dq_drift(v: Views):
    """The p-value is compared with its definition in the tests."""
    return rounded(_drift(v)).select(
        "column", "ks_statistic", "baseline_mean", "current_mean", "baseline_std", "current_std"
    )


# the Kolmogorov series, from the statistic of the exact samples
DECISION = """SELECT "column", round(ks_statistic, 6) AS ks_statistic, round(CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(least(
    list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * lam * lam))), 1.0), 0.0) END, 6) AS p_value
FROM (SELECT *, (sqrt(n1 * n2 / (n1 + n2)) + 0.12 + 0.11 / sqrt(n1 * n2 / (n1 + n2))) * ks_statistic AS lam FROM ({ks}) AS s,
  (SELECT CAST(count_if(NOT is_current) AS DOUBLE) AS n1, CAST(count_if(is_current) AS DOUBLE) AS n2 FROM drift_sample WHERE value IS NOT NULL AND NOT isnan(value)) AS n)"""


@query(
    "dq_drift_decision",
    "SELECT *, p_value < 0.05 AS is_drifted FROM (" + DECISION.format(ks=exact_ks_sql("value")) + "\nUNION ALL " + DECISION.format(ks=exact_ks_sql("value_shifted")) + ") AS d",
)
def dq_drift_decision(v: Views):
    """The probability of the distance and what follows from it."""
    return rounded(_drift(v).select("column", "ks_statistic", "p_value", "is_drifted"))


@query(
    "dq_stored_drift",
    """SELECT c AS "column", true AS near, true AS agrees, count_if(NOT is_current)::BIGINT AS baseline_rows, count_if(is_current)::BIGINT AS current_rows
FROM drift_sample, (VALUES ('value'), ('value_shifted')) AS v(c) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY c""",
)
def dq_stored_drift(v: Views):
    """Drift from the distributions that two snapshots have stored, against the rows: `near` says that the distance is within its error,
    `agrees` that the decision is the same, or the rows' own distance within that error of the critical one."""
    columns = ["value", "value_shifted"]
    sample = v["drift_sample"]
    stored = materialize(sketches.distribution(sample.where("NOT is_current"), columns), "stored-distribution")
    told = sketches.stored_drift(sketches.distribution(sample.where("is_current"), columns), stored)
    exact = _drift(v).select("column", F.col("ks_statistic").alias("exact"), F.col("is_drifted").alias("drifted"))
    near = F.abs(F.col("ks_statistic") - F.col("exact")) <= sketches.DISTANCE_ERROR
    close = F.abs(F.col("exact") - sketches.critical_distance("baseline_rows", "current_rows")) <= sketches.DISTANCE_ERROR
    agrees = (F.col("is_drifted") == F.col("drifted")) | close
    return told.join(exact, "column").select("column", near.alias("near"), agrees.alias("agrees"), "baseline_rows", "current_rows")


@query(
    "region_daily_sketched",
    f"""SELECT {region_sql('latitude', 'longitude')} AS region, CAST(event_timestamp AS DATE) AS metric_date, count(event_id) AS gps_events_count, true AS near
FROM gps_bronze GROUP BY ALL""",
)
def region_daily_sketched(v: Views):
    """Region days merged from stored hourly sketches; `near` says that the drivers are within three standard errors of the exact number."""
    gps = v["gps_bronze"]
    hours = materialize(sketches.region_hour_sketches(gps), "hour-sketches")
    exact = gps.groupBy(assign_region("latitude", "longitude").alias("region"), F.to_date("event_timestamp").alias("metric_date")).agg(F.count_distinct("driver_id").alias("exact"))
    off = F.abs(F.col("active_drivers") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * sketches.distinct_error() * F.col("exact"))
    days = sketches.daily_drivers(hours).join(exact, ["region", "metric_date"])
    return days.select("region", "metric_date", "gps_events_count", off.alias("near"))


LATE = f"""SELECT CAST(count_if(coalesce(event_timestamp > ended, false)) AS BIGINT) AS late_count, count(*) AS total_events,
  round(count_if(coalesce(event_timestamp > ended, false)) / count(*), 6) AS late_ratio
FROM {DEDUP} g LEFT JOIN (SELECT order_id, {ENDED} AS ended FROM orders_l) o ON g.order_id = o.order_id"""


@query("dq_late_ratio", LATE)
def dq_late_ratio(v: Views):
    return rounded(quality.late_arrivals(silver.gps_events(v["gps_bronze"]), v["orders_l"]))


NOW = "2024-02-01 00:00:00"
FRESH = f"""SELECT 'data_freshness' AS "check", 'silver_gps_events' AS stage,
  CASE WHEN age <= 24 THEN 'PASS' ELSE 'WARN' END AS status, round(age, 6) AS metric_value, CAST(24 AS DOUBLE) AS threshold,
  strftime(t, '%Y-%m-%dT%H:%M:%S.%f') AS message
FROM (SELECT max(event_timestamp) AS t, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(max(event_timestamp))) / CAST(3600000000 AS DOUBLE) AS age
  FROM gps_bronze)"""


@query("dq_freshness", FRESH)
def dq_freshness(v: Views):
    return rounded(quality.freshness(v["gps_bronze"], "event_timestamp", "silver_gps_events", NOW))


SUMMARY = f"""SELECT count(*) AS total_checks, CAST(count_if(status = 'PASS') AS BIGINT) AS passed,
  CAST(count_if(status = 'WARN') AS BIGINT) AS warned, CAST(count_if(status = 'FAIL') AS BIGINT) AS failed,
  CASE WHEN count_if(status = 'FAIL') > 0 THEN 'FAIL' WHEN count_if(status = 'WARN') > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status
FROM (SELECT status FROM ({ROW_COUNT}) UNION ALL SELECT status FROM ({FRESH})
  UNION ALL SELECT CASE WHEN late_ratio <= 0.15 THEN 'PASS' ELSE 'WARN' END FROM ({LATE})
  UNION ALL SELECT CASE WHEN count(*) > count(actual_delivery_minutes) * 1.0526315 THEN 'FAIL' ELSE 'PASS' END FROM orders_l)"""


@query("dq_summary", SUMMARY)
def dq_summary(v: Views):
    checks = quality.report(
        [
            _row_counts(v),
            quality.freshness(v["gps_bronze"], "event_timestamp", "silver_gps_events", NOW),
            quality.late_arrival_ratio(silver.gps_events(v["gps_bronze"]), v["orders_l"]),
            quality.null_percentage(v["orders_l"], "orders"),
        ]
    )
    return quality.summary(checks)


STEPS = [("bronze_gps_events", "silver_gps_events"), ("silver_gps_events", "gold_region_hourly"), ("bronze_gps_events", "unknown")]


@query(
    "row_count_lineage",
    f"""WITH c AS (SELECT 'bronze_gps_events' AS stage, (SELECT count(*) FROM gps_bronze) AS n
  UNION ALL SELECT 'silver_gps_events', (SELECT count(*) FROM {DEDUP})
  UNION ALL SELECT 'gold_region_hourly', (SELECT count(*) FROM ({HOURLY}))),
s AS (SELECT 'bronze_gps_events' AS a, 'silver_gps_events' AS b UNION ALL SELECT 'silver_gps_events', 'gold_region_hourly'
  UNION ALL SELECT 'bronze_gps_events', 'unknown')
SELECT a AS source_stage, b AS target_stage, x.n AS source_rows, y.n AS target_rows,
  round(abs(y.n - x.n) / greatest(x.n, 1), 6) AS variance, coalesce(abs(y.n - x.n) / greatest(x.n, 1) <= 0.1, false) AS is_valid
FROM s LEFT JOIN c x ON s.a = x.stage LEFT JOIN c y ON s.b = y.stage""",
)
def row_count_lineage(v: Views):
    gps = silver.gps_events(v["gps_bronze"])
    counts = quality.stage_counts(
        {"bronze_gps_events": v["gps_bronze"], "silver_gps_events": gps, "gold_region_hourly": gold.region_hourly(gps)}
    )
    return rounded(quality.lineage(counts, STEPS))




EDITED = """SELECT event_id, order_id, driver_id, event_timestamp, CASE WHEN order_id % 1777 = 5 THEN accuracy + 1 ELSE accuracy END AS accuracy
FROM gps_bronze WHERE event_timestamp < TIMESTAMP '2024-01-27' AND order_id % 2503 <> 1"""
TAKEN = "SELECT event_id, order_id, driver_id, event_timestamp, accuracy FROM gps_bronze WHERE event_timestamp >= TIMESTAMP '2024-01-03'"


@query(
    "snapshot_changed_days",
    f"""WITH a AS ({TAKEN}), b AS ({EDITED}),
differ AS (SELECT DISTINCT CAST(event_timestamp AS DATE) AS d FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)))
SELECT strftime(d, '%Y-%m-%d') AS label, CASE WHEN x.n IS NULL THEN 'added' WHEN y.n IS NULL THEN 'removed' ELSE 'changed' END AS change,
  x.n AS rows_before, y.n AS rows_after FROM differ
LEFT JOIN (SELECT CAST(event_timestamp AS DATE) AS d, count(*) AS n FROM a GROUP BY 1) x USING (d)
LEFT JOIN (SELECT CAST(event_timestamp AS DATE) AS d, count(*) AS n FROM b GROUP BY 1) y USING (d)""",
)
def snapshot_changed_days(v: Views):
    """Days in which two snapshots differ, found from their digest trees alone."""
    gps = v["gps_bronze"]
    columns = ["event_id", "order_id", "driver_id", "event_timestamp", "accuracy"]
    taken = gps.where("event_timestamp >= TIMESTAMP '2024-01-03'").select(*columns)
    edited = gps.where("event_timestamp < TIMESTAMP '2024-01-27' AND order_id % 2503 <> 1")
    edited = edited.withColumn("accuracy", F.expr("CASE WHEN order_id % 1777 = 5 THEN accuracy + 1 ELSE accuracy END")).select(*columns)
    trees = [materialize(digests.digest_tree(t, "event_timestamp"), "digest-tree") for t in (taken, edited)]
    return digests.changed_days(*trees)
