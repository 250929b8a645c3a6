import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill.operators import drift, quality

STAGE = "bronze_test"


@pytest.fixture(scope="module")
def sample(spark):
    rows = [(i, None if i == 3 else 10.0 * i, datetime(2024, 1, i)) for i in range(1, 6)]
    return spark.createDataFrame(rows, "id int, value double, timestamp timestamp").cache()


@pytest.mark.parametrize(
    "low, high, status, message",
    [
        (4, 6, "PASS", None), (5, 5, "PASS", None), (None, None, "PASS", None),
        (10, None, "FAIL", "Row count 5 below minimum 10"), (None, 3, "FAIL", "Row count 5 above maximum 3"),
        (10, 3, "FAIL", "Row count 5 above maximum 3"),
    ],
)
def test_row_count(sample, low, high, status, message):
    row = quality.row_count(sample, STAGE, low, high).first()
    assert (row.check, row.stage, row.status, row.metric_value, row.message) == ("row_count", STAGE, status, 5.0, message)


def test_schema(sample):
    ok = {"id": "int", "value": "double", "timestamp": "timestamp"}
    assert quality.schema(sample, ok, STAGE).first().status == "PASS"
    missing = quality.schema(sample, {"id": "int", "absent": "int"}, STAGE).first()
    assert missing.status == "FAIL"
    assert missing.message == "missing: absent; wrong type: ; unexpected: timestamp,value"
    wrong = {**ok, "id": "string"}
    assert quality.schema(sample, wrong, STAGE).first().status == "PASS"
    assert quality.schema(sample, wrong, STAGE, check_types=True).first().status == "FAIL"


def test_null_percentage(sample):
    profile = {r["column"]: r for r in quality.null_profile(sample).collect()}
    assert (profile["value"].null_count, profile["value"].null_pct, profile["value"].is_violation) == (1, 0.2, True)
    assert quality.null_percentage(sample, STAGE, 0.5).first().status == "PASS"
    assert quality.null_percentage(sample, STAGE, 0.2).first().status == "PASS"
    failed = quality.null_percentage(sample, STAGE).first()
    assert (failed.status, failed.message) == ("FAIL", "value")
    assert quality.null_percentage(sample.limit(0), STAGE).first().status == "PASS"


def test_freshness(sample):
    fresh = quality.freshness(sample, "timestamp", STAGE, datetime(2024, 1, 6)).first()
    assert (fresh.status, fresh.metric_value) == ("PASS", 24.0)
    assert quality.freshness(sample, "timestamp", STAGE, datetime(2024, 1, 6, 0, 0, 1)).first().status == "WARN"
    assert quality.freshness(sample, "nothing", STAGE, datetime(2024, 1, 6)).first().status == "skipped"
    assert quality.freshness(sample.limit(0), "timestamp", STAGE, datetime(2024, 1, 6)).first().status == "skipped"


def test_late_ratio(spark, ts):
    orders = spark.createDataFrame([(1, ts(0), 10), (2, ts(0), None)], "order_id int, created_at timestamp, actual_delivery_minutes int")
    gps = spark.createDataFrame([(1, ts(11)), (1, ts(10)), (2, ts(99)), (7, ts(99))], "order_id int, event_timestamp timestamp")
    row = quality.late_arrivals(gps, orders).first()
    assert (row.late_count, row.total_events, row.late_ratio) == (1, 4, 0.25)
    assert quality.late_arrival_ratio(gps, orders).first().status == "WARN"
    assert quality.late_arrival_ratio(gps, orders, threshold=0.25).first().status == "PASS"
    assert quality.late_arrival_ratio(gps, orders, grace_minutes=15).first().status == "PASS"
    assert quality.late_arrival_ratio(gps.limit(0), orders).first().status == "skipped"
    assert quality.late_arrival_ratio(gps, orders.limit(0)).first().status == "skipped"


@pytest.mark.parametrize(
    "statuses, overall",
    [(["PASS", "PASS", "WARN"], "WARN"), (["PASS", "FAIL"], "FAIL"), (["PASS", "skipped"], "PASS"), ([], "PASS")],
)
def test_summary(spark, statuses, overall):
    row = quality.summary(spark.createDataFrame([(s,) for s in statuses], "status string")).first()
    assert (row.total_checks, row.overall_status) == (len(statuses), overall)
    assert row.passed == statuses.count("PASS") and row.warned == statuses.count("WARN")


def test_lineage(spark):
    counts = quality.stage_counts({"stage1": spark.range(1000), "stage2": spark.range(900)})
    steps = [("stage1", "stage2"), ("stage1", "other"), ("stage1", "stage1")]
    got = {(r.source_stage, r.target_stage): (r.variance, r.is_valid) for r in quality.lineage(counts, steps, 0.2).collect()}
    assert got[("stage1", "stage2")] == (0.1, True)
    assert got[("stage1", "other")] == (None, False)
    assert got[("stage1", "stage1")] == (0.0, True)
    strict = quality.lineage(counts, steps, 0.05).where("target_stage = 'stage2'").first()
    assert strict.is_valid is False
    assert quality.lineage(counts, steps, 0.1).where("target_stage = 'stage2'").first().is_valid is True


def ks_definition(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


@pytest.mark.parametrize("slices", [2, 16, 256])
def test_ks_statistic(spark, slices):
    rnd = random.Random(7)
    base = [(rnd.choice([0.0, 0.0, 0.0, rnd.gauss(0, 1)]), None if i % 9 == 0 else float(i % 13)) for i in range(300)]
    cur = [(rnd.choice([0.0, rnd.gauss(0.3, 2)]), float(i % 17)) for i in range(200)]
    schema = "x double, y double"
    stats = drift.ks_statistics(spark.createDataFrame(cur, schema), spark.createDataFrame(base, schema), ["x", "y", "absent"], slices)
    got = {r["column"]: r for r in stats.collect()}
    assert set(got) == {"x", "y"}
    for i, name in enumerate(["x", "y"]):
        a, b = [r[i] for r in cur if r[i] is not None], [r[i] for r in base if r[i] is not None]
        assert got[name].ks_statistic == pytest.approx(ks_definition(a, b))
        assert (got[name].current_rows, got[name].baseline_rows) == (len(a), len(b))
        assert got[name].baseline_mean == pytest.approx(sum(b) / len(b))


def test_ks_extremes_and_decisions(spark):
    low = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    high = spark.createDataFrame([(1000.0 + i,) for i in range(100)], "x double")
    same = drift.feature_drift(low, low, ["x"], STAGE).first()
    assert (same.ks_statistic, same.p_value, same.is_drifted, same.status) == (0.0, 1.0, False, "PASS")
    apart = drift.feature_drift(high, low, ["x"], STAGE)
    row = apart.first()
    assert row.ks_statistic == 1.0 and row.p_value < 1e-12 and row.is_drifted
    result = drift.drift_result(apart, STAGE, ["x"]).first()
    assert (result.check, result.status) == ("feature_drift", "WARN")
    assert drift.feature_drift(low.limit(0), low, ["x"], STAGE).count() == 0


def test_ks_probability_is_the_series(spark):
    for d, n1, n2 in [(0.1, 200, 300), (0.05, 1000, 1000), (0.3, 50, 60)]:
        en = math.sqrt(n1 * n2 / (n1 + n2))
        lam = (en + 0.12 + 0.11 / en) * d
        expected = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
        got = spark.range(1).select(drift.ks_probability(F.lit(d), F.lit(float(n1)), F.lit(float(n2))).alias("p")).first().p
        assert got == pytest.approx(expected, abs=1e-9)
