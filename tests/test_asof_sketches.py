import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill.operators import asof, drift, ordered, scd, sketches

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def brute(left, right, inclusive):
    out = []
    for i, key, ts in left:
        before = [r for r in right if key is not None and ts is not None and r[0] == key and r[1] is not None and (r[1] <= ts if inclusive else r[1] < ts)]
        best = max(before, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]), default=(None,) * 4)
        out.append((i, key, ts, best[2], best[3]))
    return sorted(out, key=str)


@pytest.mark.parametrize("part_rows", [5, 100_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_as_of_against_brute_force(spark, monkeypatch, part_rows, inclusive):
    monkeypatch.setattr(ordered, "PART_ROWS", part_rows)  # slices cut into many parts, and none
    r = random.Random(part_rows)
    key = lambda: r.choice(["hot", "hot", "a", "b", None])
    left = [(i, key(), r.choice([None, at(r.randrange(4000))]) if r.random() < 0.1 else at(r.randrange(4000))) for i in range(200)]
    right = [(key(), r.choice([at(r.randrange(4000)), at(700), at(700), None]), r.choice([None, 1, 2, 3]), r.choice(["x", "y"])) for _ in range(150)]
    got = asof.as_of(
        spark.createDataFrame(left, "id int, k string, t timestamp"), spark.createDataFrame(right, "k string, since timestamp, v int, w string"),
        "k", "t", "since", ["v", "w"], inclusive=inclusive,
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right, inclusive)


def test_as_of_edges(spark):
    left = spark.createDataFrame([(1, "a", at(0))], "id int, k string, t timestamp")
    right = spark.createDataFrame([], "k string, since timestamp, v int")
    assert [tuple(r) for r in asof.as_of(left, right, "k", "t", "since", ["v"]).collect()] == [(1, "a", at(0), None)]
    assert asof.as_of(left.limit(0), right, "k", "t", "since", ["v"]).count() == 0
    with pytest.raises(ValueError):
        asof.as_of(left, left, "k", "t", "t", ["id"])


def test_version_at_order_time_after_upserts(spark):
    dims = scd.build_history(spark.createDataFrame([("a", "van", at(0)), ("a", "bike", at(100)), ("b", "car", at(0))], "k string, v string, t timestamp"), "k", ["v"], "t")
    dims = scd.upsert(dims, spark.createDataFrame([("a", "car", at(50)), ("c", "van", at(10))], "k string, v string, t timestamp"), "k", ["v"], "t")
    facts = spark.createDataFrame([(1, "a", at(49)), (2, "a", at(50)), (3, "a", at(100)), (4, "b", at(-1)), (5, "c", at(10))], "id int, k string, at timestamp")
    got = {r.id: r.v for r in scd.valid_at(facts, dims, "k", "at", ["v"]).collect()}
    assert got == {1: "van", 2: "car", 3: "bike", 4: None, 5: "van"}
    assert {(r.k, r.v, r.is_current) for r in dims.where("k <> 'a'").collect()} == {("b", "car", True), ("c", "van", True)}


def test_sketches_merge_to_days(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("event_id"), (F.col("id") % 3001).alias("driver_id"), F.lit(40.8).alias("latitude"), F.lit(-74.0).alias("longitude"),
        F.timestamp_seconds(1704067200 + F.col("id") * 3).alias("event_timestamp"),
    )
    hours = sketches.region_hour_sketches(rows)
    exact = {r.d: r.n for r in rows.groupBy(F.to_date("event_timestamp").alias("d")).agg(F.count_distinct("driver_id").alias("n")).collect()}
    days = {r.metric_date: r for r in sketches.daily_drivers(hours).collect()}
    assert days.keys() == exact.keys() and all(abs(days[d].active_drivers - n) <= 3 * sketches.distinct_error() * n for d, n in exact.items())
    assert sum(r.gps_events_count for r in days.values()) == 40_000 and hours.count() == 34
    whole = sketches.merged(hours, []).first()
    assert abs(whole.active_drivers - 3001) <= 3 * sketches.distinct_error() * 3001


def test_stored_distributions_decide_as_the_rows_do(spark, tmp_path):
    base = spark.range(6000).select((F.col("id") * 7919 % 6000 / 6.0).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 90 / 1.0).alias("b"), F.lit(float("nan")).alias("none"))
    now = base.select((F.col("a") * 1.2).alias("a"), "b", "none")
    sketches.distribution(base, ["a", "b", "none"]).write.parquet(str(tmp_path / "stored"))  # all that is kept of the baseline
    stored = spark.read.parquet(str(tmp_path / "stored"))
    got = {r.column: r for r in sketches.stored_drift(sketches.distribution(now, ["a", "b", "none"]), stored).collect()}
    exact = {r.column: r for r in drift.feature_drift(now, base, ["a", "b"], "t").collect()}
    assert got.keys() == {"a", "b"}
    for c in got:
        assert abs(got[c].ks_statistic - exact[c].ks_statistic) <= sketches.DISTANCE_ERROR and got[c].is_drifted == exact[c].is_drifted
        assert got[c].baseline_mean == pytest.approx(exact[c].baseline_mean) and got[c].current_std == pytest.approx(exact[c].current_std)
