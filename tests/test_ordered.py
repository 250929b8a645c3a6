"""Sliced ordered operators against brute force, with one key holding most rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from waybill.operators import ordered
from waybill.operators.history import COUNT, RATIO, leak_check, trailing_history
from waybill.operators.ordered import neighbour, running_before, with_slices
from waybill.operators.weather import SCORE, delivery_weather, weather_at_creation


def skewed_rows(n=400, seed=1, low=-500, high=2000):
    rnd = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b"]
    return [(i, rnd.choice(keys), rnd.randint(low, high), rnd.choice([None, *range(5)])) for i in range(n)]


@pytest.fixture(params=["plain slices", "busy slices cut again"])
def splitting(request, monkeypatch):
    if request.param != "plain slices":
        monkeypatch.setattr(ordered, "PART_ROWS", 3)


@pytest.mark.parametrize("width", [1, 100, 10_000])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_before(spark, width, inclusive, splitting):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "id int, k string, t long, v int")
    got = {
        r.id: (r.total, r.top)
        for r in running_before(df, ["k"], "t", {"total": ("sum", "v"), "top": ("max", "v")}, width=width, inclusive=inclusive).collect()
    }
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        seen = [v for _, k2, t2, v in rows if k2 == k and v is not None and (t2 < t or (inclusive and t2 == t))]
        assert got[i] == ((sum(seen), max(seen)) if seen else (None, None))


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("width", [3, 150, 100_000])
def test_neighbour(spark, following, width, splitting):
    rows = skewed_rows(seed=2)
    df = spark.createDataFrame(rows, "id int, k string, t long, v int")
    near = neighbour(df, ["k"], ["t", "id"], F.col("t"), width, {"near_id": "id", "near_v": "v"}, following)
    got = {r.id: (r.near_id, r.near_v) for r in near.collect()}
    assert len(got) == len(rows)
    for key in {r[1] for r in rows}:
        ordered = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2], r[0]), reverse=following)
        for before, row in zip([None, *ordered], ordered):
            assert got[row[0]] == ((before[0], before[3]) if before else (None, None))


START = datetime(2024, 1, 1)
ORDER = "order_id int, driver_id string, created_at timestamp, actual_delivery_minutes int, expected_delivery_minutes int"


def test_history_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [
        (i, rnd.choice(["hot"] * 5 + ["x", None]), START + timedelta(hours=rnd.randint(0, 500)) if i % 40 else None,
         rnd.choice([None, 10, 15, 16, 30]), 10)
        for i in range(300)
    ]
    got = {r.order_id: (r[COUNT], r[RATIO]) for r in trailing_history(spark.createDataFrame(rows, ORDER), days=5).collect()}
    assert len(got) == len(rows)
    for i, driver, at, _, _ in rows:
        past = [
            r for r in rows
            if driver is not None and at is not None and r[1] == driver and r[2] is not None
            and at - timedelta(days=5) <= r[2] < at
        ]
        ratio = sum(r[3] is not None and r[3] - r[4] <= 5 for r in past) / len(past) if past else None
        assert got[i] == (len(past), pytest.approx(ratio) if past else None)


def test_parts_bound_a_hot_hour(spark, monkeypatch):
    """A third of the rows in one hour of one key: no part keeps them together, and no carry window is long."""
    monkeypatch.setattr(ordered, "PART_ROWS", 100)
    hour = 3_600_000_000
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.when(F.col("id") % 3 == 0, 5 * hour + F.col("id") * 1_000_000).otherwise(F.col("id") * hour).alias("t"),
    )
    sliced = ordered.with_slices(df, ["k"], F.col("t"), hour)
    assert sliced.groupBy("k", ordered.SLICE, ordered.PART).count().agg(F.max("count")).first()[0] <= 100
    parts = sliced.groupBy("k", ordered.SLICE).agg(F.count_distinct(ordered.PART).alias("n"))
    assert parts.agg(F.max("n")).first()[0] <= 4 * 1000 / 100 + 1
    assert sliced.where(F.col(ordered.SLICE) > F.col("t")).count() == 0


def test_one_key_with_all_rows(spark, monkeypatch):
    """Windows over summaries see as many rows as a slice has parts, or a key has slices, whatever the rows."""
    monkeypatch.setattr(ordered, "PART_ROWS", 50)
    df = spark.range(4000).select(F.lit("k").alias("k"), (F.col("id") * 7919 % 4000).alias("t"), F.lit(1).alias("one"))
    out = ordered.running_before(df, ["k"], "t", {"n": ("sum", "one")}, width=1000)
    assert out.where(F.coalesce("n", F.lit(0)) != F.col("t")).count() == 0
    parts = ordered.with_slices(df, ["k"], F.col("t"), 1000).select(ordered.SLICE, ordered.PART).distinct()
    assert parts.groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0] <= 81


def test_history_boundaries(spark):
    day90 = timedelta(days=90)
    micro = timedelta(microseconds=1)
    rows = [
        (1, "d", START, 10, 10),
        (2, "d", START + day90, 10, 10),            # exactly 90 days later: sees order 1
        (3, "d", START + day90, 10, 10),            # same time as order 2: they do not see each other
        (4, "e", START, 10, 10),
        (5, "e", START + day90 + micro, 10, 10),    # one microsecond too late
    ]
    got = {r.order_id: r[COUNT] for r in trailing_history(spark.createDataFrame(rows, ORDER)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}


def test_leak_check(spark):
    features = spark.createDataFrame([(1, START), (2, START)], "order_id int, as_of timestamp")
    sources = spark.createDataFrame(
        [(1, START - timedelta(hours=1)), (1, START), (2, START - timedelta(seconds=1)), (9, START)],
        "order_id int, at timestamp",
    )
    row = leak_check(features, sources, "order_id", "as_of", "at").first()
    assert (row.sources_checked, row.violations, row.is_valid) == (3, 1, False)


@pytest.mark.parametrize("pit", [False, True])
def test_weather_against_brute_force(spark, pit):
    rnd = random.Random(4)
    regions = ["North"] * 5 + ["South", None]
    drivers = [(f"d{i}", regions[i]) for i in range(7)]
    weather = [
        (i, rnd.randint(-1, 7), START + timedelta(minutes=rnd.randint(0, 3000)), rnd.choice(["North", "South", None]))
        for i in range(60)
    ]
    weather = [(i, s, a, a + timedelta(minutes=rnd.randint(0, 200)), r) for i, s, a, r in weather]
    orders = [
        (i, rnd.choice([f"d{k}" for k in range(8)]), START + timedelta(minutes=rnd.randint(0, 3000)),
         rnd.choice([None, -5, 0, 1, 30, 120]), 30)
        for i in range(200)
    ]
    w = spark.createDataFrame(weather, "weather_event_id int, severity int, start_time timestamp, end_time timestamp, affected_region string")
    d = spark.createDataFrame(drivers, "driver_id string, region string")
    o = spark.createDataFrame(orders, ORDER)
    got = {r.order_id: r[SCORE] for r in (weather_at_creation if pit else delivery_weather)(o, d, w).collect()}
    assert len(got) == len(orders)
    region_of = dict(drivers)
    for i, driver, at, minutes, _ in orders:
        region = region_of.get(driver)
        hits = [0]
        for _, severity, begin, end, where in weather:
            if region is None or where != region:
                continue
            if pit:
                hit = begin <= at < end
            else:
                hit = minutes is not None and minutes > 0 and begin < at + timedelta(minutes=minutes) and end > at
            if hit:
                hits.append(min(10, 2 * max(severity, 0)))
        assert got[i] == max(hits), (i, region)


def test_rows_are_not_sorted_to_find_their_parts(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS t", "id", "id AS v")
    near = neighbour(df, ["k"], ["t", "id"], F.col("t"), 100, {"near_v": "v"})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")  # the counts of all slices are larger, those of busy ones are few
    try:
        joins = with_slices(df, ["k"], F.col("t"), 100)._jdf.queryExecution().executedPlan().toString()
        union = near._jdf.queryExecution().optimizedPlan().toString().split("Union")[1].split("Join")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in joins and "SortMergeJoin" not in joins
    assert "struct" not in union  # values travel in their own columns only
