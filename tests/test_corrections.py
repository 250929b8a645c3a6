"""Inputs that the fixtures lack: nulls, ties, corrections at one instant, tables of equal size, separators in texts."""

import os
import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions import digests
from waybill.functions.timing import instant
from waybill.operators import dedup, drift, scd
from waybill.operators.contracts import REASON, accepted, tagged
from waybill.operators.weather import SCORE, delivery_weather
from waybill.plans import bronze
from waybill.schemas import DATASETS
from waybill.sources import readers

START = datetime(2024, 1, 1)


def test_unknown_severity_has_no_impact(spark):
    drivers = spark.createDataFrame([("d", "North")], "driver_id string, region string")
    weather = spark.createDataFrame([(1, None, START, START + timedelta(hours=9), "North")], "weather_event_id int, severity int, start_time timestamp, end_time timestamp, affected_region string")
    orders = spark.createDataFrame([(1, "d", START + timedelta(hours=1), 30, 30)], "order_id int, driver_id string, created_at timestamp, actual_delivery_minutes int, expected_delivery_minutes int")
    assert delivery_weather(orders, drivers, weather).first()[SCORE] == 0


def test_first_arrival_is_the_first_known_one(spark):
    rows = [(1, None, "late"), (1, START, "first"), (1, START + timedelta(1), "second"), (2, None, "only")]
    df = spark.createDataFrame(rows, "event_id int, ingestion_timestamp timestamp, v string")
    assert {(r.event_id, r.v) for r in dedup.first_arrival(df, "event_id", "ingestion_timestamp").collect()} == {(1, "first"), (2, "only")}


def test_a_null_key_is_merged_once(spark):
    df = spark.createDataFrame([(None, START), (1, START)], "event_id int, at timestamp")
    once = dedup.merge_first_arrivals(df.limit(0), df, "event_id", "at")
    assert dedup.merge_first_arrivals(once, df, "event_id", "at").count() == 2


def test_content_dedup_keeps_whole_rows(spark):
    rows = [(None, "a", 3.0, "x"), (5, "b", 2.0, "z"), (5, "b", 1.0, "y"), (None, "c", 9.0, "w"), (4, "c", 8.0, "v")]
    for seed in range(3):
        df = spark.createDataFrame(rows, "event_id int, place string, accuracy double, note string").orderBy(F.rand(seed))
        got = {tuple(r) for r in dedup.content_dedup(df, ["place"], "event_id").collect()}
        assert got == {(None, "a", 3.0, "x"), (5, "b", 1.0, "y"), (4, "c", 8.0, "v")}


def test_a_correction_at_the_instant_of_a_version_wins(spark):
    old = scd.build_history(spark.createDataFrame([(1, "van", START)], "id int, kind string, ts timestamp"), "id", ["kind"], "ts")
    new = scd.upsert(old, spark.createDataFrame([(1, "bike", START)], "id int, kind string, ts timestamp"), "id", ["kind"], "ts")
    assert [(r.kind, r.is_current) for r in new.collect()] == [("bike", True)]


def test_content_hash_tells_separators_and_nulls_apart(spark):
    tables = [[("x|y", "z")], [("x", "y|z")], [("null", "z")], [(None, "z")], [("1:x", "z")], [("x", "")], [("", "x")]]
    hashes = {digests.content_hash(spark.createDataFrame(t, "a string, b string")).first()["content_hash"] for t in tables}
    assert len(hashes) == len(tables)


def test_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "a b.txt").write_bytes(b"one")
    (tmp_path / "c.txt").write_bytes(b"two")
    got = {r.sha256 for r in digests.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {hashlib.sha256(x).hexdigest() for x in (b"one", b"two")}


def test_moments_do_not_follow_the_drivers_zone(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        row = spark.range(1).select(instant(datetime(2024, 1, 1, 6)).cast("string").alias("a"), instant(datetime(2024, 1, 1, 6, tzinfo=timezone.utc)).cast("string").alias("b")).first()
    finally:
        os.environ.pop("TZ", None)
        monkeypatch.undo()
        time.tzset()
    assert row.a == row.b == "2024-01-01 06:00:00"


def test_an_empty_landing_is_an_empty_table(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "empty.json").write_text("\n\n")
    path = bronze.ingest_jsonl(spark, "drivers", str(tmp_path / "landing"), str(tmp_path / "lake"), START)
    table = readers.read_layer(spark, path, schema=bronze.bronze_schema("drivers"))
    assert table.count() == 0 and "driver_id" in table.columns


def test_nothing_to_compare_is_no_drift(spark):
    a, b = spark.range(3).toDF("a"), spark.range(3).toDF("b")
    checked = drift.feature_drift(a, b, ["a", "b"], "s")
    assert checked.count() == 0 and drift.drift_result(checked, "s", ["a"]).first()["status"] == "PASS"


def test_rows_a_stream_has_tagged_pass_through_silver(spark):
    schema = DATASETS["gps_events"]
    rows = spark.createDataFrame([(None,) * len(schema.fields) + ("malformed record",)], T.StructType([*schema.fields, T.StructField(REASON, T.StringType())]))
    out = tagged(rows, DATASETS["gps_events"], ["event_timestamp"])
    assert out.columns.count(REASON) == 1 and out.first()[REASON] == "malformed record" and accepted(out).count() == 0
