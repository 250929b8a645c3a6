import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from waybill import session
from waybill.plans import bronze, silver
from waybill.schemas import DATASETS, GPS_EVENTS, ORDERS
from waybill.sources import readers, writers

FIRST, SECOND = datetime(2024, 2, 1, 6), datetime(2024, 2, 1, 12)


def lines(path, *texts):
    path.mkdir(exist_ok=True)
    (path / "part.jsonl").write_text("\n".join(texts) + "\n")
    return str(path)


def event(i, at):
    return json.dumps({"event_id": f"E{i}", "order_id": "O1", "driver_id": "D1", "latitude": 40.7, "longitude": -74.0,
                       "accuracy": 5.0, "event_timestamp": at})


def test_date_column_choice():
    assert bronze.batch_date_column(DATASETS["drivers"].names, "drivers") == "onboard_timestamp"
    assert bronze.batch_date_column(DATASETS["orders"].names, "orders") == "created_at"
    assert bronze.batch_date_column(DATASETS["gps_events"].names, "gps_events") == "event_timestamp"
    assert bronze.batch_date_column(DATASETS["weather_events"].names, "weather_events") == "start_time"
    assert bronze.batch_date_column(["order_timestamp", "created_at"], "orders") == "order_timestamp"
    assert bronze.batch_date_column(["a"], "x") == "ingestion_timestamp"
    assert bronze.stream_date_column(DATASETS["drivers"].names) is None
    assert bronze.stream_date_column(["date", "created_at"]) == "created_at"


def test_ingest_appends_and_reruns_replace(spark, tmp_path):
    lake, bad = str(tmp_path / "lake"), str(tmp_path / "bad")
    one = lines(tmp_path / "one", event(1, "2024-01-15T10:00:00"), "", event(2, "2024-01-15T10:00:00.5"), "{broken", event(3, None))
    two = lines(tmp_path / "two", event(4, "2024-01-15T11:00:00"), event(5, "2024-01-16T00:00:00"))
    target = bronze.ingest_jsonl(spark, "gps_events", one, lake, FIRST, bad)
    for _ in range(2):
        bronze.ingest_jsonl(spark, "gps_events", two, lake, SECOND)
    table = readers.read_layer(spark, target)
    assert sorted(r.event_id for r in table.collect()) == ["E1", "E2", "E4", "E5"]
    assert os.path.isdir(f"{target}/year=2024/month=01/day=15/ingestion_id=20240201060000")
    assert {r.quarantine_reason for r in spark.read.parquet(bad).collect()} == {"malformed record", "no event_timestamp"}
    counts = {r.partition_path: r.row_count for r in bronze.partition_counts(table, "event_timestamp").collect()}
    assert counts == {"year=2024/month=01/day=15": 3, "year=2024/month=01/day=16": 1}
    later = bronze.newer_than(table, "20240201060000")
    assert sorted(r.event_id for r in later.collect()) == ["E4", "E5"]
    assert readers.read_layer(spark, target, ["event_id"], date(2024, 1, 16)).count() == 1
    assert readers.read_layer(spark, target, until=date(2024, 1, 15)).count() == 3
    stats = readers.storage_stats(spark, target, "gps_events", "*.parquet").first()
    on_disk = [os.path.join(d, f) for d, _, fs in os.walk(target) for f in fs if f.endswith(".parquet")]
    assert (stats.files, stats.size_bytes) == (len(on_disk), sum(map(os.path.getsize, on_disk)))
    assert readers.storage_stats(spark, f"{lake}/nothing", "x").count() == 0
    summary = bronze.ingest_summary(table, "gps_events", "event_timestamp").first()
    assert (summary.rows_ingested, summary.partitions) == (4, 2)


def test_strict_ingest_raises(spark, tmp_path):
    path = lines(tmp_path / "x", "{broken")
    with pytest.raises(Exception):
        bronze.ingest_jsonl(spark, "gps_events", path, str(tmp_path / "lake"), FIRST, fail_on_bad=True)


def test_empty_ingest_writes_no_rows(spark, tmp_path):
    path = lines(tmp_path / "x", "")
    target = bronze.ingest_jsonl(spark, "gps_events", path, str(tmp_path / "lake"), FIRST)
    assert not [f for _, _, fs in os.walk(target) for f in fs if f.endswith(".parquet")]


def test_silver_write_replaces_only_its_dates(spark, tmp_path, ts):
    path = str(tmp_path / "silver")
    schema = "event_id int, event_timestamp timestamp"
    writers.write_silver(spark.createDataFrame([(1, ts(day=1)), (2, ts(day=2))], schema), path, ["event_timestamp", "event_id"])
    writers.write_silver(spark.createDataFrame([(3, ts(day=2))], schema), path)
    assert sorted(r.event_id for r in readers.read_layer(spark, path).collect()) == [1, 3]
    plan = readers.read_layer(spark, path, ["event_id"], date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_gold_and_feature_writes(spark, tmp_path, ts):
    hourly = spark.createDataFrame([("North", ts(0)), ("South", ts(60, 2))], "region string, metric_hour timestamp")
    writers.write_gold(hourly, str(tmp_path / "hourly"))
    assert os.path.isdir(tmp_path / "hourly/year=2024/month=01/day=02")
    writers.write_gold(spark.range(3), str(tmp_path / "plain"))
    assert readers.read_parquet(spark, str(tmp_path / "plain")).count() == 3
    assert writers.gold_date_column(spark.createDataFrame([], "metric_hour timestamp, metric_date date")) == "metric_date"
    path = writers.write_features(spark.range(3), str(tmp_path), "delay_model_features_v1", "abc123")
    assert path.endswith("delay_model_features_v1/dataset_hash=abc123")
    assert spark.read.parquet(str(tmp_path / "delay_model_features_v1")).first().dataset_hash == "abc123"
    writers.write_parquet(spark.range(2), str(tmp_path / "deep/er"))
    assert readers.run_sql(spark, "SELECT count(*) AS n FROM t", {"t": readers.read_parquet(spark, str(tmp_path / "deep/er"))}).first().n == 2


def test_json_lines_round_trip(spark, tmp_path, ts):
    orders = spark.createDataFrame([("O1", "D1", "express", "completed", ts(1.5), 1.0, 2.0, 3.0, 4.0, 10, None)], ORDERS)
    path = str(tmp_path / "orders")
    writers.write_jsonl(orders, path)
    assert readers.read_jsonl(spark, path, ORDERS).drop(readers.CORRUPT).collect() == orders.collect()


def test_kafka_records(spark, ts):
    gps = spark.createDataFrame([("E1", "O1", "D1", 1.0, None, 3.0, ts(1))], GPS_EVENTS)
    records = writers.kafka_records(gps, "event_id")
    row = records.first()
    assert row.key == "E1" and json.loads(row.value)["longitude"] is None
    broken = spark.createDataFrame([("k", "{nope")], "key string, value string")
    parsed = readers.parse_records(records.unionAll(broken), GPS_EVENTS)
    good = parsed.where("quarantine_reason IS NULL").select(*gps.columns)
    assert good.collect() == gps.collect()
    assert parsed.where("quarantine_reason = 'malformed record'").count() == 1


def test_logs_and_report(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([("bronze", "orders", 5)], "stage string, dataset string, row_count int")
    for _ in range(2):
        writers.append_log(rows, base, "data_lineage")
    log = writers.read_log(spark, base, "data_lineage")
    assert log.count() == 2 and log.select(F.count_distinct("id")).first()[0] == 2
    assert [r.row_count for r in log.collect()] == [5, 5]
    checks = spark.createDataFrame([("row_count", "PASS")], "check string, status string")
    writers.write_report(checks, checks.agg(F.count(F.lit(1)).alias("total_checks")), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/summary")).first().total_checks == 1


def test_quarantine_table(spark, tmp_path):
    raw = spark.createDataFrame([(None, 1, "2024-01-01", "standard"), (1, 1, "2024-01-01", "standard")],
                                "order_id int, driver_id int, created_at string, order_type string")
    path = str(tmp_path / "q")
    writers.write_quarantine(silver.quarantine(silver.tagged_orders(raw), "orders"), path, "r1")
    row = spark.read.parquet(path).first()
    assert (row.dataset, row.quarantine_reason) == ("orders", "no order_id") and '"driver_id":1' in row.record


class Stub:
    """A session whose settings can be chosen; the real one fixes them at start."""

    def __init__(self, folder=None, master="yarn"):
        self.conf = {session.CHECKPOINT_SETTING: folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(Stub("s3://bucket/cp/"), "x").startswith("s3://bucket/cp/waybill/x-")
    with pytest.raises(ValueError):
        session.shared_folder(Stub())  # a cluster without a shared folder
    with pytest.raises(ValueError):
        session.shared_folder(Stub(master="local[4]"))  # nor does one machine get a folder of its own accord
    configured = spark.conf.get(session.CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    assert session.shared_folder(spark) == configured.rstrip("/")


def test_materialize_reads_back_the_same_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    back = session.materialize(df, "t")
    assert sorted(back.collect()) == sorted(df.collect()) and "Scan parquet" in back._jdf.queryExecution().executedPlan().toString()
