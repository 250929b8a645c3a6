"""Runs that come one after another, against one build over all of them."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.daily_query import write_landing
from checks.views import SparkViews
from waybill.functions.digests import content_hash
from waybill.plans import daily, runs
from waybill.plans.bronze import newer_than, with_ingestion
from waybill.schemas import DATASETS, GPS_EVENTS
from waybill.session import shared_folder
from waybill.sources import folders, merge, readers, writers
from waybill.streaming import jobs

AT = [datetime(2024, 2, 1), datetime(2024, 2, 2, 3, 4, 5, 678), datetime(2024, 2, 3)]
TABLES = [*(f"cleaned/{t}" for t in daily.SILVER), "cleaned/driver_versions", *(f"gold/{t}" for t in daily.GOLD)]


def state(spark, lake):
    """(rows, content hash) of every table; where drivers come from says nothing."""
    out = {}
    for name in TABLES:
        table = readers.read_layer(spark, f"{lake}/{name}")
        out[name] = tuple(content_hash(table).first())
    drivers = spark.read.parquet(f"{lake}/cleaned/drivers")
    return out | {"drivers": tuple(content_hash(drivers).first())}


def orders_row(i, day, minutes, driver="D1"):
    return (f"O{i}", driver, "express", "done", datetime(2024, 1, day, 23, 30), 40.7, -74.0, 40.8, -73.9, 30, minutes)


def landing(spark, path, orders=(), gps=(), drivers=(), weather=()):
    for name, rows in (("orders", orders), ("gps_events", gps), ("drivers", drivers), ("weather_events", weather)):
        writers.write_jsonl(spark.createDataFrame(list(rows), DATASETS[name]), f"{path}/{name}")


@pytest.fixture
def three_landings(spark, tmp_path):
    """Orders that move to another day, a driver who moves to another region, weather that reaches back, repeated and rejected rows."""
    driver = lambda region: ("D1", "van", 3, 0, 0.05, 0.001, region, datetime(2024, 1, 1))
    gps = lambda e, o, at: (f"E{e}", f"O{o}", "D1", 40.71, -74.0, 5.0, at)
    storm = lambda i, day, region: (f"W{i}", "storm", 5, datetime(2024, 1, day), datetime(2024, 1, day + 1), region)
    one, two, three = (str(tmp_path / f"landing{n}") for n in range(3))
    landing(spark, one, [orders_row(1, 3, 50), orders_row(2, 4, 20), orders_row(3, 9, 40)], [gps(1, 1, datetime(2024, 1, 3, 23)), gps(2, 2, datetime(2024, 1, 5))], [driver("North")], [storm(1, 3, "North")])
    landing(spark, two, [orders_row(2, 4, 20), orders_row(4, 9, 3000), orders_row(5, 12, None)], [gps(1, 1, datetime(2024, 1, 7)), gps(3, 4, datetime(2024, 1, 11, 1))], [driver("South")], [storm(2, 10, "South")])
    landing(spark, three, [orders_row(6, 20, 10, None)], [], [], [storm(2, 11, "South"), storm(3, 4, "South")])
    return [one, two, three]


def orders_scan(spark, lake):
    taken = runs.pending(spark, lake.base)
    table = runs.read_bronze(spark, lake.base, "orders", taken.of("orders"))
    return {r["ingestion_id"] for r in taken.rows}, table._jdf.queryExecution().executedPlan().toString()


def test_runs_one_by_one_equal_one_build(spark, tmp_path, three_landings, monkeypatch):
    lake = daily.Lake(str(tmp_path / "lake"))
    daily.ingest_all(spark, three_landings[1], lake, AT[1])
    daily.bring_up_to_date(spark, lake, AT[1])
    daily.ingest_all(spark, three_landings[2], lake, AT[2])
    names, plan = orders_scan(spark, lake)  # the scan opens the folders of new runs only
    assert names == {"20240203000000"} and "20240203000000" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):  # a job that breaks off takes its runs again
        patch.setattr(daily.incremental, "refresh_gold", lost)
        daily.bring_up_to_date(spark, lake, AT[2])
    opened = runs.pending(spark, lake.base)  # silver is merged, so only the attempt still knows which gold days to compute
    assert "20240104" in opened.gold_days()["deliveries"] and {name for name, _ in opened.contents()} == {"weather"}
    folders.drop_days(spark, lake.silver("weather"), {"20240104"})  # as if it had broken off while it replaced that day
    # an older run that comes last displaces what came later, in its old date as well
    daily.ingest_all(spark, three_landings[0], lake, AT[0])
    assert {r["ingestion_id"] for r in runs.pending(spark, lake.base).rows} == {"20240203000000", "20240201000000"}
    daily.bring_up_to_date(spark, lake, AT[2])
    step_by_step = state(spark, lake.base)
    left = runs.pending(spark, lake.base)
    assert not left.rows and not left.attempted
    daily.bring_up_to_date(spark, lake, AT[2], full=True)
    assert state(spark, lake.base) == step_by_step
    assert {r.event_id: r.event_timestamp.day for r in spark.read.parquet(lake.silver("gps_events")).collect()} == {"E1": 3, "E2": 5, "E3": 11}
    # a run that is ingested again, without some of its rows and with others moved
    landing(spark, three_landings[1], [orders_row(4, 10, 30)], [], [], [])
    daily.bronze.ingest_jsonl(spark, "orders", f"{three_landings[1]}/orders", lake.base, AT[1])
    daily.bring_up_to_date(spark, lake, AT[2])
    rows = {r.order_id: (r.created_at.day, r.delay_minutes) for r in spark.read.parquet(lake.gold("deliveries")).collect()}
    assert rows == {"O1": (3, 20), "O2": (4, -10), "O3": (9, 10), "O4": (10, 0)}


def test_intermediate_tables_go_when_the_runs_are_committed(spark, tmp_path, three_landings, monkeypatch):
    held = lambda: {p.name for p in Path(f"{shared_folder(spark)}/waybill").glob("*")}
    lake, before = daily.Lake(str(tmp_path / "lake")), held()
    for landed, at in zip(three_landings[:2], AT, strict=False):
        daily.ingest_all(spark, landed, lake, at)
        daily.bring_up_to_date(spark, lake, at)
    assert held() == before
    daily.ingest_all(spark, three_landings[2], lake, AT[2])
    with monkeypatch.context() as patch, pytest.raises(ZeroDivisionError):  # what a broken job was writing stays for the next one
        patch.setattr(daily.runs, "commit", lambda *_: 1 / 0)
        daily.bring_up_to_date(spark, lake, AT[2])
    contents = {Path(path).name for _, path in runs.pending(spark, lake.base).contents()}
    assert contents and contents <= held()
    daily.bring_up_to_date(spark, lake, AT[2])
    assert not runs.pending(spark, lake.base).rows and spark.read.parquet(lake.gold("deliveries")).count() == 5


def test_a_compressed_landing_is_ingested_whole(spark, tmp_path):
    schema, rows = DATASETS["orders"], [orders_row(i, 1 + i % 9, None if i % 4 else i) for i in range(25)]
    writers.write_jsonl(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "orders"), "gzip", 10)
    files = sorted((tmp_path / "orders").glob("part-*"))
    assert len(files) == 3 and all(f.name.endswith(".json.gz") for f in files)
    daily.bronze.ingest_jsonl(spark, "orders", str(tmp_path / "orders"), str(tmp_path / "lake"), AT[0])
    got = runs.read_bronze(spark, str(tmp_path / "lake"), "orders").select(*schema.names).collect()
    assert sorted(map(tuple, got), key=lambda r: int(r[0][1:])) == rows


def test_a_row_that_moves_leaves_its_old_date(spark, tmp_path, ts):
    path, schema = str(tmp_path / "t"), "order_id long, created_at timestamp, v int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    merge.merge_dated(path, make([(1, ts(day=1), 1), (2, ts(day=2), 1), (3, ts(day=2), 1), (None, ts(day=3), 1)]), "order_id", "created_at")
    change = merge.merge_dated(path, make([(1, ts(day=5), 2), (3, ts(day=2), 1), (None, None, 2)]), "order_id", "created_at")
    rows = {r.order_id: (r.created_at, r.v) for r in spark.read.parquet(path).collect()}
    assert rows == {1: (ts(day=5), 2), 2: (ts(day=2), 1), 3: (ts(day=2), 1), None: (None, 2)} and spark.read.parquet(path).count() == 4
    assert change.days("created_at") == {"20240101", "20240103", "20240105", folders.UNDATED}  # the second is not rewritten
    assert folders.held_days(spark, path) == {"20240102", "20240105", folders.UNDATED}
    assert not merge.merge_dated(path, make([(1, ts(day=5), 2)]), "order_id", "created_at").days("created_at")
    first = merge.merge_dated(path, make([(1, ts(day=6), 1), (2, ts(day=2), 9)]), "order_id", "created_at", rank=["v"])
    assert [(r.order_id, r.v) for r in first.added.collect()] == [(1, 1)] and spark.read.parquet(path).count() == 4
    merge.merge_dated(path, make([]), "order_id", "created_at")
    assert spark.read.parquet(path).count() == 4


def test_a_repeated_bronze_run_leaves_no_stale_date(spark, tmp_path, ts):
    path, schema = str(tmp_path / "raw"), "event_id long, event_timestamp timestamp"
    write = lambda rows, at: writers.write_bronze(with_ingestion(spark.createDataFrame(rows, schema), at), path, "event_timestamp")
    write([(1, ts(day=1))], AT[0])
    write([(9, ts(day=1))], AT[1])
    seen = write([(1, ts(day=2)), (2, None)], AT[0])
    assert seen.rows == 2 and seen.days == {"20240201000000": {"20240102", folders.UNDATED}}
    got = readers.read_layer(spark, path)
    assert sorted((r.event_id, r.ingestion_id) for r in got.collect()) == [(1, "20240201000000"), (2, "20240201000000"), (9, "20240202030405-000678")]
    assert writers.write_bronze(with_ingestion(spark.createDataFrame([], schema), AT[0]), path, "event_timestamp", "20240201000000").rows == 0
    assert [r.event_id for r in spark.read.parquet(path).collect()] == [9]


def test_whole_tables_lose_dates_without_rows(spark, tmp_path, ts):
    path = str(tmp_path / "gold")
    make = lambda *days: spark.createDataFrame([(d, date(2024, 1, d)) for d in days], "v int, metric_date date")
    writers.write_gold(make(1, 2), path, whole=True)
    writers.write_gold(make(2, 3), path, whole=True)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [2, 3]


def gps(spark, tmp_path, name, *ids, at=None):
    folder = str(tmp_path / name)
    spark.createDataFrame([(f"E{i}", "O1", "D1", 40.7, -74.0, 5.0, at) for i in ids], GPS_EVENTS).coalesce(1).write.mode("append").parquet(folder)
    return jobs.file_stream(spark, folder, GPS_EVENTS, files_per_batch=1)


def test_streams_never_replace_each_others_batches(spark, tmp_path, ts):
    target = str(tmp_path / "lake/raw_stream/gps_events")
    for name in ("a", "b"):
        jobs.start_topic(gps(spark, tmp_path, name, name, at=ts()), "gps_events", str(tmp_path / "lake"), True).awaitTermination() if name == "a" else jobs.start_bronze(
            gps(spark, tmp_path, name, name, at=ts()), target, str(tmp_path / "other")
        ).awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == ["Ea", "Eb"]
    noted = runs.pending(spark, str(tmp_path / "lake")).rows
    assert [(r["area"], r["day"], r["row_count"]) for r in noted] == [("raw_stream", "20240101", 1)]
    # a stream's rows have a time, not a place in the order of ids
    rows = readers.read_layer(spark, target)
    assert newer_than(rows, "20240201000000").count() == 2 and newer_than(rows, "29990101000000").count() == 0
    with pytest.raises(ValueError):
        newer_than(rows, rows.first().ingestion_id)


def test_a_repeated_batch_replaces_its_own(spark, tmp_path):
    stream, target, checkpoint = gps(spark, tmp_path, "in", 1, 2), str(tmp_path / "raw"), tmp_path / "cp"
    jobs.start_bronze(stream, target, str(checkpoint)).awaitTermination()
    first = spark.read.parquet(target).select("event_id", F.col("ingestion_timestamp").cast("string"), "day", F.col("ingestion_id").cast("string")).collect()
    (checkpoint / "commits" / "0").unlink()  # as if the job had died before it committed
    (checkpoint / "commits" / ".0.crc").unlink()
    jobs.start_bronze(stream, target, str(checkpoint)).awaitTermination()
    again = spark.read.parquet(target).select("event_id", F.col("ingestion_timestamp").cast("string"), "day", F.col("ingestion_id").cast("string")).collect()
    assert len(first) == 2 and sorted(first) == sorted(again)


def test_errors_count_a_stream_that_fails(spark, tmp_path, ts):
    stream = gps(spark, tmp_path, "in", 1, 2, at=ts())
    broken = stream.withColumn("accuracy", F.when(F.col("event_id") == "E2", F.raise_error("bad")).cast("double"))
    assert jobs.drain(broken, "broken").errors == 1 and jobs.drain(stream, "sound").errors == 0


def test_landing_views_in_halves(spark, tmp_path):
    """The daily job reads batches and streams: a stream brings half of the events, the landings the rest."""
    source, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    write_landing(SparkViews(spark, "/root/testdata/sf0.001"), source)
    events = spark.read.schema(GPS_EVENTS).json(f"{source}/gps_events")
    events.where("order_id % 2 = 0").coalesce(1).write.parquet(str(tmp_path / "topic"))
    writers.write_jsonl(events.where("order_id % 2 = 1"), str(tmp_path / "odd"))
    where = daily.Lake(lake)
    jobs.start_topic(jobs.file_stream(spark, str(tmp_path / "topic"), GPS_EVENTS), "gps_events", lake).awaitTermination()
    for name in DATASETS:
        daily.bronze.ingest_jsonl(spark, name, str(tmp_path / "odd") if name == "gps_events" else f"{source}/{name}", lake, AT[0])
    daily.bring_up_to_date(spark, where, AT[0])
    assert spark.read.parquet(f"{lake}/cleaned/gps_events").select("event_id").distinct().count() == spark.read.parquet(f"{lake}/cleaned/gps_events").count() == 980
