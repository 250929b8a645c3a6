from datetime import datetime

from checks.daily_query import write_landing
from checks.views import SparkViews
from waybill.plans import daily
from waybill.sources import readers, writers


def test_daily_run(spark, tmp_path):
    source, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    write_landing(SparkViews(spark, "/root/testdata/sf0.001"), source)
    at = datetime(2024, 2, 1)
    checks = daily.run(spark, source, lake, at)
    statuses = {(r.check, r.stage): r.status for r in checks.collect()}
    assert statuses[("row_count", "silver_orders")] == "PASS" and statuses[("late_arrival_ratio", "silver_gps_events")] == "WARN"
    first = {n: readers.read_layer(spark, f"{lake}/{n}").count() for n in
             ("cleaned/gps_events", "cleaned/orders", "gold/deliveries", "gold/region_hourly_metrics")}
    assert first["cleaned/gps_events"] == 980 and first["cleaned/orders"] == first["gold/deliveries"] == 1500
    # the same run again changes nothing
    where = daily.Lake(lake)
    daily.build_silver(spark, daily.ingest_all(spark, source, where, at), where, "20240201000000")
    assert first == {n: readers.read_layer(spark, f"{lake}/{n}").count() for n in first}
    rows = {r.dataset: r for r in daily.effectiveness(spark, lake).collect()}
    assert (rows["gps_events"].bronze_rows, rows["gps_events"].duplicates_removed) == (1000, 20)
    assert writers.read_log(spark, f"{lake}/logs", "data_lineage").count() == 3
