"""The whole daily job as one query: rows of every table it wrote."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.features_quality import RISK_FEATURES
from checks.registry import Views, query_on_files
from checks.silver_gold import DAILY, DEDUP, DELAY, ENDED, HOURLY, region_sql
from waybill.functions import digests
from waybill.plans import daily
from waybill.schemas import DATASETS
from waybill.session import materialize, scratch_path
from waybill.sources import writers
from waybill.sources.readers import read_layer

AT = datetime(2024, 2, 1)


def landing(v: Views) -> dict[str, DataFrame]:
    """The test tables in the shape of the four source datasets."""
    tables = {
        "drivers": v["drivers"].withColumn("onboard_timestamp", F.lit("2024-01-01").cast("timestamp")),
        "orders": v["orders_l"].withColumn("status", F.lit("completed")),
        "gps_events": v["gps_bronze"],
        "weather_events": v["weather"],
    }
    return {name: table.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in DATASETS[name].fields)) for name, table in tables.items()}


def write_landing(v: Views, path: str) -> None:
    """The four source datasets as JSON lines."""
    for name, rows in landing(v).items():
        writers.write_jsonl(rows, f"{path}/{name}")


HOURLY_FULL = f"""SELECT h.region FROM ({HOURLY}) h FULL JOIN (
  SELECT {region_sql('delivery_lat', 'delivery_lon')} AS region, date_trunc('hour', {ENDED}) AS metric_hour, avg({DELAY}) AS d
  FROM orders_l WHERE actual_delivery_minutes IS NOT NULL GROUP BY region, metric_hour) d
ON h.region = d.region AND h.metric_hour = d.metric_hour"""


@query_on_files(
    "daily_layers",
    f"""SELECT 'raw/drivers' AS table_name, count(*) AS row_count FROM drivers
UNION ALL SELECT 'raw/orders', count(*) FROM orders_l
UNION ALL SELECT 'raw/gps_events', count(*) FROM gps_bronze
UNION ALL SELECT 'raw/weather_events', count(*) FROM weather
UNION ALL SELECT 'cleaned/drivers', count(*) FROM drivers
UNION ALL SELECT 'cleaned/orders', count(*) FROM orders_l
UNION ALL SELECT 'cleaned/gps_events', count(*) FROM {DEDUP}
UNION ALL SELECT 'cleaned/weather', count(*) FROM weather
UNION ALL SELECT 'gold/deliveries', count(*) FROM orders_l
UNION ALL SELECT 'gold/driver_daily_metrics', count(*) FROM ({DAILY})
UNION ALL SELECT 'gold/region_hourly_metrics', count(*) FROM ({HOURLY_FULL})
UNION ALL SELECT 'features/delay_model_features_v1', count(*) FROM orders_l
UNION ALL SELECT 'features/eta_model_features_v1', count(*) FROM orders_l
UNION ALL SELECT 'features/driver_risk_features_v1', count(*) FROM ({RISK_FEATURES})""",
)
def daily_layers(spark, sf_dir, v: Views):
    base = scratch_path(spark, "daily")
    write_landing(v, f"{base}/landing")
    lake = f"{base}/lake"
    daily.run(spark, f"{base}/landing", lake, AT)
    names = [
        *(f"raw/{name}" for name in DATASETS), "cleaned/drivers", "cleaned/orders", "cleaned/gps_events", "cleaned/weather",
        "gold/deliveries", "gold/driver_daily_metrics", "gold/region_hourly_metrics",
        "features/delay_model_features_v1", "features/eta_model_features_v1", "features/driver_risk_features_v1",
    ]
    counts = [
        spark.read.parquet(f"{lake}/{name}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


FIRST_TIME = "order_id % 3 = 0"
FILE_ROWS = 100_000  # of a compressed landing file
FIRST_ARRIVALS = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival, event_timestamp, order_id) AS rn
  FROM (SELECT *, 0 AS arrival FROM gps_bronze WHERE {FIRST_TIME} UNION ALL SELECT *, 1 FROM gps_bronze)) WHERE rn = 1)"""


@query_on_files(
    "daily_two_runs",
    f"""SELECT 'cleaned/orders' AS table_name, count(*) AS row_count, CAST(sum(order_id) AS BIGINT) AS checksum, true AS equals_full_build FROM orders_l
UNION ALL SELECT 'cleaned/gps_events', count(*), CAST(sum(order_id) AS BIGINT), true FROM {FIRST_ARRIVALS}
UNION ALL SELECT 'cleaned/weather', count(*), CAST(sum(weather_event_id) AS BIGINT), true FROM weather
UNION ALL SELECT 'cleaned/driver_versions', count(*), CAST(sum(driver_id) AS BIGINT), true FROM drivers
UNION ALL SELECT 'gold/deliveries', count(*), CAST(sum(order_id) AS BIGINT), true FROM orders_l
UNION ALL SELECT 'gold/driver_daily_metrics', count(*), CAST(sum(n) AS BIGINT), true
  FROM (SELECT driver_id, CAST(created_at AS DATE) AS d, count(*) AS n FROM orders_l GROUP BY ALL)
UNION ALL SELECT 'gold/region_hourly_metrics', count(*), CAST(sum(n) AS BIGINT), true FROM (SELECT g.n, g.region FROM
  (SELECT {region_sql('latitude', 'longitude')} AS region, date_trunc('hour', event_timestamp) AS h, count(*) AS n FROM {FIRST_ARRIVALS} GROUP BY ALL) g
  FULL JOIN (SELECT {region_sql('delivery_lat', 'delivery_lon')} AS region, date_trunc('hour', {ENDED}) AS h FROM orders_l
    WHERE actual_delivery_minutes IS NOT NULL GROUP BY ALL) d ON g.region = d.region AND g.h = d.h)""",
)
def daily_two_runs(spark, sf_dir, v: Views):
    """A third of all records in a first run, everything in a second one; then the same bronze in one build."""
    base = scratch_path(spark, "two-runs")
    lake = daily.Lake(f"{base}/lake")
    for n, at in enumerate((AT, AT + timedelta(days=1))):
        source = f"{base}/landing{n}"
        for name, rows in landing(v).items():
            part = {"orders": "order_id % 3 = 0", "gps_events": FIRST_TIME, "weather_events": "weather_event_id % 3 = 0"}.get(name)
            writers.write_jsonl(rows.where(part) if part and n == 0 else rows, f"{source}/{name}", "gzip", FILE_ROWS)
        daily.ingest_all(spark, source, lake, at)
        daily.bring_up_to_date(spark, lake, at)
    sums = {
        "cleaned/orders": "order_id", "cleaned/gps_events": "order_id", "cleaned/weather": "weather_event_id", "cleaned/driver_versions": "driver_id",
        "gold/deliveries": "order_id", "gold/driver_daily_metrics": "deliveries_completed", "gold/region_hourly_metrics": "gps_events_count",
    }

    def state():
        out = None
        for name, column in sums.items():
            table = read_layer(spark, f"{lake.base}/{name}")
            own = table.agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col(column).cast("long")).alias("checksum"))
            own = own.crossJoin(digests.content_hash(table).select("content_hash"))  # two single rows
            own = own.select(F.lit(name).alias("table_name"), "*")
            out = own if out is None else out.unionAll(own)
        return out

    stepwise = materialize(state(), "stepwise")
    daily.bring_up_to_date(spark, lake, AT, full=True)
    full = state().select("table_name", F.col("content_hash").alias("full_hash"))
    joined = stepwise.join(full, "table_name")
    return joined.select("table_name", "row_count", "checksum", F.col("content_hash").eqNullSafe(F.col("full_hash")).alias("equals_full_build"))
