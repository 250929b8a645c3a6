"""Silver and gold brought up to date from new runs alone.

New rows go through the same rules as in a full build and are merged by key: the first arrival over everything seen so far stays, so
the order in which runs come does not matter. What a merge has changed - rows that came in and rows they displaced - names the days of
each gold table that can differ; those days are computed again from the days of silver they rest on, all others stay as they are.
The result equals a full build over all runs.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.timing import delivered_at, with_date_levels
from waybill.operators.contracts import accepted
from waybill.plans import gold, silver
from waybill.session import materialize
from waybill.sources import folders
from waybill.sources.merge import Change, Merge, dated_table, plan_merge
from waybill.sources.writers import write_days

MINUTES_PER_DAY = 24 * 60
# of each table: key, date column, what ranks its arrivals, what its files are sorted by
TABLES = {
    "gps_events": ("event_id", "event_timestamp", ["ingestion_timestamp", "event_timestamp", "order_id", "driver_id"], ["event_timestamp", "event_id"]),
    "orders": ("order_id", "created_at", ["ingestion_timestamp", "created_at"], ["created_at"]),
    "weather": ("weather_event_id", "start_time", ["ingestion_timestamp", "start_time"], ["start_time"]),
}


def new_rows(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows of new runs as silver takes them, one per key."""
    return {
        "gps_events": silver.gps_events(accepted(silver.tagged_gps(raw["gps_events"]))),
        "orders": silver.orders(raw["orders"]),
        "weather": silver.weather(raw["weather_events"]),
    }


def plan_silver(raw: dict[str, DataFrame], paths: dict[str, str]) -> dict[str, Merge]:
    """Work out the merges of new runs into the silver tables; without new rows for a table it is not read."""
    rows = new_rows(raw)
    return {name: plan_merge(paths[name], rows[name], key, ts, rank, sort) for name, (key, ts, rank, sort) in TABLES.items()}


def refresh_drivers(new: DataFrame, known: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(profiles, changed): the newest profile of every driver, and the drivers whose region is another than before."""
    rows = new.where("driver_id IS NOT NULL")
    rows = rows if known is None else rows.unionByName(known)
    rest = [c for c in rows.columns if c != "driver_id"]
    newest = rows.groupBy("driver_id").agg(
        F.max_by(F.struct(*rest), F.struct("ingestion_timestamp", *[c for c in rest if c != "ingestion_timestamp"])).alias("p")
    )
    profiles = materialize(newest.select("driver_id", "p.*"), "drivers")
    before = (profiles.limit(0) if known is None else known).select("driver_id", F.col("region").alias("__region"), F.lit(True).alias("__known"))
    compared = profiles.join(before, "driver_id", "left")
    return profiles, compared.where("__known IS NULL OR NOT (region <=> __region)").select("driver_id")


@dataclass(frozen=True)
class Touched:
    """The days of each gold table that new runs can have changed."""

    deliveries: set[str]
    driver_daily_metrics: set[str]
    region_hourly_metrics: set[str]

    def with_days(self, more: dict[str, set[str]]) -> Touched:
        return Touched(**{name: days | more.get(name, set()) for name, days in vars(self).items()})


def _spread(days: set[str], back: int) -> set[str]:
    """The days and as many before each."""
    known = [d for d in days if d != folders.UNDATED]
    parsed = {date(int(d[:4]), int(d[4:6]), int(d[6:])) - timedelta(days=n) for d in known for n in range(back + 1)}
    return {f"{d:%Y%m%d}" for d in parsed} | (days - set(known))


def longest_minutes(orders: DataFrame) -> int:
    return orders.agg(F.max("actual_delivery_minutes")).first()[0] or 0


def _days_back(minutes: int) -> int:
    """How many days before its end a delivery of so many minutes can have begun."""
    return -(-max(minutes, 0) // MINUTES_PER_DAY)


def touched(changes: dict[str, Change], moved_drivers: DataFrame, orders: DataFrame, minutes: int) -> Touched:
    """Follow the changes to the gold days. ``orders`` is the dated silver table, of which only driver ids are read."""
    created, ended, seen = changes["orders"].days("created_at"), changes["orders"].days(delivered_at()), changes["gps_events"].days("event_timestamp")
    # deliveries under way in changed weather were created in its days, or as long before as a delivery takes
    spans = changes["weather"].rows().where("end_time >= start_time")
    weather_days = spans.select(F.explode(F.sequence(F.to_date("start_time"), F.to_date("end_time"))).alias("__d"))
    weather = _spread(folders.days_of(with_date_levels(weather_days, "__d")), _days_back(minutes))
    drivers = folders.days_of(orders.select("driver_id", *folders.DATE_COLUMNS).join(moved_drivers, "driver_id", "left_semi"))
    return Touched(created | weather | drivers, created | seen, (seen | ended) - {folders.UNDATED})


def refresh_gold(spark: SparkSession, paths: dict[str, str], silver_paths: dict[str, str], drivers: DataFrame, which: Touched, minutes: int, oldest: date | None = None) -> None:
    """Compute the touched days again. ``oldest`` is the first day of the retention: silver before it is not read."""
    tables = {name: spark.read.parquet(silver_paths[name]) for name in TABLES}
    kept = {name: dated_table(spark, silver_paths[name], table.schema) for name, table in tables.items()}
    first = None if oldest is None else f"{oldest:%Y%m%d}"
    within = lambda days: {d for d in days if first is None or d == folders.UNDATED or d >= first}
    on = lambda name, days: kept[name].where(folders.on_days(within(days))).drop(*folders.DATE_COLUMNS)

    built = {
        "deliveries": (which.deliveries, "created_at", lambda days: gold.deliveries_with_weather(on("orders", days), drivers, kept["weather"].drop(*folders.DATE_COLUMNS))),
        "driver_daily_metrics": (which.driver_daily_metrics, "metric_date", lambda days: gold.driver_daily(on("orders", days), on("gps_events", days), with_distance=True)),
        "region_hourly_metrics": (which.region_hourly_metrics, "metric_hour", lambda days: _region_hours(on, days, minutes)),
    }
    for name, (days, ts, plan) in built.items():
        if days := within(days):
            write_days(materialize(plan(days), name), paths[name], ts, days)


def _region_hours(on, days: set[str], minutes: int) -> DataFrame:
    """Whole region hours of some days: events of these days, and orders that ended on them, created up to a delivery's length before."""
    orders = on("orders", _spread(days, _days_back(minutes)))
    ended = with_date_levels(orders.withColumn("__d", F.to_date(delivered_at())), "__d")
    ended = ended.where(folders.on_days(days)).drop("__d", *folders.DATE_COLUMNS)
    return gold.region_hourly_full(on("gps_events", days), ended)
