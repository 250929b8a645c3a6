"""The daily job: JSON lines to bronze, silver, gold, features, quality checks and models.

Every layer is written once and the next one reads it back, so a lost executor repeats one layer
at most and nothing is computed twice. Silver and gold take up the runs, of batches and of streams,
that no job has taken up yet; a run that was ingested again has them built anew. Usage::

    spark-submit -m waybill.plans.daily --landing LANDING --lake LAKE [--models]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.digests import content_hash
from waybill.functions.timing import instant, run_id
from waybill.ml import forest, models
from waybill.operators import dedup, quality, scd, sketches
from waybill.operators.contracts import accepted, meets_bronze, meets_silver
from waybill.operators.drift import drift_result, feature_drift
from waybill.plans import bronze, features, gold, incremental, runs, silver
from waybill.schemas import DATASETS, RETENTION_DAYS
from waybill.session import build_session, materialize, passing
from waybill.sources import folders, readers, writers


@dataclass(frozen=True)
class Lake:
    """Where the layers live."""

    base: str

    def silver(self, name: str) -> str:
        return f"{self.base}/cleaned/{name}"

    def gold(self, name: str) -> str:
        return f"{self.base}/gold/{name}"

    @property
    def features(self) -> str:
        return f"{self.base}/features"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine"

    @property
    def models(self) -> str:
        return f"{self.base}/models"

    @property
    def logs(self) -> str:
        return f"{self.base}/logs"


SILVER = ["gps_events", "orders", "weather"]
GOLD = ["deliveries", "driver_daily_metrics", "region_hourly_metrics"]
MEASURED = ["delay_minutes", "route_distance_km"]  # columns of deliveries that are watched for drift
VERSIONS = "driver_versions"  # silver's history of driver profiles
PROFILE = ["vehicle_type", "experience_years", "accident_history", "weather_sensitivity", "accident_risk", "region"]


def ingest_all(spark: SparkSession, landing: str, lake: Lake, at: datetime) -> dict[str, DataFrame]:
    """``landing/<dataset>`` of every dataset into bronze; returns all of bronze, what streams wrote included."""
    for name in DATASETS:
        bronze.ingest_jsonl(spark, name, f"{landing}/{name}", lake.base, at, lake.quarantine)
    return {name: enforced(runs.read_bronze(spark, lake.base, name), f"bronze {name}", meets_bronze) for name in DATASETS}


def enforced(table: DataFrame, what: str, meets) -> DataFrame:
    """The table, if it has the columns of its layer's contract."""
    if not meets(table):
        raise ValueError(f"{what} lacks columns of its contract: {table.columns}")
    return table


def quarantine_silver(raw: dict[str, DataFrame], lake: Lake, run: str) -> None:
    """Rejected rows with their reason."""
    tagged = {
        "gps_events": silver.tagged_gps(raw["gps_events"]),
        "orders": silver.tagged_orders(raw["orders"]),
        "weather": silver.tagged_weather(raw["weather_events"]),
    }
    for name, rows in tagged.items():
        writers.write_quarantine(silver.quarantine(rows, f"silver_{name}"), lake.quarantine, run)


def read_silver(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    tables = {name: readers.read_layer(spark, lake.silver(name)) for name in SILVER}
    for name, table in tables.items():
        enforced(table, f"silver {name}", lambda t, name=name: meets_silver(t, name))
    return tables | {"drivers": readers.read_parquet(spark, lake.silver("drivers"))}


def _driver_changes(drivers: DataFrame) -> DataFrame:
    return drivers.select("driver_id", *PROFILE, "ingestion_timestamp")


def build_silver(spark: SparkSession, raw: dict[str, DataFrame], lake: Lake, run: str) -> dict[str, DataFrame]:
    """Typed, deduplicated tables from all of bronze; rejected rows go to quarantine with their reason."""
    quarantine_silver(raw, lake, run)
    for name, table in incremental.new_rows(raw).items():
        writers.write_silver(table, lake.silver(name), incremental.TABLES[name][3], whole=True)
    drivers = accepted(raw["drivers"])
    # the latest arrival of a driver is its profile
    writers.write_parquet(incremental.refresh_drivers(drivers, None)[0], lake.silver("drivers"))
    writers.write_parquet(scd.build_history(_driver_changes(drivers), "driver_id", PROFILE, "ingestion_timestamp"), lake.silver(VERSIONS))
    return read_silver(spark, lake)


def build_gold(spark: SparkSession, tables: dict[str, DataFrame], lake: Lake) -> dict[str, DataFrame]:
    """The gold tables from all of silver; deliveries are dated by their creation, so that later runs can replace single days."""
    built = {
        "deliveries": (gold.deliveries_with_weather(tables["orders"], tables["drivers"], tables["weather"]), "created_at"),
        "driver_daily_metrics": (gold.driver_daily(tables["orders"], tables["gps_events"], with_distance=True), None),
        "region_hourly_metrics": (gold.region_hourly_full(tables["gps_events"], tables["orders"]), None),
    }
    for name, (table, ts) in built.items():
        writers.write_gold(table, lake.gold(name), whole=True, ts=ts)
    return {name: spark.read.parquet(lake.gold(name)) for name in built}


def take_up(spark: SparkSession, lake: Lake, taken: runs.Pending, at: datetime, oldest: date | None = None) -> None:
    """Bring silver and gold up to date with some runs and commit them."""
    paths = {name: lake.silver(name) for name in SILVER}
    for (name, content), days in taken.contents().items():  # what a job that broke off was writing
        _, ts, _, sort = incremental.TABLES[name]
        writers.write_days(spark.read.parquet(content), paths[name], ts, days, sort)

    raw = {name: runs.read_bronze(spark, lake.base, name, taken.of(name)) for name in DATASETS}
    quarantine_silver(raw, lake, run_id(at))
    merges = incremental.plan_silver(raw, paths)
    changes = {name: merge.change for name, merge in merges.items()}
    minutes = max(taken.longest_minutes, incremental.longest_minutes(changes["orders"].rows()))
    new_drivers = materialize(accepted(raw["drivers"]), "new-drivers")
    drivers, moved = incremental.refresh_drivers(new_drivers, readers.read_parquet(spark, lake.silver("drivers")))
    versions = readers.read_parquet(spark, lake.silver(VERSIONS))
    versions = materialize(scd.upsert(versions, _driver_changes(new_drivers), "driver_id", PROFILE, "ingestion_timestamp"), VERSIONS)
    orders = incremental.dated_table(spark, paths["orders"], readers.read_layer(spark, paths["orders"]).schema)
    which = incremental.touched(changes, materialize(moved, "moved-drivers"), orders, minutes).with_days(taken.gold_days())

    attempt = runs.begin(spark, lake.base, merges, vars(which))
    for merge in merges.values():
        merge.apply(spark)
    writers.write_parquet(drivers, lake.silver("drivers"))
    writers.write_parquet(versions, lake.silver(VERSIONS))
    incremental.refresh_gold(spark, {name: lake.gold(name) for name in GOLD}, paths, drivers, which, minutes, oldest)
    runs.commit(spark, lake.base, taken, at, minutes, attempt)


def _complete(spark: SparkSession, lake: Lake) -> bool:
    """Whether there are tables to start from; those that are replaced as a whole must have been written to the end."""
    whole = [lake.silver("drivers"), lake.silver(VERSIONS)]
    return all(folders.exists(spark, f"{path}/_SUCCESS") for path in whole) and all(folders.exists(spark, lake.gold(name)) for name in GOLD)


def bring_up_to_date(spark: SparkSession, lake: Lake, at: datetime, oldest: date | None = None, full: bool = False) -> None:
    """Silver and gold over all runs in bronze: from the runs not taken up yet, or anew where there is nothing to start from, where
    one of the runs has been ingested again, or when asked to. Once the runs are committed, the intermediate tables go."""
    taken = runs.pending(spark, lake.base)
    with passing(spark):
        if full or taken.repeated or not _complete(spark, lake):
            raw = {name: runs.read_bronze(spark, lake.base, name) for name in DATASETS}
            tables = build_silver(spark, raw, lake, run_id(at))
            build_gold(spark, retained(spark, tables, lake, oldest), lake)
            runs.commit(spark, lake.base, taken, at, incremental.longest_minutes(tables["orders"]))
        elif taken.rows or taken.attempted:
            take_up(spark, lake, taken, at, oldest)
    if oldest is not None:
        path, first = lake.gold("deliveries"), f"{oldest:%Y%m%d}"
        folders.drop_days(spark, path, {d for d in folders.held_days(spark, path) if d != folders.UNDATED and d < first})


def retained(spark: SparkSession, tables: dict[str, DataFrame], lake: Lake, oldest: date | None) -> dict[str, DataFrame]:
    """Whole partitions beyond the retention are never opened."""
    if oldest is None:
        return tables
    return tables | {name: readers.read_layer(spark, lake.silver(name), since=oldest) for name in ("orders", "gps_events")}


def build_features(spark: SparkSession, tables: dict[str, DataFrame], lake: Lake) -> dict[str, tuple[DataFrame, str]]:
    """Feature snapshots, each with its dataset hash.

    The hash of the content is part of the path, so different tables of one size never meet; it
    needs all rows first, so they are computed once into the work folder and copied from there.
    """
    built = {
        "delay_model_features_v1": features.delay_features(tables["orders"], tables["drivers"], tables["weather"]),
        "eta_model_features_v1": features.eta_features(tables["orders"], tables["drivers"]),
        "driver_risk_features_v1": features.driver_risk_features(tables["orders"], tables["drivers"], tables["gps_events"]),
    }
    snapshots = {}
    for name, plan in built.items():
        table = materialize(plan, name)
        digest = content_hash(table).first()["content_hash"]
        snapshots[name] = (spark.read.parquet(writers.write_features(table, lake.features, name, digest)), digest)
    return snapshots


def check_quality(
    raw: dict[str, DataFrame], tables: dict[str, DataFrame], built: dict[str, DataFrame], lake: Lake, now: datetime,
    baseline: DataFrame | None = None, drifted: DataFrame | None = None,
) -> DataFrame:
    """All checks as one table, with a report and a log entry per check. ``drifted`` is the comparison with the run before, from
    stored distributions; a ``baseline`` is compared row by row."""
    orders, gps = tables["orders"], tables["gps_events"]
    checks = [
        quality.row_count(orders, "silver_orders", at_least=1),
        quality.row_count(gps, "silver_gps_events", at_least=1),
        quality.schema(gps, {c: "" for c in silver.GPS_COLUMNS}, "silver_gps_events"),
        quality.null_percentage(orders, "silver_orders"),
        quality.late_arrival_ratio(gps, orders),
        quality.freshness(gps, "event_timestamp", "silver_gps_events", now),
    ]
    if baseline is not None:
        drifted = feature_drift(built["deliveries"], baseline, MEASURED, "gold_deliveries")
    if drifted is not None:
        checks.append(drift_result(drifted, "gold_deliveries", MEASURED))
    counts = quality.stage_counts({"bronze_gps_events": raw["gps_events"], "silver_gps_events": gps, "gold_deliveries": built["deliveries"]})
    counts = materialize(counts, "stage-counts")  # one scan of each stage, read by the log and by the lineage check
    checks.append(quality.lineage_result(quality.lineage(counts, [("bronze_gps_events", "silver_gps_events")]), "silver_gps_events"))
    report = materialize(quality.report(checks, now), "quality")  # read by the log and by the report
    writers.append_log(
        report.select(
            F.col("check").alias("check_name"),
            F.col("stage").alias("dataset"),
            F.col("timestamp").alias("check_timestamp"),
            "status",
            F.col("check").alias("metric_name"),
            "metric_value",
            "threshold",
            F.to_json(F.struct("message")).alias("details"),
        ),
        lake.logs,
        "dq_metrics",
    )
    writers.append_log(
        counts.select("stage", F.col("stage").alias("dataset"), "row_count", instant(now).alias("record_timestamp")),
        lake.logs,
        "data_lineage",
    )
    return report


def drift_since_last(spark: SparkSession, deliveries: DataFrame, lake: Lake, run: str) -> DataFrame | None:
    """Store this run's distributions of gold and compare them with those of the run before; no row of an earlier snapshot is read."""
    path, own = f"{lake.base}/profiles/deliveries", materialize(sketches.distribution(deliveries, MEASURED), "profile")
    before = None
    if folders.exists(spark, path):
        known = spark.read.parquet(path).withColumn("run", F.col("run").cast("string")).where(F.col("run") < run)
        last = known.agg(F.max("run")).first()[0]
        before = None if last is None else known.where(F.col("run") == last)
    drifted = None if before is None else materialize(sketches.stored_drift(own, before), "drift")
    own.withColumn("run", F.lit(run)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    return drifted


def train_models(snapshots: dict[str, tuple[DataFrame, str]], lake: Lake, at: datetime) -> None:
    """The three models; the trained pipelines are kept by version and their metrics go to the run log."""
    version = run_id(at)
    delay, delay_hash = snapshots["delay_model_features_v1"]
    eta, eta_hash = snapshots["eta_model_features_v1"]
    risk, risk_hash = snapshots["driver_risk_features_v1"]
    delay_model, delay_result = models.train_delay_model(delay)
    eta_model, eta_result = models.train_eta_model(eta)
    models.save(delay_model, lake.models, models.DELAY_MODEL, version)
    models.save(eta_model, lake.models, models.ETA_MODEL, version)
    results = [
        (models.DELAY_MODEL, delay_hash, delay_result),
        (models.ETA_MODEL, eta_hash, eta_result),
        (models.RISK_MODEL, risk_hash, forest.risk_summary(forest.risk_anomalies(risk))),
    ]
    for name, digest, result in results:
        writers.append_log(models.run_record(name, version, digest, result, at), lake.logs, "model_runs")


def score_snapshots(spark: SparkSession, snapshots: dict[str, tuple[DataFrame, str]], lake: Lake) -> list[str]:
    """Predictions of the newest stored models for this run's snapshots, one folder per snapshot; models without a version are skipped."""
    log, written = writers.read_log(spark, lake.logs, "model_runs"), []
    for name, table in ((models.DELAY_MODEL, "delay_model_features_v1"), (models.ETA_MODEL, "eta_model_features_v1")):
        version = models.newest_version(log, name)
        if version is not None:
            rows, digest = snapshots[table]
            scored = models.score(rows, models.load(lake.models, name, version), name).withColumn("model_version", F.lit(version))
            written.append(writers.write_features(scored, f"{lake.base}/predictions", name, digest))
    return written


def run(spark: SparkSession, landing: str, base: str, at: datetime, with_models: bool = False,
        retention_days: int = RETENTION_DAYS) -> DataFrame:
    """One run over everything in ``landing``; returns the quality checks."""
    lake = Lake(base.rstrip("/"))
    raw = ingest_all(spark, landing, lake, at)
    oldest = at.date() - timedelta(days=retention_days)
    bring_up_to_date(spark, lake, at, oldest)
    tables = retained(spark, read_silver(spark, lake), lake, oldest)
    built = {name: spark.read.parquet(lake.gold(name)) for name in GOLD}
    snapshots = build_features(spark, tables, lake)
    checks = check_quality(raw, tables, built, lake, at, drifted=drift_since_last(spark, built["deliveries"], lake, run_id(at)))
    writers.write_report(checks, quality.summary(checks), f"{lake.base}/reports/{run_id(at)}")
    if with_models:
        train_models(snapshots, lake, at)
    score_snapshots(spark, snapshots, lake)
    return checks


def effectiveness(spark: SparkSession, base: str) -> DataFrame:
    """Bronze and silver row counts per dataset after a run."""
    lake = Lake(base.rstrip("/"))
    pairs = {"gps_events": "gps_events", "orders": "orders", "weather_events": "weather"}
    return dedup.dedup_effectiveness(
        {
            raw: (readers.read_layer(spark, f"{lake.base}/raw/{raw}"), readers.read_layer(spark, lake.silver(clean)))
            for raw, clean in pairs.items()
        }
    )


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--landing", required=True)
    parser.add_argument("--lake", required=True)
    parser.add_argument("--models", action="store_true")
    args = parser.parse_args()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    checks = run(build_session("waybill-daily"), args.landing, args.lake, now, args.models)
    quality.summary(checks).show(truncate=False)


if __name__ == "__main__":
    main()
