import hashlib
import json
import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waybill.functions import digests, geo, lookups, timing


def values(df, *names):
    rows = df.collect()
    return [r[names[0]] if len(names) == 1 else tuple(r[n] for n in names) for r in rows]


@pytest.mark.parametrize(
    "actual, expected, delay, late, on_time, traffic",
    [
        (15, 10, 5, 0, 1, 5.0),
        (16, 10, 6, 1, 0, 6.0),
        (5, 10, -5, 0, 1, 0.0),
        (50, 10, 40, 1, 0, 10.0),
        (None, 10, None, 0, 0, None),
        (3, 0, 3, 0, 1, 10.0),
        (-3, 0, -3, 0, 1, 0.0),
        (0, 0, 0, 0, 1, None),
        (9, 8, 1, 0, 1, 1.2),  # 1.25: a tie goes to the even digit
    ],
)
def test_delay_rules(spark, actual, expected, delay, late, on_time, traffic):
    df = spark.createDataFrame([(actual, expected)], "a int, e int")
    d = timing.delay_minutes("a", "e")
    row = df.select(
        d.alias("d"), timing.delay_flag(d).alias("f"), timing.on_time_flag(d).alias("o"),
        timing.traffic_score("a", "e").alias("t"),
    ).first()
    assert (row.d, row.f, row.o) == (delay, late, on_time)
    assert row.t == traffic if traffic is None else row.t == pytest.approx(traffic)


REGIONS = [
    (40.76, -73.8, "North_East"), (40.75, -73.8, "Central_East"), (40.65, -73.9, "Central_West"),
    (40.64, -73.9, "South_West"), (40.7, -73.85, "Central"), (None, -73.9, "Central_West"),
    (40.8, None, "North"), (float("nan"), float("nan"), "Central"),
]


def test_region_boundaries(spark):
    df = spark.createDataFrame([r[:2] for r in REGIONS], "lat double, lon double")
    assert values(df.select(geo.assign_region("lat", "lon").alias("r")), "r") == [r[2] for r in REGIONS]


def test_sql_functions_equal_expressions(spark):
    geo.register_sql_functions(spark)
    df = spark.createDataFrame([r[:2] for r in REGIONS], "lat double, lon double")
    df.createOrReplaceTempView("points")
    assert values(spark.sql("SELECT assign_region(lat, lon) AS r FROM points"), "r") == [r[2] for r in REGIONS]
    row = spark.sql("SELECT haversine_km(40.7, -74.0, 40.8, -73.9) AS k").first()
    other = spark.range(1).select(
        geo.haversine_km(F.lit(40.7), F.lit(-74.0), F.lit(40.8), F.lit(-73.9)).alias("k")
    ).first()
    assert row.k == pytest.approx(other.k)


def test_haversine_against_definition(spark):
    cases = [(40.7, -74.0, 40.8, -73.9), (0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0)]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double")
    got = values(df.select(geo.haversine_km("a", "b", "c", "d").alias("k")), "k")
    for (a, b, c, d), k in zip(cases, got):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        assert k == pytest.approx(2 * 6371 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h))), abs=1e-6)
    none = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert none.select(geo.haversine_km("a", "b", "c", "d").alias("k")).first().k is None


def test_route_complexity_is_capped_and_keeps_null(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.3, 0.4), (0.0, 0.0, 30.0, 40.0), (None, 0.0, 1.0, 1.0)],
                               "a double, b double, c double, d double")
    got = values(df.select(geo.route_complexity("a", "b", "c", "d").alias("x")), "x")
    assert got[0] == pytest.approx(5.55) and got[1] == 10.0 and got[2] is None


def test_calendar_parts(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 7, 59, 59),), (datetime(2024, 1, 7, 10),)], "t timestamp")
    got = df.select(
        timing.day_of_week("t").alias("d"), timing.hour_floor("t").alias("h"), timing.is_peak_hour(F.hour("t")).alias("p")
    ).collect()
    assert [(r.d, r.p) for r in got] == [(0, 1), (6, 0)]
    assert got[0].h == datetime(2024, 1, 1, 7)


def test_lateness(spark):
    rows = [
        (datetime(2024, 1, 1, 1, 0, 1), datetime(2024, 1, 1), 60),
        (datetime(2024, 1, 1, 1, 0, 0), datetime(2024, 1, 1), 60),
        (datetime(2024, 1, 1, 2), datetime(2024, 1, 1), None),
        (datetime(2024, 1, 1, 1, 16), datetime(2024, 1, 1), 60),
    ]
    df = spark.createDataFrame(rows, "e timestamp, c timestamp, m int")
    end = timing.delivered_at("c", "m")
    assert values(df.select(timing.is_late("e", end).alias("l")), "l") == [True, False, False, True]
    assert values(df.select(timing.is_late("e", end, 15).alias("l")), "l") == [False, False, False, True]


def test_partition_paths_and_ids(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 15, 3, 4, 5),)], "t timestamp")
    depths = ["year/month/day", "year/month", "year"]
    got = [df.select(timing.partition_path("t", d).alias("p")).first().p for d in depths]
    assert got == ["year=2024/month=01/day=15", "year=2024/month=01", "year=2024"]
    assert df.select(timing.run_id_of("t").alias("i")).first().i == "20240115030405" == timing.run_id(datetime(2024, 1, 15, 3, 4, 5))


def test_iso_text_round_trip(spark):
    texts = ["2024-01-01T00:00:00", "2024-01-01T00:00:00.123456"]
    df = spark.createDataFrame([(t,) for t in texts] + [("nonsense",)], "s string")
    parsed = df.select(timing.parse_iso("s").alias("t"))
    assert values(parsed.select(timing.iso_text("t").alias("s")), "s") == [*texts, None]


def test_naive_local_times_become_utc(spark):
    df = spark.createDataFrame([("2024-07-01 12:00:00",)], "t string")
    assert timing.to_utc(df, "t").first().t == datetime(2024, 7, 1, 12)
    assert timing.to_utc(df, "t", "America/New_York").first().t == datetime(2024, 7, 1, 16)


def test_lookups(spark):
    df = spark.createDataFrame([("bike",), ("plane",)], "v string")
    got = values(df.select(lookups.weather_sensitivity("v").alias("s"), lookups.accident_risk("v").alias("r")), "s", "r")
    assert got == [(0.15, 0.005), (None, None)]
    storm = spark.createDataFrame([("storm",)], "w string").select(lookups.weather_severity("w").alias("s")).first()
    assert storm.s == 5


def test_row_signature_is_the_hash_of_sorted_json(spark):
    df = spark.createDataFrame([("test", 123, None, True), ('q"x\\', -1, "y", False)], "name string, value int, note string, ok boolean")
    got = values(df.select(digests.row_signature(df).alias("s")), "s")
    for row, signature in zip(df.collect(), got):
        assert signature == hashlib.sha256(json.dumps(row.asDict(), sort_keys=True).encode()).hexdigest()
    assert got[0] != got[1]


def test_fingerprint_and_content_hash(spark):
    a = spark.createDataFrame([(1, 2.0), (2, None)], "k int, v double")
    b = spark.createDataFrame([(2, None), (1, 2.0)], "k int, v double")
    c = spark.createDataFrame([(2, None), (1, 2.5)], "k int, v double")
    assert digests.dataset_fingerprint(a).first().dataset_hash == hashlib.sha256(b"2_2_2").hexdigest()[:16]
    one, two, three = (digests.content_hash(x).first().content_hash for x in (a, b, c))
    assert one == two != three
    assert digests.content_hash(a.limit(0)).first().content_hash == "0"


def test_file_hashes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    contents = {"a.bin": b"hello", "sub/b c.bin": b"x" * 3_000_000}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.split(tmp_path.name + "/")[1].replace("%20", " "): r.sha256 for r in digests.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256(d).hexdigest() for n, d in contents.items()}



def test_file_hashes_of_files_beyond_the_limit(spark, tmp_path, monkeypatch):
    (tmp_path / "in/sub").mkdir(parents=True)
    contents = {"a.bin": b"hello", "edge.bin": b"y" * 1000, "sub/b c%20d.bin": bytes(range(256)) * 13}
    for name, data in contents.items():
        (tmp_path / "in" / name).write_bytes(data)
    monkeypatch.setattr(digests, "PIECE", 100)
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.hashes.link./in", f"file://{tmp_path}/in")
    spark.conf.set(digests.MAX_LENGTH, "1000")
    try:
        for path in (str(tmp_path / "in"), f"file://{tmp_path}/in", "viewfs://hashes/in"):
            got = {r.path.split("/in/")[1]: (r.length, r.sha256) for r in digests.file_hashes(spark, path, "*.bin").collect()}
            assert got == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    finally:
        spark.conf.unset(digests.MAX_LENGTH)
