from pyspark.sql import functions as F

from waybill.llm.frequent import most_frequent


def test_levels(spark):
    rows = [(k, 1 + k // 3) for k in range(300)] + [(1000, 5000), (1001, 1)]
    counts = spark.createDataFrame(rows, "word long, c long").repartition(7)
    for most in (0, 1, 10, 50, 1000):
        got = most_frequent(counts, "word", "c", most)
        assert len(got) <= most and len(got) >= min(most, len(rows)) * 0.6 - 4
        left = [c for k, c in rows if k not in set(got["word"])]
        assert got["c"].is_monotonic_decreasing and (not len(got) or not left or got["c"].min() > max(left))
    first = most_frequent(counts, "word", "c", 5, F.col("word") == 1001)
    assert first["word"][0] == 1001 and len(first) <= 6
    assert len(most_frequent(counts.limit(0), "word", "c", 5)) == 0
