"""Digests of rows, datasets and files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINGERPRINT_LENGTH = 16


def _json_value(name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        value = value.cast("string")
    # the text after the colon of a one-field object is the JSON form of the value
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(6), F.length(text) - 6)


def canonical_json(df: DataFrame, names: list[str] | None = None) -> Column:
    """One JSON object per row, keys in order, ``", "`` and ``": "`` as separators.

    Equal to a key-sorted JSON dump for text in ASCII, integers, booleans and nulls.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [
        F.concat(F.lit(f'"{name}": '), _json_value(name, kinds[name]))
        for name in sorted(names or df.columns)
    ]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def row_signature(df: DataFrame, names: list[str] | None = None) -> Column:
    """SHA-256 of a row's canonical JSON."""
    return F.sha2(canonical_json(df, names), 256)


def dataset_fingerprint(df: DataFrame) -> DataFrame:
    """Shape digest: row count, column count and the short hash over both."""
    width = len(df.columns)
    shape = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(width))
    text = F.concat_ws("_", "n_rows", "n_columns", "n_rows")
    return shape.withColumn(
        "dataset_hash", F.substring(F.sha2(text, 256), 1, FINGERPRINT_LENGTH)
    )


def _canonical_text(name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.round(value, 6).cast("decimal(38,6)")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    text = value.cast("string")
    # the length in front keeps texts with separators, and a null from the text of a null's mark, apart
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))


def _row_digest(df: DataFrame) -> Column:
    """The first 60 bits of an MD5 over canonical texts, so any engine can redo it."""
    texts = [_canonical_text(f.name, f.dataType) for f in sorted(df.schema.fields, key=lambda f: f.name)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("decimal(28,0)")


def _content(digest: Column) -> list[Column]:
    """Row count and sum of row digests: order-insensitive, combined in the map tasks. The 19-digit digests are summed as 38-digit
    decimals, which 10^19 rows cannot overflow."""
    total = F.coalesce(F.sum(digest), F.lit(0)).cast("decimal(38,0)").cast("string")
    return [F.count(F.lit(1)).alias("n_rows"), total.alias("content_hash")]


def content_hash(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a table's content: one map-side combined sum of row digests."""
    return df.agg(*_content(_row_digest(df)))


# levels of a digest tree, each label a prefix of those below it
LEVELS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd"}
UNDATED = "undated"


def digest_tree(df: DataFrame, ts: str) -> DataFrame:
    """(level, label, n_rows, digest): the content of every day, month and year of a table, a snapshot's small companion.

    A day's digest is that of its rows; a month's follows from its days' and a year's from its months', so the table is read once.
    Rows without a date are a day, month and year of their own.
    """
    day = F.coalesce(F.date_format(ts, LEVELS["day"]), F.lit(UNDATED))
    rows = df.select(day.alias("label"), _row_digest(df).alias("__digest"))
    tree = below = rows.groupBy("label").agg(*_content(F.col("__digest"))).select(F.lit("day").alias("level"), "label", "n_rows", F.col("content_hash").alias("digest"))
    for level, size in (("month", 7), ("year", 4)):
        children = F.sort_array(F.collect_list(F.concat_ws(":", "label", "n_rows", "digest")))  # the days of a month, the months of a year
        label = F.when(F.col("label") == UNDATED, UNDATED).otherwise(F.substring("label", 1, size))
        below = below.groupBy(label.alias("label")).agg(F.sum("n_rows").alias("n_rows"), F.sha2(F.array_join(children, "|"), 256).alias("digest"))
        below = below.select(F.lit(level).alias("level"), "label", "n_rows", "digest")
        tree = tree.unionByName(below)
    return tree


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """(label, change, rows_before, rows_after): the days in which two digest trees differ: added, removed or changed.

    From the years down: months are compared in years that differ, days in such months, so equal branches of stored trees are passed
    over as a whole.
    """
    branch, parent = None, F.col("label")
    for level, size in (("year", 4), ("month", 7), ("day", 10)):
        old, new = (t.where(F.col("level") == level).select("label", F.col("n_rows").alias(n), F.col("digest").alias(d)) for t, n, d in ((before, "rows_before", "d_old"), (after, "rows_after", "d_new")))
        if branch is not None:
            old, new = (t.join(branch, parent == F.col("__branch"), "left_semi") for t in (old, new))
        differ = old.join(new, "label", "full").where("NOT (d_old <=> d_new)")
        branch = differ.select(F.col("label").alias("__branch"))
        parent = F.when(F.col("label") == UNDATED, UNDATED).otherwise(F.substring("label", 1, size))
    change = F.when(F.col("d_old").isNull(), "added").when(F.col("d_new").isNull(), "removed").otherwise("changed")
    return differ.select("label", change.alias("change"), "rows_before", "rows_after")


FILE_HASHES = "path string, length long, sha256 string"
WHOLE, PIECE = 64 << 20, 1 << 20  # bytes: of the longest file that is read as one value, and of a longer one that are read at a time
MAX_LENGTH = "spark.sql.sources.binaryFile.maxLength"


def _hash_local(piece: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A step that hashes files which a task opens itself."""

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, length in zip(frame["path"], frame["length"], strict=True):
                digest = hashlib.sha256()
                with open(re.sub("^file:(//(?=/))?", "", path), "rb") as file:
                    while part := file.read(piece):
                        digest.update(part)
                yield pd.DataFrame({"path": [path], "length": [length], "sha256": [digest.hexdigest()]})

    return step


def _hash_stored(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Hashes of files in a store that only the JVM opens: read as streams by the driver, since a task's Python has no JVM."""
    jvm, rows = spark._jvm, []
    for path, length in files.collect():
        folder = jvm.org.apache.hadoop.fs.Path(path)
        stream = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).open(folder)
        try:
            rows.append((path, length, jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)))
        finally:
            stream.close()
    return spark.createDataFrame(rows, FILE_HASHES)


def file_hashes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of every file below a path, whatever the store and the file's length.

    Short files are values of Spark's own file layer. A longer file, which Spark would hold whole or refuse, is read in pieces; its hash
    is one chain over its bytes, so one task reads all of it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    short = F.col("length") <= min(WHOLE, int(spark.conf.get(MAX_LENGTH)))  # the listing tells, before a file is opened
    hashed = files.where(short).select("path", "length", F.sha2("content", 256).alias("sha256"))
    long = files.where(~short).select("path", "length")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getUri().getScheme() != "file":
        return hashed.unionByName(_hash_stored(spark, long))
    return hashed.unionByName(long.repartition(spark.sparkContext.defaultParallelism).mapInPandas(_hash_local(PIECE), FILE_HASHES))
