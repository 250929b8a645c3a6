"""Token ids as Parquet files (operator 8).

One row per document in ascending doc_id order: `doc_id`, `part` (the file's place in that order), `start_in_part`, `n_tokens` and
`ids`, a list of integers. Ids are written with a dictionary (or delta packed), in row groups and pages of set sizes; Parquet's
column and page indexes let a reader skip to the rows of some documents, and a reader of the small columns never touches the ids.

The ids are those of the tokenizers library called on the whole text without adding special tokens: where a text itself holds the
name of a special token, it is that token's one id.

Null or empty texts have only the end id. Rows that repeat a doc_id are all kept, ordered by text; rows without doc_id come first.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waybill.llm.bpe import encoder
from waybill.llm.text import chunks

END_ID = 0
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 20_000


def options(encoding: str = "dictionary", row_group: int = ROW_GROUP_BYTES, page: int = PAGE_BYTES) -> dict[str, str]:
    """Writer options: ids as places in a dictionary, or as differences in packed blocks."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    return {
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.writer.version": "v1" if encoding == "dictionary" else "v2",
        "parquet.block.size": str(row_group),
        "parquet.page.size": str(page),
        "parquet.page.row.count.limit": str(PAGE_ROWS),
        "compression": "zstd",
    }


@functools.cache
def plain(path: str) -> tuple[Tokenizer | None, list[str]]:
    """The library's own tokenizer of a file, and the names of its special tokens; rank files have none."""
    if not path.endswith(".json"):
        return None, []
    made = Tokenizer.from_file(path)
    return made, [token.content for token in made.get_added_tokens_decoder().values()]


def as_the_library(path: str, texts: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of all rows, those that hold the name of a special token encoded whole by the library."""
    tokenizer, names = plain(path)
    named = np.zeros(len(texts), bool)
    for name in names:
        named |= pc.fill_null(pc.match_substring(texts, name), False).to_numpy(zero_copy_only=False)
    if not named.any():
        return ids, bounds
    rows = [ids[a:b] for a, b in itertools.pairwise(bounds.tolist())]
    for i in np.flatnonzero(named).tolist():
        rows[i] = np.array(tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, ids.dtype)
    return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


def encoded(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """The rows of the files, ranged and sorted by doc_id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, upto = encoder(path), TaskContext.get().partitionId(), 0
        for batch in chunks(batches):
            ids, bounds, _, _ = coder.rows(batch.column("text"))
            ids, bounds = as_the_library(path, batch.column("text"), ids, bounds)
            if end_id is not None:
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(upto + bounds[:-1]), pa.array(n), lists],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )
            upto += int(bounds[-1])

    return texts.mapInArrow(run, f"doc_id {kind}, part int, start_in_part long, n_tokens long, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer: str, encoding: str = "dictionary", end_id: int | None = END_ID) -> None:
    encoded(docs, tokenizer, end_id).write.options(**options(encoding)).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_documents(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """The documents low <= doc_id <= high: row groups and pages outside that range are skipped by their indexes."""
    return read(spark, path).where(F.col("doc_id").between(low, high))


def starts(files: DataFrame) -> DataFrame:
    """Per part: the number of ids in all parts before it. One row per file goes through the window."""
    total = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return total.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def checked(files: DataFrame) -> DataFrame:
    """Per document, from the files: its place in the stream of all ids, their number, and their CRC-32 as little-endian 32-bit."""
    kind = files.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            bounds = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            columns = [batch.column(c) for c in ("doc_id", "part", "start_in_part")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(bounds).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])

    rows = files.select("doc_id", "part", "start_in_part", "ids").mapInArrow(run, f"doc_id {kind}, part int, start_in_part long, n_tokens long, ids_crc32 long")
    return rows.join(starts(files), "part").select("doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


