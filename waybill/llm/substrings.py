"""Substring dedup (operator 1): a De Bruijn graph of word k-mers, compacted, whose repeated edges mark repeated text.

An edge is a window of WINDOW words, from the node of its first WINDOW - 1 words to that of its last. A document is a walk.

1. Paths. In each window the k-mer of ANCHOR words with the smallest hash is its anchor. A run of windows with one anchor is a
   path of edges: all that equal windows anywhere need to meet is their anchor, so about 20 edges travel as one row.
2. Repeats. Anchors that occur in two documents or more are joined back to the paths; the others are done.
3. Compaction. An anchor that lies in one and the same path wherever it occurs doesn't branch: its path is one compacted edge, and
   the smallest document that holds it settles all of its windows at once. Where paths differ the graph branches: one occurrence
   of each distinct path is opened again at its source coordinates, its edges are grouped, and each edge's smallest document goes
   back to the paths.
4. Verification. Paths, settled or opened, are joined to all occurrences; the coordinates of each document's removed windows are
   laid over its whole text.

Every group is combined before it is shuffled and comes back by a join that Spark may split, so a passage that a third of all
documents share is no single task's work. Hashes have 64 bits (see text.py). Windows are judged on the input.

Null texts have no words. A row without doc_id is compared with nothing. Rows that repeat a doc_id are one document: they never
remove each other's words, and each row is returned.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.text import chunks, hash_ranges, hash_spans, hash_windows, signed, utf8, whole_windows, words
from waybill.session import materialize

WINDOW, ANCHOR = 50, 12
BLOCK = 1 << 23  # windows taken at once: positions in a block fit 24 bits


def smallest(anchors: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` following anchors, the place of the smallest, the first of equal ones (by 40 bits of the hash)."""
    out = []
    for start in range(0, len(anchors) - width + 1, BLOCK):
        part = anchors[start : start + BLOCK + width - 1]
        keys = (part & ~np.uint64(0xFFFFFF)) | np.arange(len(part), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            keys = np.minimum(keys[:-size], keys[size:])
            size *= 2
        if size < width:
            keys = np.minimum(keys[: len(keys) - (width - size)], keys[width - size :])
        out.append((keys & np.uint64(0xFFFFFF)).astype(np.int64) + start)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def paths_of(hashes: np.ndarray, first: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(anchor's hash, path's hash, row, first window, windows) of every path."""
    valid = np.flatnonzero(whole_windows(first, window))
    if not len(valid):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    anchors = hash_windows(hashes, anchor)
    place = smallest(anchors, window - anchor + 1)[valid]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(valid) != 1) | (np.diff(place) != 0)]))
    starts, count = valid[new], np.diff(np.append(new, len(valid)))
    row = np.searchsorted(first, starts, side="right") - 1
    return anchors[place[new]], hash_ranges(hashes, starts, starts + count + window - 1), row, starts - first[row], count


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a hash of the text: with doc_id the key of a row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("content"))


def path_table(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, path, doc_id, content, start, n) of every path of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            offsets, data = utf8(batch.column("text"))
            starts, ends, first = words(offsets, data)
            key, path, row, start, n = paths_of(hash_spans(data, starts, ends), first, window, anchor)
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key)), pa.array(signed(path)), batch.column("doc_id").take(own), batch.column("content").take(own), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["anchor", "path", "doc_id", "content", "start", "n"],
            )

    return docs.where("doc_id is not null").mapInArrow(run, f"anchor long, path long, doc_id {kind}, content long, start int, n int")


def edges_of(docs: DataFrame, opened: DataFrame, window: int) -> DataFrame:
    """(edge, anchor, path, at, doc_id) of each window of the paths to open, read again at their source coordinates."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = opened.groupBy("doc_id", "content").agg(F.collect_list(F.struct("start", "n", "anchor", "path")).alias("own"))
    source = docs.where("doc_id is not null").join(lists, ["doc_id", "content"]).select("doc_id", "text", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            offsets, data = utf8(batch.column("text"))
            starts, ends, first = words(offsets, data)
            edges = hash_windows(hash_spans(data, starts, ends), window)
            lists = batch.column("own")
            own = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            begin, n, anchor, path = (own.field(i).to_numpy() for i in range(4))
            which = np.repeat(np.arange(len(row)), n)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            edge = edges[(first[row] + begin)[which] + at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(edge)), pa.array(anchor[which]), pa.array(path[which]), pa.array(at.astype(np.int32)), batch.column("doc_id").take(pa.array(row[which]))],
                names=["edge", "anchor", "path", "at", "doc_id"],
            )

    return source.mapInArrow(run, f"edge long, anchor long, path long, at int, doc_id {kind}")


def removed_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, content, spans): per row with repeated windows, the first word and the number of windows of each run of them."""
    docs = keyed(docs)
    every = materialize(path_table(docs, window, anchor), "paths")
    repeated = every.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    met = materialize(every.join(repeated, "anchor"), "repeated")
    distinct = materialize(met.groupBy("anchor", "path").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.max("n").alias("n")), "distinct")
    branches = distinct.groupBy("anchor").agg(F.count("*").alias("paths"))
    distinct = distinct.join(branches, "anchor")
    whole = distinct.where("paths = 1 and low < high").select("anchor", "path", "low")
    several = distinct.where("paths > 1").select("anchor", "path", "low", "high", "n")
    source = met.select("anchor", "path", F.col("doc_id").alias("low"), "content", "start").join(several, ["anchor", "path", "low"])
    source = source.groupBy("anchor", "path", F.col("low").alias("doc_id"), "content", "n").agg(F.min("start").alias("start"))
    edges = materialize(edges_of(docs, source, window), "edges")
    earliest = edges.groupBy("edge").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("most"), F.count("*").alias("times")).where("times > 1").select("edge", "low")
    settled = edges.join(earliest, "edge").groupBy("anchor", "path").agg(F.collect_list(F.struct("at", "low")).alias("edges"))
    # An edge of one path only is settled by that path's own smallest document.
    opened = several.where("low < high").join(settled, ["anchor", "path"], "full").select("anchor", "path", "low", "n", "edges")
    found = met.join(whole, ["anchor", "path"]).where("low < doc_id").select("doc_id", "content", F.array(F.struct("start", "n")).alias("spans"))
    single = F.transform(F.filter("edges", lambda e: e["low"] < F.col("doc_id")), lambda e: F.struct((F.col("start") + e["at"]).alias("start"), F.lit(1).alias("n")))
    spans = F.when(F.col("low") < F.col("doc_id"), F.array(F.struct("start", "n"))).otherwise(F.coalesce(single, F.array().cast("array<struct<start:int,n:int>>")))
    more = met.join(opened.drop("n"), ["anchor", "path"]).select("doc_id", "content", spans.alias("spans")).where("size(spans) > 0")
    return found.unionByName(more).groupBy("doc_id", "content").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def kept_words(text: bytes, own: list | None, window: int) -> tuple[int, int, bytes]:
    """(words, words removed, the kept ones joined by one space)."""
    found = text.split()  # ASCII white space only: x20 and x09 to x0D
    if not own:
        return len(found), 0, b" ".join(found)
    change = np.zeros(len(found) + 1, np.int64)
    start = np.array([s["start"] for s in own])
    np.add.at(change, start, 1)
    np.add.at(change, start + np.array([s["n"] for s in own]) + window - 1, -1)
    kept = np.cumsum(change[:-1]) == 0
    return len(found), len(found) - int(kept.sum()), b" ".join(itertools.compress(found, kept.tolist()))


def deduplicated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, texts: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256; with `texts` the kept words as `kept` too."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = keyed(docs).join(removed_windows(docs, window, anchor), ["doc_id", "content"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            offsets, data = utf8(batch.column("text"))
            raw = data.tobytes()
            rows = [kept_words(raw[a:b], own, window) for a, b, own in zip(offsets.tolist(), offsets[1:].tolist(), batch.column("spans").to_pylist(), strict=False)]
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string())]
            columns += [pa.array([r[2].decode() for r in rows], pa.string())] if texts else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])])

    return source.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)
