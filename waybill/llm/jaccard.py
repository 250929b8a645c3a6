"""N-gram Jaccard join (operator 4): vertical partitioning of a global order of n-grams.

Documents with equal sets of shingles are one node; everything below is about different sets.

* Order and fragments. Shingles are ordered by hash, and the order is cut into fragments of equal width. Two sets of n and m shingles
  at the threshold differ in at most K = (100 - PERCENT) * (n + m) / (100 + PERCENT) shingles, so of K + 1 + t fragments at least
  t + 1 hold the same shingles in both sets. The hash of a whole fragment is therefore a key that linked sets share.
* Sizes. A set takes part in its own class of sizes and in the next one: sizes that may be similar enough lie in one class or in
  neighbours, and K follows from the largest size of the class.
* Frequent shingles. Those of more than OFTEN sets (the HOT most frequent at most; a table of fixed size) make no key of their
  own: a fragment without any other counts as empty. A set with more than t empty fragments adds the shingles of its prefix in the
  order that puts frequent ones last; two such sets meet there, so no link is lost.
* Bounds. Sizes, the parities of PARITIES classes of hashes (shingles that differ change one each), and the smaller of the two
  counts in each of FRAGMENTS fragments bound the overlap from above; what can't reach the threshold is dropped, and no link with it.
* Partial overlaps. For a pair, the common shingles are counted in each of PIECES fragments of the order on its own, and summed per
  pair.
* Groups. A group of near copies isn't compared pair by pair. In each of ROUNDS rounds every entry is paired with HUBS hubs of its
  bucket, and verified links merge nodes into components; pairs within a component need no look. Then the entries outside a bucket's
  largest component are verified with all of other components: in buckets of more than CROWDED entries a pair is made once, in the
  least such bucket that both are in, as far as the LEAST first ones of each tell.

A document without words, or without doc_id, is linked with nothing; null texts are empty. Rows that repeat a doc_id are each judged
by their own text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.frequent import most_frequent
from waybill.llm.text import chunks, hash_ranges, hash_spans, hash_windows, lower_ascii, mix, signed, utf8, words
from waybill.session import materialize

HOT = 1 << 18
COUNTED = 1 << 21  # shingles among which a task looks for repeats at once
OFTEN = 1024  # sets that a frequent shingle is in
ROUNDS, HUBS = 2, 4
CROWDED, LEAST = 16, 16
FRAGMENTS, PIECES = 256, 16
PARITIES = 256
WORDS = [f"p{i}" for i in range(PARITIES // 64)]
BITS = 48  # of a hash, besides the piece it is in, by which shingles of a pair are compared
FILTER_BITS = 24  # the filter of the nodes of a round has this power of two of bits


def sets_of(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words has one for the whole of it."""
    offsets, data = utf8(column)
    data = lower_ascii(data)
    starts, ends, first = words(offsets, data)
    hashes = hash_spans(data, starts, ends)
    grams, whole = hash_windows(hashes, size), hash_ranges(hashes, first[:-1], first[1:])
    return [np.unique(grams[a : b - size + 1]) if b - a >= size else whole[r : r + (b > a)] for r, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist(), strict=False))]


def set_key(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def summaries(docs: DataFrame, size: int) -> DataFrame:
    """One table of two kinds of rows: (doc_id, content, node, n, counts by fragment, parities) of each document, and (shingle, times) of the
    shingles that three of a task's distinct sets held."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def often() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            values, times = values[times > 2], times[times > 2]
            none = pa.nulls(len(values))
            made = pa.RecordBatch.from_arrays([none.cast(kinds), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.binary()), *[none.cast(pa.int64())] * len(WORDS), pa.array(signed(values)), pa.array(times)], names=NAMES)
            held.clear()
            seen.clear()
            return made

        for batch in chunks(batches):
            kinds = batch.column("doc_id").type
            own = sets_of(batch.column("text"), size)
            nodes = [set_key(s) for s in own]
            for s, k in zip(own, nodes, strict=True):
                if k not in seen:
                    seen.add(k)
                    held.append(s)
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("content"), pa.array(nodes, pa.int64()), pa.array([len(s) for s in own], pa.int32()), pa.array(map(fragment_counts, own), pa.binary()), *map(pa.array, parities(own).T), none.cast(pa.int64()), none.cast(pa.int64())], names=NAMES)
            if sum(map(len, held)) > COUNTED:
                yield often()
        if held:
            yield often()

    return docs.mapInArrow(run, f"doc_id {kind}, content long, node long, n int, counts binary, {', '.join(w + ' long' for w in WORDS)}, shingle long, times long")


NAMES = ["doc_id", "content", "node", "n", "counts", *WORDS, "shingle", "times"]


def fragment_counts(own: np.ndarray) -> bytes:
    return np.minimum(np.bincount((own >> np.uint64(56)).astype(np.int64), minlength=FRAGMENTS), 255).astype(np.uint8).tobytes()


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """Whether each class of hashes holds an odd number of a set's shingles, as rows of 64-bit words."""
    bits = np.array([np.bincount((s & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1 for s in sets], np.uint8).reshape(-1, PARITIES)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1, PARITIES // 64)


def ordered(own: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The set in the global order: by hash, then the hot ones by their rank."""
    if not len(hot[0]):
        return own
    at = np.minimum(np.searchsorted(hot[0], own), len(hot[0]) - 1)
    frequent = hot[0][at] == own
    return np.concatenate([own[~frequent], own[frequent][np.argsort(hot[1][at[frequent]], kind="stable")]])


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


@lru_cache
def size_classes(percent: int) -> np.ndarray:
    """The largest size of each class. 100 / percent times a size lies in its own class or in the next."""
    largest = [1]
    while largest[-1] < 1 << 40:
        largest.append(max(largest[-1] + 1, 100 * largest[-1] // percent))
    return np.array(largest)


def fragments_of(largest: int, percent: int) -> tuple[int, int]:
    """(fragments, spare ones) for sets of at most `largest` shingles: one more than two linked sets can differ in, and twice as
    many spare ones as fragments of a set in the middle of the sizes that meet here are empty."""
    differ = 2 * largest * (100 - percent) // (100 + percent)
    share = 2 * (100 - percent) / (100 + percent)
    spare = 1 + math.ceil(2 * share * math.exp(-((percent / 100) ** 1.5) / share) * largest)
    return (differ + 1 + spare, spare) if differ else (0, 0)


def keys_of(own: np.ndarray, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, bool]]:
    """(keys, whether of the next class) of a set in its own class of sizes and in the next one."""
    held, mixed = own[:0], mix(own)
    if len(hot[0]):
        held = hot[0][np.minimum(np.searchsorted(hot[0], own), len(hot[0]) - 1)]
    rare = held != own if len(held) else np.ones(len(own), bool)
    at = int(np.searchsorted(size_classes(percent), len(own)))
    for upper in (False, True):
        number, spare = fragments_of(int(size_classes(percent)[at + upper]), percent)
        if not number:  # sets this small are linked only if they are equal
            continue
        salt = mix(np.array([at + upper], np.uint64))
        fragment = ((own >> np.uint64(32)) * np.uint64(number)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
        told = np.logical_or.reduceat(rare, starts)
        yield mix(mix(np.add.reduceat(mixed, starts) + salt) + fragment[starts])[told], upper
        if number - int(told.sum()) > spare:
            yield mix(ordered(own, hot)[: prefix_length(len(own), percent)] ^ ~salt), upper


def entries(docs: DataFrame, size: int, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, node, upper) of every key of every set, once a task; `upper` in the class of sizes above its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            keys, nodes, counts, uppers = [], [], [], []
            for own in sets_of(batch.column("text"), size):
                node = set_key(own)
                if len(own) and node not in seen:
                    seen.add(node)
                    for found, upper in keys_of(own, percent, hot):
                        keys.append(found)
                        nodes.append(node)
                        counts.append(len(found))
                        uppers.append(upper)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(keys))), pa.array(np.repeat(np.array(nodes, np.int64), counts)), pa.array(np.repeat(np.array(uppers), counts))], names=["key", "node", "upper"])

    return docs.select("text").mapInArrow(run, "key long, node long, upper boolean")


def met(entries: DataFrame) -> DataFrame:
    """The entries whose key two different nodes hold, one of them in its own class of sizes. They are dealt by key once; counting and
    joining read the same exchange."""
    dealt = entries.repartition("key")
    shared = dealt.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.min("upper").alias("z")).where("x <> y and not z").select("key")
    return dealt.join(shared.hint("shuffle_hash"), "key").dropDuplicates(["key", "node"])


def possible(percent: int) -> Column:
    """Sizes and parities allow the threshold, and this is the class of sizes in which the two are to be compared."""
    n, m = F.col("s.n"), F.col("t.n")
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"s.{w}").bitwiseXOR(F.col(f"t.{w}"))) for w in WORDS])
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ~(F.col("s.upper") & F.col("t.upper")) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def across(live: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket. Two nodes meet in one class of sizes only, so buckets of a node are
    told apart by `upper`. If the lists of two nodes meet, the least bucket in both is the least that the two share."""
    held = live.groupBy("key", "root").count().groupBy("key").agg(F.max_by("root", F.struct("count", "root")).alias("largest"), (F.sum("count") > CROWDED).alias("crowded"))
    own = live.join(held, "key")
    least = own.where("crowded").groupBy("node", "upper").agg(F.slice(F.sort_array(F.collect_set("key")), 1, LEAST).alias("least"))
    own = own.join(least, ["node", "upper"], "left").withColumn("least", F.when(F.col("crowded"), F.col("least"))).join(sketches.drop("counts"), "node")
    fewer = own.where("root <> largest")
    once = (F.col("t.root") == F.col("t.largest")) | (F.col("s.node") < F.col("t.node"))
    here = F.coalesce(F.array_min(F.array_intersect("s.least", "t.least")), F.col("s.key")) == F.col("s.key")
    both = fewer.alias("s").join(own.alias("t"), (F.col("s.key") == F.col("t.key")) & (F.col("s.root") != F.col("t.root")) & once & possible(percent) & here)
    return both.select(F.least("s.node", "t.node").alias("a"), F.greatest("s.node", "t.node").alias("b"))


def place_of(nodes: np.ndarray) -> np.ndarray:
    return (mix(nodes.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def filter_of(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds all of the column `node`, and few others while they are few. Tasks set the bits; Spark
    joins them, and 2**FILTER_BITS / 64 numbers at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, np.uint8)
        for batch in batches:
            bits[place_of(batch.column("node").to_numpy())] = 1
        packed = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(packed)
        yield pa.record_batch([pa.array(at), pa.array(packed[at])], names=["at", "bits"])

    rows = nodes.select("node").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    packed = np.zeros((1 << FILTER_BITS) // 64, np.int64)
    packed[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return packed.view(np.uint8)


def parts_of(docs: DataFrame, held: np.ndarray, size: int) -> DataFrame:
    """(node, pieces): the sets of the nodes in the filter, once a task, cut into pieces by the top four bits of the hash; a piece
    holds 48 further bits of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in chunks(batches):
            own = {key: s for s in sets_of(batch.column("text"), size) if len(s) and (key := set_key(s)) not in seen}
            nodes = np.array(list(own), np.int64)
            place = place_of(nodes)
            nodes = nodes[(held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
            seen.update(nodes.tolist())
            pieces = []
            for s in map(own.__getitem__, nodes.tolist()):
                cut = np.searchsorted(s >> np.uint64(60), np.arange(PIECES + 1)).tolist()
                low = np.ascontiguousarray(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8])
                pieces.append([low[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)])
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(pieces, pa.list_(pa.binary()))], names=["node", "pieces"])

    return docs.select("text").mapInArrow(run, "node long, pieces array<binary>").dropDuplicates(["node"])


def bounded(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose fragment counts allow the threshold."""
    own = sketches.select("node", "n", "counts")
    both = pairs.join(own.toDF("a", "n_a", "counts_a"), "a").join(own.toDF("b", "n_b", "counts_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, FRAGMENTS) for c in ("counts_a", "counts_b"))
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            least = -(-percent * (n + m) // (100 + percent))
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64) + np.where(((x == 255) & (y == 255)).any(axis=1), np.minimum(n, m), 0)
            yield batch.filter(pa.array(most >= least)).select(["a", "b", "n_a", "n_b"])

    return both.mapInArrow(run, "a long, b long, n_a int, n_b int")


def linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold: overlaps are counted piece by piece and summed per pair."""
    pieces = parts.select("node", F.posexplode("pieces").alias("piece", "own")).where("length(own) > 0")
    both = pairs.join(pieces.toDF("a", "piece", "own_a"), "a").join(pieces.toDF("b", "piece", "own_b"), ["b", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                sides = []
                for c in ("own_a", "own_b"):
                    raw = part.column(c).to_pylist()
                    each = np.zeros((sum(map(len, raw)) * 8 // BITS, 8), np.uint8)
                    each[:, : BITS // 8] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BITS // 8)
                    sides.append((np.repeat(np.arange(len(raw), dtype=np.uint64), [len(r) * 8 // BITS for r in raw]) << np.uint64(BITS)) | each.view("<u8").ravel())
                common = np.intersect1d(*sides) >> np.uint64(BITS)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in ("a", "b", "n_a", "n_b")] + [pa.array(np.bincount(common.astype(np.int64), minlength=part.num_rows))], names=["a", "b", "n_a", "n_b", "overlap"])

    partial = both.mapInArrow(run, "a long, b long, n_a int, n_b int, overlap long")
    whole = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return whole.where(100 * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b") - F.col("overlap"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by smallest labels and pointer jumping until nothing changes."""
    edges = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialize(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        best = edges.join(labels.toDF("b", "root"), "b").groupBy("a").agg(F.min("root").alias("best"))
        near = labels.join(best.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("old"), F.least("root", "best").alias("root"))
        jumped = near.join(labels.toDF("root", "further"), "root").select("node", F.least("root", "further").alias("root"), (F.least("root", "further") < F.col("old")).alias("moved"))
        step = materialize(jumped, "labels")
        labels = step.select("node", "root")
        if not step.where("moved").limit(1).count():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, root) after the links joined their components."""
    roots = links.join(labels.toDF("a", "x"), "a").join(labels.toDF("b", "y"), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    above = components(roots).toDF("root", "above")
    return materialize(labels.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "labels")


def classes(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row: doc_id, content, n_shingles, component_id, the smallest doc_id reachable by links, and root, which the rows of a
    component share (null where there is nothing to link)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("content"))
    table = materialize(summaries(docs, size), "sets")
    rows = table.where("node is not null")
    ranked = most_frequent(table.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times")).where(F.col("times") > OFTEN), "shingle", "times", HOT)
    keys = ranked["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    hot = (keys[order], (len(keys) - np.arange(len(keys)))[order])  # the rarer, the earlier
    nodes = rows.where("n > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("low"))

    known = docs.where("doc_id is not null")
    live = materialize(met(entries(known, size, percent, hot)), "entries")
    labels = materialize(live.select("node").distinct().select("node", F.col("node").alias("root")), "labels")
    sketches = materialize(rows.where("doc_id is not null and n > 0").dropDuplicates(["node"]).join(labels, "node", "left_semi").select("node", "n", "counts", *WORDS), "sketches")
    parts = materialize(parts_of(known, filter_of(labels), size), "parts")
    for step in range(ROUNDS + 1):
        own = live.join(labels, "node")
        split = own.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key")
        live = materialize(own.join(split, "key").select("key", "node", "upper", "root"), "open")
        if step < ROUNDS:
            # the buckets of a group first have the same hubs, so that most of it soon is one component, then each its own
            own = live.join(sketches.drop("counts"), "node")
            chance = F.xxhash64("node", "key", F.lit(step)) if step else F.xxhash64("node")
            first = F.row_number().over(Window.partitionBy("key").orderBy("upper", chance, "node"))
            hubs = live.withColumn("place", first).where(F.col("place") <= HUBS).drop("place").join(sketches.drop("counts"), "node")
            both = own.alias("s").join(hubs.alias("t"), "key").where((F.col("s.root") != F.col("t.root")) & possible(percent))
            pairs = both.select(F.least("s.node", "t.node").alias("a"), F.greatest("s.node", "t.node").alias("b"))
        else:
            pairs = across(live, sketches, percent)
        live = live.drop("root")
        pairs = materialize(bounded(pairs.distinct(), sketches, percent), "pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        links = materialize(linked(pairs, parts.join(ends, "node", "left_semi"), percent), "links")
        labels = merged(labels, links)
    low = nodes.join(labels, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    ids = low.groupBy("root").agg(F.min("low").alias("component_id"))
    found = low.join(ids, "root").select("node", "component_id", "root")
    joined = rows.where("doc_id is not null").join(found, "node", "left")
    alone = rows.where("doc_id is null").select("doc_id", "content", F.col("n").cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return joined.select("doc_id", "content", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "root").unionByName(alone)
