"""Target-distribution importance resampling over hashed word runs (operator 13).

Features of a text are its runs of 1 to `size` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its bytes
modulo BUCKETS. The corpus and the target each have a total for every bucket, and a bucket's gain is the smoothed logarithm of the
ratio of the two. A document's weight is the sum of the gains of its features; with a hashed Gumbel noise added to it, the highest
scores are a draw without replacement by weight.

The vocabulary has a head and a tail. The head is what occurs most often: words with the state of the CRC after their bytes, from
which the CRC of any run that starts with them goes on, and pairs of words with their buckets. It is found over all documents with
counters of bounded size and broadcast, HEAD words and HEAD pairs at most. All other features, the tail, get their CRC directly. The
head saves work and never decides: both ways give the same bucket, head words are compared byte by byte, and the totals hold every
occurrence of every feature. (Within one chunk of texts equal words are found by a 64-bit hash, here as in all operators.)

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case. Null and empty texts have no features and a weight
of 0. A null doc_id is hashed as an empty text. Rows may repeat; equal scores are ordered by doc_id, rows without one last. A corpus or
target without features has totals of 0, and gains follow from the smoothing alone. Other columns of any name are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.bpe import ranges
from waybill.llm.frequent import most_frequent
from waybill.llm.text import chunks, hash_spans, lower_ascii, mix, signed, spans, utf8
from waybill.session import materialize

BUCKETS = 10_000
HEAD = 1 << 16  # words, and pairs, of the broadcast head
COUNTERS = 1 << 18  # words, or pairs, that a task counts at a time
LEAST_SHARE = 1 << 17  # a task names a word or a pair that makes up one in so many of those it read
PAIR = np.uint64(0x9E3779B97F4A7C15)
NONE: tuple[np.ndarray, ...] = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in lower case, starts, ends, first word of each row)."""
    offsets, data = utf8(column)
    data = lower_ascii(data)
    return data, *spans((data > 127) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)), offsets)


def pair_hashes(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of words that another of the same row follows, hash of each such pair)."""
    follows = np.ones(len(hashes), bool)
    follows[first[1:][first[1:] > 0] - 1] = False
    at = np.flatnonzero(follows)
    return at, mix(hashes[at] * PAIR + hashes[at + 1]) if len(at) else hashes[:0]


class Counters:
    """Counts of the most frequent keys of a stream. Beyond `most` keys the least count is taken from all and those at zero go, so a
    key that makes up more than one in `most` of the stream always stays, and no count is too high."""

    def __init__(self, most: int):
        self.most, self.total, self.held = most, 0, [NONE]

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.total += int(counts.sum())
        self.held.append((keys, counts))
        if sum(len(k) for k, _ in self.held) > 4 * self.most:
            self.merge()

    def merge(self) -> None:
        keys, back = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([c for _, c in self.held]), len(keys)).astype(np.int64)
        if len(keys) > self.most:
            counts = counts - np.partition(counts, -self.most - 1)[-self.most - 1]
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.held = [(keys, counts)]

    def top(self, share: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys that make up one in `share` or more."""
        self.merge()
        keys, counts = self.held[0]
        often = counts * share >= self.total
        return keys[often], counts[often]


@dataclass
class Head:
    """Frequent words by hash with their bytes and CRC states, and frequent pairs by hash with their two words and buckets."""

    keys: np.ndarray
    states: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    bytes: np.ndarray
    pairs: np.ndarray
    pair_words: np.ndarray
    pair_buckets: np.ndarray

    def look(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place in the head of each word, -1 for those outside it; the bytes are compared."""
        if not len(self.keys):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = (self.keys[at] == hashes) & (self.sizes[at] == ends - starts)
        found = np.flatnonzero(hit)
        size = self.sizes[at[found]]
        same = data[ranges(starts[found], size)] == self.bytes[ranges(self.places[at[found]], size)]
        if not same.all():
            bad = np.unique(np.repeat(np.arange(len(found)), size)[~same])
            hit[found[bad]] = False
        return np.where(hit, at, -1)


def head_of(docs: DataFrame, size: int, most: int = HEAD) -> Head:
    """The head of a corpus: a task sends only what is frequent in it, so no word that is frequent in all is missed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = Counters(COUNTERS), Counters(COUNTERS)
        shown: dict[int, bytes] = {}
        members: dict[int, tuple[int, int]] = {}
        for batch in chunks(batches):
            data, starts, ends, first = words_of(batch.column("text"))
            hashes = hash_spans(data, starts, ends)
            keys, where, counts = np.unique(hashes, return_index=True, return_counts=True)
            words.add(keys, counts)
            often = np.flatnonzero(counts * LEAST_SHARE >= len(hashes))
            raw = data.tobytes()
            shown |= {k: raw[a:b] for k, a, b in zip(keys[often].tolist(), starts[where[often]].tolist(), ends[where[often]].tolist(), strict=True) if k not in shown}
            if len(shown) > 2 * COUNTERS:
                words.merge()
                kept = set(words.held[0][0].tolist())
                shown = {k: v for k, v in shown.items() if k in kept}
            if size > 1:
                at, both = pair_hashes(hashes, first)
                keys, where, counts = np.unique(both, return_index=True, return_counts=True)
                pairs.add(keys, counts)
                often = np.flatnonzero(counts > 1)
                members |= {k: (a, b) for k, a, b in zip(keys[often].tolist(), hashes[at[where[often]]].tolist(), hashes[at[where[often]] + 1].tolist(), strict=True)}
                if len(members) > 2 * COUNTERS:
                    pairs.merge()
                    kept = set(pairs.held[0][0].tolist())
                    members = {k: v for k, v in members.items() if k in kept}
        for kind, counters, known in (("word", words, shown), ("pair", pairs, members)):
            keys, counts = counters.top(LEAST_SHARE)
            rows = [(k, c, known[k]) for k, c in zip(keys.tolist(), counts.tolist(), strict=True) if k in known]
            if rows:
                one = np.array([r[0] for r in rows], np.uint64)
                a, b = (np.array([r[2][i] for r in rows], np.uint64) if kind == "pair" else one for i in (0, 1))
                text = [r[2] if kind == "word" else None for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(rows)), *(pa.array(signed(x)) for x in (one, a, b)), pa.array(text, pa.binary()), pa.array([r[1] for r in rows], pa.int64())], names=["kind", "key", "a", "b", "word", "c"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "kind string, key long, a long, b long, word binary, c long")
    counts = materialize(found.groupBy("kind", "key").agg(F.sum("c").alias("c"), F.min("a").alias("a"), F.min("b").alias("b"), F.min("word").alias("word")), "head-counts")
    top = {kind: most_frequent(counts.where(F.col("kind") == kind).withColumn("row", F.struct("key", "a", "b", "word")), "row", "c", most)["row"].tolist() for kind in ("word", "pair")}
    unsigned = lambda values: np.array(values, np.int64).view(np.uint64)
    texts = [bytes(r["word"]) for r in top["word"]]
    keys = unsigned([r["key"] for r in top["word"]])
    order = np.argsort(keys)
    texts, keys = [texts[i] for i in order], keys[order]
    sizes = np.array([len(t) for t in texts], np.int64)
    states = np.array([zlib.crc32(t) for t in texts], np.int64)
    place = {k: i for i, k in enumerate(keys.tolist())}
    pairs = sorted((p, place[a], place[b]) for p, a, b in ((*unsigned([r["key"], r["a"], r["b"]]).tolist(),) for r in top["pair"]) if a in place and b in place)
    pair_buckets = [zlib.crc32(b" " + texts[b], int(states[a])) % BUCKETS for _, a, b in pairs]
    return Head(
        keys, states, np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(texts), np.uint8),
        np.array([p[0] for p in pairs], np.uint64), np.array([p[1:] for p in pairs], np.int64).reshape(-1, 2), np.array(pair_buckets, np.int64),
    )


def buckets_of(column: pa.Array, head: Head, size: int, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, row of each feature, words of each row)."""
    data, starts, ends, first = words_of(column)
    hashes = hash_spans(data, starts, ends)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
    place = head.look(keys, data, starts[where], ends[where])
    states = head.states[np.maximum(place, 0)] if len(head.states) else np.zeros(len(keys), np.int64)
    raw, tail = data.tobytes(), np.flatnonzero(place < 0)
    if len(tail):
        states[tail] = [zlib.crc32(raw[a:b]) for a, b in zip(starts[where[tail]].tolist(), ends[where[tail]].tolist(), strict=True)]
    made, owner = [states[back] % buckets], [rows]
    for n in range(2, size + 1):
        at = np.arange(max(0, len(hashes) - n + 1))
        at = at[rows[at] == rows[at + n - 1]]
        run = hashes[at].copy()
        for k in range(1, n):
            run = mix(run * PAIR + hashes[at + k])
        kinds, one, again = np.unique(run, return_index=True, return_inverse=True)
        got = np.full(len(kinds), -1)
        if n == 2 and len(head.pairs):
            near = np.minimum(np.searchsorted(head.pairs, kinds), len(head.pairs) - 1)
            a, b = place[back[at[one]]], place[back[at[one] + 1]]
            same = (head.pairs[near] == kinds) & (head.pair_words[near, 0] == a) & (head.pair_words[near, 1] == b)
            got[same] = head.pair_buckets[near[same]] % buckets
        for i in np.flatnonzero(got < 0).tolist():  # on from the state of the first word
            w = at[one[i]]
            state = int(states[back[w]])
            for k in range(w + 1, w + n):
                state = zlib.crc32(raw[starts[k] : ends[k]], zlib.crc32(b" ", state))
            got[i] = state % buckets
        made.append(got[again])
        owner.append(rows[at])
    return np.concatenate(made), np.concatenate(owner), np.diff(first)


def totals(docs: DataFrame, head: Head, size: int, buckets: int = BUCKETS) -> np.ndarray:
    """The number of features of a table in each bucket; a task sends one count for each bucket."""
    spread = docs.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in chunks(batches):
            counts += np.bincount(buckets_of(batch.column("text"), spread.value, size, buckets)[0], minlength=buckets)
        yield pa.record_batch([pa.array(np.flatnonzero(counts).astype(np.int32)), pa.array(counts[counts > 0])], names=["bucket", "n"])

    made = np.zeros(buckets, np.int64)
    for row in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        made[row["bucket"]] = row["n"]
    return made


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over corpus in each bucket, one added to every count; rounded down."""
    up = (target + 1.0) * (float(corpus.sum()) + len(corpus))
    down = (corpus + 1.0) * (float(target.sum()) + len(target))
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


@dataclass
class Model:
    head: Head
    gains: np.ndarray
    size: int


def learn(docs: DataFrame, target: DataFrame, size: int = 1, buckets: int = BUCKETS) -> Model:
    """The gains of a corpus towards a target: all features of all texts of both are counted."""
    head = head_of(docs, size)
    return Model(head, gains_of(totals(docs, head, size, buckets), totals(target, head, size, buckets)), size)


def weighed(docs: DataFrame, model: Model, seed: str = "2024") -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight and score (the weight with the document's own noise)."""
    spread, size = docs.sparkSession.sparkContext.broadcast((model.head, model.gains)), model.size
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, gains = spread.value
        for batch in chunks(batches):
            made, owner, n_words = buckets_of(batch.column("text"), head, size, len(gains))
            n = np.bincount(owner, minlength=batch.num_rows)
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, owner, gains[made])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, n, weight))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + noise)


def drawn(weights: DataFrame, percent: int = 10, least_words: int = 20) -> DataFrame:
    """doc_id, n_features, weight, score and rank: of the N documents with `least_words` or more, floor(percent * N / 100) are drawn,
    ranked from the highest score; all others have no rank. Rows are ranked by ranges of the score: a task needs only the number of
    rows in the ranges before its own."""
    fits = F.col("n_words") >= least_words
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features"), F.col("n_words")]
    table = materialize(weights.withColumn("fits", fits), "resample-weights")
    ranged = table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    ranged = materialize(ranged, "resample-order").withColumn("part", F.shiftright("row", 33))
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), F.sum(F.col("fits").cast("long")).alias("n_fits"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each task
    taken = F.floor(F.sum("n_fits").over(Window.partitionBy()) * percent / 100).cast("long")
    shift = parts.select("part", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"), taken.alias("taken"))
    rank = F.col("row") + F.col("shift")
    rows = ranged.join(shift, "part")
    return rows.select("doc_id", "n_features", "weight", "score", F.when(F.col("fits") & (rank <= F.col("taken")), rank).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, size: int = 1, percent: int = 10, least_words: int = 20, seed: str = "2024") -> DataFrame:
    """All documents with their weights and scores, and the ranks of those that are drawn."""
    return drawn(weighed(docs, learn(docs, target, size), seed), percent, least_words)
