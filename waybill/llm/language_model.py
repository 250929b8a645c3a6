"""LM scoring (operator 2): a gated recurrent language model in numpy.

Tokens are words (A-Z in lower case) and one end. The corpus is counted in full by Spark: every word of every training document.
The VOCABULARY - 1 most frequent words and the end fall into classes of CLASS words; other words that occur twice or more, as far
as the HOT table of fixed size holds them, are one class, and all remaining ones, the unseen with them, another. The probability of
a token is that of its class times that within its class: for the last two classes the smoothed counts of the whole corpus.

Training starts from the counts (output biases), so that an untrained model is a unigram model. Each round every task trains a copy
on its own documents by truncated backpropagation over STEPS tokens in LANES lanes, the state carried on from window to window, and
Spark averages the copies, weighed by their tokens. A hash deals all training documents out over the rounds, so the network reads
every one of them once. Scoring carries the state through a whole document, whatever its length.

Words outside the HOT table meet their counts in a join, so no table that grows with the corpus is sent to tasks. Null texts are
empty: one end. A row without doc_id is trained on unless its fold says otherwise, and scored. Rows may repeat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.frequent import most_frequent
from waybill.llm.text import chunks, lower_ascii, signed, utf8, word_hashes
from waybill.session import materialize

END = np.uint64(0xE4D0F7E87)  # stands for the hash of the end
HOT = 1 << 18
CLASS, CLASSES = 32, 32
VOCABULARY = CLASS * CLASSES  # the end among them
HIDDEN, LANES, STEPS, ROUNDS, RATE = 24, 256, 16, 3, 0.03
UPDATES = 32  # lanes are few enough for so many updates a stream
TOP = 20  # bits of a hash by which the table is entered
MERGED = 1 << 20  # distinct words that a task holds before it sends its counts on
BYTES = 1 << 22
MID, TAIL = CLASSES, CLASSES + 1  # the classes of other words
KIND = np.append(np.arange(VOCABULARY) // CLASS, [MID, TAIL]).astype(np.uint8)  # the class of each id; sorting bytes takes one pass


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, first token of each row); every row ends with END."""
    offsets, data = utf8(column)
    hashes, first = word_hashes(offsets, lower_ascii(data))
    return np.insert(hashes, first[1:], END), first + np.arange(len(first))


def counts_of(docs: DataFrame) -> DataFrame:
    """(word, c): the tokens of all rows, counted; tasks send partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return keys, np.bincount(back, np.concatenate([h[1] for h in held]), len(keys)).astype(np.int64)

        for batch in chunks(batches, limit=BYTES):
            held.append(np.unique(tokens_of(batch.column("text"))[0], return_counts=True))
            if sum(len(h[0]) for h in held) > MERGED:
                held = [merge()]
                if len(held[0][0]) > MERGED // 2:
                    yield pa.record_batch([pa.array(signed(held[0][0])), pa.array(held[0][1])], names=["word", "c"])
                    held = []
        if held:
            keys, times = merge()
            yield pa.record_batch([pa.array(signed(keys)), pa.array(times)], names=["word", "c"])

    return docs.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Words:
    """What every task knows of the counts: the HOT table, sorted by hash, and sums."""

    keys: np.ndarray
    c: np.ndarray
    ids: np.ndarray  # 0: the end; below VOCABULARY: its words; VOCABULARY: other hot words
    total: int
    distinct: int
    mid: int  # log's argument within the class of other hot words
    tail: int  # and of all others

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): VOCABULARY + 1 and 0 for words outside the table."""
        if not len(self.keys):
            return np.full(len(hashes), VOCABULARY + 1), np.zeros(len(hashes), np.int64)
        starts = self.starts
        top = hashes >> np.uint64(64 - TOP)
        at, ends = starts[top], starts[top + np.uint64(1)]
        left = np.flatnonzero(at < ends)
        left = left[self.keys[at[left]] != hashes[left]]
        while len(left):  # a few keys share their first bits
            at[left] += 1
            left = left[at[left] < ends[left]]
            left = left[self.keys[at[left]] != hashes[left]]
        same = at < ends
        at[~same] = 0
        return np.where(same, self.ids[at], VOCABULARY + 1), np.where(same, self.c[at], 0)

    @cached_property
    def starts(self) -> np.ndarray:
        """The first key of each beginning of TOP bits, and the end."""
        return np.searchsorted(self.keys >> np.uint64(64 - TOP), np.arange((1 << TOP) + 1, dtype=np.uint64)).astype(np.int32)


def words_of(counts: DataFrame) -> Words:
    """The table of the most frequent words that occur twice or more; the end is always in it if any document is."""
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    end = F.col("word") == int(END)
    top = most_frequent(counts.where((F.col("c") > 1) | end), "word", "c", HOT, end)
    keys, c = top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    ids = np.minimum(np.arange(len(keys)), VOCABULARY)
    order = np.argsort(keys)
    mid = int(c[VOCABULARY:].sum()) + max(0, len(c) - VOCABULARY)
    return Words(keys[order], c[order], ids[order], int(total or 0), distinct, mid, int(total or 0) - int(c.sum()) + distinct - len(c) + 1)


NAMES = ["x", "u", "class_w", "class_b", "word_w", "word_b"]


class Network:
    """x: what each input adds to the three gates; u: state to gates; class_w, class_b, word_w, word_b: the two softmax layers."""

    def __init__(self, table: Words, seed: int = 11):
        r = np.random.default_rng(seed)
        self.x = r.normal(0, 0.3, (VOCABULARY + 2, 3 * HIDDEN)).astype(np.float32)
        self.u = r.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)).astype(np.float32)
        self.class_w = np.zeros((HIDDEN, CLASSES + 2), np.float32)
        self.word_w = np.zeros((CLASSES, HIDDEN, CLASS), np.float32)
        c = np.zeros(VOCABULARY)
        own = table.ids < VOCABULARY
        c[table.ids[own]] = table.c[own]
        by = np.append(c.reshape(CLASSES, CLASS).sum(1), [table.c[~own].sum(), table.total - table.c.sum()])
        self.class_b = np.log(by + 0.5).astype(np.float32)
        self.word_b = np.where(c > 0, np.log(c + 0.1), -20).reshape(CLASSES, CLASS).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in NAMES])

    def cut(self, values: np.ndarray) -> dict[str, np.ndarray]:
        """Views of one flat array, in the shapes of the parameters."""
        ends = np.cumsum([getattr(self, n).size for n in NAMES])
        return {n: own.reshape(getattr(self, n).shape) for n, own in zip(NAMES, np.split(values, ends[:-1]), strict=True)}

    def load(self, values: np.ndarray, into: np.ndarray | None = None) -> None:
        """Takes the values over, into a flat array if one is given: the parameters are then views of it."""
        into = np.empty(len(values), np.float32) if into is None else into
        into[:] = values
        for n, own in self.cut(into).items():
            setattr(self, n, own)

    def step(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, and what the way back needs."""
        a, b = self.x.take(ids, 0), h @ self.u
        gates = a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5  # the logistic function
        z, r, inner = gates[:, :HIDDEN], gates[:, HIDDEN:], b[:, 2 * HIDDEN :]
        n = r * inner
        n += a[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n, inner

    def logs(self, states: np.ndarray, ids: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities (of the class alone, for other words), and with `grads` the gradient of -sum to the states."""
        kind = KIND[ids]
        logits = states @ self.class_w
        logits += self.class_b
        logits -= logits.max(1, keepdims=True)
        rows = np.arange(len(ids))
        out = logits[rows, kind]
        p = np.exp(logits, out=logits)
        total = p @ np.ones((p.shape[1], 1), p.dtype)
        out -= np.log(total[:, 0])
        back = None
        if grads is not None:
            p /= total
            p[rows, kind] -= 1
            grads["class_w"][...], grads["class_b"][...] = states.T @ p, p.sum(0)
            back = p @ self.class_w.T
        order = np.argsort(kind, kind="stable")
        bounds = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        used = [(c, slice(bounds[c], bounds[c + 1])) for c in np.flatnonzero(np.diff(bounds))]
        order = order[: bounds[-1]]
        h, at = states.take(order, 0), np.arange(len(order))
        logits = np.empty((len(order), CLASS), h.dtype)
        for c, own in used:
            np.matmul(h[own], self.word_w[c], out=logits[own])
        logits += self.word_b.take(kind[order], 0)
        logits -= logits.max(1, keepdims=True, initial=-np.inf)
        target = ids[order] % CLASS
        own = logits[at, target]
        p = np.exp(logits, out=logits)
        total = p @ np.ones((CLASS, 1), p.dtype)
        out[order] += own - np.log(total[:, 0])
        if grads is not None and used:
            p /= total
            p[at, target] -= 1
            grads["word_b"][[c for c, _ in used]] = np.add.reduceat(p, [own.start for _, own in used])
            down = np.empty_like(h)
            for c, own in used:
                np.matmul(h[own].T, p[own], out=grads["word_w"][c])
                np.matmul(p[own], self.word_w[c].T, out=down[own])
            back[order] += down
        return out, back

    def train(self, ids: np.ndarray) -> None:
        """Truncated backpropagation through one pass over a stream of tokens, cut into lanes; Adam."""
        lanes = max(1, min(LANES, len(ids) // (UPDATES * STEPS)))
        length = len(ids) // lanes
        if length < 2:
            return
        stream = ids[: lanes * length].reshape(lanes, length).T
        before = np.concatenate([np.zeros((1, lanes), ids.dtype), stream[:-1]])
        self.load(self.flat(), values := np.empty(sum(getattr(self, n).size for n in NAMES), np.float32))
        m, v, g, part = np.zeros((4, len(values)), np.float32)
        grads = self.cut(g)
        h, updates = np.zeros((lanes, HIDDEN), np.float32), 0
        for start in range(0, length, STEPS):
            own, saved = range(start, min(start + STEPS, length)), []
            fresh = before[own.start : own.stop] == 0  # a new document
            for t, new in zip(own, fresh, strict=True):
                h[new] = 0
                saved.append((h, *self.step(before[t], h)))
                h = saved[-1][1].copy()
            g.fill(0)
            _, back = self.logs(np.concatenate([s[1] for s in saved]), stream[own.start : own.stop].ravel(), grads)
            back = back.reshape(len(own), lanes, HIDDEN)
            down, added = np.empty((2, len(own), lanes, 3 * HIDDEN), np.float32)
            after, turned = np.zeros_like(h), np.ascontiguousarray(self.u.T)
            old, _, z, r, n, inner = (np.stack(x) for x in zip(*saved, strict=True))
            inward = (1 - z) * (1 - n * n)
            slopes = np.stack([(old - n) * z * (1 - z), inward * inner * r * (1 - r), inward], 2)
            passed = np.concatenate([np.ones((*r.shape[:2], 2 * HIDDEN), np.float32), r], 2)
            for k in range(len(own) - 1, -1, -1):
                d = back[k] + after
                np.multiply(d[:, None], slopes[k], out=added[k].reshape(lanes, 3, HIDDEN))
                np.multiply(added[k], passed[k], out=down[k])
                after = d * z[k] + down[k] @ turned
                after[fresh[k]] = 0
            np.matmul(old.reshape(-1, HIDDEN).T, down.reshape(-1, 3 * HIDDEN), out=grads["u"])
            given = before[own.start : own.stop].ravel()
            order = np.argsort(given.astype(np.int16), kind="stable")
            words = given[order]
            at = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            grads["x"][words[at]] = np.add.reduceat(added.reshape(-1, 3 * HIDDEN).take(order, 0), at)
            updates += 1
            scale = 1 / (lanes * len(own))
            size = math.sqrt(float(g @ g)) * scale
            g *= scale * min(1.0, 1.0 / max(size, 1e-9))
            m *= 0.9
            m += np.multiply(g, 0.1, out=part)
            v *= 0.995
            v += np.multiply(np.square(g, out=g), 0.005, out=part)
            np.sqrt(np.multiply(v, 1 / (1 - 0.995**updates), out=part), out=part)
            part += 1e-6
            np.divide(m, part, out=part)
            values -= np.multiply(part, RATE / (1 - 0.9**updates), out=part)

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of the probability of every token, other words by their class alone; the state goes through whole documents."""
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        starts, ends = first[:-1][order], lengths[order]
        out = np.zeros(len(ids))
        h, given = np.zeros((len(order), HIDDEN), np.float32), np.zeros(len(order), ids.dtype)
        held: list[np.ndarray] = []
        places: list[np.ndarray] = []
        size = 0
        live = len(order)
        for t in range(int(ends[0]) if len(ends) else 0):
            while live and ends[live - 1] <= t:
                live -= 1
            h = self.step(given[:live], h[:live])[0]
            at = starts[:live] + t
            given = ids[at]
            held.append(h)
            places.append(at)
            size += live
            if size >= 1 << 16:
                where = np.concatenate(places)
                out[where] = self.logs(np.concatenate(held), ids[where])[0]
                held, places, size = [], [], 0
        if held:
            where = np.concatenate(places)
            out[where] = self.logs(np.concatenate(held), ids[where])[0]
        return out / math.log(10)


def trained(docs: DataFrame, table: Words, rounds: int = ROUNDS) -> Network:
    """The network after `rounds` rounds of training in all tasks and averaging."""
    net = Network(table)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lm")), F.lit(rounds))
    for k in range(rounds if table.total else 0):
        start = net.flat()

        def run(batches: Iterator[pa.RecordBatch], start: np.ndarray = start) -> Iterator[pa.RecordBatch]:
            own = Network(table)
            own.load(start)
            read, parts, size = 0, [], 0
            for batch in chunks(batches, limit=BYTES):
                parts.append(table.look(tokens_of(batch.column("text"))[0])[0])
                size += len(parts[-1])
                if size >= 1 << 19:
                    own.train(np.concatenate(parts))
                    read, parts, size = read + size, [], 0
            if parts:
                own.train(np.concatenate(parts))
                read += size
            if read:
                yield pa.record_batch([pa.array([own.flat()], pa.list_(pa.float32())), pa.array([read], pa.int64())], names=["w", "n"])

        # A fixed order of sums would cost a sort; the averages of a few tasks differ by rounding only.
        copies = docs.where(place == k).select("text").mapInArrow(run, "w array<float>, n long")
        each = copies.select("n", F.posexplode("w").alias("at", "w"))
        mean = each.groupBy("at").agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("w")).toPandas()
        if len(mean):
            values = start.copy()
            values[mean["at"].to_numpy()] = mean["w"].to_numpy()
            net.load(values)
    return net


def scored(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", held_out.alias("held_out"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("string"), text).alias("row"))
    train = docs.where(~F.col("held_out")).select("doc_id", "text")
    counts = materialize(counts_of(train), "counts")
    table = words_of(counts)
    net = trained(train, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BYTES):
            hashes, first = tokens_of(batch.column("text"))
            ids, c = table.look(hashes)
            n, row = np.diff(first), np.repeat(np.arange(batch.num_rows), np.diff(first))
            logs = np.log10(c + 1.0)
            within = np.where(ids == VOCABULARY, logs - math.log10(max(1, table.mid)), np.where(ids > VOCABULARY, -math.log10(max(1, table.tail)), 0.0))
            total = lambda x: np.bincount(row, x, batch.num_rows)
            other = ids == VOCABULARY + 1
            lost = hashes[other]
            ends = np.concatenate([[0], np.cumsum(total(other).astype(np.int64))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), batch.column("row"), pa.array(n.astype(np.int64)), pa.array(total(c > 0).astype(np.int64)), pa.array(total(logs)), pa.array(total(net.score(ids, first) + within)), pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(lost)))],
                names=["doc_id", "held_out", "row", "n_tokens", "known", "logs", "part", "others"],
            )

    rows = materialize(docs.select("doc_id", "held_out", "row", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, logs double, part double, others array<long>"), "scores")
    others = rows.where("size(others) > 0").dropDuplicates(["row"]).select("row", F.explode("others").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    met = others.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_logs"))
    joined = rows.drop("others").join(met, "row", "left").fillna(0, ["more"]).fillna(0.0, ["more_logs"])
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("more")).alias("n_known"),
        F.lit(table.total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * math.log10(table.total + table.distinct + 1)).alias("base_score"),
        (F.col("part") + F.col("more_logs")).alias("score"),
    )


def fold(key: str = "doc_id", folds: int = 7, held: int = 2) -> Column:
    """Held out: the CRC-32 of the key as text leaves `held`; a null key never does."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == held, F.lit(False))
