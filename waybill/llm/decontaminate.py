"""Benchmark decontamination (operator 9): SimHash windows of item size, Hamming blocks, exact weighted-shingle similarity.

Words are runs of letters and digits, A-Z in lower case. Item lengths fall on a ladder of window sizes (the largest size that the
item holds). For every size, every window of every document gets a 64-bit SimHash of its words; an item gives its first and its
last window of that size. Fingerprints are cut into BLOCKS blocks; each block of an item is filed under its value and all values
one bit away. Two fingerprints within RADIUS = 2 * BLOCKS - 1 bits agree in some block but for one bit, so none of them is missed.
What the blocks propose is measured in full, and what lies within RADIUS is aligned with its item: the weighted Jaccard similarity
of the two bags of five-word shingles must reach SIMILARITY. All windows of up to 1 / SIMILARITY times the item's words are
tried (and SLACK words more) whose start is as many words at most from a proposed one.

The items of one pass are at most ITEMS (a hash deals more of them out over several passes), which bounds what is sent to tasks.
Null or empty texts and items match nothing; an item of fewer than five words is one shingle and matches as a whole. Repeated
items count under each item_id; repeated rows get equal results.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from waybill.llm.text import chunks, hash_spans, lower_ascii, mix, spans, utf8
from waybill.session import materialize

SHINGLE, SIMILARITY = 5, 0.8
BLOCKS, RADIUS = 4, 7
SLACK = 2  # words that an aligned window may be off beyond what SIMILARITY leaves room for
ITEMS = 20_000
CHUNK = 1 << 18  # bytes of text whose windows are worked out at once; a window takes some hundred bytes meanwhile


def ladder(n: int) -> int:
    """The window size for an item of n words: the largest of 1, 2, 3, ... in steps of a quarter."""
    size = 1
    while (more := max(size + 1, size * 5 // 4)) <= n:
        size = more
    return size


def item_words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first word of each row)."""
    low = lower_ascii(data)
    word = ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128)
    starts, ends, first = spans(word, offsets)
    return hash_spans(low, starts, ends), starts, ends, first


def fingerprints(hashes: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each size: the SimHash of the window at every word, rows not heeded. A bit is set where most words of the window have it."""
    n = len(hashes)
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(n, 8), axis=1)
    upto = np.zeros((64, n + 1), np.int32 if max(sizes, default=0) >= 1 << 15 else np.int16)
    np.cumsum(bits.T, axis=1, dtype=upto.dtype, out=upto[:, 1:])  # wraps; differences are right all the same
    upto = np.ascontiguousarray(upto.T)
    for size in sizes:
        if size <= n:
            most = (upto[size:] - upto[: n - size + 1]) > size // 2
            yield size, np.packbits(most, axis=1).view(np.uint64)[:, 0]


@dataclass
class Index:
    ids: list  # item_id of each item
    words: list[np.ndarray]
    weight: dict[int, float]  # of words of items
    rare: float  # of every other word
    bags: list[dict]
    sizes: list[int]
    prints: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by size: fingerprint, item, offset in it
    files: dict[int, list[tuple[np.ndarray, np.ndarray]]]  # by size, for each block: starts by value, entries


def bag(words: np.ndarray, weight: dict[int, float], rare: float) -> dict[tuple, tuple[int, float]]:
    """Shingle: (times, weight); a shingle weighs what its words do."""
    own = words.tolist()
    n = min(SHINGLE, len(own))
    times = Counter(tuple(own[i : i + n]) for i in range(len(own) - n + 1)) if own else {}
    return {s: (k, sum(weight.get(w, rare) for w in s)) for s, k in times.items()}


def similarity(a: dict, b: dict) -> float:
    both = sum(min(k, b[s][0]) * w for s, (k, w) in a.items() if s in b)
    total = sum(k * w for x in (a, b) for k, w in x.values()) - both
    return both / total if total else 0.0


def longest(n: int) -> int:
    """The most words of a window aligned with an item of n words."""
    return n if n < SHINGLE else max(n + SLACK, int(n / SIMILARITY))


def aligned(found: Index, item: int, words: np.ndarray, most: int) -> tuple[float, int, int] | None:
    """(similarity, start, end) of the window most like the item, if it reaches SIMILARITY: the first start below `most`, then the first end.

    A window neither begins nor ends best with a shingle that the item lacks. Of a shingle's kind as many count as the item has: one
    counts if the one so many places before it in its kind lies before the window.
    """
    own, item_bag, n = words.tolist(), found.bags[item], len(found.words[item])
    size, whole = min(SHINGLE, n), sum(k * w for k, w in item_bag.values())
    most_shingles, shingles = longest(n) - size + 1, list(zip(*[own[i:] for i in range(size)], strict=False))
    shared, back, places = np.zeros(len(shingles)), np.full(len(shingles), -1), {}
    for i, s in enumerate(shingles):
        if s in item_bag:
            at, (times, shared[i]) = places.setdefault(s, []), item_bag[s]
            if len(at) >= times:
                back[i] = at[-times]
            at.append(i)
    upto = np.concatenate([[0], np.cumsum(shared)])
    starts = np.flatnonzero(shared[:most])
    starts = starts[upto[np.minimum(starts + most_shingles, len(shingles))] - upto[starts] >= SIMILARITY * whole - 1e-6]  # others hold too little
    if not len(starts):
        return None
    words_upto = np.cumsum([0, *[found.weight.get(w, found.rare) for w in own]])
    total = np.concatenate([[0], np.cumsum(words_upto[size:] - words_upto[:-size])])
    best = (SIMILARITY - 1e-6, 0, 0)
    for a in starts.tolist():
        own_part = slice(a, a + most_shingles)
        both = np.cumsum(np.where(back[own_part] < a, shared[own_part], 0))
        alike = both / (whole + total[a + 1 : a + 1 + len(both)] - total[a] - both)
        if alike.max() > best[0] + 1e-9:
            end = int(np.flatnonzero(alike >= alike.max() - 1e-9)[0])
            best = (float(alike[end]), a, a + end + size)
            if best[0] >= 1 - 1e-9:
                break
    _, start, end = best
    alike = similarity(item_bag, bag(words[start:end], found.weight, found.rare)) if end else 0.0
    return (alike, start, end) if alike >= SIMILARITY else None


def index(items: list[tuple[object, str]]) -> Index:
    """items: (item_id, text). Words of few items weigh more."""
    hashes, _, _, first = item_words(*utf8(pa.array([t or "" for _, t in items], pa.string())))
    words = [hashes[a:b] for a, b in zip(first, first[1:], strict=False)]
    held = Counter(w for own in words for w in {*own.tolist()})
    weight = {w: 1 + math.log((1 + len(words)) / n) for w, n in held.items()}
    rare = 1 + math.log(1 + len(words))
    entries: dict[int, list[tuple[int, int, int]]] = {}
    for i, own in enumerate(words):
        if len(own):
            size = ladder(len(own))
            (prints,) = [p for _, p in fingerprints(own, [size])]
            for at in {0, len(own) - size}:
                entries.setdefault(size, []).append((int(prints[at]), i, at))
    prints, files = {}, {}
    flips = np.array([0, *[1 << b for b in range(16)]], np.uint16)
    for size, own in entries.items():
        prints[size] = np.array([e[0] for e in own], np.uint64), np.array([e[1] for e in own]), np.array([e[2] for e in own])
        files[size] = []
        for block in prints[size][0].view(np.uint16).reshape(-1, BLOCKS).T:
            values = (block[:, None] ^ flips).ravel()
            order = np.argsort(values, kind="stable")
            files[size].append((np.searchsorted(values[order], np.arange((1 << 16) + 1)), np.repeat(np.arange(len(own)), len(flips))[order]))
    return Index([i for i, _ in items], words, weight, rare, [bag(w, weight, rare) for w in words], sorted(entries), prints, files)


def proposed(found: Index, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, entry) of all pairs within RADIUS, by way of the blocks."""
    entries, out = found.prints[size][0], set()
    for k, block in enumerate(prints.view(np.uint16).reshape(-1, BLOCKS).T):
        starts, filed = found.files[size][k]
        counts = (starts[1:] - starts[:-1])[block]
        hit = np.flatnonzero(counts)
        for part in np.array_split(hit, max(1, int(counts.sum()) // (1 << 20))):
            n = counts[part]
            window = np.repeat(part, n)
            upto = np.cumsum(n)
            entry = filed[np.arange(len(window)) + np.repeat(starts[block[part]] - (upto - n), n)]
            near = np.bitwise_count(prints[window] ^ entries[entry]) <= RADIUS
            out.update(zip(window[near].tolist(), entry[near].tolist(), strict=True))
    both = np.array(sorted(out), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def matches(found: Index, column: pa.Array) -> list[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word, words) of the best window of each item in each row."""
    hashes, _, _, first = item_words(*utf8(column))
    out: list[tuple[int, int, float, int, int]] = []
    for size, prints in fingerprints(hashes, found.sizes):
        window, entry = proposed(found, size, prints)
        rows = np.searchsorted(first, window, side="right") - 1
        inside = window + size <= first[1:][rows]
        places = np.unique(np.stack([rows[inside], found.prints[size][1][entry[inside]], window[inside] - found.prints[size][2][entry[inside]]], 1), axis=0)
        pairs, at = np.unique(places[:, :2], axis=0, return_index=True)
        for (r, item), starts in zip(pairs.tolist(), np.split(places[:, 2], at[1:]), strict=bool(len(at))):
            low, high, n = int(first[r]), int(first[r + 1]), len(found.words[item])
            off, best = longest(n) - n + SLACK, (0.0, 0, 0)
            for near in np.split(starts, np.flatnonzero(np.diff(starts) > 2 * off + 1) + 1):  # their windows' starts lie side by side
                begin, last = max(low, int(near[0]) - off), int(near[-1]) + off
                own = aligned(found, item, hashes[begin : min(high, last + longest(n))], last - begin + 1)
                if own and own[0] > best[0]:
                    best = (own[0], begin + own[1] - low, own[2] - own[1])
                if best[0] == 1:
                    break
            if best[0]:
                out.append((r, item, *best))
    return sorted(out)


def passes(items: DataFrame, most: int) -> Iterator[tuple[Index, bool]]:
    """The items in indexes of at most about `most` each, dealt by hash, and whether more follow; each is built when its turn comes."""
    texts = items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
    parts = -(-texts.count() // most)
    dealt = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    for k in range(parts):
        yield index(sorted([tuple(r) for r in texts.where(dealt == k).collect()], key=str)), k + 1 < parts


def leaks(docs: DataFrame, items: DataFrame, most: int = ITEMS) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) of each item that a document holds, with its best window."""
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = StructType([source.schema["doc_id"], items.schema["item_id"], StructField("similarity", DoubleType()), StructField("first_word", LongType()), StructField("n_words", LongType())])
    kinds = to_arrow_type(items.schema["item_id"].dataType)

    def by(found: Index) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, limit=CHUNK):
                own = matches(found, batch.column("text"))
                cols = list(zip(*own, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array([found.ids[i] for i in cols[1]], kinds), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                    names=schema.names,
                )

        return source.mapInArrow(run, schema)

    out = None
    for found, more in passes(items, most):  # a pass is written before the next one's index is built
        own = materialize(by(found), "leaks") if more else by(found)
        out = own if out is None else out.unionByName(own)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, most: int = ITEMS) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    names = docs.columns
    for found, more in passes(items, most):

        def run(batches: Iterator[pa.RecordBatch], found: Index = found) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, limit=CHUNK):
                kept = np.ones(batch.num_rows, bool)
                kept[[m[0] for m in matches(found, batch.column(names.index("text")))]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(run, docs.schema)
        if more:
            docs = materialize(docs, "clean")
    return docs
