import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from waybill.llm import resample

SCHEMA = "doc_id long, text string, row int, fits string, n_words string"


def words(text):
    low = "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def features(text, size):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in range(1, size + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, size=1, percent=10, least=20):
    s, t = (Counter(b for text in texts for b in features(text, size)) for texts in ([t for _, t in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
    rows = []
    for i, text in docs:
        made = features(text, size)
        weight = sum(map(gain, made))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(made), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    fits = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = percent * len(fits) // 100
    return sorted([(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(fits)] + [(*r[:4], None) for r in rows if r[4] < least], key=str)


def table(n=120, seed=3):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "straße", "日本", "x1", "don't", "a-b", "_", "é", *("w%d" % i for i in range(60))]
    docs = [(i, " ".join(r.choices(vocabulary, [40, 9, 30, *[1] * 67], k=r.randrange(60))) + r.choice(["", "\x00z", "\n.", "\x7f"])) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "--- ..."), (None, "no id " * 20), (None, None), (5, "tie " * 30), (5, "tie " * 30), (n + 3, "the of " * 40_000), (-4, "Ünïcode ÀÉ A " * 9)]
    return docs, [" ".join(r.choices(vocabulary, k=30)) for _ in range(9)] + [None, ""]


@pytest.mark.parametrize("size", [1, 2, 3])
def test_against_brute_force(spark, size):
    docs, target = table()
    rows = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA).repartition(6)
    goal = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resample.resampled(rows, goal, size)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, size)


def test_the_head_never_decides(spark):
    docs, _ = table()
    rows = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA)
    head = resample.head_of(rows, 2)
    known = {bytes(head.bytes[p : p + s]).decode() for p, s in zip(head.places, head.sizes, strict=True)}
    assert {"the", "of", "日本"} <= known and len(head.pairs)
    small, none = resample.head_of(rows, 2, most=3), resample.head_of(rows.limit(0), 2)
    assert len(small.keys) <= 3 and not len(none.keys)
    column = pa.array([t for _, t in docs])
    plain = [resample.buckets_of(column, h, 2) for h in (head, small, none)]
    for other in plain[1:]:
        assert all(np.array_equal(a, b) for a, b in zip(plain[0], other, strict=True))
    assert Counter(plain[0][0].tolist()) == Counter(b for _, t in docs for b in features(t, 2))


def test_head_words_are_compared_byte_by_byte(spark):
    docs = spark.createDataFrame([(1, "one one one", 1, "", "")], SCHEMA)
    head = resample.head_of(docs, 1)
    head.keys[:] = resample.hash_spans(np.frombuffer(b"two", np.uint8), np.array([0]), np.array([3]))  # the hash of another word
    assert resample.buckets_of(pa.array(["two"]), head, 1)[0].tolist() == [zlib.crc32(b"two") % 10000]


def test_counters_keep_what_is_frequent():
    r, counters, exact = np.random.default_rng(1), resample.Counters(50), Counter()
    for _ in range(200):
        keys = np.concatenate([r.integers(0, 5, 30), r.integers(100, 10**6, 60)]).astype(np.uint64)
        exact.update(keys.tolist())
        counters.add(*np.unique(keys, return_counts=True))
    keys, counts = counters.top(30)
    held = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert set(range(5)) <= set(held) and all(c <= exact[k] for k, c in held.items())


def test_empty_tables(spark):
    docs, target = table()
    none, goal = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert resample.resampled(none, goal).count() == 0
    rows = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], SCHEMA)
    assert sorted(map(tuple, resample.resampled(rows, goal.limit(0)).collect()), key=str) == brute(docs, [])
