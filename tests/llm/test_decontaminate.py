import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from waybill.llm import decontaminate
from waybill.llm.text import chunks

WORD = re.compile(r"[a-z0-9\x80-\U0010ffff]+")


def make(seed=1):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(r.choice([3, 8, 15, 23, 40, 59])))) for i in range(40)]
    docs, truth = [], set()
    for d in range(120):
        words = [word() for _ in range(r.randrange(20, 200))]
        if r.random() < 0.4:
            i, text = r.choice(items)
            at = r.randrange(len(words))
            words[at:at] = [x.upper() + "," if r.random() < 0.2 else x for x in text.split()]
            truth.add((d, i))
        docs.append((d, "\n".join(words) if d % 2 else " ".join(words)))
    return docs, items, truth


def found(spark, docs, items, most=decontaminate.ITEMS):
    rows = decontaminate.leaks(spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int").repartition(3), spark.createDataFrame(items, "item_id long, text string"), most)
    return {(r.doc_id, r.item_id): r for r in rows.collect()}


def test_exact_passages(spark):
    docs, items, truth = make()
    got = found(spark, docs, items)
    assert set(got) == truth and all(r.similarity == 1 for r in got.values())
    texts, bench = dict(docs), dict(items)
    for (d, i), r in got.items():
        assert WORD.findall(texts[d].lower())[r.first_word : r.first_word + r.n_words] == bench[i].split()
    assert set(found(spark, docs, items, most=7)) == truth  # in several passes


def test_changed_passages(spark):
    r = random.Random(4)
    item = [f"w{k}" for k in range(59)]
    docs, close = [], set()
    for d in range(60):
        own = list(item)
        for _ in range(d % 4):
            own[r.randrange(len(own))] = f"x{r.randrange(99)}"
        text = [f"y{r.randrange(9999)}" for _ in range(50)]
        text[20:20] = own
        docs.append((d, " ".join(text)))
        grams = lambda w: Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        a, b = grams(item), grams(own)
        if sum((a & b).values()) >= 0.82 * sum((a | b).values()):
            close.add(d)
    got = {d for d, _ in found(spark, docs, [(1, " ".join(item))])}
    assert len(close - got) <= 0.1 * len(close) and all(sum(w.startswith("x") for w in dict(docs)[d].split()) <= 3 for d in got) and len(got) >= 15


def test_blocks_lose_nothing_within_the_radius():
    r = np.random.default_rng(5)
    own = decontaminate.index([(i, " ".join(f"w{x}" for x in r.integers(0, 999, 40))) for i in range(50)])
    (size,) = own.sizes
    base = own.prints[size][0]
    prints = np.concatenate([base ^ np.array([sum(1 << int(b) for b in r.choice(64, k, replace=False)) for _ in base], np.uint64) for k in range(0, 12)])
    window, entry = decontaminate.proposed(own, size, prints)
    near = np.bitwise_count(prints[:, None] ^ base[None]) <= decontaminate.RADIUS
    assert set(zip(window.tolist(), entry.tolist(), strict=True)) == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_simhash_is_the_majority_of_the_words():
    h = np.random.default_rng(6).integers(0, 2**63, 90).astype(np.uint64)
    bits = np.unpackbits(decontaminate.mix(h).view(np.uint8).reshape(90, 8), axis=1)
    for size, prints in decontaminate.fingerprints(h, [1, 15, 41, 200]):
        expected = [np.packbits(bits[i : i + size].sum(0) > size // 2).view(np.uint64)[0] for i in range(90 - size + 1)]
        assert prints.tolist() == expected


def test_edges(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "one two three four five six"), (5, "x " * 30000 + "One two three, four five six!"), (6, "one two")]
    items = [(1, "one two three four five six"), (2, None), (3, ""), (1, "one two three four five six"), (9, "...")]
    assert set(found(spark, docs, items)) == {(None, 1), (5, 1)}
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}
    frame = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, similarity string")
    left = [tuple(r) for r in decontaminate.clean(frame, spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert left == [(*d, "k") for d in docs if d[0] not in (None, 5)]
    assert decontaminate.matches(decontaminate.index([(1, "a b")]), pa.array(["", None], pa.string())) == []


def test_words_put_in_and_left_out():
    r = random.Random(8)
    for n, change in ((59, 4), (80, 6), (80, -6), (120, 12), (120, -10), (400, 50), (400, -50)):
        item = [f"w{k}" for k in range(n)]
        found = decontaminate.index([(1, " ".join(item))])
        n_proposed, n_found = 0, 0
        for _ in range(30):
            at, own = r.randrange(10, n - 60 if n > 200 else n - 15), list(item)
            own[at : at + max(0, -change)] = [f"x{r.randrange(9999)}" for _ in range(change)]
            text = [f"y{k}" for k in range(50)] + own + [f"z{k}" for k in range(50)]
            hashes, *_ = decontaminate.item_words(*decontaminate.utf8(pa.array([" ".join(text)], pa.string())))
            alike = decontaminate.similarity(found.bags[0], decontaminate.bag(hashes[50:-50], found.weight, found.rare))
            prints = [p for _, p in decontaminate.fingerprints(hashes, found.sizes)]
            if alike < 0.8 or not prints or not len(decontaminate.proposed(found, found.sizes[0], prints[0])[0]):
                continue
            n_proposed += 1
            got = decontaminate.matches(found, pa.array([" ".join(text)], pa.string()))
            n_found += len(got) == 1 and got[0][2] >= alike - 1e-9  # the whole passage, or a part of it that is still closer
        assert n_proposed >= 10 and n_found == n_proposed, (n, change, n_proposed, n_found)


def test_the_best_window_of_all():
    r = random.Random(9)
    for _ in range(60):
        item = [r.choice("abcdefgh") for _ in range(r.randrange(5, 30))]
        own = [x for x in item if r.random() > 0.03]
        words = [r.choice("abcdefgh") for _ in range(r.randrange(6))] + own + [r.choice("abcdefgh") for _ in range(r.randrange(6))]
        found = decontaminate.index([(1, " ".join(item)), (2, "a b c d")])
        hashes, *_ = decontaminate.item_words(*decontaminate.utf8(pa.array([" ".join(words)], pa.string())))
        windows = [(a, b) for a in range(len(words)) for b in range(a + 1, min(len(words), a + decontaminate.longest(len(item))) + 1)]
        alike = max(decontaminate.similarity(found.bags[0], decontaminate.bag(hashes[a:b], found.weight, found.rare)) for a, b in windows)
        got = decontaminate.aligned(found, 0, hashes, len(words))
        assert (got is None and alike < 0.8) or abs(got[0] - alike) < 1e-9


def test_work_space_of_a_chunk_is_small():
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(3000)}" for _ in range(400)) for _ in range(600)]
    own = decontaminate.index([(1, " ".join(texts[0].split()[:40]))])
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    found = []
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        for part in chunks([batch], limit=decontaminate.CHUNK):
            found += decontaminate.matches(own, part.column("text"))
        most = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert len(found) == 1 and found[0][2:4] == (1.0, 0)
    assert most < 60e6, f"{most / 1e6:.0f} MB"
