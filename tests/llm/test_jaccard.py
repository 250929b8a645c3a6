import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from waybill.llm import jaccard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, size, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if rows[a][0] is not None and rows[b][0] is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), d if d is None else least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["The", "of", "and"]) if r.random() < 0.3 else f"w{r.randrange(800)}"
    rows, ids = [], iter(r.sample(range(5000), 400))
    for _ in range(25):
        base = [word() for _ in range(r.choice([2, 4, 8, 30, 60, 120]))]
        for _ in range(r.choice([1, 1, 3, 12])):
            own = list(base)
            for _ in range(r.randrange(4)):
                k = r.randrange(len(own) + 1)
                own[k : k + r.randrange(2)] = [word()] * r.randrange(2)
            base = own if r.random() < 0.5 else base  # chains: near copies of near copies
            rows.append((next(ids), " ".join(own).upper() if r.random() < 0.2 else "\n".join(own)))
    rows += [(next(ids), t) for _, t in rows[:5]] + [(next(ids), None), (next(ids), ""), (next(ids), " \t"), (None, rows[0][1]), (None, None), rows[2], rows[2]]
    r.shuffle(rows)
    return rows


def found(spark, rows, size=4, percent=85):
    docs = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, node int, root string").repartition(4)
    return sorted(map(tuple, jaccard.classes(docs, size, percent).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def test_against_brute_force(spark):
    rows = corpus(1)
    assert found(spark, rows) == brute(rows, 4, 85)


def test_other_sizes_and_hot_shingles(spark, monkeypatch):
    rows = corpus(2)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    monkeypatch.setattr(jaccard, "HOT", 4)
    assert found(spark, rows, 5, 80) == brute(rows, 5, 80)


def passages(seed):
    """Different documents around one passage that all of them share, and near copies of a few."""
    r = random.Random(seed)
    common = [f"c{i}" for i in range(60)]
    rows = []
    for d in range(60):
        own = [f"w{r.randrange(3000)}" for _ in range(r.choice([3, 6, 8, 10, 14, 60]))]
        cut = r.randrange(len(own) + 1)
        base = own[:cut] + common + own[cut:]
        for c in range(r.choice([1, 1, 1, 4])):
            copy = list(base)
            for _ in range(r.randrange(3) if c else 0):
                copy[r.randrange(len(copy))] = f"e{r.randrange(3000)}"
            rows.append((10 * d + c, " ".join(copy)))
    return rows


def test_a_passage_that_many_share(spark, monkeypatch):
    rows = passages(3)
    assert found(spark, rows) == brute(rows, 4, 85)
    monkeypatch.setattr(jaccard, "OFTEN", 2)  # the passage makes no keys: such sets meet in their prefixes
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    assert found(spark, rows) == brute(rows, 4, 85)


def test_a_pair_is_made_once(spark, monkeypatch):
    r = np.random.default_rng(7)
    family = np.unique(r.integers(0, 2**64, 400, np.uint64))
    sets = {k: np.unique(np.append(r.choice(family, 350, replace=False), r.integers(0, 2**64, 30 + 2 * (k % 20), np.uint64))) for k in range(40)}
    hot = (family[:0], family[:0])
    rows = [(int(key), node, node, upper) for node, own in sets.items() for keys, upper in jaccard.keys_of(own, 85, hot) for key in jaccard.signed(keys)]
    live = spark.createDataFrame(rows, "key long, node long, root long, upper boolean")
    split = live.groupBy("key").count().where("count > 1").select("key")
    live = live.join(split, "key").cache()
    words = jaccard.parities(list(sets.values()))
    sketches = spark.createDataFrame([(k, len(own), None, *map(int, w)) for (k, own), w in zip(sets.items(), words, strict=True)], f"node long, n int, counts binary, {', '.join(w + ' long' for w in jaccard.WORDS)}")

    def pairs():
        return [tuple(row) for row in jaccard.across(live, sketches, 60).collect()]

    every = {(min(a, b), max(a, b)) for _, a, b in live.toDF("key", "a", "ra", "ua").join(live.toDF("key", "b", "rb", "ub"), "key").where("a < b and not (ua and ub)").select("key", "a", "b").collect()}
    monkeypatch.setattr(jaccard, "CROWDED", 1)
    monkeypatch.setattr(jaccard, "possible", lambda percent: ~(F.col("s.upper") & F.col("t.upper")))
    for least in (1, 3):  # lists too short to meet lose nothing
        monkeypatch.setattr(jaccard, "LEAST", least)
        assert set(pairs()) == every
    monkeypatch.setattr(jaccard, "LEAST", 1000)
    assert sorted(pairs()) == sorted(every)
    monkeypatch.setattr(jaccard, "CROWDED", 1000)
    assert set(pairs()) == every and len(pairs()) > 2 * len(every)


def test_keys_meet_where_sets_are_linked():
    r = np.random.default_rng(5)
    for percent in (80, 85):
        for n in [5, 9, 14, 30, 80, 300, 2000]:
            for _ in range(20):
                both = np.unique(r.integers(0, 2**64, n, np.uint64))
                left = int(len(both) * (100 - percent) / percent * r.random())
                x = np.unique(np.concatenate([both, r.integers(0, 2**64, left, np.uint64)]))
                y = np.unique(np.concatenate([both, r.integers(0, 2**64, int(len(both) * (100 - percent) / percent) - left, np.uint64)]))
                if 100 * len(both) < percent * (len(x) + len(y) - len(both)) or np.array_equal(x, y):
                    continue
                often = np.sort(r.choice(both, len(both) // r.integers(1, 5)))
                hot = (often, np.arange(len(often)))
                a, b = ({(k, up) for keys, up in jaccard.keys_of(s, percent, hot) for k in keys.tolist()} for s in (x, y))
                assert {k for k, up in a if not up} & {k for k, _ in b} or {k for k, up in b if not up} & {k for k, _ in a}


def test_nothing_to_link(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "a b c d e"), (2, None)]) == [(1, 2, 1), (2, 0, 2)]


def test_long_chain_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.root) for r in jaccard.components(links).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
