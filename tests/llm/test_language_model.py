import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from waybill.llm import language_model as lm
from waybill.llm.quality import GAP  # noqa: F401  the same words


def table(n=2000, seed=1):
    r = np.random.default_rng(seed)
    keys = np.sort(r.choice(2**60, n, replace=False).astype(np.uint64))
    c = r.integers(2, 500, n)
    ids = np.minimum(np.argsort(np.argsort(-c, kind="stable"), kind="stable"), lm.VOCABULARY)
    return lm.Words(keys, c, ids, int(c.sum()) + 100, n + 100, int(c[ids == lm.VOCABULARY].sum()) + int((ids == lm.VOCABULARY).sum()), 201)


def test_probabilities_sum_to_one():
    net = lm.Network(table())
    net.load(net.flat() + np.random.default_rng(2).normal(0, 0.2, len(net.flat())))
    state = np.random.default_rng(3).normal(0, 1, (1, lm.HIDDEN)).astype(np.float32)
    ids = np.arange(lm.VOCABULARY + 2)
    assert np.exp(net.logs(np.repeat(state, len(ids), 0), ids)[0]).sum() == pytest.approx(1, abs=1e-3)


def test_words_are_looked_up_without_a_search(monkeypatch):
    r = np.random.default_rng(6)
    close = np.uint64(7 << 44) + np.arange(0, 60, 3, dtype=np.uint64)  # one beginning for all of these
    keys = np.unique(np.concatenate([close, r.integers(0, 2**64, 3000, np.uint64), np.array([0, 2**64 - 1], np.uint64)]))
    words = lm.Words(keys, r.integers(2, 99, len(keys)), r.integers(0, lm.VOCABULARY + 1, len(keys)), 9, 9, 9, 9)
    assert len(words.starts) == (1 << lm.TOP) + 1
    asked = np.concatenate([keys, keys + np.uint64(1), close + np.uint64(2), r.integers(0, 2**64, 500, np.uint64)])
    known = dict(zip(keys.tolist(), zip(words.ids.tolist(), words.c.tolist(), strict=True), strict=True))
    monkeypatch.setattr(lm.np, "searchsorted", None)
    ids, c = words.look(asked)
    monkeypatch.undo()
    assert list(zip(ids.tolist(), c.tolist(), strict=True)) == [known.get(h, (lm.VOCABULARY + 1, 0)) for h in asked.tolist()]
    assert [a.tolist() for a in words.look(asked[:0])] == [[], []]


def test_gradient():
    net = lm.Network(table())
    r = np.random.default_rng(4)
    states, ids = r.normal(0, 1, (40, lm.HIDDEN)), r.integers(0, lm.VOCABULARY + 2, 40)
    for n in lm.NAMES:
        setattr(net, n, getattr(net, n).astype(float))
    net.class_w += r.normal(0, 0.3, net.class_w.shape)
    net.word_w += r.normal(0, 0.3, net.word_w.shape)
    grads = {n: np.zeros_like(getattr(net, n)) for n in lm.NAMES}
    _, back = net.logs(states, ids, grads)
    for i, j in ((0, 0), (7, 3)):
        moved = states.copy()
        moved[i, j] += 1e-5
        assert -(net.logs(moved, ids)[0].sum() - net.logs(states, ids)[0].sum()) / 1e-5 == pytest.approx(back[i, j], rel=1e-3, abs=1e-5)
    net.class_w[2, 5] += 1e-5
    up = net.logs(states, ids)[0].sum()
    net.class_w[2, 5] -= 1e-5
    assert -(up - net.logs(states, ids)[0].sum()) / 1e-5 == pytest.approx(grads["class_w"][2, 5], rel=1e-3, abs=1e-5)


def test_training_learns_order_and_state_is_carried():
    net, words = lm.Network(table()), np.tile([0, 5, 9, 5, 40, 700], 6000)
    first = np.array([0, 4, 4, 7, 12 * 999])
    before = net.score(words[: first[-1]], first).mean()
    net.train(words)
    after = net.score(words[: first[-1]], first)
    assert after.mean() > before + 0.5
    whole = net.score(words[: first[-1]], np.array([0, first[-1]]))
    long = slice(first[-2], first[-1])  # the same words, once with their document's beginning before them
    assert not np.allclose(whole[long][:2], after[long][:2])
    alone = np.concatenate([net.score(words[a:b], np.array([0, b - a])) for a, b in zip(first, first[1:], strict=False)])
    assert np.allclose(alone, after, atol=1e-4)


def corpus(n=150):
    r = random.Random(1)
    langs = [[f"{p}{k}" for k in range(300)] for p in ("Aa", "bé", "cc")]
    rows = [(i, " ".join(own[min(int(r.expovariate(0.02)), 299)] for _ in range(r.randrange(5, 120)))) for i in range(n) for own in [r.choice(langs)]]
    return rows + [(9001, None), (9002, ""), (9003, "\t\n"), (9004, "never seen"), (9005, "Aa0 " * 9000), (rows[3]), (rows[3]), (None, "Aa1 Aa2")]


def test_counts_and_scores(spark):
    rows = corpus()
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    tokens = [[*(t or "").translate(lower).split(), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(x for own, h in zip(tokens, held, strict=True) if not h for x in own)
    total, distinct = sum(c.values()), len(c)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, word int, part string").repartition(3)
    got = lm.scored(docs, lm.fold()).collect()
    expected = Counter((i, h, len(own), sum(c[x] > 0 for x in own), total, round(sum(math.log10((c[x] + 1) / (total + distinct + 1)) for x in own), 6)) for (i, _), own, h in zip(rows, tokens, held, strict=True))
    assert Counter((*r[:5], round(r.base_score, 6)) for r in got) == expected
    better = [r for r in got if r.held_out and r.n_tokens > 5 and r.n_known == r.n_tokens]
    assert sum(r.score for r in better) > sum(r.base_score for r in better) and all(r.score <= 0 for r in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(16, "a b")], "doc_id long, text string")  # any row: held out by force
    from pyspark.sql import functions as F

    (row,) = lm.scored(docs, F.lit(True)).collect()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0 and math.isfinite(row.score)
    assert lm.scored(docs.limit(0), lm.fold()).count() == 0


def test_the_network_reads_every_training_document(spark):
    own = table()
    own.total = 10**9  # of a large corpus
    words = " ".join(random.Random(7).choices("abcdefgh", k=300))
    for key in (1, 2, 3, 4, 5, None):
        docs = spark.createDataFrame([(key, words)], "doc_id long, text string")
        assert not np.array_equal(lm.trained(docs, own).flat(), lm.Network(own).flat()), key
