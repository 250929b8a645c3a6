import hashlib
import random
import re

from waybill.llm import substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    low = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - window + 1 if i is not None else 0):
            g = tuple(w[k : k + window])
            low[g] = min(i, low.get(g, i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if low[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "of"]) if r.random() < 0.2 else f"w{r.randrange(4000)}é"
    passages = [[word() for _ in range(r.choice([49, 50, 51, 80, 120]))] for _ in range(4)]
    rows = []
    for i in range(n):
        words = [word() for _ in range(r.randrange(5, 150))]
        for _ in range(r.randrange(3)):
            own = list(r.choice(passages))
            if r.random() < 0.3:
                own[r.randrange(len(own))] = word()
            at = r.randrange(len(words))
            words[at:at] = own
        rows.append((r.randrange(10 * n), r.choice([" ", "\n", "\t "]).join(words)))
    rows += [(rows[0][0] + 1000, rows[0][1]), (rows[1][0] + 1000, "x " + rows[1][1]), (7, "ha " * 300), (8, "ha " * 200), (9, " "), (10, None), (11, ""), (None, rows[0][1]), rows[3], rows[3], (rows[4][0], rows[5][1])]
    r.shuffle(rows)
    return rows


def found(spark, rows, window=50):
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, content int, spans int").repartition(4)
    return sorted(map(tuple, substrings.deduplicated(docs, window).collect()), key=str)


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        assert found(spark, rows) == brute(rows, 50)


def test_small_windows_branch_everywhere(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("ab") for _ in range(40))) for i in range(40)]
    assert found(spark, rows, 14) == brute(rows, 14)


def test_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a  b\nc"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in substrings.deduplicated(docs, texts=True).collect()} == {1: "a b c", 2: ""}
    assert substrings.deduplicated(docs.limit(0)).count() == 0


def test_smallest_is_the_first_of_equals():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 6, 300).astype(np.uint64) << np.uint64(24)
    got = substrings.smallest(values, 39)
    assert got.tolist() == [i + int(np.argmin(values[i : i + 39])) for i in range(262)]
