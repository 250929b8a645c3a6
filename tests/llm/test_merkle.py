import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from waybill.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, leaf int, at string"


def node(*children):
    return hashlib.sha256("".join(children).encode()).hexdigest()


def leaf(row, text):
    shown = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return node(*map(shown, (row[0], row[3], row[2], row[4], text)))


def altered(row):
    even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return row[1].replace("\n", "") if even and row[1] is not None else row[1]


def levels_of(nodes, arity=3):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([node(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def beside(levels, i, arity=3):
    out = []
    for nodes in levels[:-1]:
        start = i - i % arity
        out.append((nodes[start:i], nodes[i + 1 : start + arity]))
        i //= arity
    return out


def trees_of(rows, text=lambda row: row[1]):
    by = defaultdict(list)
    for row in rows:
        by[row[3]].append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
    trees = {s: levels_of([leaf(r, text(r)) for r in by[s]]) for s in names}
    return names, by, trees, levels_of([trees[s][-1][0] for s in names])


def brute(rows):
    names, by, trees, top = trees_of(rows)
    out = []
    for k, s in enumerate(names):
        for i, row in enumerate(by[s]):
            steps, folded = beside(trees[s], i) + beside(top, k), leaf(row, altered(row))
            for left, right in steps:
                folded = node(*left, folded, *right)
            proof = node(*(x for left, right in steps for x in left + right))
            root = top[-1][0]
            out.append((row[0], trees[s][0][i], trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def table(n=140, seed=5):
    r = random.Random(seed)
    rows = [(i, "".join(r.choices("ab\n é", k=r.randrange(20))), r.choice(["en", None]), r.choice(["a", "a", "a", "b", "é", "", "Z"]), r.choice([3, None])) for i in range(n)]
    rows += [(n, None, "en", "a", 1), (n + 1, "x\ny", None, None, None), (None, "no\nid", "en", "a", 2), (7, "same\nid", "en", "a", 2), (7, "same\nid", "en", "a", 2), (n + 2, "\n" * 100_000, "en", "lone", 0), (-5, "\n", "en", None, 1)]
    return [(*row, "clash", 1, "x") for row in rows]


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_against_brute_force(spark, depth):
    rows = table()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    made = merkle.manifest(docs, merkle.tampered(), F.replace("text", F.lit("\n"), F.lit("")), depth=depth)
    assert sorted(map(tuple, merkle.digest(made).collect()), key=str) == brute(rows)
    if depth == 6:
        assert sorted(map(tuple, merkle.audited(docs).collect()), key=str) == brute(rows)


def test_versions_share_untouched_nodes(spark):
    rows = table(60)
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), merkle.tampered(), F.replace("text", F.lit("\n"), F.lit("")), depth=2)
    _, by, trees, _ = trees_of(rows)
    shared = {(r.tree, r.level, r.at): r.digest for r in made.nodes().collect()}
    assert shared == {("n" if s is None else "s" + s, k, i): d for s, t in trees.items() for k, nodes in enumerate(t) for i, d in enumerate(nodes)}
    copies = defaultdict(dict)
    for r in made.versions().collect():
        copies[r.tree, r.version][r.level, r.at] = r.digest
    changed = {(t, v) for (t, v), c in copies.items() if c[0, v] != shared[t, 0, v]}
    assert changed and all(len(c) == len(trees[None if t == "n" else t[1:]]) for (t, _), c in copies.items())  # a copy for each level
    place = next((i for i, row in enumerate(by["a"]) if altered(row) != row[1]))
    own = by["a"][place]
    expected = levels_of([leaf(r, altered(r) if r is own else r[1]) for r in by["a"]])
    assert {(r.level, r.at): r.digest for r in made.view("sa", place).collect()} == {(k, i): d for k, nodes in enumerate(expected) for i, d in enumerate(nodes)}


def test_small_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.audited(none).count() == 0
    one = [(3, "a\nb", "en", "s", 3, "", 0, "")]
    assert [tuple(r) for r in merkle.audited(spark.createDataFrame(one, SCHEMA)).collect()] == brute(one)
    assert merkle.audited(spark.createDataFrame(one, SCHEMA)).first().proof_sha256 == hashlib.sha256(b"").hexdigest()
