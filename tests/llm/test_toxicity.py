import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from waybill.llm import toxicity

TERMS = [("idiot", False), ("disgusting", False), ("scum", False), ("lowei", True), ("crétin", True)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def matches(word):
    """Brute force: does any term accept the word?"""
    for term, stem in TERMS:
        most = toxicity.edits_of(term, stem)
        if stem and any(distance(word[:k], term) <= most for k in range(len(word) + 1)) or not stem and distance(word, term) <= most:
            return True
    return False


def test_automaton_is_levenshtein():
    r = random.Random(1)
    machine = toxicity.automaton(TERMS)
    words = ["idiot", "idiott", "diot", "odiot", "disgustng", "disgusst", "loweischaft", "lowe", "crétins", "xcrétin", "cretin", "scu", ""]
    for _ in range(3000):
        own = list(r.choice(TERMS)[0])
        for _ in range(r.randrange(4)):
            k = r.randrange(len(own) + 1)
            own[k : k + r.randrange(2)] = [r.choice("abdiotscumlwé")] * r.randrange(2)
        words.append("".join(own))
    words = [w for w in words if w]
    points = np.concatenate([np.array([ord(c) for c in w], np.uint32) for w in words])
    ends = np.cumsum([len(w) for w in words])
    hit, _, edits = machine.run(points, ends - [len(w) for w in words], ends)
    assert {words[i] for i in hit} == {w for w in words if matches(w)}
    exact = {words[i] for i, e in zip(hit, edits, strict=True) if e == 0}
    assert {"idiot", "loweischaft", "crétins"} <= exact and "idiott" not in exact


def model():
    own = toxicity.Model(TERMS, np.ones(len(TERMS)), machine=toxicity.automaton(TERMS))
    own.beta = np.array([-3.0, 3, 3, 0, 0, 0, 0])
    return own


def test_quotation_counts_less_than_abuse():
    x = toxicity.features(model(), pa.array(["you idiot, you disgustng scum", 'he said "idiot" and wrote "scum" in the report', "plain words", None, "", "...!"]))
    assert x[0, 1] > x[1, 1] and x[1, 3] > 0 and x[0, 2] > 0
    assert (x[2:, 1:] == 0).all() and (x[:, 0] == 1).all()


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(tables):
    docs, labels = tables
    held = toxicity.fold() == 0
    fitted = toxicity.learn(docs, labels.where(~held))
    rows = toxicity.scored(docs.select("doc_id", "text"), fitted).join(labels.where(held), "doc_id").collect()
    right = np.mean([(r.toxicity >= 0.5) == (r.toxic > 0) for r in rows])
    assert len(rows) == len([r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]) and right >= 0.95
    assert 0 <= min(r.toxicity for r in rows) and max(r.toxicity for r in rows) <= 1


def test_edges(spark, tables):
    rows = [(1, "idiot", 0.5, "x"), (2, None, None, None), (3, "", 0.1, ""), (3, "", 0.1, ""), (None, "a " * 40000 + "idiot", 0.0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxicity double, toxic_text string")
    got = toxicity.scored(docs, model()).collect()
    assert len(got) == 5 and all(0 <= r.toxicity <= 1 for r in got) and got[0].toxicity > 4 * got[2].toxicity
    left = toxicity.kept(docs, model(), 0.1).collect()
    assert [tuple(r) for r in left][:3] == rows[1:4] and left[0].toxicity is None
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.scored(docs, toxicity.learn(docs, none)).agg({"toxicity": "max"}).first()[0] < 1e-9
    ones = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    assert toxicity.scored(docs, toxicity.learn(docs, ones)).agg({"toxicity": "max"}).first()[0] < 1e-9
    assert toxicity.scored(docs.limit(0), model()).count() == 0
