import base64
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from waybill.llm import secrets

BAD = ["idiot", "scum", "moron"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, content_key string, kept_doc int, toxicity double"


def word(r):
    return f"w{r.randrange(3000)}"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with toxic ones, near copies, benchmark passages and secrets, and what brute force would leave of them."""
    r, folder = random.Random(8), tmp_path_factory.mktemp("corpus")
    items = [" ".join(word(r) for _ in range(30)) for _ in range(5)]
    texts, fate, labels = {}, {}, {}
    for i in range(300):
        own = [word(r) for _ in range(80)]
        kind = i % 6
        if kind == 1:
            for k in (5, 20, 50):
                own.insert(k, r.choice(BAD))
        elif kind == 2 and i > 20:
            own = texts[i - 12].split()[:-1] + [word(r)]
        elif kind == 3:
            own[10:10] = r.choice(items).split()
        elif kind == 4:
            own.insert(7, f'token = "{r.randrange(16**39, 16**40):x}"')
        texts[i], fate[i] = " ".join(own), kind
        labels[i] = int(kind == 1)
    rows = [(i, t, "en", "s", len(t), "k", 1, 0.5) for i, t in texts.items()]
    rows += [(900, None, None, None, None, None, None, None), (901, "", "en", "s", 0, "", 0, 0.0), (901, "", "en", "s", 0, "", 0, 0.0), (None, "no id here", "en", "s", 10, "", 0, 0.0), (0, texts[0], "en", "s", 1, "k", 1, 0.5)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, 0, v) for i, v in labels.items()] + [(5000, 0, None)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), texts, fate, rows


def grams(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_run_against_brute_force(spark, corpus):
    folder, texts, fate, rows = corpus
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*[c.split()[0] for c in SCHEMA.split(", ")], "token_ids", "n_tokens"]
    got = out.collect()
    clean = [i for i in sorted(texts) if not any(b in texts[i].split() for b in BAD)]
    left: list[int] = []
    for i in clean:  # the copies here are all near the first of their group, so the order of ids settles them
        own = grams(texts[i])
        if not any(100 * len(own & grams(texts[j])) >= 80 * len(own | grams(texts[j])) for j in left):
            left.append(i)
    expected = {i for i in left if fate[i] != 3} | {900, 901, None}
    assert {r.doc_id for r in got} == expected and len(got) == len(expected)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in got:
        assert r.token_ids == plain.encode_ordinary(r.text or "") and r.n_tokens == len(r.token_ids)
        if r.doc_id in texts:
            before = texts[r.doc_id]
            found = secrets.ASSIGN.search(before)
            assert r.text == (before[: found.start()] + "[secret]" + before[found.end() :] if found else before)
            assert r.n_chars == len(r.text) and r.content_key == "k" and r.toxicity == 0.5
    assert any("[secret]" in (r.text or "") for r in got)


def test_stages_on_an_empty_table(spark, corpus):
    folder, *_ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() == 0


def test_stages_keep_clean_rows(spark, corpus):
    folder, *_ = corpus
    rows = [(1, "quite ordinary words in a row, no harm in them", "en", "s", 46, "k", 1, 0.5), (2, None, None, None, None, None, None, None), (3, "", "", "", 0, "", 0, 0.0), (None, "z", "", "", 1, "", 0, 0.0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert sorted([tuple(r)[: len(docs.columns)] for r in stage(spark, docs, folder).collect()], key=str) == sorted(rows, key=str)


def test_entry_lists_every_query():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_stages_deal_rows_out_in_small_batches(spark, corpus):
    folder, setting = corpus[0], "spark.sql.execution.arrow.maxBytesPerBatch"
    wide = spark.range(4000).selectExpr("id AS doc_id", "repeat('w x y ', 500) AS text").repartition(1)

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["held"])

    before = spark.conf.get(setting)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(setting, "64m")
            stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
            assert wide.mapInArrow(sizes, "held long").agg({"held": "max"}).first()[0] < 2 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.set(setting, before)


def test_workers_hold_little_beside_a_full_heap(spark, monkeypatch):
    """The driver's check stopped a later round in toxicity, beside the workers of the last stage that had kept up to 1.5 million pieces."""
    asked = []
    monkeypatch.setattr(corpus_pipeline.bpe, "intact", lambda docs, path, kept=corpus_pipeline.bpe.PIECES_KEPT: asked.append(kept) or docs)
    corpus_pipeline.STAGES[-1][1](spark, spark.range(1), "")
    assert asked[0] <= 300_000 and corpus_pipeline.BATCH_BYTES <= 256 << 10
