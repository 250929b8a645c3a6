import base64
import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from waybill.llm import bpe, token_files

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a", "  a  b ", "don't we'll 's 'sam it's's", "日本語 🙂‍x é", "\n\n a\n b", "<|endoftext|> x", "a\x00b\x1c c", "1234 5,6", "x" * 30000, " \xa0 tab\t\r\n"]


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n=400, seed=3):
    r = random.Random(seed)
    bits = [*" \t\n\r\x85\xa0　abZé1²́'ß漢🙂.,!-ſ  \n'", "'s", "'re", "\n\n", " the", "ing", "***"]
    return ["".join(r.choices(bits, k=r.randrange(60))) for _ in range(n)]


def test_ids_as_the_plain_library(plain):
    own = texts(4000) + [t or "" for t in ODD] + [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    for kept in (10**6, 500):  # a memory that holds all pieces, and one that is emptied all the time
        ids, bounds = bpe.Encoder(RANKS, kept).flat(*bpe.utf8(pa.array(own)))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == plain.encode_ordinary_batch(own)


def test_round_trip_rows(spark, plain):
    rows = [(i, t, 1, "x") for i, t in enumerate(ODD)] + [(1, "", 2, "y"), (1, "", 2, "y"), (None, "no id", 0, "")]
    got = bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string"), RANKS).collect()
    expected = []
    for i, t, *_ in rows:
        ids = plain.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_offsets_and_split_characters(spark):
    rows = [(1, "añ🙂 z"), (2, None), (3, "")]
    out = {r.doc_id: r for r in bpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, offsets=True).collect()}
    one, raw = out[1], "añ🙂 z".encode()
    table = bpe.token_bytes(RANKS)
    assert [raw[a:b] for a, b in zip(one.byte_start, one.byte_end, strict=True)] == [table[i] for i in one.token_ids]
    spans = list(zip(one.char_start, one.char_end, strict=True))
    assert spans.count((2, 3)) > 1 and spans[-1] == (3, 5)  # the emoji is split over tokens; each covers all of it
    assert out[2].token_ids == [] == out[3].char_end
    back = bpe.decode(spark.createDataFrame([(1, one.token_ids, "clash"), (2, one.token_ids[:3], ""), (3, None, ""), (4, [-1, 10**6], "")], "doc_id long, token_ids array<int>, decoded string"), RANKS)
    text = {r.doc_id: (r.decoded, r.decoded_bytes) for r in back.collect()}
    assert text[1] == ("añ🙂 z", bytearray(raw)) and "�" in text[2][0] and text[3] == (None, None) and text[4][0] == ""


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, bpe_text string")
    assert bpe.round_trip(none, RANKS).count() == 0
    assert bpe.intact(none, RANKS).columns == ["doc_id", "text", "bpe_text", "token_ids", "n_tokens"] and bpe.intact(none, RANKS).count() == 0


def test_token_files(spark, tmp_path):
    import zlib

    from tokenizers import Tokenizer

    own = Tokenizer.from_file(JSON)  # the plain library: the name of a special token in a text is its one id
    assert own.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    rows = [(100 - i, t, 7) for i, t in enumerate([*ODD, *texts(50)])] + [(100, "tie", 7), (None, "no id", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    for encoding in ("dictionary", "delta"):
        path = str(tmp_path / encoding)
        token_files.write(docs, path, JSON, encoding)
        got = [tuple(r) for r in token_files.checked(token_files.read(spark, path)).orderBy("start").collect()]
        expected, start = [], 0
        for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
            expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert got == expected
    assert {r.doc_id for r in token_files.read_documents(spark, path, 60, 70).collect()} <= set(range(60, 71))
    import pyarrow.parquet as pq

    part = next(p for p in sorted((tmp_path / "delta").glob("*.parquet")) if pq.ParquetFile(p).metadata.num_rows)
    column = pq.ParquetFile(part).metadata.row_group(0).column(4)
    assert "DELTA_BINARY_PACKED" in column.encodings and column.has_offset_index
    empty = str(tmp_path / "empty")
    token_files.write(docs.limit(0), empty, JSON)
    assert token_files.checked(token_files.read(spark, empty)).count() == 0
    with pytest.raises(ValueError):
        token_files.options("none")


def test_ids_with_few_pieces_kept(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = spark.createDataFrame(list(enumerate(texts(200))), "doc_id long, text string").repartition(3)
    few, many = (sorted(bpe.intact(docs, path, **kept).select("doc_id", "token_ids").collect()) for kept in ({"kept": 50}, {}))
    assert few == many
