import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from waybill.llm import piece_bpe

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", "  a  b ", "don't 's", "日本語 🙂‍x é", "\n\n a\n b", "<s> </s> <0x41> <unk>", "a\x00b\x1c", "1234 5,6", "x" * 30000, " " * 5000, "▁", "▁▁ a▁", "﷽ﷺ", "ab" * 3000, " \xa0 tab\t\r\n", "̈́"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts(library, n):
    r = random.Random(4)
    bits = [*" \t\n\r\x85\xa0abZé1²'漢🙂.,!-ſ   ▁\x00", "  ", "    " * 5, " the", "ing", "hello", "пре", "xxxx", "<s>"]
    pieces = [library.id_to_piece(i) for i in range(259, len(library))]
    return ["".join(r.choices(bits, k=r.randrange(40))) for _ in range(n)] + ["".join(r.choices(pieces, k=r.randrange(10))) for _ in range(n)]


def test_ids_as_the_library(library):
    own = texts(library, 3000) + [t or "" for t in ODD] + [t for (t,) in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    expected = library.encode(own, add_bos=True, add_eos=True)
    for kept in (10**6, 300):  # a memory that holds all stretches, and one that is emptied all the time
        coder, got = piece_bpe.PieceEncoder(PATH, kept), []
        for at in range(0, len(own), 100):
            ids, bounds, decoded, upto = coder.rows(pa.array(own[at : at + 100]))
            got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
            assert [bytes(decoded[a:b]).decode() for a, b in zip(upto, upto[1:], strict=False)] == library.decode(expected[at : at + 100])
        assert got == expected


def test_a_row_that_differs_is_encoded_by_itself(library, monkeypatch):
    coder = piece_bpe.PieceEncoder(PATH)
    monkeypatch.setattr(piece_bpe, "hash_spans", lambda data, starts, ends: np.zeros(len(starts), np.uint64))  # every stretch alike
    ids, bounds, *_ = coder.rows(pa.array(["one two", "", "three"]))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == library.encode(["one two", "", "three"], add_bos=True, add_eos=True)


def test_positions_are_not_tried_twice():
    """A text on which a search without marks would turn back again and again, in steps that grow with its length alone."""
    model = piece_bpe.model(PATH)
    for text in ("".join(random.Random(2).choices("aeinst", k=50_000)), "aab" * 10_000):
        seen = []
        fit, model.fit = model.fit, lambda a, b: seen.append(1) or fit(a, b)
        try:
            model.encode([text])
        finally:
            del model.fit
        assert len(seen) < 8 * len(text)


def test_decoding_any_ids(library):
    model, r = piece_bpe.model(PATH), random.Random(6)
    for _ in range(4000):
        ids = [r.choice([r.randrange(32000), r.randrange(262), r.randrange(130, 259)]) for _ in range(r.randrange(8))]
        assert piece_bpe.text_of(ids, model) == library.decode(ids)


def test_round_trip_rows(spark, library):
    rows = [(i, t, 1, "x") for i, t in enumerate(ODD)] + [(1, "", 2, "y"), (1, "", 2, "y"), (None, "no id", 0, "")]
    got = piece_bpe.round_trip(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string"), PATH).collect()
    expected = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        expected.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_columns_beside(spark, library):
    docs = spark.createDataFrame([(1, "añ🙂 z", "p", "old"), (2, None, "q", "old"), (2, None, "q", "old")], "doc_id long, text string, piece_text string, token_ids string")
    out = piece_bpe.encode(docs, PATH)
    assert out.columns == ["doc_id", "text", "piece_text", "token_ids"]
    assert sorted((r.doc_id, r.piece_text, r.token_ids) for r in out.collect()) == [(1, "p", library.encode("añ🙂 z", add_bos=True, add_eos=True)), (2, "q", [1, 2]), (2, "q", [1, 2])]
    assert piece_bpe.encode(docs, PATH, ends=False).where("doc_id = 1").first().token_ids == library.encode("añ🙂 z")
    ids = spark.createDataFrame([(1, library.encode("a b"), 0), (2, None, 0), (3, [None, -1, 10**6], 0), (4, [228, 29871], 0)], "doc_id long, token_ids array<int>, decoded int")
    assert {r.doc_id: r.decoded for r in piece_bpe.decode(ids, PATH).collect()} == {1: "a b", 2: None, 3: "", 4: library.decode([228, 29871])}
    none = docs.limit(0)
    assert piece_bpe.encode(none, PATH).count() == 0 == piece_bpe.round_trip(none, PATH).count() == piece_bpe.decode(ids.limit(0), PATH).count()


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as raw:
        proto.ParseFromString(raw.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        piece_bpe.Model(str(path))
