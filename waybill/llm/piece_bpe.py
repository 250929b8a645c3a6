"""SentencePiece encoding and decoding of merge-type models (operator 12).

A sequence of pieces is what merging makes of a text exactly if every two neighbours are what merging makes of their own two texts:
merges inside a piece keep their order when other text stands beside them, so the first merge across a bound would come up in the
pair as well. So a text is encoded from left to right by its longest pieces (Aho-Corasick, over pieces that merging makes at all);
a piece that doesn't go with the one before gives way to the next shorter one, then to a shorter one before it. A text has one such
sequence, so a position from which the search had to turn back is never tried again: a bit marks it.

Whether two pieces go together is found by merging their text again, best score first, the leftmost of equal ones, and remembered.

Texts are cut between characters that stand side by side in no piece, so equal stretches need encoding only once: each Python worker
keeps the ids of PIECES_KEPT stretches at most, by a 64-bit hash. Every row is decoded and compared with its text; one that differs
is encoded by itself, without the memory.

Null and empty texts have no pieces besides begin and end. Rows may repeat and come in any order; other columns may have any names.
U+2581 in a text is a space, as in the library. Characters of no piece become the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import itertools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

from waybill.llm.bpe import Encoder, ranges
from waybill.llm.text import chunks, fresh, hash_spans, utf8

SPACE = "▁"
PIECES_KEPT = 1_500_000  # stretches of text whose ids a worker remembers
PAIRS_KEPT = 4_000_000  # pairs of pieces of which a worker remembers whether they go together
APART = "\0"  # stands between stretches that are searched together; no piece has it


class Model:
    """Pieces, their scores and bytes, and which of them merging can make."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as raw:
            proto.ParseFromString(raw.read())
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece.Type
        trainer, rules = proto.trainer_spec, proto.normalizer_spec
        plain = rules.add_dummy_prefix and rules.escape_whitespaces and not (rules.precompiled_charsmap or rules.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix)
        if trainer.model_type != trainer.BPE or not trainer.byte_fallback or not plain or {p.type for p in proto.pieces} - {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}:
            raise ValueError("a merge-type model with byte pieces, a prefix space, no normalisation and no pieces of the user is expected")
        library = SentencePieceProcessor(model_file=path)
        self.begin, self.end, self.unknown = library.bos_id(), library.eos_id(), library.unk_id()
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.texts = [p.piece if p.type == kinds.NORMAL else "" for p in proto.pieces]
        self.bytes = [bytes([self.byte_of[i]]) if i in self.byte_of else t.replace(SPACE, " ").encode() for i, t in enumerate(self.texts)]
        self.known = {t for t in self.ids if len(t) == 1}
        if not all(self.known.issuperset(t) for t in self.ids) or any(APART in t for t in self.ids):
            raise ValueError("every character of a piece is expected to be a piece")
        self.together: dict[int, bool] = {}
        valid = {t: i for t, i in self.ids.items() if len(t) == 1 or self.merged(t) == [t]}
        self.sizes = [len(t) for t in self.texts]
        self.shorter = [-1] * len(self.texts)
        for text, i in valid.items():
            self.shorter[i] = next((valid[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in valid), -1)
        self.automaton = ahocorasick.Automaton()
        for text, i in valid.items():
            self.automaton.add_word(text, (i, len(text) - 1))
        self.automaton.make_automaton()

    def merged(self, text: str) -> list[str]:
        """What merging makes of a text of known characters: the pair of the best score first, the leftmost of equal ones."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i, pair in enumerate(map(str.__add__, parts, parts[1:])):
                score = scores.get(pair)
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, a: int, b: int) -> bool:
        """Whether merging the text of two pieces makes these two."""
        key = a << 20 | b
        known = self.together.get(key)
        if known is None:
            if len(self.together) >= PAIRS_KEPT:
                self.together.clear()
            known = self.together[key] = self.merged(self.texts[a] + self.texts[b]) == [self.texts[a], self.texts[b]]
        return known

    def search(self, longest: list[int], low: int, high: int) -> list[int]:
        """The ids of the stretch [low, high); longest[i] is the longest piece that starts at i."""
        sizes, shorter, fit = self.sizes, self.shorter, self.fit
        failed = bytearray((high - low >> 3) + 1)
        found: list[int] = []
        at, piece = low, longest[low]
        while at < high:
            after = at + sizes[piece]
            bit = after - low
            if not failed[bit >> 3] >> (bit & 7) & 1 and (not found or fit(found[-1], piece)):
                found.append(piece)
                at = after
                piece = longest[at] if at < high else -1
                continue
            piece = shorter[piece]
            while piece < 0:  # nothing fits here: back to the piece before
                failed[at - low >> 3] |= 1 << (at - low & 7)
                last = found.pop()
                at -= sizes[last]
                piece = shorter[last]
        return found

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """The ids of each stretch; spaces are written as SPACE. Every stretch is judged by itself."""
        known, made, plain = self.known, [], []
        for text in stretches:
            if known.issuperset(text):
                made.append(None)
                plain.append(text)
                continue
            ids: list[int] = []
            for own, run in itertools.groupby(text, known.__contains__):  # no merge reaches across characters of no piece
                ids += self.encode(["".join(run)])[0] if own else [self.byte_ids[b] for b in "".join(run).encode()]
            made.append(ids)
        joined = APART.join(plain)
        longest = [-1] * len(joined)
        for end, (piece, back) in self.automaton.iter(joined):  # ends rise, so the longest piece of a start comes last
            longest[end - back] = piece
        at, rest = 0, iter(plain)
        for i, ids in enumerate(made):
            if ids is None:
                size = len(next(rest))
                made[i] = self.search(longest, at, at + size)
                at += size + 1
        return made


@functools.cache
def model(path: str) -> Model:
    return Model(path)


def _ascii_bounds(of: Model) -> np.ndarray:
    """[a, b]: whether a text is cut between the ASCII characters a and b (a space stands for SPACE): in no piece b follows a."""
    cut = np.ones((128, 128), bool)
    shown = {SPACE: 32}
    for text in of.ids:
        for a, b in zip(text, text[1:]):
            a, b = shown.get(a, ord(a)), shown.get(b, ord(b))
            if a < 128 and b < 128:
                cut[a, b] = False
    return cut


class PieceEncoder(Encoder):
    """Ids of texts, with the bounded memory of the byte-level encoder over this model's stretches."""

    def __init__(self, path: str, kept: int = PIECES_KEPT):
        self.model, self.kept = model(path), kept
        self.sizes = np.array([len(b) for b in self.model.bytes], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.model.bytes), np.uint8)
        self.cut = _ascii_bounds(self.model)
        self.before_space = not any(SPACE in t.lstrip(SPACE) for t in self.model.ids)
        self.old = self.new = self.empty()

    def starts(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where stretches start: at rows, between ASCII characters that are neighbours in no piece, and, where no piece has a space
        after another character, before a space that follows one."""
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge = edge[:-1]
        a, b = data[:-1], data[1:]
        narrow = (a < 128) & (b < 128)
        edge[1:] |= narrow & self.cut[a & 127, b & 127]
        if self.before_space:
            edge[1:] |= (a != 32) & (b == 32)
        return np.flatnonzero(edge)

    def ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all stretches, number of ids of each)."""
        got = self.model.encode([t.replace(" ", SPACE) for t in texts])
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(counts.sum())), counts

    def flat(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows as one array, bounds of the rows in it); the rows have their prefix space."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts = self.starts(offsets, data)
        ends = np.append(starts[1:], len(data))
        keys, where, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        hit, place, size = self.find(keys)
        if not hit.all():
            if len(self.old[0]) + len(self.new[0]) + len(keys) > self.kept:  # what came up last stays
                self.old, self.new = (self.new if len(self.new[0]) < self.kept // 2 else self.empty()), self.empty()
                hit, place, size = self.find(keys)
            lost, raw = np.flatnonzero(~hit), data.tobytes()
            ids, counts = self.ask([raw[a:b].decode() for a, b in zip(starts[where[lost]].tolist(), ends[where[lost]].tolist(), strict=True)])
            self.new = self.merged(self.new, (keys[lost], np.cumsum(counts) - counts, counts.astype(np.int32), ids))
            if 4 * len(self.new[0]) > len(self.old[0]) and len(self.old[0]) + len(self.new[0]) < self.kept // 2:
                self.old, self.new = self.merged(self.old, self.new), self.empty()
            hit, place, size = self.find(keys)
        pool = np.concatenate([self.old[3], self.new[3]])
        upto = np.concatenate([[0], np.cumsum(size[back])])
        return pool[ranges(place[back], size[back])], upto[np.searchsorted(starts, offsets)]

    def rows(self, column: pa.Array, ends: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, their bounds by row, decoded bytes, their bounds by row), with begin and end ids if `ends`."""
        column = pc.replace_substring(pc.fill_null(column, ""), SPACE, " ")
        offsets, data = utf8(column)
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 32)
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        ids, bounds = self.flat(offsets, data)
        upto = np.concatenate([[0], np.cumsum(self.sizes[ids])])[bounds]
        decoded = self.back(ids)
        if not np.array_equal(upto, offsets) or not np.array_equal(decoded, data):
            got = self.model.encode([(" " + t).replace(" ", SPACE) if t else "" for t in column.to_pylist()])
            ids, bounds = np.array([i for g in got for i in g], np.uint32), np.concatenate([[0], np.cumsum([len(g) for g in got])])
            decoded, upto = self.back(ids), np.concatenate([[0], np.cumsum(self.sizes[ids])])[bounds]
        decoded, upto = np.delete(decoded, upto[:-1][full]), upto - np.concatenate([[0], np.cumsum(full)])  # the prefix space
        if ends:
            places = np.stack([bounds[:-1], bounds[1:]], 1).ravel()
            ids = np.insert(ids, places, np.tile(np.array([self.model.begin, self.model.end], np.uint32), len(bounds) - 1))
            bounds = bounds + 2 * np.arange(len(bounds))
        return ids, bounds, decoded, upto


@functools.cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("waybill_one_by_one", _one_by_one)


def text_of(ids: list[int], of: Model) -> str:
    """The text of ids as the library decodes them: no control pieces, one space less in front, bytes read as UTF-8 where they are."""
    made, run = [], bytearray()
    for i in ids:
        if i in of.byte_of:
            run.append(of.byte_of[i])
            continue
        if run:
            made.append(run.decode("utf-8", "waybill_one_by_one"))
            run = bytearray()
        if i == of.unknown:
            made.append(" ⁇ ")
        elif of.texts[i]:
            text = of.texts[i]
            made.append((text[1:] if not made and text[0] == SPACE else text).replace(SPACE, " "))
    made.append(run.decode("utf-8", "waybill_one_by_one"))
    return "".join(made)


def encode(docs: DataFrame, path: str, column: str = "text", ends: bool = True) -> DataFrame:
    """Adds `token_ids` array<int> (a column of that name is replaced): begin and end ids around those of the text if `ends`."""
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "token_ids"])
    own = fresh("piece_text", rest.columns)
    schema = StructType([*rest.schema.fields, StructField("token_ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in chunks(batches, own):
            ids, bounds, _, _ = coder.rows(batch.column(own), ends)
            made = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], schema=pa.schema([*list(batch.schema)[:-1], pa.field("token_ids", pa.list_(pa.int32()))]))

    return rest.withColumn(own, F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """Adds `decoded` (a column of that name is replaced); null ids give null, ids that the model lacks and null ones no text."""
    rest = tokens.select(*[F.col(f"`{c}`") for c in tokens.columns if c != "decoded"])
    schema = StructType([*rest.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model(path)
        for batch in batches:
            texts = [None if ids is None else text_of([i for i in ids if i is not None and 0 <= i < len(of.texts)], of) for ids in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rest.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: the key, n_tokens, the SHA-256 of the ids (begin and end among them) and that of the text decoded from them."""
    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in chunks(batches):
            ids, bounds, decoded, upto = coder.rows(batch.column("text"))
            ids = ids.astype("<u4")
            got = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in itertools.pairwise(bounds.tolist())]
            back = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in itertools.pairwise(upto.tolist())]
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(got, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
