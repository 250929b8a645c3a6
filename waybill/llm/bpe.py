"""Byte-level BPE encoding and decoding (operator 3).

The tokenizers library encodes Arrow batches. Texts are cut where a match of the split pattern ends for certain, so that equal
pieces need encoding only once: a table of bounded size in each Python worker keeps the ids of pieces by a 64-bit hash, and the
library encodes those it has not met. Every batch is decoded and compared with its text; one that differs is encoded whole.

Decoding reverses the table that maps each byte to a printable character, joins the bytes of all tokens and only then reads UTF-8,
so a character split over several tokens comes back whole; bytes that are no UTF-8 become U+FFFD in `text`, and stay in `bytes`.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, decoders, models, pre_tokenizers

from waybill.llm.text import chunks, fresh, hash_spans, utf8

PIECES_KEPT = 1_500_000  # pieces whose ids a worker remembers
OUTSIDE = re.compile(r"[\sA-Za-z0-9']").search  # in ASCII: characters outside a run of symbols, and the start of contractions


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable, else the next one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


def halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes the token: its bytes merged, lowest rank first, until two are left."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= limit:
            raise ValueError(f"no merges lead to {token!r}")
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


@functools.cache
def from_ranks(path: str) -> Tokenizer:
    """A tokenizer of the tokenizers library with the ids and merges of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    shown = byte_characters()
    name = lambda token: "".join(map(shown.__getitem__, token))
    merges = [tuple(map(name, halves(t, ranks))) for t in sorted(ranks, key=ranks.get) if len(t) > 1]
    made = Tokenizer(models.BPE(vocab={name(t): i for t, i in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    made.decoder = decoders.ByteLevel()
    return made


@functools.cache
def from_json(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # names of special tokens in a text are ordinary text
    return made


def load(path: str) -> Tokenizer:
    return from_json(path) if path.endswith(".json") else from_ranks(path)


@functools.cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    back = {c: b for b, c in byte_characters().items()}
    vocab = load(path).get_vocab(with_added_tokens=True)
    table = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        table[i] = bytes(map(back.__getitem__, token)) if all(c in back for c in token) else token.encode()
    return table


def pieces(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the pieces, first piece of each row). Cut only where a match of the split pattern ends for certain.

    Between two characters that are not white space: before a single space, before and after a single line feed, and at a change
    of kind between ASCII letters, digits and others, but not after an apostrophe (contractions). Elsewhere nothing is cut.
    """
    n = len(data)
    kind = KIND[data]
    for lead, rest in WIDE_SPACES:
        for at in np.flatnonzero(data[: n - len(rest)] == lead).tolist() if n > len(rest) and lead in data else ():
            if bytes(data[at + 1 : at + 1 + len(rest)]) == rest:
                kind[at : at + 1 + len(rest)] = SPACE
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    solid = kind != SPACE
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = solid[:-1] & ~edge[1:n]
    after[:-1] = solid[1:] & ~edge[1:n]
    alone = before & after
    cut = edge[:n] | (alone & ((data == 32) | (data == 10)))
    cut[1:] |= (alone & (data == 10))[:-1]
    known = (kind == LETTER) | (kind == DIGIT) | (kind == OTHER)
    cut[1:] |= known[1:] & known[:-1] & (kind[1:] != kind[:-1]) & ~((data[:-1] == 39) & (kind[1:] == LETTER))
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


SPACE, LETTER, DIGIT, OTHER, WIDE = range(5)
KIND = np.array([SPACE if c in range(9, 14) or c in range(28, 33) else WIDE if c > 127 else LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else OTHER for c in range(256)], np.uint8)
#: White space outside ASCII: the first byte and the others, of each character that any library here may count as such.
WIDE_SPACES = [(w[0], w[1:]) for w in (chr(c).encode() for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF))]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all ranges [start, start + size), one after another."""
    upto = np.cumsum(sizes)
    return np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(starts - (upto - sizes), sizes)


class Encoder:
    """Ids of texts, with a bounded memory of pieces: a sorted hash, and a range of a pool of ids, for each."""

    def __init__(self, path: str, kept: int = PIECES_KEPT):
        self.tokenizer, self.kept = load(path), kept
        table = token_bytes(path)
        self.sizes = np.array([len(b) for b in table], np.int64)
        self.places = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.chars = byte_characters()
        self.shown = {b: c for b, c in self.chars.items() if b < 128}
        self.old = self.new = self.empty()

    @staticmethod
    def empty() -> tuple[np.ndarray, ...]:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    @staticmethod
    def merged(a: tuple, b: tuple) -> tuple[np.ndarray, ...]:
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1] + len(a[3])])[order], np.concatenate([a[2], b[2]])[order], np.concatenate([a[3], b[3]])

    def ask(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each). A piece that is one match of the split pattern goes straight to the library's
        BPE model, by its bytes' characters; the library's whole encoding, which splits first, takes the others."""
        tokenize, shown, got, odd = self.tokenizer.model.tokenize, self.shown, [], []
        for i, t in enumerate(texts):
            bare = t[1:] if t[0] == " " else t
            if bare.isalpha() or bare.isascii() and (bare.isdigit() or bare == "\n" == t or not OUTSIDE(bare)):
                got.append([x.id for x in tokenize(t.translate(shown) if t.isascii() else "".join([self.chars[c] for c in t.encode()]))])
            else:
                odd.append(i)
                got.append([])
        for done, i in zip(self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), odd, strict=True):
            got[i] = done.ids
        counts = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(counts.sum())), counts

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which keys are known, with their places in the joined pools of `old` and `new`, and sizes."""
        place, size, hit = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for table, base in ((self.old, 0), (self.new, len(self.old[3]))):
            if len(table[0]):
                at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
                same = table[0][at] == keys
                place[same], size[same] = table[1][at[same]] + base, table[2][at[same]]
                hit |= same
        return hit, place, size

    def flat(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows as one array, bounds of the rows in it)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, first = pieces(offsets, data)
        ends = np.append(starts[1:], len(data))
        keys, where, back = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        hit, place, size = self.find(keys)
        if len(lost := np.flatnonzero(~hit)):
            raw = data.tobytes()
            ids, counts = self.ask([raw[a:b].decode() for a, b in zip(starts[where[lost]].tolist(), ends[where[lost]].tolist(), strict=True)])
            fresh = (keys[lost], np.cumsum(counts) - counts, counts.astype(np.int32), ids)
            if len(self.old[0]) + len(self.new[0]) + len(lost) > self.kept:  # what came up last stays
                self.old, self.new = self.new, self.empty()
                if len(self.old[0]) > self.kept // 2:
                    self.old = self.empty()
                hit, place, size = self.find(keys)
                if not hit[np.delete(np.arange(len(keys)), lost)].all():
                    return self.flat(offsets, data)
            self.new = self.merged(self.new, fresh)
            if 4 * len(self.new[0]) > len(self.old[0]) and len(self.old[0]) + len(self.new[0]) < self.kept // 2:
                self.old, self.new = self.merged(self.old, self.new), self.empty()
            hit, place, size = self.find(keys)
        pool = np.concatenate([self.old[3], self.new[3]]) if len(self.new[3]) else self.old[3]
        sizes = size[back]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return pool[ranges(place[back], sizes)], upto[first]

    def back(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids."""
        return self.bytes[ranges(self.places[ids], self.sizes[ids])]

    def rows(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, their bounds by row, decoded bytes, their bounds by row); nulls are empty. A row that doesn't come back as it was
        is encoded whole by the library (that guards against two pieces of one hash)."""
        offsets, data = utf8(column)
        ids, bounds = self.flat(offsets, data)
        upto = np.concatenate([[0], np.cumsum(self.sizes[ids])])[bounds]
        decoded = self.back(ids)
        if not np.array_equal(upto, offsets) or not np.array_equal(decoded, data):
            texts = pc.fill_null(column, "").to_pylist()
            got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids, bounds = np.concatenate(got), np.concatenate([[0], np.cumsum([len(g) for g in got])])
            decoded, upto = self.back(ids), np.concatenate([[0], np.cumsum(self.sizes[ids])])[bounds]
        return ids, bounds, decoded, upto


@functools.cache
def encoder(path: str, kept: int = PIECES_KEPT) -> Encoder:
    return Encoder(path, kept)


def offsets_of(text: str, ids: np.ndarray, table: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end, character start and end of every token; a token inside a character covers that whole character."""
    ends = np.cumsum([len(table[i]) for i in ids], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return starts, ends, char[starts] if len(ends) else starts, char[ends - 1] + 1 if len(ends) else ends


def encode(docs: DataFrame, path: str, column: str = "text", offsets: bool = False, kept: int = PIECES_KEPT) -> DataFrame:
    """Adds `token_ids` array<int>; with `offsets`, `byte_start`, `byte_end`, `char_start` and `char_end` arrays too.

    A null or empty text has no tokens. Columns of these names are replaced; rows may repeat and are kept as they are. `kept` pieces
    are remembered by a worker (some 100 bytes each); how many bears on time and memory, never on the ids.
    """
    names = ["token_ids", *(["byte_start", "byte_end", "char_start", "char_end"] if offsets else [])]
    rest = docs.select(*[c for c in docs.columns if c not in names])
    target = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([*rest.schema.fields, *[StructField(n, ArrayType(IntegerType())) for n in names]])
    own = fresh("bpe_text", rest.columns)
    source = rest.withColumn(own, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, table = encoder(path, kept), token_bytes(path) if offsets else []
        for batch in chunks(batches, own):
            ids, bounds, _, _ = coder.rows(batch.column(own))
            made = [pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))]
            if offsets:
                places = [offsets_of(t, ids[a:b], table) for t, a, b in zip(batch.column(own).to_pylist(), bounds, bounds[1:], strict=False)]
                made += [list_array(list(x)) for x in zip(*places, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(batch.num_columns - 1)], *made], schema=pa.schema([*list(batch.schema)[:-1], *[pa.field(n, pa.list_(pa.int32())) for n in names]]))

    return source.mapInArrow(run, schema)


def list_array(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rows).astype(np.int32) if rows else np.zeros(0, np.int32)))


def decode(tokens: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """Adds `decoded` (text, U+FFFD for what is no UTF-8) and `decoded_bytes`; null ids give null, unknown ids no bytes."""
    from pyspark.sql.types import BinaryType, StringType, StructField, StructType

    rest = tokens.select(*[c for c in tokens.columns if c not in ("decoded", "decoded_bytes")])
    schema = StructType([*rest.schema.fields, StructField("decoded", StringType()), StructField("decoded_bytes", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in batches:
            raw = [None if ids is None else b"".join(table[i] for i in ids if i is not None and 0 <= i < len(table)) for ids in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([None if r is None else r.decode("utf-8", "replace") for r in raw], pa.string()), pa.array(raw, pa.binary())],
                names=[*batch.schema.names, "decoded", "decoded_bytes"],
            )

    return rest.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Per row: the key, n_tokens, the SHA-256 of the ids and that of the bytes decoded from them; a null text counts as empty."""
    source = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in chunks(batches):
            ids, bounds, decoded, upto = coder.rows(batch.column("text"))
            got = [sha(ids[a:b].astype("<u4")) for a, b in zip(bounds, bounds[1:], strict=False)]
            back = [sha(decoded[a:b]) for a, b in zip(upto, upto[1:], strict=False)]
            columns = [batch.column("doc_id"), pa.array(np.diff(bounds), pa.int64()), pa.array(got, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return source.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def intact(docs: DataFrame, path: str, kept: int = PIECES_KEPT) -> DataFrame:
    """The rows with `token_ids` and `n_tokens` beside them: what a trainer reads. Every row is kept."""
    return encode(docs, path, kept=kept).withColumn("n_tokens", F.size("token_ids").cast("long"))

