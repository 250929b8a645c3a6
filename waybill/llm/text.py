"""Words of whole texts as numpy arrays: boundaries, 64-bit hashes and hashes of word windows.

A word is `[^\\x20\\x09-\\x0D]+`. Hashes are polynomial prefix sums modulo 2**64 (odd base, so every power has an inverse), then
mixed; equal sequences have equal hashes everywhere, and two of n different ones agree with probability about n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # text taken through numpy at once; a longer text is one chunk of its own
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
ROLL = np.uint64(0xC2B2AE3D27D4EB4F | 1)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores before it until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most `limit` bytes of text, one row at least; a null text is read as empty, a binary one as it is."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls have no bytes."""
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def spans(kept: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the runs where `kept` holds; runs end at row bounds; first[r] is the first run of row r."""
    if not len(kept):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    bound = np.zeros(len(kept) + 1, bool)
    bound[offsets] = True
    start = kept.copy()
    start[1:] &= ~kept[:-1] | bound[1:-1]
    end = kept.copy()
    end[:-1] &= ~kept[1:] | bound[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _tables.get(int(base))
    if have is None or len(have[0]) < n:
        size = -(-int(n) // 65536) * 65536
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (base, inverse))
        if size <= 4 * CHUNK_BYTES:
            _tables[int(base)] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    power, inverse = _powers(BASE, len(data) + 1)
    upto = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=upto[1:])
    return mix((upto[ends] - upto[starts]) * inverse[starts])


def word_hashes(offsets: np.ndarray, data: np.ndarray, limit: int = CHUNK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, first word of each row), worked out over some rows at a time: only the hashes are held together."""
    hashes, counts, start = [], [], 0
    while start < len(offsets) - 1:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1)
        part = data[offsets[start] : offsets[end]]
        starts, ends, first = words(offsets[start : end + 1] - offsets[start], part)
        hashes.append(hash_spans(part, starts, ends))
        counts.append(np.diff(first))
        start = end
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(hashes or none), np.concatenate([[0], np.cumsum(np.concatenate(counts or none).astype(np.int64))])


def hash_windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each window of `size` following hashes, rows not heeded; one for each position that has a whole window."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(ROLL, n + 1)
    upto = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=upto[1:])
    return mix((upto[size:] - upto[: n - size + 1]) * inverse[: n - size + 1])


def hash_ranges(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each range [start, end) of following hashes."""
    power, inverse = _powers(ROLL, len(hashes) + 1)
    upto = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[: len(hashes)], out=upto[1:])
    return mix((upto[ends] - upto[starts]) * inverse[starts])


def whole_windows(first: np.ndarray, size: int) -> np.ndarray:
    """True at the word positions where a window of `size` words of one row starts."""
    n = int(first[-1]) if len(first) else 0
    fits = np.zeros(n, bool)
    if n >= size:
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        fits = np.arange(n) + size <= first[1:][row]
    return fits


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
