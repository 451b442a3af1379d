"""Words and n-grams of many texts at once, as 64-bit hashes, in numpy inside Arrow tasks.

A task sees the bytes of an Arrow string column as one buffer. Words are found by a table of
separator bytes and hashed by a polynomial over their bytes (a running sum, so no loop over
words); n-grams mix the hashes of neighbouring words. Work goes piece by piece, so memory follows
the piece and not the batch or a long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: A second base, for keys of 128 bits.
_OTHER = 0xD6E8FEB86659FD93
_MUL, _XOR1, _XOR2 = U(0xFF51AFD7ED558CCD), U(33), U(29)
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Separators: the six ASCII white-space bytes.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Separators: every ASCII byte that is no letter or digit.
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[:128] = [not chr(k).isalnum() for k in range(128)]

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse, modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, PIECE + 1)
        steps = np.full((2, size), U(base))
        steps[1] = U(pow(base, -1, 1 << 64))
        steps[:, 0] = 1
        _powers[base] = tuple(np.multiply.accumulate(steps, axis=1))
    up, down = _powers[base]
    return up[:n], down[:n]


def lower(body: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return _LOWER[body]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> _XOR1)) * _MUL
    return x ^ (x >> _XOR2)


def _piece_words(body: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word in a piece that no word crosses."""
    body = _LOWER[body]
    inside = np.empty(len(body) + 2, bool)
    inside[0] = inside[-1] = False
    inside[1:-1] = ~separators[body]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return span_hashes(body, start, end), start, end


def span_hashes(body: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """Hash of each stretch of bytes; `second` gives independent ones."""
    up, down = _power(len(body) + 1, _OTHER if second else _BASE)
    total = np.zeros(len(body) + 1, U)
    np.cumsum((body.astype(U) + U(1)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U))


def words(body: np.ndarray, separators: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (A-Z lower-cased), start and end of the words in one text's bytes, piece by piece."""
    if len(body) <= PIECE:
        return _piece_words(body, separators)
    out, at = [], 0
    while at < len(body):
        stop = min(at + PIECE, len(body))
        while stop < len(body):
            cut = np.flatnonzero(separators[body[at:stop]])
            if len(cut):
                stop = at + int(cut[-1]) + 1
                break
            stop = min(stop + PIECE, len(body))
        h, s, e = _piece_words(body[at:stop], separators)
        out.append((h, s + at, e + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def grams(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams; with fewer words, one of the whole sequence; none without words."""
    n = min(n, len(word_hashes))
    if n == 0:
        return np.zeros(0, U)
    last = len(word_hashes) - n + 1
    out = np.full(last, U(n))
    for k in range(n):
        out = mix(out * U(_BASE) + word_hashes[k : k + last])
    return out


def text_bytes(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of an Arrow string column, without a copy; none for null."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield data[offsets[k] : offsets[k + 1]] if valid[k] else data[:0]


def texts_words(column: pa.Array, separators: np.ndarray = SPACE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """`words` of each text of a column; short texts are hashed together, a piece at a time."""
    wait, size = [], 0

    def flush() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        bounds = np.cumsum([0, *[len(x) + 1 for x in wait]])
        joined = np.full(bounds[-1], 32, np.uint8)
        for b, x in zip(bounds[:-1], wait, strict=True):
            joined[b : b + len(x)] = x
        h, s, e = _piece_words(joined, separators)
        cut = np.searchsorted(s, bounds)
        for b, i, j in zip(bounds[:-1], cut[:-1], cut[1:], strict=True):
            yield h[i:j], s[i:j] - b, e[i:j] - b

    for body in text_bytes(column):
        if len(body) > PIECE // 4:
            if wait:
                yield from flush()
                wait, size = [], 0
            yield words(body, separators)
            continue
        wait.append(body)
        size += len(body)
        if size > PIECE // 2:
            yield from flush()
            wait, size = [], 0
    if wait:
        yield from flush()


SLICES = 16


def count_table(df: DataFrame, hashes, buckets: int) -> np.ndarray:
    """How many hashes of all rows fall in each bucket (hash modulo `buckets`), as uint32.

    `hashes` turns an Arrow batch of `df` into an array of uint64. Each task counts its own rows and
    gives its table out in slices, which are summed by slice; the driver gets 4 * `buckets` bytes,
    whatever the input.
    """
    if buckets % SLICES:
        raise ValueError(f"the number of buckets must be a multiple of {SLICES}")
    wide = buckets // SLICES
    schema = "k int, n binary"

    def row(k: int, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"k": pa.array([k], pa.int32()), "n": pa.array([n.tobytes()], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(buckets, np.uint32)
        for batch in batches:
            for h in hashes(batch):
                np.add.at(table, (h % U(buckets)).astype(np.int64), np.uint32(1))
        for k in range(SLICES):
            if (part := table[k * wide : (k + 1) * wide]).any():
                yield row(k, part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k in held:
                    held[k] += np.frombuffer(n, np.uint32)
                else:
                    held[k] = np.frombuffer(n, np.uint32).copy()
        for k, n in held.items():
            yield row(k, n)

    total = np.zeros(buckets, np.uint32)
    parts = df.mapInArrow(count, schema).repartition(SLICES, "k").mapInArrow(add, schema)
    for r in parts.toLocalIterator():
        total[r["k"] * wide : (r["k"] + 1) * wide] += np.frombuffer(r["n"], np.uint32)
    return total


def bit_table(df: DataFrame, hashes, bits: int) -> np.ndarray:
    """A table of bits (hash modulo `bits`), packed in bytes: those of all hashes of all rows are set.

    `hashes` turns an Arrow batch of `df` into arrays of uint64. A task gives out the places it has set, or
    a slice's bytes where that is shorter; slices are united by slice, and the driver gets `bits` / 8 bytes.
    """
    wide = bits // (8 * SLICES)
    if wide * 8 * SLICES != bits:
        raise ValueError(f"the number of bits must be a multiple of {8 * SLICES}")
    schema = "k int, places binary, dense binary"

    def row(k: int, part: np.ndarray) -> pa.RecordBatch:
        dense = np.count_nonzero(part) > wide // 8
        places = b"" if dense else np.flatnonzero(np.unpackbits(part, bitorder="little")).astype(np.uint32).tobytes()
        return pa.record_batch({"k": pa.array([k], pa.int32()), "places": pa.array([places], pa.binary()), "dense": pa.array([part.tobytes() if dense else b""], pa.binary())})

    def mark(part: np.ndarray, places: np.ndarray) -> None:
        np.bitwise_or.at(part, places >> 3, (1 << (places & 7)).astype(np.uint8))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for h in hashes(batch):
                mark(table, (h % U(bits)).astype(np.int64))
        for k in range(SLICES):
            if (part := table[k * wide : (k + 1) * wide]).any():
                yield row(k, part)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, places, dense in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = held.setdefault(k, np.zeros(wide, np.uint8))
                if dense:
                    part |= np.frombuffer(dense, np.uint8)
                mark(part, np.frombuffer(places, np.uint32).astype(np.int64))
        for k, part in held.items():
            yield row(k, part)

    total = np.zeros(bits // 8, np.uint8)
    for r in df.mapInArrow(collect, schema).repartition(SLICES, "k").mapInArrow(unite, schema).toLocalIterator():
        part = total[r["k"] * wide : (r["k"] + 1) * wide]
        if r["dense"]:
            part |= np.frombuffer(r["dense"], np.uint8)
        mark(part, np.frombuffer(r["places"], np.uint32).astype(np.int64))
    return total


def has_bits(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set in a `bit_table`."""
    place = (hashes % U(8 * len(table))).astype(np.int64)
    return ((table[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)
