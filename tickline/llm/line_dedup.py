"""Line dedup with a filter of lines seen once and a filter of lines seen twice.

Pass 1 hashes the lines of each document (once a document) and sets, in every task, bits in a
filter of hashes seen once and in one of hashes seen twice. Filters of different tasks meet slice
by slice: a hash that two tasks saw once each has its bits in both once-filters, so
    twice = twice_a | twice_b | (once_a & once_b),   once = once_a | once_b
keeps every repeated hash in the twice-filter (it may hold others, never lack one).
Pass 2 tests all lines against the broadcast twice-filter, and only the suspects shuffle: they are
counted by an exact 128-bit key, the keeper (largest document id) is chosen, and the documents
lose the lines that another document keeps.

The filter has a fixed number of bits, whatever the input: `BITS` bounds the broadcast. Past some
ten times as many different lines as bits nearly every line is a suspect; the result is the same,
only more lines shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.llm import grams
from tickline.llm.common import small_batches, stored

#: 2**26 bits: 8 MB a filter.
BITS = 1 << 26
SLICES = 16
MIN_CHARS = 20
MIN_DOCS = 3
U = np.uint64

#: Lines of more bytes, blanks at their ends aside, are hashed by BLAKE2.
LONG = grams.PIECE // 4
_BLANK = b" \t\n\x0b\x0c\r"


def _line_keys(body: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both halves of the key and the code points of the lines at start..end of one stretch of bytes."""
    body = grams.lower(body)
    solid = np.flatnonzero(~grams.SPACE[body])
    i, j = np.searchsorted(solid, start), np.searchsorted(solid, end)
    some = j > i
    first = np.where(some, np.append(solid, 0)[i], start)
    last = np.where(some, np.append(solid, 0)[j - 1] + 1, start)
    points = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80)])
    return grams.span_hashes(body, first, last), grams.span_hashes(body, first, last, second=True), points[last] - points[first]


def _long_text(body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for all lines of one long text: stretches of some lines, and lines longer than that alone."""
    feed = np.flatnonzero(body == 10)
    start, end = np.concatenate([[0], feed + 1]), np.append(feed, len(body))
    a, b, chars = np.zeros(len(start), U), np.zeros(len(start), U), np.zeros(len(start), np.int64)
    k = 0
    while k < len(start):
        stop = max(k + 1, int(np.searchsorted(end, start[k] + LONG)))
        if stop == k + 1:
            line = body[start[k] : end[k]].tobytes().strip(_BLANK).lower()
            if len(line) > LONG:
                d = hashlib.blake2b(line, digest_size=16).digest()
                a[k], b[k], chars[k] = int.from_bytes(d[:8], "big"), int.from_bytes(d[8:], "big"), len(line.decode("utf-8", "replace"))
            else:
                a[k : k + 1], b[k : k + 1], chars[k : k + 1] = _line_keys(np.frombuffer(line, np.uint8), np.zeros(1, int), np.array([len(line)]))
        else:
            at = start[k]
            a[k:stop], b[k:stop], chars[k:stop] = _line_keys(body[at : end[stop - 1]], start[k:stop] - at, end[k:stop] - at)
        k = stop
    return a, b, chars


def keys(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some texts at a time: the text (its place in the column) of each line, both halves of its key,
    and its code points. A null text is one empty line."""
    at, wait, size = 0, [], 0

    def flush() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        body = np.frombuffer(b"\n".join([*(x.tobytes() for x in wait), b""]), np.uint8)
        end = np.flatnonzero(body == 10)
        bounds = np.cumsum([len(x) + 1 for x in wait])
        owner = np.searchsorted(bounds, end, side="right")
        return (owner + at - len(wait), *_line_keys(body, np.concatenate([[0], end[:-1] + 1]), end))

    for body in grams.text_bytes(column):
        if len(body) > LONG:
            if wait:
                yield flush()
                wait, size = [], 0
            a, b, chars = _long_text(body)
            yield np.full(len(a), at), a, b, chars
            at += 1
            continue
        wait.append(body)
        at += 1
        size += len(body)
        if size > 2 * LONG:
            yield flush()
            wait, size = [], 0
    if wait:
        yield flush()


def _distinct(column: pa.Array, min_chars: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text and key of the lines of enough code points, once a text."""
    for owner, a, b, chars in keys(column):
        use = np.flatnonzero(chars >= min_chars)
        order = use[np.lexsort((b[use], a[use], owner[use]))]
        owner, a, b = owner[order], a[order], b[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        yield owner[fresh], a[fresh], b[fresh]


def _spots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions a hash, from its low and its high half."""
    return (h % U(bits)).astype(np.int64), (grams.mix(h) % U(bits)).astype(np.int64)


def _has(bitmap: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return (bitmap[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1


def _set(bitmap: np.ndarray, spot: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, spot >> 3, np.left_shift(np.uint8(1), (spot & 7).astype(np.uint8)))


def _fill(bits: int, min_chars: int):
    """One pair of filters a task, given out in slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for _, h, _ in _distinct(batch.column(0), min_chars):
                h, n = np.unique(h, return_counts=True)
                p, q = _spots(h, bits)
                again = (n > 1) | (_has(once, p) & _has(once, q))
                _set(twice, p[again]), _set(twice, q[again])
                _set(once, p), _set(once, q)
        wide = bits // 8 // SLICES
        for k in range(SLICES):
            o, t = once[k * wide : (k + 1) * wide], twice[k * wide : (k + 1) * wide]
            if o.any():
                yield pa.record_batch({"k": pa.array([k], pa.int32()), "once": pa.array([o.tobytes()], pa.binary()), "twice": pa.array([t.tobytes()], pa.binary())})

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the slices that this task got, one pair of filters a slice number."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            o, t = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
            if k not in held:
                held[k] = [o.copy(), t.copy()]
            else:
                once, twice = held[k]
                twice |= t | (once & o)
                once |= o
    for k, (once, twice) in held.items():
        yield pa.record_batch({"k": pa.array([k], pa.int32()), "once": pa.array([once.tobytes()], pa.binary()), "twice": pa.array([twice.tobytes()], pa.binary())})


def repeat_filter(texts: DataFrame, min_chars: int = MIN_CHARS, bits: int = BITS) -> np.ndarray:
    """The twice-filter over the lines of all texts (the frame's only column).

    The driver gets `bits` bits at most, whatever the number of lines.
    """
    if bits % (8 * SLICES):
        raise ValueError(f"the number of bits must be a multiple of {8 * SLICES}")
    schema = "k int, once binary, twice binary"
    parts = texts.mapInArrow(_fill(bits, min_chars), schema).repartition(SLICES, "k").mapInArrow(_merge, schema)
    whole = np.zeros(bits // 8, np.uint8)
    wide = bits // 8 // SLICES
    for row in parts.select("k", "twice").toLocalIterator():
        whole[row["k"] * wide : (row["k"] + 1) * wide] |= np.frombuffer(row["twice"], np.uint8)
    return whole


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = BITS) -> DataFrame:
    """(__id, __drop): for each document the 128-bit keys of lines that a larger id keeps."""
    spark = df.sparkSession
    named = df.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    share = spark.sparkContext.broadcast(repeat_filter(named.select("__text"), min_chars, bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = share.value
        for batch in batches:
            for owner, a, b in _distinct(batch.column(1), min_chars):
                p, q = _spots(a, bits)
                hit = _has(twice, p) & _has(twice, q)
                yield pa.record_batch({"__id": batch.column(0).take(pa.array(owner[hit])), "a": pa.array(a[hit].view(np.int64)), "b": pa.array(b[hit].view(np.int64))})

    id_type = dict(named.dtypes)["__id"]
    # both are written: a line that a third of all documents hold is then a skewed key of a plain join, which Spark splits
    seen = stored(named.mapInArrow(suspects, f"__id {id_type}, a long, b long").distinct(), "line-suspects")
    kept = seen.groupBy("a", "b").agg(F.count("*").alias("__n"), F.max("__id").alias("__keeper")).where(F.col("__n") >= min_docs)
    lost = seen.join(stored(kept, "line-keepers"), ["a", "b"]).where(F.col("__id") != F.col("__keeper"))
    return lost.groupBy("__id").agg(F.collect_list(F.struct("a", "b")).alias("__drop"))


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())]))
def _cut(text: pd.Series, drop_a: pd.Series, drop_b: pd.Series) -> pd.DataFrame:
    """The text less the lines of the keys to drop, and how many went; nulls where there is nothing to drop."""
    out = []
    for t, p, q in zip(text, drop_a, drop_b, strict=True):
        if t is None:
            out.append((None, None))
            continue
        gone = set(zip(p.tolist(), q.tolist(), strict=True))
        key = (x.view(np.int64).tolist() for x in list(keys(pa.array([t], pa.large_string())))[0][1:3])
        lines = t.split("\n")
        left = [line for line, *k in zip(lines, *key, strict=True) if tuple(k) not in gone]
        out.append(("\n".join(left), len(lines) - len(left)))
    return pd.DataFrame(out, columns=["text", "n_dropped"], dtype=object)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = BITS) -> DataFrame:
    """All rows of `df` with `text` less the lines that another document keeps, and two more columns,
    `n_lines` (before) and `n_dropped`.

    A line's key is the line trimmed of ASCII white space and lower-cased (A-Z). A key of `min_chars`
    code points found in `min_docs` documents stays only in the largest id that holds it, there with
    all its lines. Null or empty text is one empty line. A row without an id neither counts nor loses
    lines. Rows that repeat an id count as one document; each is cut alike. Columns named `n_lines`
    or `n_dropped` are replaced. An empty table stays empty.
    """
    small_batches(df.sparkSession)
    lost = repeated_lines(df, id_col, text, min_chars, min_docs, bits)
    own = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    joined = df.select(*[f"`{c}`" for c in own]).join(lost, F.col(f"`{id_col}`") == F.col("__id"), "left")
    body, cut_here = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col("__drop").isNotNull()
    gone = lambda name: F.transform("__drop", lambda x: x[name])
    cut = joined.withColumn("__cut", _cut(F.when(cut_here, body), gone("a"), gone("b")))
    new_text = F.coalesce(F.col("__cut")["text"], body)
    feeds = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"), F.lit("")))
    return cut.select(
        *[(new_text.alias(c) if c == text else F.col(f"`{c}`")) for c in own],
        (feeds + 1).cast("long").alias("n_lines"),
        F.coalesce(F.col("__cut")["n_dropped"], F.lit(0)).cast("long").alias("n_dropped"),
    )
