"""Suffix-array dedup: remove bytes that repeated strings of `LENGTH` bytes cover.

Every string of LENGTH bytes belongs to a group: the least hash among its `GRAM`-byte grams. Equal
strings have equal groups, so a group can be sorted by itself; neighbouring strings of a text that have
the same group make one segment. Groups whose gram occurs once hold no repeat and go no further. Of the
rest, equal segments are counted and sent once, segments go to shards by their group, and each shard
sorts its segments' suffixes by induced sorting (see `suffix_sort`: recursion, queues and arrays in
files beyond a fixed memory, common prefixes carried along). A string is repeated if its suffix shares
LENGTH bytes with a neighbour in the suffix array, or if its whole segment occurs twice. The answers go
back to all holders of a segment and from there to the documents.

Texts that several documents have are worked on once.
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

from tickline.llm import grams, suffix_sort
from tickline.llm.common import small_batches, stored

LENGTH = 400
GRAM = 128
#: Bits of the table of repeated grams, 2 MB in a task; tasks give out the places they have set.
BITS = 1 << 24
#: Bytes of segments a shard should get; a group larger than that makes its shard larger, which files bear.
SHARD = 8 << 20
U = np.uint64


def _digest(body: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(body.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _extreme(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum or maximum of each window, by windows of doubling width."""
    pick = np.minimum if least else np.maximum
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    n = len(values) - width + 1
    return pick(out[:n], out[width - have : width - have + n])


def segments(body: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group, first byte and end of each segment, and the hashes of all grams that are the least of some string."""
    if len(body) < length:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    start = np.arange(len(body) - gram + 1)
    h = grams.span_hashes(body, start, start + gram)
    width = length - gram + 1
    least = _extreme(h, width, True)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    end = np.append(first[1:], len(least)) + length - 1
    # a gram is the least of a string if the largest least value around it is its own
    edge = np.zeros(width - 1, U)
    chosen = h[_extreme(np.concatenate([edge, least, edge]), width, False) == h]
    return least[first], first, end, chosen


def _texts(documents: DataFrame, id_col: str, text: str, gram: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Each different text's digest, its number of rows and its smallest row; and the grams that occur twice."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = list(grams.text_bytes(batch.column(1)))
            keys = [_digest(b) for b in bodies]
            yield pa.record_batch({"id": batch.column(0), "n": pa.array([len(b) for b in bodies], pa.int64()), "a": pa.array([k[0] for k in keys], pa.int64()), "b": pa.array([k[1] for k in keys], pa.int64())})

    rows = documents.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text}`")).mapInArrow(describe, "id string, n long, a long, b long")
    known = stored(rows, "text-digests")
    return known, known.groupBy("a", "b").agg(F.count("*").alias("copies"), F.max("n").alias("n"))


def _repeated_grams(documents: DataFrame, text: str, gram: int, length: int) -> DataFrame:
    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _some(grams.text_bytes(batch.column(0))):
                found = [segments(b, length, gram)[3] for b in part]
                yield pa.record_batch({"gram": pa.array(np.concatenate(found).view(np.int64))})

    return documents.select(F.col(f"`{text}`")).mapInArrow(chosen, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("gram")


def _some(bodies: Iterator[np.ndarray], size: int = 4 << 20) -> Iterator[list[np.ndarray]]:
    """Texts some megabytes at a time."""
    wait, n = [], 0
    for b in bodies:
        wait.append(b)
        n += len(b)
        if n > size:
            yield wait
            wait, n = [], 0
    if wait:
        yield wait


def _held(documents: DataFrame, text: str, repeated: DataFrame, gram: int, length: int) -> DataFrame:
    """(a, b: text; start; sa, sb: segment; size; key: group; twice: whether its gram occurs twice in it; body).

    A text is described once a task, and a segment's bytes are given once a task."""
    spark = documents.sparkSession
    known = spark.sparkContext.broadcast(grams.bit_table(repeated, lambda x: [x.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U)], BITS))
    names = ("a", "b", "start", "sa", "sb", "size", "key", "twice", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, given = set(), set()
        for batch in batches:
            for part in _some(grams.text_bytes(batch.column(0))):
                rows = []
                for body in part:
                    if len(body) < length:
                        continue
                    key = _digest(body)
                    if key in told:
                        continue
                    told.add(key)
                    group, first, end, chosen = segments(body, length, gram)
                    hit = np.flatnonzero(grams.has_bits(known.value, group))
                    if not len(hit):
                        continue
                    values, times = np.unique(chosen, return_counts=True)
                    often = times[np.searchsorted(values, group)] > 1
                    for k in hit.tolist():
                        piece = body[first[k] : end[k]]
                        name = _digest(piece)
                        rows.append((*key, int(first[k]), *name, len(piece), int(group[k].astype(np.int64)), bool(often[k]), None if name in given else piece.tobytes()))
                        given.add(name)
                kinds = (*[pa.int64()] * 7, pa.bool_(), pa.binary())
                yield pa.record_batch({n: pa.array(list(c), t) for n, c, t in zip(names, zip(*rows, strict=True) if rows else [[]] * 9, kinds, strict=True)})

    return documents.select(F.col(f"`{text}`")).mapInArrow(run, "a long, b long, start long, sa long, sb long, size long, key long, twice boolean, body binary")


def _covered(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of bytes that strings starting at these ascending places cover."""
    new = np.concatenate([[True], at[1:] > at[:-1] + length])
    return at[new], np.append(at[:-1][new[1:]], at[-1]) + length


def _sort_shard(length: int):
    """Sort the suffixes of one task's segments; give the stretches that repeated strings cover, by segment.

    Rows come sorted by group. A group of one segment whose gram occurs once in it holds no repeat within."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with suffix_sort.Scratch() as scratch:
            names, sizes = [], []
            path = f"{scratch.folder.name}/text"
            with open(path, "wb") as out:
                waiting = None  # (key, sa, sb, twice, body) of a segment that is the first of its group
                last = None

                def put(sa: int, sb: int, body: bytes) -> None:
                    # bytes of UTF-8 texts end at 0xF4; two symbols are left for the ends
                    out.write((np.frombuffer(body, np.uint8) + np.uint8(2)).tobytes() + b"\1")
                    names.append((sa, sb))
                    sizes.append(len(body) + 1)

                for batch in batches:
                    for key, sa, sb, twice, body in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                        if key != last:
                            waiting, last = None, key
                            if not twice:
                                waiting = (sa, sb, body)
                                continue
                        if waiting is not None:
                            put(*waiting)
                            waiting = None
                        put(sa, sb, body)
                out.write(b"\0")
            if not names:
                return
            text = np.memmap(path, np.uint8, "r")
            if len(text) <= scratch.in_memory:
                text = np.array(text)
            order, shared = suffix_sort.suffix_array(text, length, scratch)
            mark = scratch.array(len(text), bool)
            for at in range(0, len(order), 1 << 20):
                same = np.flatnonzero(shared[at : at + (1 << 20)] >= length) + at
                mark[order[same]] = True
                mark[order[same - 1]] = True
            begin = np.concatenate([[0], np.cumsum(sizes)])
            rows = []
            for k, name in enumerate(names):
                hit = np.flatnonzero(mark[begin[k] : max(begin[k], begin[k + 1] - length)])  # others reach beyond the segment
                if len(hit):
                    s, e = _covered(hit, length)
                    rows.append((*name, s.tolist(), e.tolist()))
                if len(rows) == 10_000 or (rows and k == len(names) - 1):
                    columns = list(zip(*rows, strict=True))
                    yield pa.record_batch({"sa": pa.array(columns[0], pa.int64()), "sb": pa.array(columns[1], pa.int64()), "s": pa.array(columns[2], pa.list_(pa.int64())), "e": pa.array(columns[3], pa.list_(pa.int64()))})
                    rows = []

    return run


def repeated_spans(documents: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD) -> DataFrame:
    """(a, b, s, e): for each text (by digest) that shares a string of `length` bytes with another text or
    holds one twice, stretches that such strings cover; they may overlap. Equal texts count as one text here."""
    repeated = _repeated_grams(documents, text, gram, length)
    held = stored(_held(documents, text, repeated, gram, length), "segment-holders")
    # the same text may be told by several tasks
    places = held.groupBy("a", "b", "start").agg(F.first("sa").alias("sa"), F.first("sb").alias("sb"), F.first("size").alias("size"))
    places = stored(places, "segment-places")
    times = places.groupBy("sa", "sb").agg(F.count("*").alias("times"))
    bodies = held.where(F.col("body").isNotNull()).groupBy("sa", "sb").agg(F.max("key").alias("key"), F.max("twice").alias("twice"), F.max("size").alias("size"), F.max("body").alias("body"))
    bodies = stored(bodies, "segments")
    total = bodies.agg(F.sum("size")).first()[0] or 0
    shards = max(documents.sparkSession.sparkContext.defaultParallelism, -(-total // shard_bytes))
    dealt = bodies.select("key", "sa", "sb", "twice", "body").repartition(shards, "key").sortWithinPartitions("key")
    sorted_ = dealt.mapInArrow(_sort_shard(length), "sa long, sb long, s array<long>, e array<long>")
    whole = times.where(F.col("times") > 1).join(bodies.select("sa", "sb", "size"), ["sa", "sb"]).select("sa", "sb", F.array(F.lit(0).cast("long")).alias("s"), F.array("size").alias("e"))
    answers = stored(whole.unionByName(sorted_), "segment-answers")
    moved = places.join(answers, ["sa", "sb"]).select("a", "b", F.transform("s", lambda x: x + F.col("start")).alias("s"), F.transform("e", lambda x: x + F.col("start")).alias("e"))
    return moved.groupBy("a", "b").agg(F.flatten(F.collect_list("s")).alias("s"), F.flatten(F.collect_list("e")).alias("e"))


@F.pandas_udf(T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType())]))
def _remove(text: pd.Series, whole: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for t, all_, s, e in zip(text, whole, starts, ends, strict=True):
        body = t.encode("utf-8", "surrogatepass")
        if all_:
            s, e = [0], [len(body)]
        if s is None or not len(body):
            out.append((body, len(body), 0, 0))
            continue
        order = np.argsort(s, kind="stable")
        s, e = np.asarray(s, np.int64)[order], np.maximum.accumulate(np.asarray(e, np.int64)[order])
        new = np.concatenate([[True], s[1:] > e[:-1]])
        s, e = s[new], np.append(e[:-1][new[1:]], e[-1])
        left = b"".join(body[i:j] for i, j in zip([0, *e.tolist()], [*s.tolist(), len(body)], strict=True))
        out.append((left, len(body), len(body) - len(left), len(s)))
    return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans"])


def dedup(documents: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD) -> DataFrame:
    """All rows and columns of `documents`, and `kept` (binary: the bytes that no repeated string covers),
    `n_bytes`, `n_removed` and `n_spans` (maximal removed runs).

    Strings are judged on the input: all occurrences go, the first as well. Null text is empty; texts shorter
    than `length` lose nothing. Rows that repeat a text, with or without an id, lose all of it. Columns named
    like the new ones are replaced. An empty table stays empty.
    """
    if not 0 < gram <= length:
        raise ValueError("a gram is no longer than the string")
    small_batches(documents.sparkSession)
    new = ("kept", "n_bytes", "n_removed", "n_spans")
    known, per = _texts(documents, id_col, text, gram, length)
    spans = repeated_spans(documents, text, length, gram, shard_bytes)
    copied = per.where((F.col("copies") > 1) & (F.col("n") >= length)).select("a", "b", F.lit(True).alias("whole"))
    told = stored(copied.join(spans, ["a", "b"], "full").select("a", "b", F.coalesce("whole", F.lit(False)).alias("whole"), F.when(F.col("whole").isNull(), F.col("s")).alias("s"), F.when(F.col("whole").isNull(), F.col("e")).alias("e")), "text-spans")
    by_row = known.select(F.coalesce("id", F.lit("")).alias("__id"), "a", "b").distinct().join(told, ["a", "b"])
    by_row = by_row.select("__id", F.col("a").alias("__a"), F.col("b").alias("__b"), F.col("whole").alias("__whole"), F.col("s").alias("__s"), F.col("e").alias("__e"))
    own = [c for c in documents.columns if c not in new]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # rows meet their answer by id, which spreads a text that a third of all rows have; the digest tells repeated ids apart
    keyed = documents.select(*[f"`{c}`" for c in own]).withColumns({"__id": F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), "__text": body})
    keyed = keyed.withColumn("__digest", _digest_of("__text"))
    keyed = keyed.withColumns({"__a": F.col("__digest")["a"], "__b": F.col("__digest")["b"]}).drop("__digest")
    joined = keyed.join(by_row, ["__id", "__a", "__b"], "left")
    cut = joined.withColumn("__cut", _remove("__text", F.coalesce("__whole", F.lit(False)), "__s", "__e"))
    return cut.select(*[f"`{c}`" for c in own], *[F.col("__cut")[c].alias(c) for c in new])


@F.pandas_udf(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
def _digest_of(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_digest(np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)) for t in text], columns=["a", "b"], dtype="int64")
