"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its n-word shingles (64-bit hashes). Documents of equal sets are one class,
told by a 128-bit hash of the set and named by the smallest id. Shingles are ordered by how many classes
hold them, rare first, by exact counts: shingles are cut into parts of some million (the leading bits name
the part, 32 further bits the shingle), each task sums its own part by part, and only shingles that are
counted twice go on. A table of bits (fixed size) tells most others apart before they are joined with
their counts; where it fills up, more rows are joined and the result is the same.

If two sets are similar enough, their prefixes of size - ceil(t * size) + m shingles share m of them, for
any m. Each document picks its own m: a longer prefix costs more postings, and leaves fewer candidates to
verify since m common shingles are asked for; both costs come from the counts. Shingles of one document
only head each prefix and need no postings. A pair is verified if it shares the smaller m of the two.

`similar_pairs` gives every similar pair of classes. `similar_components` gives the components of those
links without making the pairs of a group. Documents that posting lists connect are a group, and go in
blocks: each pair of blocks of a group is looked at inside one task, which tells candidates from prefixes,
verifies them with their whole sets, and returns no more links than join the components. Where lists connect
so much that this would cost more rows than going list by list, candidates are told from prefixes alone
first, list by list in blocks (short lists give their pairs as rows), and the documents that candidates
connect are the groups. A group of several blocks is first held against
a few of its own documents; those that link with one are in one component and meet only the documents of
others. No pair that could link two documents is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import grams
from tickline.llm.common import discard, small_batches, stored
from tickline.llm.components import components

#: Shingles of a part on average, and those that a task sums before it gives them out.
PART, FLUSH = 1 << 20, 1 << 20
#: Bits of the table of shared shingles (16 MB) and of that of ids that are asked for (2 MB), whatever the input.
SHARED_BITS, ID_BITS = 1 << 27, 1 << 24
MOST_MATCHES = 8
#: Cost of verifying a pair, in postings, for each shingle of the document, and as a constant.
VERIFY_PER_SHINGLE, VERIFY = 0.02, 4.0
#: Posting lists of more documents go in blocks of so many.
SHORT_LIST, BLOCK = 16, 256
#: Documents of a group of several blocks that all others are held against first.
HUBS = 3
#: Texts whose sets a task holds at once.
TEXTS = 1024
#: Shingles of a block's sets that are told apart at once.
TOLD = 1 << 19
U = np.uint64


@dataclass(frozen=True)
class Spec:
    """n words a shingle; similar means 100 * intersection >= percent * union."""

    n: int = 5
    percent: int = 80
    most_matches: int = MOST_MATCHES

    def linked(self, common, size_a, size_b):
        return 100 * common >= self.percent * (size_a + size_b - common)

    def least_overlap(self, size):
        """The least common shingles with any partner: ceil(percent * size / 100)."""
        return -(-self.percent * size // 100)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    for h, _, _ in grams.texts_words(column):
        yield np.unique(grams.grams(h, n))


def _halves(values: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def members(documents: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """(__id, __size, __class): each row with its set's size and its class, the smallest id that has this
    set; null for a row without words or, where no row of the class has an id, without an id."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [(len(s), *_halves(s)) for s in shingle_sets(batch.column(1), n)]
            yield pa.record_batch({"__id": batch.column(0), **{c: pa.array([x[k] for x in keys], pa.int64()) for k, c in enumerate(("__size", "a", "b"))}})

    kind = dict(documents.dtypes)[id_col]
    rows = documents.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(describe, f"__id {kind}, __size long, a long, b long")
    rows = stored(rows, "set-keys")
    # written, so that a class of a third of all rows is a skewed key of a plain join, which Spark splits
    classes = stored(rows.where(F.col("__size") > 0).groupBy("a", "b").agg(F.min("__id").alias("__class")), "classes")
    out = stored(rows.join(classes, ["a", "b"], "left").select("__id", "__size", "__class"), "members")
    discard(rows, classes)
    return out


def _id_hash(ids: pa.Array) -> np.ndarray:
    if pa.types.is_integer(ids.type):
        return grams.mix(ids.to_numpy(zero_copy_only=False).astype(np.int64).view(U) + U(1))
    return np.array([int.from_bytes(hashlib.blake2b(str(x).encode(), digest_size=8).digest(), "big") for x in ids.to_pylist()], U)


def _prefix(counts: np.ndarray, size: int, spec: Spec) -> tuple[int, int]:
    """Prefix length and matches to ask for, of a set of `size` shingles, from the ascending counts of those
    that other sets share; all its others come before them."""
    base = size - spec.least_overlap(size)
    m = np.arange(1, min(spec.most_matches, size - base) + 1)
    inside = np.maximum(base + m - (size - len(counts)), 0)
    postings = np.concatenate([[0], np.cumsum(counts)])[inside].astype(float)
    cost = postings + postings / m * (VERIFY + VERIFY_PER_SHINGLE * size) + 0.01 * m  # ties go to the shorter prefix
    best = int(m[cost.argmin()])
    return base + best, best


def _pass(documents: DataFrame, id_col: str, text: str, wanted: DataFrame, n: int, rows, schema: str) -> DataFrame:
    """One pass over the texts of the asked ids (and perhaps others); `rows` makes batches of (ids, sets)."""
    asked = documents.sparkSession.sparkContext.broadcast(grams.bit_table(wanted, lambda b: [_id_hash(b.column(0))], ID_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
            for batch in batches:
                pick = pa.array(np.flatnonzero(grams.has_bits(asked.value, _id_hash(batch.column(0)))))
                for at in range(0, len(pick), TEXTS):
                    some = pick.slice(at, TEXTS)
                    yield batch.column(0).take(some), list(shingle_sets(batch.column(1).take(some), n))

        yield from rows(each())

    named = documents.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`"), F.col(f"`{text}`"))
    return named.mapInArrow(run, schema)


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(key) else count


def _part_rows(shift: int):
    """Shingles of a task summed some million at a time: (part, keys, counts) as bytes."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        key, count = np.unique(np.concatenate(held) >> U(shift), return_counts=True)
        part = (key >> U(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = pa.py_buffer((np.concatenate([first, [len(key)]]) * 4).astype(np.int32))
        packed = lambda x: pa.Array.from_buffers(pa.binary(), len(first), [None, ends, pa.py_buffer(x.astype(np.uint32))])
        return pa.record_batch({"part": pa.array(part[first], pa.int64()), "keys": packed(key), "counts": packed(count)})

    def run(sets: Iterator[tuple[pa.Array, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, found in sets:
            for s in found:
                if len(s):
                    held.append(s)
                    size += len(s)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _shared_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by part: (token, n) of the shingles that are counted twice. One part is held at a time."""
    now, keys, counts, size = None, [], [], 0

    def flush() -> pa.RecordBatch:
        key, count = _sums(keys, counts)
        key, count = key[count > 1], count[count > 1]
        return pa.record_batch({"token": pa.array((now << 32) + key.astype(np.int64)), "n": pa.array(count)})

    for batch in batches:
        for part, k, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if part != now:
                if keys:
                    yield flush()
                now, keys, counts, size = part, [], [], 0
            keys.append(np.frombuffer(k.as_buffer(), np.uint32))
            counts.append(np.frombuffer(n.as_buffer(), np.uint32))
            size += len(keys[-1])
            if size > 8 * PART:  # shingles that come from every task take their room once
                key, count = _sums(keys, counts)
                keys, counts, size = [key], [count], 0
    if keys:
        yield flush()


def _two_bits(tokens: np.ndarray) -> list[np.ndarray]:
    """A shingle's two places in the table of shared ones."""
    once = grams.mix(tokens)
    return [once, grams.mix(once + U(1))]


def _starts(rows: pa.RecordBatch) -> np.ndarray:
    """Where id or size differ from the row before; the first row is none."""
    same = [pc.equal(rows.column(k).slice(1), rows.column(k).slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False).astype(bool) for k in (0, 1)]
    return np.flatnonzero(~(same[0] & same[1])) + 1


def _heads(spec: Spec):
    """From rows (id, size, n, token) of the shared shingles, sorted by all four, to (id, size, m, head: the
    prefix's shared shingles as bytes); none for a prefix without any, which links with nothing.

    Different texts of one id and size come as one. The first rows hold the prefix of each: they are as
    many as one text's prefix and all shared shingles of the others together.
    """

    def heads(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        count, token = (rows.column(k).to_numpy() for k in (2, 3))
        ends = np.concatenate([[0], _starts(rows), [rows.num_rows]])
        keep, out = [], []
        for size, at, end in zip(rows.column(1).to_numpy()[ends[:-1]].tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            length, m = _prefix(count[at:end], size, spec)
            inside = token[at:end][: max(length - (size - (end - at)), 0)]
            if len(inside):
                head = np.unique(inside)
                keep.append(at)
                # two shingles of one token share it once only
                out.append((max(m - (len(inside) - len(head)), 1), head.tobytes()))
        at = pa.array(keep, pa.int64())
        m, head = zip(*out, strict=True) if out else ((), ())
        return pa.record_batch({"id": rows.column(0).take(at), "size": rows.column(1).take(at), "m": pa.array(m, pa.int32()), "head": pa.array(head, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the last id and size, which the next batch may go on with
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts = _starts(batch)
            if held and not all(held[-1].column(k)[-1].equals(batch.column(k)[0]) for k in (0, 1)):
                yield heads(held)
                held = []
            if len(starts):
                yield heads([*held, batch.slice(0, starts[-1])])
                held = []
            held.append(batch.slice(starts[-1]) if len(starts) else batch)
        if held:
            yield heads(held)

    return run


def _shared_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (token, id): one row a token and id, where the token has another id as well.
    Only the last row waits for the next batch, with whether its token is known to be shared."""
    held, shared_before = None, False
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        token = rows.column(0).to_numpy(zero_copy_only=False)
        same_token = token[1:] == token[:-1]
        same_id = pc.equal(rows.column(1).slice(1), rows.column(1).slice(0, len(token) - 1)).to_numpy(zero_copy_only=False).astype(bool)
        first = np.concatenate([[True], ~(same_token & same_id)])
        rows, token = rows.filter(pa.array(first)), token[first]
        near = token[1:] == token[:-1]
        shared = np.zeros(len(token), bool)
        shared[1:] |= near
        shared[:-1] |= near
        shared[0] |= held is not None and shared_before
        last = len(token) - 1
        yield rows.slice(0, last).filter(pa.array(shared[:last]))
        held, shared_before = rows.slice(last, 1), bool(shared[last])
    if held is not None and shared_before:
        yield held


@dataclass
class Prepared:
    """Tables of the join: rows with their classes; heads (id, size, m, head); postings (token, id, size, m);
    and a function from ids to their sets (id, size, m, head, tokens)."""

    members: DataFrame
    heads: DataFrame
    postings: DataFrame
    sets: Callable[[DataFrame], DataFrame]


def prepare(documents: DataFrame, id_col: str, text: str, spec: Spec) -> Prepared:
    spark = documents.sparkSession
    small_batches(spark)
    who = members(documents, id_col, text, spec.n)
    kind = dict(who.dtypes)["__id"]
    firsts = who.where(F.col("__id") == F.col("__class"))
    total = firsts.agg(F.sum("__size")).first()[0] or 0
    firsts = firsts.select("__id")
    # leading bits that name the part, which leave 32 for the shingle
    shift = 32 - min(max(int(total // PART).bit_length(), 6), 31)

    parts = _pass(documents, id_col, text, firsts, spec.n, _part_rows(shift), "part long, keys binary, counts binary")
    counts = stored(parts.repartition("part").sortWithinPartitions("part").mapInArrow(_shared_of_parts, "token long, n long"), "shared-shingles")
    bits = spark.sparkContext.broadcast(grams.bit_table(counts.select("token"), lambda b: _two_bits(b.column(0).to_numpy(zero_copy_only=False).view(U)), SHARED_BITS))

    def likely(sets: Iterator[tuple[pa.Array, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for ids, found in sets:
            tokens = [s >> U(shift) for s in found]
            tokens = [t[np.logical_and(*(grams.has_bits(bits.value, h) for h in _two_bits(t)))] for t in tokens]
            at = np.repeat(np.arange(len(found)), [len(t) for t in tokens])
            sizes = np.array([len(s) for s in found], np.int64)
            yield pa.record_batch({"token": pa.array(np.concatenate([np.zeros(0, U), *tokens]).view(np.int64)), "id": ids.take(pa.array(at, pa.int64())), "size": pa.array(sizes[at], pa.int64())})

    rows = _pass(documents, id_col, text, firsts, spec.n, likely, f"token long, id {kind}, size long").join(counts, "token")
    rows = rows.select("id", "size", "n", "token").repartition("id").sortWithinPartitions("id", "size", "n", "token")
    heads = rows.mapInArrow(_heads(spec), f"id {kind}, size long, m int, head binary")
    heads = stored(heads.join(firsts, F.col("id") == F.col("__id"), "left_semi"), "prefixes")
    discard(counts)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(3)]
            at = pa.array(np.repeat(np.arange(len(head)), [len(h) for h in head]), pa.int64())
            yield pa.record_batch({"token": pa.array(np.concatenate([np.zeros(0, np.int64), *head])), **{c: batch.column(k).take(at) for k, c in enumerate(("id", "size", "m"))}})

    schema = f"token long, id {kind}, size long, m int"
    every = heads.select("id", "size", "m", "head").mapInArrow(postings, schema)
    lists = stored(every.repartition("token").sortWithinPartitions("token", "id").mapInArrow(_shared_lists, schema), "postings")

    def whole(sets: Iterator[tuple[pa.Array, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for ids, found in sets:
            yield pa.record_batch({"id": ids, "size": pa.array([len(s) for s in found], pa.int64()), "tokens": pa.array([s.tobytes() for s in found], pa.binary())})

    def sets(wanted: DataFrame) -> DataFrame:
        found = _pass(documents, id_col, text, wanted, spec.n, whole, f"id {kind}, size long, tokens binary")
        return stored(heads.join(wanted.select("id"), "id", "left_semi").join(found, ["id", "size"]), "sets")

    return Prepared(who, heads, lists, sets)


def _close(spec: Spec):
    """Whether two sizes allow a link."""
    return (100 * F.least("x_size", "y_size") >= spec.percent * F.greatest("x_size", "y_size")) & (F.col("x") != F.col("y"))


def verify(pairs: DataFrame, sets: DataFrame, spec: Spec) -> DataFrame:
    """The linked ones of pairs (x, y) of ids, with the size of the intersection."""
    left = sets.select(F.col("id").alias("x"), F.col("tokens").alias("tx"))
    right = sets.select(F.col("id").alias("y"), F.col("tokens").alias("ty"))
    kind = dict(pairs.dtypes)["x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, common = [], []
            for k, (p, q) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                p, q = np.frombuffer(p.as_buffer(), U), np.frombuffer(q.as_buffer(), U)
                n = len(np.intersect1d(p, q, assume_unique=True))
                if spec.linked(n, len(p), len(q)):
                    keep.append(k)
                    common.append(n)
            at = pa.array(keep, pa.int64())
            yield pa.record_batch({"x": batch.column(0).take(at), "y": batch.column(1).take(at), "common": pa.array(common, pa.int64())})

    both = pairs.join(left, "x").join(right, "y").select("x", "y", "tx", "ty")
    return both.mapInArrow(run, f"x {kind}, y {kind}, common long")


def similar_pairs(documents: DataFrame, id_col: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> tuple[DataFrame, DataFrame]:
    """Every similar pair of classes (x < y, common), and the members (__id, __size, __class)."""
    ready = prepare(documents, id_col, text, spec)
    x = ready.postings.select("token", F.col("id").alias("x"), F.col("size").alias("x_size"), F.col("m").alias("x_m"))
    y = ready.postings.select("token", F.col("id").alias("y"), F.col("size").alias("y_size"), F.col("m").alias("y_m"))
    shared = x.join(y, "token").where((F.col("x") < F.col("y")) & _close(spec)).groupBy("x", "y").agg(F.count("*").alias("n"), F.first(F.least("x_m", "y_m")).alias("least"))
    pairs = stored(shared.where(F.col("n") >= F.col("least")).select("x", "y"), "candidate-pairs")
    sets = ready.sets(pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct())
    return verify(pairs, sets, spec).distinct(), ready.members


def _short(postings: DataFrame, spec: Spec) -> DataFrame:
    """Candidate pairs of lists of SHORT_LIST documents at most (token, id, size, m, list); both must share the
    smaller m of their shingles, but shingles with long lists are not seen here and so are taken as shared."""
    few = postings.where(F.col("list") <= SHORT_LIST)
    far = postings.where(F.col("list") > SHORT_LIST).groupBy("id").agg(F.count("*").alias("unseen"))
    few = few.join(far, "id", "left").withColumn("unseen", F.coalesce("unseen", F.lit(0)))
    x = few.select("token", F.col("id").alias("x"), F.col("size").alias("x_size"), F.col("m").alias("x_m"), F.col("unseen").alias("x_u"))
    y = few.select("token", F.col("id").alias("y"), F.col("size").alias("y_size"), F.col("m").alias("y_m"), F.col("unseen").alias("y_u"))
    shared = x.join(y, "token").where((F.col("x") < F.col("y")) & _close(spec))
    shared = shared.groupBy("x", "y").agg(F.count("*").alias("n"), F.first(F.least("x_m", "y_m") - F.least("x_u", "y_u")).alias("least"))
    return shared.where(F.col("n") >= F.col("least")).select("x", "y")


def _block_links(spec: Spec, verified: bool):
    """Links between components within one pair of blocks of a group, no more than join the components: of
    similar documents, or (not `verified`) of documents whose prefixes let them be similar."""

    def run(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        size = rows.column("size").to_numpy()
        m = rows.column("m").to_numpy()
        _, component = np.unique(rows.column("component").to_numpy(zero_copy_only=False), return_inverse=True)
        ids = rows.column("id").combine_chunks()
        heads = [np.frombuffer(x.as_buffer(), U) for x in rows.column("head")]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        may = component[left][:, None] != component[right][None, :]
        may &= 100 * np.minimum(size[left][:, None], size[right][None, :]) >= spec.percent * np.maximum(size[left][:, None], size[right][None, :])
        if may.any():
            may &= _common(heads, left, right) >= np.minimum(m[left][:, None], m[right][None, :])
        # documents of no candidate pair need no verifying
        rows_, cols = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
        out, linked = [], set()
        if len(rows_):
            good = may[np.ix_(rows_, cols)]
            if verified:
                tokens = [np.frombuffer(x.as_buffer(), U) for x in rows.column("tokens")]
                good &= spec.linked(_common(tokens, left[rows_], right[cols]), size[left[rows_]][:, None], size[right[cols]][None, :])
            parent = list(range(int(component.max()) + 1))

            def top(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for i, j in np.argwhere(good):
                p, q = int(left[rows_[i]]), int(right[cols[j]])
                a, b = top(component[p]), top(component[q])
                if a != b:
                    parent[a] = b
                linked.update((p, q))
            first: dict[int, int] = {}  # every linked document is given with one of its component's, as a star
            for p in sorted(linked):
                out.append((first.setdefault(top(component[p]), p), p))
        at = lambda k: ids.take(pa.array([o[k] for o in out], pa.int64()))
        return pa.table({"x": at(0), "y": at(1)})

    return run


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, chunk: int = 4096) -> np.ndarray:
    """Sizes of the intersections of left and right sets, which are ascending: products of 0/1 matrices, some
    thousand shingles at a time. Shingles are told apart in ranges of about TOLD, whatever the sets' sizes."""
    used, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    sets = [sets[k] for k in used]
    ranges = max(-(-sum(map(len, sets)) // TOLD), 1)
    some = np.sort(np.concatenate([s[::ranges] for s in sets]))
    edges = some[len(some) * np.arange(1, ranges) // ranges]
    cuts = [np.concatenate([[0], np.searchsorted(s, edges), [len(s)]]) for s in sets]
    total = np.zeros((len(left), len(right)), np.int64)
    for k in range(ranges):
        parts = [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts, strict=True)]
        values, column = np.unique(np.concatenate(parts), return_inverse=True)
        row = np.repeat(np.arange(len(used)), [len(p) for p in parts])
        often = np.bincount(column, minlength=len(values)) > 1
        new = np.cumsum(often) - 1
        keep = often[column]
        row, column = row[keep], new[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, int(often.sum()), chunk):
            i, j = np.searchsorted(column, [at, at + chunk])
            matrix = np.zeros((len(used), chunk), np.float32)
            matrix[row[i:j], column[i:j] - at] = 1
            total += np.rint(matrix[place[: len(left)]] @ matrix[place[len(left) :]].T).astype(np.int64)
    return total


def _star_links(spec: Spec, verified: bool, kind: str):
    """Rows (token, hub, id, and both sides' size, m, head and, if `verified`, tokens) to the links among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = lambda a, b: len(np.intersect1d(np.frombuffer(a.as_buffer(), U), np.frombuffer(b.as_buffer(), U), assume_unique=True))
        for batch in batches:
            of = dict(zip(batch.schema.names, batch.columns, strict=True))
            size, hub_size, m, hub_m = (of[c].to_numpy(zero_copy_only=False) for c in ("size", "hub_size", "m", "hub_m"))
            keep = []
            for k in np.flatnonzero(100 * np.minimum(size, hub_size) >= spec.percent * np.maximum(size, hub_size)).tolist():
                if common(of["head"][k], of["hub_head"][k]) >= min(m[k], hub_m[k]) and (not verified or spec.linked(common(of["tokens"][k], of["hub_tokens"][k]), size[k], hub_size[k])):
                    keep.append(k)
            at = pa.array(keep, pa.int64())
            yield pa.record_batch({"token": of["token"].take(at), "x": of["hub"].take(at), "y": of["id"].take(at)})

    return run, f"token string, x {kind}, y {kind}"


def _ways(known: DataFrame, blocks, block, i, j, side) -> DataFrame:
    """Each row once for each of `blocks` blocks k that it meets, by functions of (k, its own block)."""
    ways = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(i(k, block).alias("i"), j(k, block).alias("j"), side(k, block).cast("int").alias("side")))
    return known.where(blocks > 0).withColumn("way", F.explode(ways)).select("token", "id", "component", "way.i", "way.j", "way.side")


def _within(known: DataFrame, size: str) -> DataFrame:
    """All pairs of blocks of a group of `size` documents: block i meets blocks i.. on the left and ..i on the
    right; side 2: it meets itself."""
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("id"), blocks).cast("int")
    return _ways(known, blocks, block, F.least, F.greatest, lambda k, own: F.when(k == own, 2).when(k > own, 0).otherwise(1))


def _blocks(known: DataFrame, sets: DataFrame, spec: Spec, verified: bool = True) -> DataFrame:
    """Links between components among the documents of each group (token, id, component, list: the group's
    size): each pair of blocks of a group in a task of its own. Of a group of several blocks, documents that
    link with one of HUBS documents are told first; the largest component is then held against the rest only."""
    kind = dict(known.dtypes)["id"]
    sides = ["size", "m", "head", *(["tokens"] if verified else [])]
    known = known.withColumn("token", F.col("token").cast("string"))
    dealt, stars = _within(known.where(F.col("list") <= BLOCK), "list"), None
    big = known.where(F.col("list") > BLOCK).drop("component")
    if not big.isEmpty():
        run, schema = _star_links(spec, verified, kind)
        hubs = big.groupBy("token", F.pmod(F.xxhash64("id"), F.lit(HUBS))).agg(F.min("id").alias("hub")).select("token", "hub")
        hubs = hubs.join(sets.select(F.col("id").alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in sides)), "hub")
        pairs = big.select("token", "id").join(sets.select("id", *sides), "id").join(hubs, "token").where(F.col("id") != F.col("hub"))
        stars = stored(pairs.mapInArrow(run, schema), "stars")
        # the least of the hubs that a document links with names its component so far, a lower one than its own if it is a hub
        named = stars.groupBy("token", F.col("y").alias("id")).agg(F.min("x").alias("component"))
        hub = hubs.select("token", F.col("hub").alias("id"), F.lit(True).alias("is_hub")).distinct()
        big = big.join(named, ["token", "id"], "left").join(hub, ["token", "id"], "left")
        own = F.col("component").isNull() | (F.col("is_hub") & (F.col("id") < F.col("component")))
        big = stored(big.select("token", "id", F.when(own, F.col("id")).otherwise(F.col("component")).alias("component"), "list"), "starred-groups")
        most = big.groupBy("token", "component").agg(F.count("*").alias("n")).groupBy("token").agg(F.max(F.struct("n", "component")).alias("main"))
        both = big.join(most.select("token", F.col("main.n").alias("main_n"), F.col("main.component").alias("main")), "token")
        both = both.withColumn("rest", F.col("list") - F.col("main_n"))
        main, rest = both.where(F.col("component") == F.col("main")), both.where(F.col("component") != F.col("main"))
        wide, tall = F.ceil(F.col("main_n") / BLOCK).cast("int"), F.ceil(F.col("rest") / BLOCK).cast("int")
        # blocks of the main component are numbered -1, -2, ...
        mine = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
        dealt = dealt.unionByName(_within(rest, "rest"))
        dealt = dealt.unionByName(_ways(main, tall, mine(F.greatest(wide, F.lit(1))), lambda k, own: -1 - own, lambda k, own: k, lambda k, own: F.lit(0)))
        dealt = dealt.unionByName(_ways(rest, wide, mine(F.greatest(tall, F.lit(1))), lambda k, own: -1 - k, lambda k, own: own, lambda k, own: F.lit(1)))
    whole = dealt.join(sets.select("id", *sides), "id")
    links = whole.groupBy("token", "i", "j").applyInArrow(_block_links(spec, verified), f"x {kind}, y {kind}")
    return links if stars is None else links.unionByName(stars.select("x", "y"))


def _candidate_groups(postings: DataFrame, heads: DataFrame, spec: Spec) -> DataFrame:
    """Documents that candidate pairs connect (token: the group, id, component: each its own, list: the
    group's size), told from prefixes alone, so that whole sets are fetched for few documents."""
    lists = stored(postings.join(postings.groupBy("token").agg(F.count("*").alias("list")), "token"), "lists")
    long = lists.where(F.col("list") > SHORT_LIST).select("token", "id", F.col("id").alias("component"), "list")
    near = _blocks(long, heads, spec, verified=False).unionByName(_short(lists, spec))
    groups = components(near, "x", "y")
    size = groups.groupBy("component").agg(F.count("*").alias("list"))
    return stored(groups.join(size, "component").select(F.col("component").alias("token"), F.col("node").alias("id"), F.col("node").alias("component"), "list"), "candidate-groups")


def _compact_groups(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of documents that posting lists connect, where a group in blocks makes no more rows than its
    lists in blocks (token: the group, id, component, list); and the postings of all other groups."""
    hubs = postings.groupBy("token").agg(F.min("id").alias("hub"))
    groups = components(postings.join(hubs, "token").select("hub", "id").distinct(), "hub", "id")
    named = groups.select(F.col("node").alias("id"), F.col("component").alias("group"))
    lists = postings.join(named, "id").groupBy("group", "token").agg(F.count("*").alias("n"))
    by_list = lists.groupBy("group").agg(F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK)).alias("by_list"))
    size = named.groupBy("group").agg(F.count("*").alias("list"))
    compact = size.join(by_list, "group").where(F.col("list") * F.ceil(F.col("list") / BLOCK) <= F.col("by_list")).select("group", "list")
    inside = stored(named.join(compact, "group").select(F.col("group").alias("token"), "id", F.col("id").alias("component"), "list"), "compact-groups")
    return inside, stored(postings.join(inside.select("id"), "id", "left_anti"), "other-postings")


def _named(groups: DataFrame, by: str) -> DataFrame:
    return groups.withColumn("token", F.concat_ws(" ", F.lit(by), F.col("token").cast("string")))


def similar_components(documents: DataFrame, id_col: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """(id, `n_shingles`, `component_id`) for every row: the size of its set, and the smallest id that it
    reaches by links, itself included.

    Null and empty texts and texts without words have no shingles and link with nothing; their component
    is their own id. A row without an id belongs to the class of its text, and to none (null) where no row
    of that class has an id. Rows that repeat an id have the size and class of their own text, and that id
    has the links of all its texts. An empty table stays empty.
    """
    ready = prepare(documents, id_col, text, spec)
    kind = dict(ready.members.dtypes)["__id"]
    compact, others = _compact_groups(ready.postings)
    groups = _named(compact, "lists")
    if not others.isEmpty():
        groups = groups.unionByName(_named(_candidate_groups(others, ready.heads, spec), "candidates"))
    links = stored(_blocks(groups, ready.sets(groups.select("id").distinct()), spec), "links")
    labels = components(links, "x", "y")
    joined = ready.members.join(labels, F.col("__class") == F.col("node"), "left")
    return joined.select(F.col("__id").cast(kind).alias(id_col), F.col("__size").alias("n_shingles"), F.coalesce("component", "__class", "__id").alias("component_id"))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text: str = "text", spec: Spec = Spec()) -> DataFrame:
    """The rows of `documents` that stay when one document of each component does: the smallest id.

    Rows without an id stay. Of rows that repeat an id, those stay whose id is their component's; repeated
    rows of such an id all stay.
    """
    found = similar_components(documents, id_col, text, spec)
    drop = found.where(F.col(f"`{id_col}`") != F.col("component_id")).select(F.col(f"`{id_col}`").alias("__drop")).distinct()
    return documents.join(stored(drop, "near-copies"), documents[f"`{id_col}`"] == F.col("__drop"), "left_anti")
