"""Embedding whitening by polarisation covariance.

An entry c of a vector becomes the integer x = floor(64 * c) + 1,000,000. The fit list holds each distinct
integer vector once. Over it Spark sums the exact squares of the centred values of every dimension and of every
sum of two dimensions; half the difference of variances, (V(i + j) - V(i) - V(j)) / 2, is the covariance of i
and j. The matrix (dimensions squared, whatever the rows) goes to the driver for `eigh`; every row is then
projected on the first components and divided by their standard deviations.

All sums are whole numbers of any size. Values are centred at the rounded mean m before they are squared, which
keeps them small; what is left of the mean, r = S/n - m, is taken out of the sums exactly:
sum((n * x - S)^2) = n^2 * sum((x - m)^2) - n * sum(x - m)^2.

Vectors that are null or hold null or non-finite entries are dropped; so are vectors of another length than most
(the longest of the commonest lengths stays). Entries beyond 2^56 either way count as 2^56. Repeated vectors count
once in the fit and are whitened as often as they occur; rows without an id stay. An empty table, or one of equal
vectors only, has no component and gives no rows; components without variance (less than 1e-12 of the whole) are
left out. Other columns of the table are not looked at, whatever their names. A deviation that no long holds is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
#: Components that are returned.
COMPONENTS = 16
#: Eigenvalues of less than this share of the trace are no variance.
LEAST_SHARE = 1e-12
#: Whole numbers of a sum travel as two decimals, of this base.
LIMB = 10**18
ENTRY = float(1 << 56)


@dataclass(frozen=True)
class Whitening:
    """Count n of the fit list, rounded mean and the exact sums of what is left; components as columns."""

    n: int
    middle: np.ndarray
    rest: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    @property
    def sums(self) -> list[int]:
        """Per-dimension sums of x over the fit list."""
        return [self.n * int(m) + r for m, r in zip(self.middle, self.rest, strict=True)]

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that are usable, and their whole numbers; all lists have one length."""
    usable = column.is_valid().to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(usable)
    flat = column.take(pa.array(kept)).flatten()
    width = len(flat) // len(kept) if len(kept) else 0
    entries = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(kept), width)
    good = np.isfinite(entries).all(axis=1)
    scaled = np.clip(np.floor(SCALE * entries[good]), -ENTRY, ENTRY)
    return kept[good], scaled.astype(np.int64) + SHIFT


def exact_square_sums(values: np.ndarray) -> list[int]:
    """Per column, the sum of the squares of an int64 matrix, as whole numbers of any size."""
    if not values.size:
        return [0] * values.shape[1]
    top = max(int(values.max()), -int(values.min()), 1)
    if top * top >= 1 << 62:  # no int64 holds a square
        return [int(x) for x in (values.astype(object) ** 2).sum(axis=0)]
    rows = max(1, (1 << 62) // (top * top))
    total = [0] * values.shape[1]
    for at in range(0, len(values), rows):
        part = values[at : at + rows]
        total = [t + int(x) for t, x in zip(total, np.einsum("ij,ij->j", part, part), strict=True)]
    return total


def _sum_rows(sums: dict[int, int]) -> pa.RecordBatch:
    keys = list(sums)
    halves = [divmod(sums[k], LIMB) for k in keys]
    kind = pa.decimal128(38, 0)
    return pa.record_batch({"k": pa.array(keys, pa.int32()), "hi": pa.array([h for h, _ in halves], kind), "lo": pa.array([x for _, x in halves], kind)})


def _summed(rows: DataFrame, sums) -> dict[int, int]:
    """Whole-number sums over all rows by key; `sums` turns a batch of int64 vectors into {key: sum}. Each task
    gives one row a key, which Spark adds up by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for k, v in sums(matrix(batch.column(0))).items():
                total[k] = total.get(k, 0) + v
        if total:
            yield _sum_rows(total)

    added = rows.mapInArrow(run, "k int, hi decimal(38,0), lo decimal(38,0)").groupBy("k").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))
    return {r["k"]: int(r["hi"]) * LIMB + int(r["lo"]) for r in added.collect()}


def matrix(column: pa.Array) -> np.ndarray:
    """int64 vectors of equal length from a binary column."""
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return np.frombuffer(b"".join(x.as_py() for x in column), "<i8").reshape(len(column), -1)


def usable(embeddings: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has the commonest length, as (__id, __vector)-ready selection of `embeddings`."""
    size = F.size(F.col(f"`{vector}`"))
    lengths = embeddings.where(F.col(f"`{vector}`").isNotNull() & (size > 0)).groupBy(size.alias("d")).agg(F.count("*").alias("rows"))
    most = lengths.agg(F.max(F.struct("rows", "d")).alias("m")).first()["m"]
    return embeddings.where(size == F.lit(most["d"] if most else -1))


def _sums(x: np.ndarray) -> dict[int, int]:
    """Count (key -1) and per-dimension sums."""
    high, low = x >> 32, x & 0xFFFFFFFF  # their sums fit for 2^31 rows
    return {-1: len(x), **{k: (int(h) << 32) + int(v) for k, (h, v) in enumerate(zip(high.sum(axis=0), low.sum(axis=0), strict=True))}}


def polarised(x: np.ndarray, middle: np.ndarray) -> dict[int, int]:
    """Sums of the squares of x - middle: of dimension i under key i * D + i, of dimensions i and j under i * D + j."""
    d, out = x - middle, {}
    width = d.shape[1]
    for i in range(width):
        pairs = d[:, i:] + d[:, i : i + 1]
        pairs[:, 0] = d[:, i]
        out.update(zip(range(i * width + i, i * width + width), exact_square_sums(pairs), strict=True))
    return out


def covariance(n: int, rest: list[int], squares: dict[int, int]) -> np.ndarray:
    """The covariance matrix, each entry correctly rounded, from the sums of :func:`polarised` and the sums
    (`rest`) of the values they were centred to."""
    width = len(rest)
    own = [n * squares[i * width + i] - rest[i] ** 2 for i in range(width)]  # n^2 times the variance
    out = np.zeros((width, width))
    for i in range(width):
        out[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, width):
            both = n * squares[i * width + j] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - own[i] - own[j], 2 * n * n))
    return out


def fit(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of vectors, or None where it has no variance."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x = integers(batch.column(0))
            yield pa.record_batch({"x": pa.array([v.tobytes() for v in x], pa.binary())})

    rows = usable(embeddings, vector).select(F.col(f"`{vector}`").alias("v"))
    # copies are dropped within each task before the shuffle
    once = stored(rows.mapInArrow(encode, "x binary").distinct(), "vectors")
    first = _summed(once, _sums)
    n = first.pop(-1, 0)
    if not n:
        return None
    sums = [first[k] for k in range(len(first))]
    middle = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    squares = _summed(once, lambda x: polarised(x, middle) if len(x) else {})
    cov = covariance(n, rest, squares)
    trace = float(np.trace(cov))
    if trace <= 0:
        return None
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values, kind="stable")[::-1][:components]
    order = order[values[order] > LEAST_SHARE * trace]
    found = Whitening(n, middle, tuple(rest), vectors[:, order], values[order], trace, 0.0)
    return Whitening(n, middle, tuple(rest), found.vectors, found.values, trace, _identity_error(once, found))


def project(x: np.ndarray, w: Whitening) -> np.ndarray:
    """Whitened values of int64 vectors, a column a component."""
    centred = (x - w.middle).astype(np.float64) - np.array([float(Fraction(r, w.n)) for r in w.rest])
    return centred @ w.vectors / np.sqrt(w.values)


def _identity_error(once: DataFrame, w: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, by another pass over it."""
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                y = project(matrix(batch.column(0)), w)
                total[:k] += y.T @ y
                total[k] += y.sum(axis=0)
        yield pa.record_batch({"k": pa.array(range(total.size), pa.int32()), "v": pa.array(total.ravel())})

    total = np.zeros((k + 1) * k)
    for r in once.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        total[r["k"]] = r["v"]
    total = total.reshape(k + 1, k) / w.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, w: Whitening) -> list[int | None]:
    """Per vector, the sum over dimensions of (n * x - S)^2; None where no long holds it."""
    d = x - w.middle
    far = max([int(np.abs(d).max()) if d.size else 0, 1])
    worst = w.n * far + max(map(abs, w.rest))
    if worst * worst * x.shape[1] < 1 << 63:
        return [int(v) for v in ((w.n * d - np.array(w.rest, np.int64)) ** 2).sum(axis=1)]
    exact = ((w.n * d.astype(object) - np.array(w.rest, object)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def whiten(embeddings: DataFrame, w: Whitening | None, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, `component` from 1, `n`, `deviation`, `whitened`, `explained`, `identity_error`) for each usable row and
    component; narrow, one pass."""
    kind = dict(embeddings.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    shared = embeddings.sparkSession.sparkContext.broadcast(w)  # dimensions times components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k = len(w.values)
        for batch in batches:
            kept, x = integers(batch.column(1))
            if not len(kept):
                continue
            rows = len(kept)
            yield pa.record_batch(
                {
                    id_col: batch.column(0).take(pa.array(np.repeat(kept, k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * k, w.n, np.int64)),
                    "deviation": pa.array([v for v in deviations(x, w) for _ in range(k)], pa.int64()),
                    "whitened": pa.array(project(x, w).ravel()),
                    "explained": pa.array(np.tile(w.explained, rows)),
                    "identity_error": pa.array(np.full(rows * k, w.identity_error)),
                }
            )

    return usable(embeddings, vector).select(F.col(f"`{id_col}`"), F.col(f"`{vector}`")).mapInArrow(run, schema)
