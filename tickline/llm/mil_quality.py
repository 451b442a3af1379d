"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of `PASSAGE` words. Each passage becomes a vector of character,
word and repetition statistics and hashed word counts; a learned layer encodes it; gated attention
    a_k  ~  exp( w . ( tanh(V h_k) * sigmoid(U h_k) ) )
weighs the passages of a document, and the weighted sum of their encodings is scored. Weights of
encoder, gate and scorer are learned together from document labels alone, on a sample of at most
`TRAIN_DOCS` labelled documents (those of the smallest hash of their id); training and scoring read every
passage of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import grams

PASSAGE = 64
TRAIN_DOCS = 6000
HASHED = 32
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 128, 0.01, 1e-4
U = np.uint64

_KIND = np.full(256, 7, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[ord(c) for c in ".,;:"]] = 4
_KIND[[ord(c) for c in "!?"]] = 5
_KIND[[ord(c) for c in "#*$%&|<>{}[]\\^~`=+_@/"]] = 6
KINDS = 8
STATS = KINDS + 9
WIDTH = STATS + HASHED


def passages(bodies: list[np.ndarray]) -> list[np.ndarray]:
    """For each text (bytes) one row of WIDTH features a passage; one row of zeros for a text without words.

    Texts are worked on together: they are laid out with a blank between them, and every passage is a
    stretch of that layout.
    """
    text_at = np.cumsum([0, *[len(b) + 1 for b in bodies]])
    body = np.full(text_at[-1], 32, np.uint8)
    for b, at in zip(bodies, text_at[:-1], strict=True):
        body[at : at + len(b)] = b
    h, start, end = grams.words(body)
    word_at = np.searchsorted(start, text_at)
    n_words = np.diff(word_at)
    count = np.maximum(-(-n_words // PASSAGE), 1)
    row_at = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros((row_at[-1], WIDTH), np.float32)
    if len(h):
        text = np.repeat(np.arange(len(bodies)), n_words)
        owner = row_at[text] + (np.arange(len(h)) - word_at[text]) // PASSAGE
        rows = len(out)
        size = np.maximum(np.bincount(owner, minlength=rows), 1)
        edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        # a passage reaches to the next one's first word; blanks between texts count to the text before
        place = np.repeat(owner[edge], np.diff(np.concatenate([[0], start[edge[1:]], [len(body)]])))
        kinds = np.bincount(place * KINDS + _KIND[body], minlength=rows * KINDS).reshape(-1, KINDS)
        chars = np.maximum(kinds.sum(1), 1)
        out[:, :KINDS] = kinds / chars[:, None]
        length = (end - start).astype(np.float32)
        mean = np.bincount(owner, length, rows) / size
        out[:, KINDS] = mean / 10
        out[:, KINDS + 1] = np.sqrt(np.maximum(np.bincount(owner, length**2, rows) / size - mean**2, 0)) / 10
        out[:, KINDS + 2] = np.bincount(owner, minlength=rows) / PASSAGE
        order = np.lexsort((h, owner))
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        out[:, KINDS + 3] = np.bincount(owner[order], fresh, rows) / size
        same = np.zeros(len(h))
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        out[:, KINDS + 4] = np.bincount(owner, same, rows) / size
        last = _KIND[body[end - 1]]
        for k, kind in enumerate((4, 5, 6)):
            out[:, KINDS + 5 + k] = np.bincount(owner, last == kind, rows) / size
        out[:, KINDS + 8] = np.bincount(place, body == 10, rows) / chars * 10
        out[:, STATS:] = np.bincount(owner * HASHED + (h % U(HASHED)).astype(np.int64), minlength=rows * HASHED).reshape(-1, HASHED) / size[:, None]
        out[np.flatnonzero(np.bincount(owner, minlength=rows) == 0)] = 0
    return [out[i:j] for i, j in zip(row_at[:-1], row_at[1:], strict=True)]


def bags(column: pa.Array) -> Iterator[np.ndarray]:
    wait, size = [], 0
    for body in grams.text_bytes(column):
        wait.append(body)
        size += len(body)
        if size > grams.PIECE // 4:
            yield from passages(wait)
            wait, size = [], 0
    yield from passages(wait) if wait else ()


@dataclass
class Model:
    """Weights by name; `mean` and `scale` standardize features."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def forward(self, rows: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Logit of each of `n` bags; `owner` is the bag of each row, ascending, no bag empty."""
        w = self.weights
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w["E"] + w["e"])
        t = np.tanh(h @ w["V"] + w["v"])
        s = 1 / (1 + np.exp(-(h @ w["U"] + w["u"])))
        gate = t * s
        raw = gate @ w["w"]
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        a = np.exp(raw - np.maximum.reduceat(raw, begin)[owner])
        a = a / np.add.reduceat(a, begin)[owner]
        z = np.add.reduceat(a[:, None] * h, begin, axis=0)
        logit = z @ w["c"] + w["d"][0]
        return logit, {"x": x, "h": h, "t": t, "s": s, "gate": gate, "a": a, "z": z, "begin": begin}

    def score(self, lists: list[np.ndarray]) -> np.ndarray:
        if not lists:
            return np.zeros(0)
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        logit, _ = self.forward(np.concatenate(lists), owner, len(lists))
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def attention(self, rows: np.ndarray) -> np.ndarray:
        """The weight of each passage of one document."""
        return self.forward(rows, np.zeros(len(rows), np.int64), 1)[1]["a"]


def _gradients(m: Model, rows: np.ndarray, owner: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    w = m.weights
    logit, k = m.forward(rows, owner, len(y))
    off = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y) * weight / weight.sum()
    g = {"c": k["z"].T @ off, "d": np.array([off.sum()])}
    dz = off[:, None] * w["c"]
    dz_row = dz[owner]
    dh = k["a"][:, None] * dz_row
    da = (dz_row * k["h"]).sum(1)
    draw = k["a"] * (da - np.add.reduceat(k["a"] * da, k["begin"])[owner])
    g["w"] = k["gate"].T @ draw
    dgate = draw[:, None] * w["w"]
    dt = dgate * k["s"] * (1 - k["t"] ** 2)
    ds = dgate * k["t"] * k["s"] * (1 - k["s"])
    g["V"], g["v"], g["U"], g["u"] = k["h"].T @ dt, dt.sum(0), k["h"].T @ ds, ds.sum(0)
    dh = (dh + dt @ w["V"].T + ds @ w["U"].T) * (1 - k["h"] ** 2)
    g["E"], g["e"] = k["x"].T @ dh, dh.sum(0)
    return g


def train(lists: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Fit on bags and their 0/1 labels; the two labels weigh alike. One label alone, or none, gives a constant."""
    rng = np.random.default_rng(seed)
    rows = np.concatenate(lists) if lists else np.zeros((1, WIDTH), np.float32)
    draw = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
    weights = {
        "E": draw(WIDTH, HIDDEN), "e": np.zeros(HIDDEN), "V": draw(HIDDEN, GATE), "v": np.zeros(GATE), "U": draw(HIDDEN, GATE), "u": np.zeros(GATE),
        "w": rng.normal(0, 0.1, GATE), "c": rng.normal(0, 0.1, HIDDEN), "d": np.zeros(1),
    }
    m = Model(weights, rows.mean(0), np.maximum(rows.std(0), 1e-3))
    n, ones = len(y), int(y.sum()) if len(y) else 0
    if ones in (0, n):
        m.weights["c"][:] = 0
        m.weights["d"][0] = 4.0 if ones else -4.0 if n else 0.0
        return m
    share = np.where(y == 1, n / (2 * ones), n / (2 * (n - ones)))
    first, second = ({k: np.zeros_like(v) for k, v in weights.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            pick = order[at : at + BATCH]
            owner = np.repeat(np.arange(len(pick)), [len(lists[i]) for i in pick])
            g = _gradients(m, np.concatenate([lists[i] for i in pick]), owner, y[pick], share[pick])
            step += 1
            for k, v in g.items():
                v = v + DECAY * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                weights[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return m


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from the `train_docs` labelled documents of the smallest hash of their id.

    Rows without an id or label, or with another label than 0 or 1, are left out. Only the ids and labels
    of the sample (`train_docs` rows at most), then all their passages (about half the size of their texts), go
    to the driver. Documents that repeat an id count with each of their texts, up to twice the sample. Empty
    tables, or labels of one kind, give a constant.
    """
    known = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isin(0, 1)).select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label}`").cast("int").alias("__y"))
    sample = known.orderBy(F.xxhash64("__id"), "__id", "__y").limit(train_docs)
    texts = documents.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    joined = texts.join(F.broadcast(sample), "__id")  # at most `train_docs` ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [rows.tobytes() for rows in bags(batch.column(1))]
            yield pa.record_batch({"id": batch.column(0), "y": batch.column(2), "bag": pa.array(out, pa.large_binary()).cast(pa.binary())})

    kind = dict(documents.dtypes)[id_col]
    described = joined.select("__id", "__text", "__y").mapInArrow(encode, f"id {kind}, y int, bag binary")
    # repeated ids count, at most twice the sample; in one order, so the same model however the tasks ran
    rows = described.orderBy("id", "y", F.xxhash64("bag")).limit(2 * train_docs).collect()
    return train([np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows], np.array([r["y"] for r in rows], float))


def score(documents: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """All rows and columns and `out`, the probability of label 1. Null and empty texts are scored as one
    empty passage; repeated rows are scored alike; a column named like `out` is replaced; an empty table stays empty."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # some thousand numbers

    @F.pandas_udf("double")
    def scored(texts):
        import pandas as pd

        out, wait, size = [], [], 0
        for rows in bags(pa.array(texts, pa.large_string())):
            wait.append(rows)
            size += len(rows)
            if size > 20_000:
                out.append(shared.value.score(wait))
                wait, size = [], 0
        out.append(shared.value.score(wait))
        return pd.Series(np.concatenate(out))

    return documents.withColumn(out, scored(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
