"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The words of all documents are counted in a table of fixed size. A test item's n-grams become
   seeds where chance alone would make them rare: the product of their words' shares, times the
   number of words, is at most `chance` occurrences a million words. Rarity is judged by the words,
   not by how often the n-gram occurs, so a test passage copied into a third of all documents keeps
   its seeds.
2. A bit table of the seeds (fixed size) lets a document's n-grams through; those join the seeds
   exactly. A document and an item that share seeds over `cover` of the item's words are a candidate.
3. Candidates are aligned: Smith-Waterman over words, linear gaps, the whole item against the whole
   text. The score is the share of the best possible score; `least` of it is a leak.

A leak is thus a text that shares seeds over `cover` of an item's words and aligns with it to `least`. An item
of fewer than n words has one seed, the whole of it, and only a whole copy of it (score 1) is a leak: a word or
two in common with so short an item say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import grams
from tickline.llm.common import stored

N = 3
WORD_BUCKETS = 1 << 20
SEED_BITS = 1 << 24
CHANCE = 20.0
COVER = 0.2
LEAST = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
U = np.uint64


def _grams_of(body: np.ndarray, n: int) -> np.ndarray:
    return grams.grams(grams.words(body, grams.PUNCTUATION)[0], n)


def seeds(items: DataFrame, documents: DataFrame, item_id: str, item_text: str, text: str, n: int = N, chance: float = CHANCE) -> DataFrame:
    """(__item, __words, __gram, __at): the rare n-grams of each item. An item whose rare ones touch
    less than half of its words keeps all of its own: a copy must touch `cover` of the words to be looked at."""
    spark = documents.sparkSession
    table = grams.count_table(documents.select(text), lambda b: (h for h, _, _ in grams.texts_words(b.column(0), grams.PUNCTUATION)), WORD_BUCKETS)
    share = spark.sparkContext.broadcast((table / max(int(table.sum(dtype=np.int64)), 1)).astype(np.float32))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0), [[], [], [], []]
            for k, (h, _, _) in enumerate(grams.texts_words(batch.column(1), grams.PUNCTUATION)):
                g = grams.grams(h, n)
                p = np.log10(np.maximum(share.value[(h % U(WORD_BUCKETS)).astype(np.int64)].astype(float), 1e-12))
                width = min(n, len(h))
                expected = sum((p[i : i + len(g)] for i in range(width)), np.zeros(len(g))) + 6
                keep = np.flatnonzero(expected <= np.log10(chance))
                # an n-gram at k touches words k .. k+width-1
                if 2 * len(np.unique(keep[:, None] + np.arange(width))) < len(h):
                    keep = np.arange(len(g))
                for column, values in zip(out, (np.full(len(keep), k), np.full(len(keep), len(h)), g[keep].view(np.int64), keep), strict=True):
                    column.append(values)
            owner, size, gram, at = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
            yield pa.record_batch({"__item": ids.take(pa.array(owner.astype(np.int64))), "__words": pa.array(size.astype(np.int32)), "__gram": pa.array(gram.astype(np.int64)), "__at": pa.array(at.astype(np.int32))})

    kind = dict(items.dtypes)[item_id]
    known = items.where(F.col(f"`{item_id}`").isNotNull()).select(F.col(f"`{item_id}`"), F.col(f"`{item_text}`"))
    return known.mapInArrow(cut, f"__item {kind}, __words int, __gram long, __at int")


def candidates(documents: DataFrame, seed_rows: DataFrame, id_col: str, text: str, n: int = N, cover: float = COVER) -> DataFrame:
    """(__id, __item): pairs whose common seeds touch enough of the item's words."""
    spark = documents.sparkSession
    bits = grams.count_table(seed_rows.select("__gram"), lambda b: [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U)], SEED_BITS)
    known = spark.sparkContext.broadcast(np.packbits(bits > 0, bitorder="little"))
    short = [r["__words"] for r in seed_rows.where(F.col("__words") < n).select("__words").distinct().toLocalIterator()]  # fewer than n numbers

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value
        for batch in batches:
            owner, hit = [], []
            for k, (h, _, _) in enumerate(grams.texts_words(batch.column(1), grams.PUNCTUATION)):
                g = np.concatenate([grams.grams(h, n), *(grams.grams(h, m) for m in short)])
                spot = (g % U(SEED_BITS)).astype(np.int64)
                g = np.unique(g[(table[spot >> 3] >> (spot & 7).astype(np.uint8)) & 1 == 1])
                owner.append(np.full(len(g), k))
                hit.append(g.view(np.int64))
            at = np.concatenate(owner) if owner else np.zeros(0, np.int64)
            gram = np.concatenate(hit) if hit else np.zeros(0, np.int64)
            yield pa.record_batch({"__id": batch.column(0).take(pa.array(at.astype(np.int64))), "__gram": pa.array(gram)})

    kind = dict(documents.dtypes)[id_col]
    named = documents.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`"), F.col(f"`{text}`"))
    hits = named.mapInArrow(found, f"__id {kind}, __gram long")
    # an n-gram at k of the item touches words k .. k+n-1; the set is no larger than the item
    touched = F.size(F.array_distinct(F.flatten(F.transform(F.collect_set("__at"), lambda k: F.sequence(k, k + n - 1)))))
    pairs = hits.join(seed_rows, "__gram").groupBy("__id", "__item").agg(touched.alias("__touched"), F.max("__words").alias("__words"))
    return pairs.where(F.col("__touched") >= F.greatest(F.least(F.lit(n), F.col("__words")), F.ceil(F.col("__words") * cover))).select("__id", "__item")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, and the stretch of text words (start, end) it covers.

    One numpy row an item word. Within a row the gap along the text is a running maximum, since
    H[j] = max over k <= j of T[k] + GAP * (j - k).
    """
    m = len(text)
    if not len(item) or not m:
        return 0, 0, 0
    ramp = GAP * np.arange(m, dtype=np.int64)
    places = np.arange(m, dtype=np.int64)
    above, since = np.zeros(m, np.int64), places.copy()
    best = (0, 0, 0)
    for w in item:
        slant = np.concatenate([[0], above[:-1]]) + np.where(text == w, MATCH, MISMATCH)
        slant_since = np.concatenate([[0], since[:-1]])
        slant_since[0] = 0
        fresh = np.concatenate([[True], above[:-1] == 0])
        slant_since = np.where(fresh, places, slant_since)
        down = above + GAP
        here = np.maximum(np.maximum(slant, down), 0)
        start = np.where(slant >= down, slant_since, since)
        reach = np.maximum.accumulate((here - ramp) * m + (m - 1 - places))  # value first, then the leftmost source
        source = m - 1 - reach % m
        row = reach // m + ramp
        above, since = row, start[source]
        k = int(row.argmax())
        if row[k] > best[0]:
            best = (int(row[k]), int(since[k]), k + 1)
    return best


def leaks(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = N, chance: float = CHANCE, cover: float = COVER, least: float = LEAST
) -> DataFrame:
    """One row per document and item that it holds a copy of: id, item id, `score` (0 to 1),
    `start_word` and `end_word` (the copy's place among the document's words).

    Words are runs of letters and digits, A-Z lower-cased. Null or empty texts and items hold nothing.
    Rows without an id are not reported. Documents or items that repeat an id are compared by each of
    their texts and the best score is reported. Empty tables give no rows.
    """
    seed_rows = stored(seeds(items, documents, item_id, item_text, text, n, chance), "benchmark-seeds")
    pairs = candidates(documents, seed_rows, id_col, text, n, cover)
    texts = items.select(F.col(f"`{item_id}`").alias("__item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("__item_text")).distinct()
    told = pairs.join(texts, "__item").groupBy("__id").agg(F.collect_list(F.struct("__item", "__item_text")).alias("__items"))
    named = documents.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    both = named.join(stored(told, "leak-candidates"), "__id").select("__id", "__text", F.col("__items.__item").alias("__item"), F.col("__items.__item_text").alias("__item_text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, item_texts = batch.column(0), batch.column(2), batch.column(3)
            width = np.diff(lists.offsets.to_numpy())
            owner, values, spans = [], [], []
            asked = iter(grams.texts_words(item_texts.flatten(), grams.PUNCTUATION))
            for k, (h, _, _) in enumerate(grams.texts_words(batch.column(1), grams.PUNCTUATION)):
                for _ in range(width[k]):
                    item = next(asked)[0]
                    best, start, end = align(item, h)
                    share = best / (MATCH * len(item)) if len(item) else 0.0
                    owner.append(k)
                    values.append(share if len(item) >= n or share == 1 else 0.0)
                    spans.append((start, end))
            yield pa.record_batch(
                {
                    "id": ids.take(pa.array(owner, pa.int64())),
                    "item": lists.flatten(),
                    "score": pa.array(values, pa.float64()),
                    "start_word": pa.array([s for s, _ in spans], pa.int64()),
                    "end_word": pa.array([e for _, e in spans], pa.int64()),
                }
            )

    doc_kind, item_kind = dict(documents.dtypes)[id_col], dict(items.dtypes)[item_id]
    scored = both.mapInArrow(score, f"id {doc_kind}, item {item_kind}, score double, start_word long, end_word long").where(F.col("score") >= least)
    best = scored.groupBy("id", "item").agg(F.max(F.struct("score", "start_word", "end_word")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_id), "b.score", "b.start_word", "b.end_word")


def decontaminate(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of `documents` that hold no copy of an item; rows without an id stay."""
    leaked = stored(leaks(documents, items, id_col, text, **how).select(F.col(f"`{id_col}`").alias("__leaked")).distinct(), "leaked")
    return documents.join(leaked, documents[f"`{id_col}`"] == F.col("__leaked"), "left_anti")
