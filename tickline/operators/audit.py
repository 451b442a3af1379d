"""Data-quality audits over the trades table and the metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_ids(trades: DataFrame, key: str = "event_id") -> DataFrame:
    """Total rows, distinct ids, and whether the table is non-empty and unique.

    ``count(DISTINCT)`` plans as two hash aggregations (by key, then global), so a
    key repeated a billion times is collapsed in the partial step of each task.
    """
    return trades.agg(
        F.count(F.lit(1)).alias("total"),
        F.countDistinct(key).alias("unique_ids"),
    ).select(
        "total",
        "unique_ids",
        ((F.col("total") > 0) & (F.col("total") == F.col("unique_ids"))).alias("ok"),
    )


# The seven OHLCV invariants, as (name, violation predicate).
OHLCV_RULES: tuple[tuple[str, str], ...] = (
    ("high_below_low", "high_price < low_price"),
    ("high_below_open", "high_price < open_price"),
    ("high_below_close", "high_price < close_price"),
    ("low_above_open", "low_price > open_price"),
    ("low_above_close", "low_price > close_price"),
    ("negative_volume", "volume < 0"),
    ("empty_bar", "trade_count < 1"),
)


def ohlcv_violations(metrics: DataFrame) -> DataFrame:
    """Rows breaking any invariant, the count per invariant, and the bar count."""
    preds: list[Column] = [F.expr(p) for _, p in OHLCV_RULES]
    any_bad = reduce(lambda a, b: a | b, preds)
    return metrics.agg(
        F.count_if(any_bad).alias("invalid_rows"),
        *[F.count_if(p).alias(n) for (n, _), p in zip(OHLCV_RULES, preds)],
        F.count(F.lit(1)).alias("bars"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of each named table (non-empty audit).

    The first count is an aggregate; the others are scalar subqueries on it, so
    every table is scanned once and nothing is joined.
    """
    (first_name, first), *rest = tables.items()
    out = first.agg(F.count(F.lit(1)).alias(first_name))
    return out.select(
        first_name, *[df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in rest]
    )
