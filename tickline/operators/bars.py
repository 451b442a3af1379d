"""One-minute OHLCV bars and the indicators computed over them.

``minute_bars`` is one ``groupBy().agg()``: Spark runs a partial aggregate before
the shuffle, so a hot symbol is reduced to at most one row per (symbol, minute) per
input task before anything moves. Bars exist only for minutes with trades.

``indicators`` adds the moving averages and the rolling volatility over the last
N *bars* (not minutes) of each symbol, in one Window node with one sort. The
window input is bars, so its size per symbol is bounded by the number of minutes
in the history, not by the number of trades.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order_key() -> Column:
    # Total order inside a bar: time, then id (ids are unique in the trades table).
    return F.struct(F.col("trade_time"), F.col("event_id"))


def minute_bars(trades: DataFrame, width: str = "minute") -> DataFrame:
    """OHLCV bars per (symbol, ``width``) from a trades DataFrame.

    Columns: symbol, minute, open_price, high_price, low_price, close_price,
    volume, trade_count, vwap (NULL when the bar's volume is zero). Open and close
    are the first and last price by (trade_time, event_id).
    """
    return (
        trades.groupBy("symbol", F.date_trunc(width, "trade_time").alias("minute"))
        .agg(
            F.min_by("price", _order_key()).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", _order_key()).alias("close_price"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            (F.sum(F.col("price") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0.0))).alias("vwap"),
        )
    )


def indicators(bars: DataFrame, short: int = 5, long: int = 15, vol: int = 15) -> DataFrame:
    """Add price_change and the bar-count moving averages / rolling volatility.

    The frames are ROWS frames over the symbol's bars ordered by minute, so gaps
    and day boundaries are crossed and leading bars average over fewer rows.
    Volatility is the sample standard deviation (NULL on a symbol's first bar).
    """
    by_symbol = Window.partitionBy("symbol").orderBy("minute")
    return bars.select(
        *bars.columns,
        (F.col("close_price") - F.col("open_price")).alias("price_change"),
        F.avg("close_price").over(by_symbol.rowsBetween(-(short - 1), 0)).alias(f"moving_average_{short}"),
        F.avg("close_price").over(by_symbol.rowsBetween(-(long - 1), 0)).alias(f"moving_average_{long}"),
        F.stddev_samp("close_price").over(by_symbol.rowsBetween(-(vol - 1), 0)).alias(f"rolling_volatility_{vol}"),
    )


def indicators_by_day(bars: DataFrame, short: int = 5, long: int = 15, vol: int = 15) -> DataFrame:
    """Same result as :func:`indicators`, with the Window partitioned by
    (symbol, day) instead of symbol.

    A symbol's full history can be years of bars; here every Window partition is
    one symbol-day (at most 1,440 bars) plus the ``warm`` bars that precede it,
    so the work spreads over symbols × days tasks. The warm-up bars of a day are
    the last ``warm`` bars before it, which may lie several (sparse) days back:

    1. per (symbol, day), its last ``warm`` bars (a bounded array);
    2. per symbol ordered by day, the arrays of the previous ``warm`` days (each
       day holds at least one bar, so they contain the ``warm`` bars needed),
       flattened and cut to the last ``warm`` by minute;
    3. the day's bars plus its warm-up bars go through the ROWS frames, and the
       warm-up rows are dropped.
    """
    warm = max(short, long, vol) - 1
    day = F.to_date("minute")
    b = bars.withColumn("_day", day)
    cols = [c for c in bars.columns]
    by_day_desc = Window.partitionBy("symbol", "_day").orderBy(F.col("minute").desc())
    tails = (
        b.withColumn("_rk", F.row_number().over(by_day_desc))
        .where(F.col("_rk") <= warm)
        .groupBy("symbol", "_day")
        .agg(F.collect_list(F.struct(*cols)).alias("_tail"))
    )
    prev_days = Window.partitionBy("symbol").orderBy("_day").rowsBetween(-warm, -1)
    warmups = tails.select(
        "symbol",
        "_day",
        F.flatten(F.collect_list("_tail").over(prev_days)).alias("_prev"),
    ).select(
        "symbol",
        "_day",
        F.array_sort(F.transform("_prev", lambda r: F.struct(r["minute"].alias("k"), r.alias("v")))).alias("_prev"),
    )
    # keep the last `warm` entries (fewer when the history is shorter)
    start = F.greatest(F.size("_prev") - F.lit(warm - 1), F.lit(1))
    warmups = warmups.select("symbol", "_day", F.slice("_prev", start, F.lit(warm)).alias("_prev"))
    warm_rows = warmups.select("_day", F.inline(F.transform("_prev", lambda e: e["v"]))).withColumn("_warm", F.lit(True))
    day_rows = b.withColumn("_warm", F.lit(False))
    frame_input = day_rows.unionByName(warm_rows.select(*cols, "_day", "_warm"))
    w = Window.partitionBy("symbol", "_day").orderBy("minute")
    out = frame_input.select(
        *cols,
        "_warm",
        (F.col("close_price") - F.col("open_price")).alias("price_change"),
        F.avg("close_price").over(w.rowsBetween(-(short - 1), 0)).alias(f"moving_average_{short}"),
        F.avg("close_price").over(w.rowsBetween(-(long - 1), 0)).alias(f"moving_average_{long}"),
        F.stddev_samp("close_price").over(w.rowsBetween(-(vol - 1), 0)).alias(f"rolling_volatility_{vol}"),
    )
    return out.where(~F.col("_warm")).drop("_warm")


def one_minute_metrics(trades: DataFrame) -> DataFrame:
    """The full metrics view: bars plus indicators (no Window holds a symbol's whole history)."""
    return indicators_by_day(minute_bars(trades))

