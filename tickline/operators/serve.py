"""Read-side queries: the feed, the latest-day metrics and their summaries.

Every function returns a DataFrame; a caller that renders it collects a bounded
result (top-k or one row per symbol).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEED_COLUMNS = ("symbol", "price", "volume", "trade_time", "source")


def available_symbols(trades: DataFrame) -> DataFrame:
    """Distinct symbols, ordered."""
    return trades.select("symbol").distinct().orderBy("symbol")


def _feed(trades: DataFrame, symbol: str | None, limit: int, extra: tuple[str, ...] = ()) -> DataFrame:
    if symbol is not None and symbol != "All":
        trades = trades.where(F.col("symbol") == F.lit(symbol))
    return (
        trades.orderBy(F.col("trade_time").desc(), F.col("event_id").desc())
        .limit(limit)
        .select(*FEED_COLUMNS, *extra)
    )


def latest_trades(trades: DataFrame, symbol: str | None = None, limit: int = 200) -> DataFrame:
    """The ``limit`` latest trades, all symbols or one (``None`` or ``"All"`` = all).

    Ties on trade_time are broken by event_id so the cut is repeatable. Planned as
    TakeOrderedAndProject: each task keeps its own top ``limit``, then one merge.
    """
    return _feed(trades, symbol, limit)


def latest_day_metrics(metrics: DataFrame, symbol: str, limit: int = 120, completed_before=None) -> DataFrame:
    """Up to ``limit`` latest bars of the symbol's latest day, ascending by minute.

    The symbol filter is pushed below the Window into the scan; the day filter is
    applied after the Window, since the moving averages need earlier bars.
    ``completed_before`` (a timestamp) keeps only bars whose minute has ended by
    then; by default the running minute is shown, as the reference does.
    """
    one = metrics.where(F.col("symbol") == F.lit(symbol))
    if completed_before is not None:
        # only bars whose minute has ended by then (drops the running minute);
        # the indicators of the kept bars do not depend on later bars
        end = F.col("minute") + F.expr("INTERVAL 1 MINUTE")
        one = one.where(end <= F.lit(completed_before).cast("timestamp"))
    day_start = one.select(F.date_trunc("day", F.max("minute"))).scalar()
    return (
        one.where(F.col("minute") >= day_start)
        .orderBy(F.col("minute").desc())
        .limit(limit)
        .drop("symbol")
        .orderBy("minute")
    )


def latest_day_metrics_from_bars(
    bars: DataFrame, symbol: str, limit: int = 120, short: int = 5, long: int = 15, vol: int = 15
) -> DataFrame:
    """Same result as ``latest_day_metrics(indicators(bars), symbol)`` with the
    Window run over the latest day and the bars its longest frame reaches back to,
    instead of the symbol's whole history.

    The earlier bars are found by a top-k on minute (TakeOrderedAndProject), so the
    work outside the latest day is one pass over the symbol's bar minutes.
    """
    from tickline.operators.bars import indicators

    one = bars.where(F.col("symbol") == F.lit(symbol))
    day_start = one.select(F.date_trunc("day", F.max("minute"))).scalar()
    day = one.where(F.col("minute") >= day_start)
    before = one.where(F.col("minute") < day_start).orderBy(F.col("minute").desc()).limit(max(short, long, vol) - 1)
    window_input = day.unionByName(before)
    return (
        indicators(window_input, short, long, vol)
        .where(F.col("minute") >= day_start)
        .orderBy(F.col("minute").desc())
        .limit(limit)
        .drop("symbol")
        .orderBy("minute")
    )


def gap_segments(bars: DataFrame, max_gap_seconds: int = 60) -> DataFrame:
    """Number runs of bars without a gap: ``segment`` grows by one each time the
    distance to the previous bar exceeds ``max_gap_seconds``; first bar is 0.

    For one bounded result such as :func:`latest_day_metrics`; the numbering of
    whole histories is :func:`gap_segments_by_symbol`.
    """
    w = Window.orderBy("minute")
    gap = F.unix_seconds(F.col("minute")) - F.unix_seconds(F.lag("minute").over(w))
    flagged = bars.withColumn("_gap", F.when(gap > max_gap_seconds, 1).otherwise(0))
    return flagged.withColumn(
        "segment", F.sum("_gap").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    ).drop("_gap")


def gap_segments_by_symbol(bars: DataFrame, max_gap_seconds: int = 60) -> DataFrame:
    """:func:`gap_segments` of each symbol's whole history, in two levels: gaps are
    counted within each (symbol, day), a running sum over the days (one row each)
    gives where a day's numbering starts, and the first bar of a day is compared
    with the last bar before it. No Window holds a symbol's bars."""
    day = Window.partitionBy("symbol", "_day").orderBy("minute")
    seconds = F.unix_seconds(F.col("minute"))
    flagged = bars.withColumn("_day", F.to_date("minute"))
    flagged = flagged.withColumn("_gap", F.when(seconds - F.lag(seconds).over(day) > max_gap_seconds, 1).otherwise(0))
    inside = flagged.withColumn("_in_day", F.sum("_gap").over(day.rowsBetween(Window.unboundedPreceding, 0)))
    days = flagged.groupBy("symbol", "_day").agg(F.min(seconds).alias("_first"), F.max(seconds).alias("_last"), F.sum("_gap").alias("_gaps"))
    history = Window.partitionBy("symbol").orderBy("_day")
    opens = F.when(F.col("_first") - F.lag("_last").over(history) > max_gap_seconds, 1).otherwise(0)
    days = days.withColumn("_opens", opens)
    before = F.sum(F.col("_gaps") + F.col("_opens")).over(history.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_gaps")
    offsets = days.select("symbol", "_day", before.alias("_before"))
    joined = inside.join(offsets, ["symbol", "_day"])
    return joined.select(*bars.columns, (F.col("_in_day") + F.col("_before")).cast("long").alias("segment"))


def long_form(
    segmented: DataFrame,
    values: tuple[str, ...] = ("close_price", "moving_average_5", "moving_average_15"),
) -> DataFrame:
    """Wide → long for charting: (minute, segment, metric, price); NULLs kept."""
    ids = [c for c in ("symbol", "minute", "segment") if c in segmented.columns]
    return segmented.unpivot(ids, list(values), "metric", "price")


def latest_bar_per_symbol(bars: DataFrame, short: int = 5, long: int = 15, vol: int = 15) -> DataFrame:
    """The last bar of every symbol with its indicators (one row per symbol).

    Each task keeps a symbol's newest bars only, as many as the longest frame
    holds (Spark limits the ranking before the shuffle), so the indicator Window
    never sees a history."""
    from tickline.operators.bars import indicators

    newest = Window.partitionBy("symbol").orderBy(F.col("minute").desc())
    tail = bars.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= max(short, long, vol)).drop("_rank")
    told = indicators(tail, short, long, vol)
    cols = [c for c in told.columns if c != "symbol"]
    latest = F.max_by(F.struct(*cols), F.col("minute")).alias("b")
    return told.groupBy("symbol").agg(latest).select("symbol", "b.*")


def feed_summary(trades: DataFrame, symbol: str | None = None, limit: int = 200) -> DataFrame:
    """Summary of the feed shown by :func:`latest_trades`: rows shown, distinct
    symbols among them, and the latest trade (first row of the feed)."""
    feed = _feed(trades, symbol, limit, extra=("event_id",))
    key = F.struct(F.col("trade_time"), F.col("event_id"))
    return feed.agg(
        F.count(F.lit(1)).alias("rows_displayed"),
        F.countDistinct("symbol").alias("symbols"),
        F.max_by("symbol", key).alias("latest_symbol"),
        F.max_by("price", key).alias("latest_price"),
        F.max("trade_time").alias("last_event"),
    )


def latest_bar_summary(latest_day: DataFrame) -> DataFrame:
    """The caption row of the metrics page: the last bar of a latest-day result
    (the running minute included, as on the page)."""
    return latest_day.orderBy(F.col("minute").desc()).limit(1).select(
        "minute", "close_price", "price_change", "high_price", "low_price", "volume", "vwap", "trade_count"
    )


def caption_texts(summary: DataFrame, *keys: str) -> DataFrame:
    """Display texts of a :func:`latest_bar_summary` row, formatted the way the
    metrics page prints them: ``%Y-%m-%d %H:%M UTC`` for the minute, two
    decimals and no separators for prices (half-even on the exact value),
    thousands separators and no decimals for volume and trade count."""
    plain = lambda c: F.replace(F.format_number(F.col(c), 2), F.lit(","), F.lit(""))
    money = lambda c: F.concat(F.lit("$"), plain(c))
    return summary.select(
        *keys,
        F.concat(F.lit("Latest completed minute: "), F.date_format("minute", "yyyy-MM-dd HH:mm"), F.lit(" UTC")).alias("caption"),
        money("close_price").alias("close"),
        plain("price_change").alias("change"),
        money("high_price").alias("high"),
        money("low_price").alias("low"),
        F.format_number(F.col("volume"), 0).alias("volume"),
        F.coalesce(money("vwap"), F.lit("$nan")).alias("vwap"),
        F.format_number(F.col("trade_count").cast("double"), 0).alias("trades"),
    )


def feed_caption_texts(summary: DataFrame) -> DataFrame:
    """Display texts of a :func:`feed_summary` row, as the feed page prints them."""
    price = F.replace(F.format_number("latest_price", 2), F.lit(","), F.lit(""))
    return summary.select(
        F.format_number("rows_displayed", 0).alias("rows_displayed"),
        F.col("symbols").cast("string").alias("symbols"),
        F.concat("latest_symbol", F.lit("  $"), price).alias("latest_trade"),
        F.date_format("last_event", "HH:mm:ss 'UTC'").alias("last_event"),
    )


def query_dataframe(spark, query: str, **params) -> DataFrame:
    """Run a parameterized SQL text (``:name`` markers) as a DataFrame."""
    return spark.sql(query, args=params or None)


def table_status(spark, path: str) -> DataFrame:
    """Availability and latest arrival of the stored trades table; a table that
    does not exist (yet) gives ``(false, NULL)`` instead of an error."""
    from tickline.sinks.trades_table import read_trades

    stored = read_trades(spark, path)
    if stored is not None:
        return freshness(stored)
    return spark.range(1).select(F.lit(False).alias("available"), F.lit(None).cast("timestamp").alias("latest_received"))


def freshness(trades: DataFrame, column: str = "received_at") -> DataFrame:
    """One row: whether the table has data and its latest arrival time."""
    return trades.agg(
        (F.count(F.lit(1)) > 0).alias("available"),
        F.max(column).alias("latest_received"),
    )
