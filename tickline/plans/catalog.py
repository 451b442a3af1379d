"""Registered queries: name → Spark builder (spark, sf_dir) and its DuckDB oracle.

Each Spark builder reads the driver's tables (or a projection Spark derives from
them) in full and returns a DataFrame; nothing is collected here. Output edges
cast TIMESTAMP to TIMESTAMP_NTZ (UTC wall time) so that results do not depend on
the reader's time zone, and round order-dependent float sums to 8 digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.functions.fingerprint import event_id_for_message
from tickline.operators import audit, bars, dedup, ingest, serve, validate
from tickline.plans import oracle_sql as O
from tickline import streaming
from tickline.schemas import LOG_RECORD, TRADE_WIRE
from tickline.session import configure, scratch_path
from tickline.sinks import archive, bars_table, dead_letters, folders, metrics_table, trades_table
from tickline.sources.events import log_from_events, read_events, trades_from_events, vendor_frames_from_events
from tickline.sources.frames import read_frames
from tickline.sources.layout import balance
from tickline.streaming.queries import table_batch

QueryFn = Callable[[SparkSession, str], DataFrame]

SYMBOL = "VIEW"  # symbol chosen on the dashboard in the per-symbol queries
ROUND = 8


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return trades_from_events(read_events(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.one_minute_metrics(_trades(spark, sf_dir))


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def rnd(name: str) -> Column:
    return F.round(F.col(name), ROUND).alias(name)


def _metric_cols(with_symbol: bool = True) -> list[Column]:
    cols = [F.col("symbol")] if with_symbol else []
    return cols + [
        ntz("minute"),
        F.col("open_price"),
        F.col("high_price"),
        F.col("low_price"),
        F.col("close_price"),
        F.col("volume"),
        F.col("trade_count"),
        rnd("vwap"),
        F.col("price_change"),
        rnd("moving_average_5"),
        rnd("moving_average_15"),
        rnd("rolling_volatility_15"),
    ]


QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- trades table


@register(
    "trades_projection",
    O.T + "SELECT event_id, symbol, price, volume, trade_time, trade_timestamp_ms, source, received_at FROM trades",
)
def q_trades_projection(spark, sf_dir):
    t = _trades(spark, sf_dir)
    return t.select("event_id", "symbol", "price", "volume", ntz("trade_time"), "trade_timestamp_ms", "source", ntz("received_at"))


# ---------------------------------------------------------------- bars and indicators


@register(
    "minute_bars",
    O.TB + "SELECT symbol, minute, open_price, high_price, low_price, close_price, volume, trade_count, round(vwap, 8) AS vwap FROM bars",
)
def q_minute_bars(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir))
    return b.select("symbol", ntz("minute"), "open_price", "high_price", "low_price", "close_price", "volume", "trade_count", rnd("vwap"))


@register(
    "hour_bars",
    O.with_ctes(O.trades_cte(1), O.bars_cte("hour"))
    + "SELECT symbol, minute, open_price, high_price, low_price, close_price, volume, trade_count, round(vwap, 8) AS vwap FROM bars",
)
def q_hour_bars(spark, sf_dir):
    configure(spark)
    t = trades_from_events(read_events(spark, sf_dir), squeeze=1)
    b = bars.minute_bars(t, width="hour")
    return b.select("symbol", ntz("minute"), "open_price", "high_price", "low_price", "close_price", "volume", "trade_count", rnd("vwap"))


@register("one_minute_metrics", O.TBM + "SELECT symbol, " + O.METRIC_SELECT + " FROM metrics")
def q_one_minute_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).select(*_metric_cols())


@register(
    "moving_average_5",
    O.TBM + "SELECT symbol, minute, close_price, round(moving_average_5, 8) AS moving_average_5 FROM metrics",
)
def q_ma5(spark, sf_dir):
    return _metrics(spark, sf_dir).select("symbol", ntz("minute"), "close_price", rnd("moving_average_5"))


@register(
    "moving_average_15",
    O.TBM + "SELECT symbol, minute, close_price, round(moving_average_15, 8) AS moving_average_15 FROM metrics",
)
def q_ma15(spark, sf_dir):
    return _metrics(spark, sf_dir).select("symbol", ntz("minute"), "close_price", rnd("moving_average_15"))


@register(
    "rolling_volatility_15",
    O.TBM + "SELECT symbol, minute, round(rolling_volatility_15, 8) AS rolling_volatility_15 FROM metrics",
)
def q_vol15(spark, sf_dir):
    return _metrics(spark, sf_dir).select("symbol", ntz("minute"), rnd("rolling_volatility_15"))


@register(
    "vwap_by_symbol_minute",
    O.TB + "SELECT symbol, minute, volume, round(vwap, 8) AS vwap FROM bars",
)
def q_vwap(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir))
    return b.select("symbol", ntz("minute"), "volume", rnd("vwap"))


@register(
    "open_close_by_minute",
    O.TB + "SELECT symbol, minute, open_price, close_price, close_price - open_price AS price_change FROM bars",
)
def q_open_close(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir))
    return b.select("symbol", ntz("minute"), "open_price", "close_price", (F.col("close_price") - F.col("open_price")).alias("price_change"))


# ---------------------------------------------------------------- serving


@register(
    "latest_trades_all",
    O.T + "SELECT symbol, price, volume, trade_time, source FROM trades ORDER BY trade_time DESC, event_id DESC LIMIT 200",
)
def q_latest_all(spark, sf_dir):
    f = serve.latest_trades(_trades(spark, sf_dir))
    return f.select("symbol", "price", "volume", ntz("trade_time"), "source")


@register(
    "latest_trades_symbol",
    O.T
    + f"SELECT symbol, price, volume, trade_time, source FROM trades WHERE symbol = '{SYMBOL}' "
    + "ORDER BY trade_time DESC, event_id DESC LIMIT 200",
)
def q_latest_symbol(spark, sf_dir):
    f = serve.latest_trades(_trades(spark, sf_dir), SYMBOL)
    return f.select("symbol", "price", "volume", ntz("trade_time"), "source")


_LATEST_DAY_SQL = (
    O.TBM
    + ", latest AS (SELECT * FROM metrics WHERE symbol = '{s}' AND minute >= "
    + "(SELECT date_trunc('day', max(minute)) FROM metrics WHERE symbol = '{s}') ORDER BY minute DESC LIMIT 120)\n"
)


def _latest_day(spark, sf_dir) -> DataFrame:
    return serve.latest_day_metrics_from_bars(bars.minute_bars(_trades(spark, sf_dir)), SYMBOL)


@register("latest_day_metrics", _LATEST_DAY_SQL.format(s=SYMBOL) + "SELECT " + O.METRIC_SELECT + " FROM latest")
def q_latest_day(spark, sf_dir):
    return _latest_day(spark, sf_dir).select(*_metric_cols(with_symbol=False))


@register("available_symbols", O.T + "SELECT DISTINCT symbol FROM trades")
def q_symbols(spark, sf_dir):
    return serve.available_symbols(_trades(spark, sf_dir))


@register(
    "gap_segments",
    O.TB
    + """, g AS (SELECT symbol, minute, CASE WHEN epoch(minute) - epoch(lag(minute) OVER (PARTITION BY symbol ORDER BY minute)) > 60 THEN 1 ELSE 0 END AS gap FROM bars)
SELECT symbol, minute, CAST(sum(gap) OVER (PARTITION BY symbol ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM g""",
)
def q_gap_segments(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir)).select("symbol", "minute")
    return serve.gap_segments_by_symbol(b).select("symbol", ntz("minute"), "segment")


_LATEST_DAY_SEG = (
    _LATEST_DAY_SQL.format(s=SYMBOL)
    + """, g AS (SELECT *, CASE WHEN epoch(minute) - epoch(lag(minute) OVER (ORDER BY minute)) > 60 THEN 1 ELSE 0 END AS gap FROM latest),
seg AS (SELECT *, CAST(sum(gap) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS segment FROM g)
"""
)


@register("gap_segments_latest_day", _LATEST_DAY_SEG + "SELECT minute, close_price, segment FROM seg")
def q_gap_latest(spark, sf_dir):
    s = serve.gap_segments(_latest_day(spark, sf_dir))
    return s.select(ntz("minute"), "close_price", "segment")


@register(
    "metrics_long_form",
    _LATEST_DAY_SEG
    + """SELECT minute, segment, metric, round(price, 8) AS price FROM (
  SELECT minute, segment, 'close_price' AS metric, close_price AS price FROM seg
  UNION ALL SELECT minute, segment, 'moving_average_5', moving_average_5 FROM seg
  UNION ALL SELECT minute, segment, 'moving_average_15', moving_average_15 FROM seg)""",
)
def q_long_form(spark, sf_dir):
    s = serve.gap_segments(_latest_day(spark, sf_dir))
    lf = serve.long_form(s)
    return lf.select(ntz("minute"), "segment", "metric", rnd("price"))


@register(
    "latest_bar_per_symbol",
    O.TBM + "SELECT symbol, " + O.METRIC_SELECT + " FROM metrics QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY minute DESC) = 1",
)
def q_latest_bar(spark, sf_dir):
    return serve.latest_bar_per_symbol(bars.minute_bars(_trades(spark, sf_dir))).select(*_metric_cols())


@register(
    "feed_summary",
    O.T
    + """, feed AS (SELECT * FROM trades ORDER BY trade_time DESC, event_id DESC LIMIT 200)
SELECT count(*) AS rows_displayed, count(DISTINCT symbol) AS symbols,
       arg_max(symbol, (trade_time, event_id)) AS latest_symbol,
       arg_max(price, (trade_time, event_id)) AS latest_price,
       max(trade_time) AS last_event FROM feed""",
)
def q_feed_summary(spark, sf_dir):
    return serve.feed_summary(_trades(spark, sf_dir)).select(
        "rows_displayed", "symbols", "latest_symbol", "latest_price", ntz("last_event")
    )


@register(
    "feed_captions",
    O.T
    + """, feed AS (SELECT * FROM trades ORDER BY trade_time DESC, event_id DESC LIMIT 200)
SELECT count(*)::VARCHAR AS rows_displayed, count(DISTINCT symbol)::VARCHAR AS symbols,
       arg_max(symbol || printf('  $%.2f', price), (trade_time, event_id)) AS latest_trade,
       strftime(max(trade_time), '%H:%M:%S UTC') AS last_event FROM feed""",
)
def q_feed_captions(spark, sf_dir):
    return serve.feed_caption_texts(serve.feed_summary(_trades(spark, sf_dir)))


@register("freshness", O.T + "SELECT count(*) > 0 AS available, max(received_at) AS latest_received FROM trades")
def q_freshness(spark, sf_dir):
    return serve.freshness(_trades(spark, sf_dir)).select("available", ntz("latest_received"))


# ---------------------------------------------------------------- audits


@register(
    "unique_id_audit",
    O.T + "SELECT count(*) AS total, count(DISTINCT event_id) AS unique_ids, count(*) > 0 AND count(*) = count(DISTINCT event_id) AS ok FROM trades",
)
def q_unique(spark, sf_dir):
    return audit.unique_ids(_trades(spark, sf_dir))


@register(
    "ohlcv_violations",
    O.TBM
    + """SELECT count_if(high_price < low_price OR high_price < open_price OR high_price < close_price
                  OR low_price > open_price OR low_price > close_price OR volume < 0 OR trade_count < 1) AS invalid_rows,
       count_if(high_price < low_price) AS high_below_low,
       count_if(high_price < open_price) AS high_below_open,
       count_if(high_price < close_price) AS high_below_close,
       count_if(low_price > open_price) AS low_above_open,
       count_if(low_price > close_price) AS low_above_close,
       count_if(volume < 0) AS negative_volume,
       count_if(trade_count < 1) AS empty_bar,
       count(*) AS bars
FROM metrics""",
)
def q_ohlcv(spark, sf_dir):
    return audit.ohlcv_violations(_metrics(spark, sf_dir))


@register(
    "table_counts",
    O.TBM + "SELECT (SELECT count(*) FROM trades) AS trades, (SELECT count(*) FROM metrics) AS metrics",
)
def q_table_counts(spark, sf_dir):
    t = _trades(spark, sf_dir)
    return audit.table_counts({"trades": t, "metrics": bars.one_minute_metrics(t)})


# ---------------------------------------------------------------- ingest: log, validation, routing


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    # Spread the scan first: the per-record work (message text, SHA-256, parsing)
    # then runs on every core even when the table is a single row group.
    return log_from_events(balance(read_events(spark, sf_dir)))


def _validated(spark: SparkSession, sf_dir: str, table_path: bool = False) -> DataFrame:
    return validate.validate(_log(spark, sf_dir), table_path=table_path)


@register(
    "validate_trades",
    O.L + "SELECT partition, \"offset\", error, CASE WHEN error IS NULL THEN eid END AS event_id FROM checked",
)
def q_validate(spark, sf_dir):
    v = _validated(spark, sf_dir)
    # event_id only where valid: derived ids need a valid message. Passing the
    # rows through `route` starts a new generated method after the rule chain.
    rows = validate.route(v, F.lit(True), F.col("partition"), F.col("offset"), F.col("error"), F.col("msg"))
    return rows.select(
        "partition", "offset", "error", F.when(F.col("error").isNull(), event_id_for_message()).alias("event_id")
    )


@register(
    "validate_trades_table_path",
    O.L + "SELECT partition, \"offset\", table_error AS error FROM checked_table",
)
def q_validate_table(spark, sf_dir):
    return _validated(spark, sf_dir, table_path=True).select("partition", "offset", "error")


@register(
    "dead_letters",
    O.L
    + """SELECT error, topic AS source_topic, partition AS source_partition, "offset" AS source_offset,
       CASE WHEN k = 11 THEN '�' || text ELSE text END AS original_value
FROM checked WHERE error IS NOT NULL""",
)
def q_dead_letters(spark, sf_dir):
    return validate.dead_letters(_validated(spark, sf_dir)).drop("key")


@register(
    "rejection_summary",
    O.L + "SELECT error, count(*) AS records FROM checked WHERE error IS NOT NULL GROUP BY error",
)
def q_rejections(spark, sf_dir):
    return validate.rejection_summary(_validated(spark, sf_dir))


_TABLE_ROWS_SQL = (
    O.L
    + """, tr AS (
  SELECT eid AS event_id, json_extract_string(text, '$.symbol') AS symbol,
         CAST(json_extract(text, '$.price') AS DOUBLE) AS price, CAST(json_extract(text, '$.volume') AS DOUBLE) AS volume,
         CAST(CAST(json_extract_string(text, '$.timestamp') AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS trade_time,
         CAST(json_extract(text, '$.trade_timestamp_ms') AS BIGINT) AS trade_timestamp_ms,
         CASE WHEN list_contains(json_keys(text), 'conditions') THEN CASE k WHEN 27 THEN '[1,"é",{"a":null,"b":1000.0},20000000000000000000]' WHEN 24 THEN 'null' WHEN 31 THEN '{"z":[{"y":{"a":null,"b":[1,2]}}]}' ELSE CAST(json_extract(text, '$.conditions') AS VARCHAR) END ELSE '[]' END AS conditions_json,
         json_extract_string(text, '$.source') AS source, partition, "offset", batch_id, k
  FROM checked_table WHERE table_error IS NULL)
"""
)


def _table_rows(spark, sf_dir) -> DataFrame:
    v = _validated(spark, sf_dir, table_path=True)
    rows = validate.valid_messages(v, extra=(F.col("batch_id"),))
    return validate.to_table_rows(rows)


@register(
    "valid_trades",
    _TABLE_ROWS_SQL
    + "SELECT event_id, symbol, price, volume, trade_time, trade_timestamp_ms, conditions_json, k BETWEEN 20 AND 25 AS id_given, source, partition, \"offset\" FROM tr",
)
def q_valid_trades(spark, sf_dir):
    t = _table_rows(spark, sf_dir)
    return t.select(
        "event_id", "symbol", "price", "volume", ntz("trade_time"), "trade_timestamp_ms",
        F.col("conditions").alias("conditions_json"), "id_given", "source", "partition", "offset",
    )


@register(
    "dedup_first",
    _TABLE_ROWS_SQL
    + """SELECT event_id, min(partition) AS partition, arg_min("offset", (partition, "offset")) AS "offset", count(*) AS copies
FROM tr GROUP BY event_id""",
)
def q_dedup_first(spark, sf_dir):
    t = _table_rows(spark, sf_dir)
    first = dedup.dedup_first(t.select("event_id", "partition", "offset"), key="event_id", order=("partition", "offset"), count_as="copies")
    return first.select("event_id", "partition", "offset", "copies")


@register(
    "upsert_counts",
    _TABLE_ROWS_SQL
    + """, firsts AS (SELECT event_id, min(batch_id) AS first_batch FROM tr GROUP BY event_id),
received AS (SELECT batch_id, count(*) AS received FROM tr GROUP BY batch_id),
ins AS (SELECT first_batch AS batch_id, count(*) AS inserted FROM firsts GROUP BY first_batch)
SELECT r.batch_id, r.received, coalesce(i.inserted, 0) AS inserted, r.received - coalesce(i.inserted, 0) AS duplicates
FROM received r LEFT JOIN ins i USING (batch_id)""",
)
def q_upsert_counts(spark, sf_dir):
    return dedup.replay_counts(_table_rows(spark, sf_dir), batch="batch_id")


@register(
    "archive_partition_counts",
    O.L
    + """SELECT json_extract_string(text, '$.symbol') AS symbol, substr(json_extract_string(text, '$.timestamp'), 1, 10) AS date,
       batch_id, count(*) AS rows
FROM checked WHERE error IS NULL GROUP BY ALL""",
)
def q_archive_counts(spark, sf_dir):
    v = _validated(spark, sf_dir)
    valid = validate.valid_messages(v, extra=(F.col("batch_id"),))
    rows = valid.select("symbol", F.substring("timestamp", 1, 10).alias("date"), "batch_id")
    return rows.groupBy("symbol", "date", "batch_id").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "offset_spans",
    O.L
    + """, spans AS (SELECT batch_id, partition, min("offset") AS first_offset, max("offset") AS last_offset FROM log GROUP BY ALL)
SELECT batch_id, string_agg('p' || partition || '-' || first_offset || '-' || last_offset, '_' ORDER BY partition) AS offset_span,
       sum(last_offset - first_offset + 1) AS span_width
FROM spans GROUP BY batch_id""",
)
def q_offset_spans(spark, sf_dir):
    return archive.offset_spans(_log(spark, sf_dir), batch="batch_id")


# ---------------------------------------------------------------- frames → normalized trades


_FRAMES_SQL = """WITH n AS (
  SELECT event_id % 40 AS k, upper(event_type) AS symbol, value AS price, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS DOUBLE) AS volume,
         1704067200000 + (epoch_us(ts)//1000 - 1704067200000)//60 AS trade_timestamp_ms
  FROM events WHERE event_type <> 'error' AND event_id % 40 NOT IN (5, 6, 9, 10, 11, 12)),
n2 AS (
  SELECT *, strftime(make_timestamp(trade_timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S')
            || CASE WHEN trade_timestamp_ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST((trade_timestamp_ms % 1000) * 1000 AS VARCHAR), 6, '0') END
            || '+00:00' AS timestamp
  FROM n)
"""


@register(
    "normalize_trades",
    _FRAMES_SQL
    + """SELECT sha256('{"conditions":' || CASE k WHEN 7 THEN 'null' WHEN 8 THEN '[]' WHEN 13 THEN '["a",null,"b"]' WHEN 14 THEN '{"z":[{"y":{"a":null,"b":[1,2]}}]}' ELSE '["@"]' END || ',"price":' || CAST(price AS VARCHAR) || ',"source":"finnhub","symbol":"' || symbol
       || '","timestamp":"' || timestamp || '","trade_timestamp_ms":' || CAST(trade_timestamp_ms AS VARCHAR)
       || ',"volume":' || CAST(volume AS VARCHAR) || '}') AS event_id,
       symbol, price, volume, timestamp, trade_timestamp_ms, 'finnhub' AS source
FROM n2""",
)
def q_normalize(spark, sf_dir):
    configure(spark)
    frames = vendor_frames_from_events(balance(read_events(spark, sf_dir)))
    n = ingest.normalize_trades(ingest.decode_frames(frames))
    return n.select("event_id", "symbol", "price", "volume", "timestamp", "trade_timestamp_ms", "source")


@register(
    "decode_frames",
    "SELECT upper(event_type) AS s, count(*) AS trades FROM events WHERE event_type <> 'error' GROUP BY 1",
)
def q_decode(spark, sf_dir):
    configure(spark)
    v = ingest.decode_frames(vendor_frames_from_events(read_events(spark, sf_dir)))
    return v.groupBy("s").agg(F.count(F.lit(1)).alias("trades"))


@register(
    "normalize_rejects",
    """SELECT 'unreadable vendor field: ' || CASE WHEN event_id % 40 IN (5, 11) THEN 'p' WHEN event_id % 40 IN (6, 12) THEN 'v' ELSE 't' END AS error, count(*) AS elements,
       count(DISTINCT upper(event_type)) AS symbols
FROM events WHERE event_type <> 'error' AND event_id % 40 IN (5, 6, 9, 10, 11, 12) GROUP BY 1""",
)
def q_normalize_rejects(spark, sf_dir):
    configure(spark)
    bad = ingest.normalize_rejects(ingest.decode_frames(vendor_frames_from_events(read_events(spark, sf_dir))))
    symbol = F.get_json_object("original_value", "$.s")
    return bad.groupBy("error").agg(F.count(F.lit(1)).alias("elements"), F.countDistinct(symbol).alias("symbols"))


SUBSCRIPTION = ("CLICK", "VIEW")


@register(
    "symbol_subscription",
    O.T + f"SELECT symbol, count(*) AS trades FROM trades WHERE symbol IN {SUBSCRIPTION} GROUP BY symbol",
)
def q_subscription(spark, sf_dir):
    t = _trades(spark, sf_dir)
    return ingest.subscribe(t, list(SUBSCRIPTION)).groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"))


_LISTS = "' ' || event_type || ',, ' || upper(substr(event_type, 1, 2)) || ' x ,' || CASE WHEN event_id % 2 = 0 THEN ' ' ELSE event_id::VARCHAR END"


@register(
    "symbol_list_parse",
    f"""SELECT event_id, array_to_string(list_transform(list_filter(string_split({_LISTS}, ','), lambda x: trim(x) <> ''), lambda x: upper(trim(x))), '|') AS symbols
FROM events""",
)
def q_symbol_list(spark, sf_dir):
    configure(spark)
    ev = read_events(spark, sf_dir)
    last = F.when(F.col("event_id") % 2 == 0, F.lit(" ")).otherwise(F.col("event_id").cast("string"))
    text = F.concat(F.lit(" "), "event_type", F.lit(",, "), F.upper(F.substring("event_type", 1, 2)), F.lit(" x ,"), last)
    return ev.select("event_id", F.array_join(ingest.parse_symbols(text), "|").alias("symbols"))


# ---------------------------------------------------------------- latest-bar summary (dashboard caption)


@register(
    "latest_bar_summary",
    _LATEST_DAY_SQL.format(s=SYMBOL)
    + """SELECT minute, close_price, price_change, high_price, low_price, volume, round(vwap, 8) AS vwap, trade_count
FROM latest ORDER BY minute DESC LIMIT 1""",
)
def q_latest_bar_summary(spark, sf_dir):
    return serve.latest_bar_summary(_latest_day(spark, sf_dir)).select(
        ntz("minute"), "close_price", "price_change", "high_price", "low_price", "volume", rnd("vwap"), "trade_count"
    )


_CAPTION_SQL = (
    "SELECT symbol, strftime(minute, 'Latest completed minute: %Y-%m-%d %H:%M UTC') AS caption, printf('$%.2f', close_price * 1000) AS close, "
    "printf('%.2f', price_change) AS change, printf('$%.2f', high_price) AS high, printf('$%.2f', low_price) AS low, "
    "format('{:,}', volume::BIGINT) AS volume, coalesce(printf('$%.2f', vwap), '$nan') AS vwap, format('{:,}', trade_count) AS trades FROM metrics"
)


@register("caption_texts", O.TBM + _CAPTION_SQL)
def q_captions(spark, sf_dir):
    """The captions of every bar; close prices are raised a thousandfold to show large ones."""
    m = _metrics(spark, sf_dir).withColumn("close_price", F.col("close_price") * 1000)
    return serve.caption_texts(m, "symbol")


# ---------------------------------------------------------------- streaming = batch
#
# These run the real streaming queries (file source with the log's record
# columns, several micro-batches, availableNow trigger) into a fresh folder
# under the shared checkpoint root, then read the sink back. Their oracles are
# the batch answers.

LOG_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
STREAM_FILES = 4


def _stream_folder(spark: SparkSession, name: str) -> str:
    import uuid

    return scratch_path(spark, f"stream-checks/{name}-{uuid.uuid4().hex}")


def _stage_log(spark: SparkSession, sf_dir: str, root: str, change: Callable[[DataFrame], DataFrame] = lambda log: log) -> tuple[str, int]:
    """Write the log as it is partitioned (no funnel into a few writers) and
    return the files-per-trigger that splits it into about STREAM_FILES batches."""
    incoming = f"{root}/incoming"
    change(_log(spark, sf_dir).select(*LOG_COLUMNS)).write.parquet(incoming)
    return incoming, _per_trigger(len(folders.files(spark, [incoming])))


def _per_trigger(files: int) -> int:
    return max(1, -(-files // STREAM_FILES))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


_STORED_SQL = """SELECT event_id, symbol, price, volume, trade_time, trade_timestamp_ms, conditions_json AS conditions, source, count(*) OVER () AS n
FROM (SELECT DISTINCT event_id, symbol, price, volume, trade_time, trade_timestamp_ms, conditions_json, source FROM tr)"""


def _stored(spark, root: str) -> DataFrame:
    stored = trades_table.read_trades(spark, f"{root}/trades")
    n = stored.count()
    return stored.select(
        "event_id", "symbol", "price", "volume", ntz("trade_time"), "trade_timestamp_ms", "conditions", "source", F.lit(n).alias("n")
    )


@register("stream_upsert", _TABLE_ROWS_SQL + _STORED_SQL)
def q_stream_upsert(spark, sf_dir):
    return _stored(spark, _table_run(spark, sf_dir))


def _table_run(spark, sf_dir, again: bool = False, change: Callable[[DataFrame], DataFrame] = lambda log: log, **options) -> str:
    """Run the table query; ``again``: and once more with a new checkpoint, from the first offset and in other batches."""
    root = _stream_folder(spark, "upsert")
    incoming, per_trigger = _stage_log(spark, sf_dir, root, change)
    options = {k: f"{root}/{v}" for k, v in options.items()}
    for n in range(2 if again else 1):
        stream = streaming.read_log_stream(spark, incoming, max_files_per_trigger=per_trigger + n)
        _run(streaming.start_table_query(stream, f"{root}/trades", f"{root}/ck{n}", {"availableNow": True}, **options))
    return root


@register("table_replay_new_checkpoint", _TABLE_ROWS_SQL + _STORED_SQL)
def q_table_replay(spark, sf_dir):
    return _stored(spark, _table_run(spark, sf_dir, again=True))


def _with_given_ids(log: DataFrame) -> DataFrame:
    """The log with ids that are not hashes of their trades: free text in partition 0, other hex text in partition 1."""
    text = F.coalesce(F.col("value").cast("string"), F.lit(""))
    own = F.regexp_extract(text, '"event_id": "([0-9a-f]{64})"', 1)
    other = F.when(F.col("partition") == 0, F.concat(F.lit("t-"), own)).when(F.col("partition") == 1, F.reverse(own)).otherwise(own)
    change = F.is_valid_utf8(text) & (own != "")
    return log.withColumn("value", F.when(change, F.replace(text, own, other).cast("binary")).otherwise(F.col("value")))


@register(
    "stream_upsert_given_ids",
    _TABLE_ROWS_SQL.replace("SELECT eid AS event_id, json_extract_string(text, '$.symbol') AS symbol,", "SELECT CASE WHEN k IN (13, 27, 28, 30, 31) OR partition = 2 THEN eid WHEN partition = 0 THEN 't-' || eid ELSE reverse(eid) END AS event_id, json_extract_string(text, '$.symbol') AS symbol,")
    + _STORED_SQL,
)
def q_stream_upsert_given(spark, sf_dir):
    """Most ids are given: told apart through the id index, replayed once."""
    return _stored(spark, _table_run(spark, sf_dir, again=True, change=_with_given_ids))


@register("stream_dedup_state", _TABLE_ROWS_SQL + _STORED_SQL)
def q_stream_dedup_state(spark, sf_dir):
    """First copies by keyed state, with a restart of the query between the two halves of the log."""
    root = _stream_folder(spark, "state")
    log = _log(spark, sf_dir)
    before = 0
    for half in (F.col("batch_id") < 15, F.col("batch_id") >= 15):
        log.where(half).select(*LOG_COLUMNS).write.mode("append").parquet(f"{root}/incoming")
        files = len(folders.files(spark, [f"{root}/incoming"]))
        stream = streaming.read_log_stream(spark, f"{root}/incoming", max_files_per_trigger=_per_trigger(files - before))
        before = files
        _run(streaming.start_state_table_query(stream, f"{root}/trades", f"{root}/ck", {"availableNow": True}))
    return _stored(spark, root)


@register(
    "publish_wire_records",
    _FRAMES_SQL
    + """SELECT symbol AS key, symbol, price, volume, timestamp, trade_timestamp_ms, 'finnhub' AS source,
       CASE k WHEN 7 THEN 'null' WHEN 8 THEN '[]' WHEN 13 THEN '["a",null,"b"]' WHEN 14 THEN '{"z":[{"y":{"a":null,"b":[1,2]}}]}' ELSE '["@"]' END AS conditions FROM n2""",
)
def q_publish(spark, sf_dir):
    """Wire records that the publish query wrote, read back from their keys and JSON."""
    root = _stream_folder(spark, "publish")
    vendor_frames_from_events(balance(read_events(spark, sf_dir))).write.text(f"{root}/frames")
    _run(streaming.start_publish_query(read_frames(spark, f"{root}/frames"), f"{root}/records", f"{root}/ck", {"availableNow": True}))
    wire = spark.read.parquet(f"{root}/records")
    read = wire.select(F.col("key").cast("string").alias("key"), F.from_json(F.col("value").cast("string"), TRADE_WIRE).alias("w"))
    return read.select("key", "w.symbol", "w.price", "w.volume", "w.timestamp", "w.trade_timestamp_ms", "w.source", F.to_json("w.conditions").alias("conditions"))


@register(
    "stream_bars",
    _TABLE_ROWS_SQL.replace(", tr AS (", ", tr AS (SELECT DISTINCT ON (event_id) * FROM (").rstrip().removesuffix(")")
    + ")),\ntrades AS (SELECT * FROM tr),"
    + O.BARS_CTE
    + "\nSELECT symbol, minute, open_price, high_price, low_price, close_price, volume, trade_count, round(vwap, 8) AS vwap FROM bars",
)
def q_stream_bars(spark, sf_dir):
    """Bars that each micro-batch refreshed for the minutes it touched."""
    stored = bars_table.read_bars(spark, f"{_table_run(spark, sf_dir, bars_path='bars')}/bars")
    return stored.select("symbol", ntz("minute"), "open_price", "high_price", "low_price", "close_price", "volume", "trade_count", rnd("vwap"))


@register(
    "stream_metrics",
    _TABLE_ROWS_SQL.replace(", tr AS (", ", tr AS (SELECT DISTINCT ON (event_id) * FROM (").rstrip().removesuffix(")")
    + ")),\ntrades AS (SELECT * FROM tr),"
    + O.BARS_CTE
    + ","
    + O.METRICS_CTE
    + "\nSELECT symbol, "
    + O.METRIC_SELECT
    + " FROM metrics",
)
def q_stream_metrics(spark, sf_dir):
    """Bars and indicators that each micro-batch brought up to date, late trades included."""
    root = _table_run(spark, sf_dir, bars_path="bars", metrics_path="metrics")
    return metrics_table.read_metrics(spark, f"{root}/metrics").select(*_metric_cols())


@register(
    "stream_progress",
    _TABLE_ROWS_SQL
    + """SELECT count(*) AS received, count(DISTINCT event_id) AS inserted, count(*) - count(DISTINCT event_id) AS duplicates,
       (SELECT count(*) FROM checked_table WHERE table_error IS NOT NULL) AS rejected FROM tr""",
)
def q_stream_progress(spark, sf_dir):
    """Sums of the progress rows of all micro-batches."""
    rows = spark.read.parquet(f"{_table_run(spark, sf_dir, progress_path='progress')}/progress")
    return rows.agg(*[F.sum(c).alias(c) for c in ("received", "inserted", "duplicates", "rejected")])


@register(
    "stream_progress_rerun",
    _TABLE_ROWS_SQL
    + """SELECT count(*) AS received, count(DISTINCT event_id) AS inserted, count(*) - count(DISTINCT event_id) AS duplicates,
       (SELECT count(*) FROM checked_table WHERE table_error IS NOT NULL) AS rejected FROM tr""",
)
def q_progress_rerun(spark, sf_dir):
    """Sums of the progress rows where every batch is run again, as after a crash before the checkpoint's commit."""
    root = _stream_folder(spark, "rerun")
    incoming, _ = _stage_log(spark, sf_dir, root)
    body = table_batch(f"{root}/trades", f"{root}/progress")
    log = spark.read.schema(LOG_RECORD).parquet(incoming)
    for number in range(3):
        for _ in range(2):
            body(log.where(F.col("partition") == number), number)
    rows = spark.read.parquet(f"{root}/progress")
    return rows.agg(*[F.sum(c).alias(c) for c in ("received", "inserted", "duplicates", "rejected")])


def _archive_query(spark, root: str, incoming: str, per_trigger: int, checkpoint: str, fmt: str = "parquet") -> None:
    stream = streaming.read_log_stream(spark, incoming, max_files_per_trigger=per_trigger)
    query = streaming.start_archive_query(stream, f"{root}/archive", f"{root}/dead_letters", f"{root}/{checkpoint}", {"availableNow": True}, fmt)
    _run(query)


def _archive_run(spark, sf_dir, again: bool = False, fmt: str = "parquet") -> str:
    """Archive the log; ``again``: and once more by a new query, from the first offset and in other batches."""
    root = _stream_folder(spark, "archive")
    incoming, per_trigger = _stage_log(spark, sf_dir, root)
    _archive_query(spark, root, incoming, per_trigger, "ck", fmt)
    if again:
        _archive_query(spark, root, incoming, per_trigger + 1, "ck2", fmt)
    return root


_DEAD_LETTERS_SQL = (
    O.L
    + """SELECT key, error, topic AS source_topic, partition AS source_partition, "offset" AS source_offset,
       CASE WHEN k = 11 THEN '�' || text ELSE text END AS original_value
FROM checked WHERE error IS NOT NULL"""
)


def _dead_letters(spark, root) -> DataFrame:
    dl = dead_letters.read_dead_letters(spark, f"{root}/dead_letters")
    return dl.select(F.col("key").cast("string").alias("key"), "error", "source_topic", "source_partition", "source_offset", "original_value")


@register("stream_dead_letters", _DEAD_LETTERS_SQL)
def q_stream_dead_letters(spark, sf_dir):
    return _dead_letters(spark, _archive_run(spark, sf_dir))


@register("dead_letters_replay_new_checkpoint", _DEAD_LETTERS_SQL)
def q_dead_letters_replay(spark, sf_dir):
    return _dead_letters(spark, _archive_run(spark, sf_dir, again=True))


_ARCHIVE_SQL = (
    O.L
    + """SELECT eid AS event_id, json_extract_string(text, '$.symbol') AS symbol, substr(json_extract_string(text, '$.timestamp'), 1, 10) AS date,
       CAST(json_extract(text, '$.price') AS DOUBLE) AS price, key, text AS body, topic, partition AS source_partition, "offset" AS source_offset
FROM checked WHERE error IS NULL"""
)


def _archived(spark, root, fmt: str = "parquet") -> DataFrame:
    a = archive.read_archive(spark, f"{root}/archive", fmt=fmt)
    return a.select("event_id", "symbol", "date", "price", "key", "body", "topic", "source_partition", "source_offset")


@register("stream_archive", _ARCHIVE_SQL)
def q_stream_archive(spark, sf_dir):
    return _archived(spark, _archive_run(spark, sf_dir))


@register("archive_replay_new_checkpoint", _ARCHIVE_SQL)
def q_archive_replay(spark, sf_dir):
    return _archived(spark, _archive_run(spark, sf_dir, again=True))


@register(
    "archive_listing",
    O.L
    + """SELECT json_extract_string(text, '$.symbol') AS symbol, substr(json_extract_string(text, '$.timestamp'), 1, 10) AS date, true AS listed
FROM checked WHERE error IS NULL GROUP BY ALL""",
)
def q_archive_listing(spark, sf_dir):
    """The folders of the archive, from its listing."""
    files = archive.list_archive(spark, f"{_archive_run(spark, sf_dir)}/archive", "*.parquet")
    part = lambda name: F.url_decode(F.replace(F.regexp_extract("path", f"/{name}=([^/]+)/", 1), F.lit("+"), F.lit("%2B"))).alias(name)
    return files.groupBy(part("symbol"), part("date")).agg((F.min("length") > 0).alias("listed"))


@register(
    "offset_span_parse",
    O.L + """SELECT batch_id, partition, min("offset") AS first_offset, max("offset") AS last_offset FROM log GROUP BY ALL""",
)
def q_offset_span_parse(spark, sf_dir):
    """The spans read back from their text."""
    spans = archive.offset_spans(_log(spark, sf_dir), batch="batch_id")
    return spans.select("batch_id", F.inline(archive.parse_offset_span(F.col("offset_span"))))


@register("archive_csv", _ARCHIVE_SQL)
def q_archive_csv(spark, sf_dir):
    return _archived(spark, _archive_run(spark, sf_dir, fmt="csv"), "csv")


@register(
    "archive_round_trip",
    _TABLE_ROWS_SQL + "SELECT event_id, symbol, price, volume, trade_time, conditions_json AS conditions, partition, \"offset\" FROM tr",
)
def q_archive_round_trip(spark, sf_dir):
    """Table rows made from the archived messages, which are read and validated like the log itself."""
    log = archive.archive_log(archive.read_archive(spark, f"{_archive_run(spark, sf_dir)}/archive"))
    rows = validate.to_table_rows(validate.valid_messages(validate.validate(log, table_path=True)))
    return rows.select("event_id", "symbol", "price", "volume", ntz("trade_time"), "conditions", "partition", "offset")


@register("latest_day_metrics_from_bars", _LATEST_DAY_SQL.format(s=SYMBOL) + "SELECT " + O.METRIC_SELECT + " FROM latest")
def q_latest_day_from_bars(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir))
    return serve.latest_day_metrics_from_bars(b, SYMBOL).select(*_metric_cols(with_symbol=False))


@register("one_minute_metrics_by_day", O.TBM + "SELECT symbol, " + O.METRIC_SELECT + " FROM metrics")
def q_metrics_by_day(spark, sf_dir):
    b = bars.minute_bars(_trades(spark, sf_dir))
    return bars.indicators_by_day(b).select(*_metric_cols())


@register(
    "one_minute_metrics_by_day_hourly",
    O.with_ctes(O.trades_cte(1), O.bars_cte("hour"), O.METRICS_CTE) + "SELECT symbol, " + O.METRIC_SELECT + " FROM metrics",
)
def q_metrics_by_day_hourly(spark, sf_dir):
    # Unsqueezed events over 30 days: hour bars cross many day boundaries, so
    # the warm-up bars of each day come from earlier days.
    configure(spark)
    t = trades_from_events(read_events(spark, sf_dir), squeeze=1)
    return bars.indicators_by_day(bars.minute_bars(t, width="hour")).select(*_metric_cols())
