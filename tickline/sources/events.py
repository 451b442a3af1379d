"""Trades, frames and log records derived from the driver's ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` is read as a trade
stream: the event type is the symbol, ``value`` the price and ``props.k`` the
volume. Its 30 days are squeezed 60-fold into 12 hours so that one-minute bars hold
several trades. Every function is a projection of the whole table; nothing is
sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.functions.fingerprint import canonical_text_rendered, sha256_hex
from tickline.functions.jsontext import json_string, python_float_text
from tickline.functions.timefmt import iso_from_millis
from tickline.schemas import SOURCE_NAME

# Fixed values of the fixture mapping.
EPOCH_START_MS = 1704067200000  # 2024-01-01T00:00:00Z, first day of the events table
DEFAULT_SQUEEZE = 60
LOG_TOPIC = "trades.realtime"
LOG_PARTITIONS = 3


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_ms(ts_col: str = "ts") -> Column:
    """Epoch milliseconds (floor) of a ``timestamp_ntz`` taken as UTC wall time."""
    return F.expr(f"unix_micros(to_timestamp({ts_col}::string)) div 1000")


def squeezed_ms(ts_col: str = "ts", squeeze: int = DEFAULT_SQUEEZE) -> Column:
    """Trade time in epoch ms: the event time squeezed ``squeeze``-fold."""
    return F.expr(
        f"{EPOCH_START_MS} + (unix_micros(to_timestamp({ts_col}::string)) div 1000 - {EPOCH_START_MS}) div {squeeze}"
    )


def trades_from_events(events: DataFrame, squeeze: int = DEFAULT_SQUEEZE) -> DataFrame:
    """The ``trades`` table shape from ``events``.

    ``received_at`` is the original (unsqueezed) event time, so freshness and
    arrival order are meaningful. Rows with ``value <= 0`` fail the price rule and
    are left out, as validation would reject them.
    """
    ms = squeezed_ms("ts", squeeze) if squeeze != 1 else event_ms("ts")
    return (
        events.where(F.col("value") > 0)
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.upper("event_type").alias("symbol"),
            F.col("value").alias("price"),
            F.get_json_object("props", "$.k").cast("double").alias("volume"),
            ms.alias("trade_timestamp_ms"),
            F.to_timestamp(F.col("ts").cast("string")).alias("received_at"),
        )
        .select(
            "event_id",
            "symbol",
            "price",
            "volume",
            F.timestamp_millis("trade_timestamp_ms").alias("trade_time"),
            "trade_timestamp_ms",
            F.lit("[]").alias("conditions"),
            F.lit(SOURCE_NAME).alias("source"),
            "received_at",
        )
    )


def vendor_frames_from_events(events: DataFrame, squeeze: int = DEFAULT_SQUEEZE) -> DataFrame:
    """One vendor frame per event: ``{"type":"trade","data":[{"s","p","v","t","c"}]}``.

    Events of type ``error`` become non-trade frames (a vendor status message),
    which the decoder must skip. By ``event_id % 40``: class 5 has a price that is no
    number, 6 no volume, 7 a null and 8 no ``c``, 9 and 10 a time that no timestamp
    holds, 11 a price of ``NaN``, 12 an infinite volume, 13 a null among the strings of
    ``c`` and 14 a ``c`` of five levels. Output: one string column ``value``.
    """
    fault = F.pmod(F.col("event_id"), F.lit(FAULT_CYCLE))
    trade = F.struct(
        F.upper("event_type").alias("s"),
        F.when(fault == 5, F.lit("n/a")).when(fault == 11, F.lit("NaN")).otherwise(F.col("value").cast("string")).alias("p"),
        F.when(fault == 12, F.lit("Infinity")).when(fault != 6, F.get_json_object("props", "$.k")).alias("v"),
        F.when(fault == 9, F.lit(99999999999999999)).when(fault == 10, F.lit(2**63 - 1)).otherwise(squeezed_ms("ts", squeeze)).alias("t"),
        F.when(fault == 7, F.parse_json(F.lit("null")))
        .when(fault == 13, F.parse_json(F.lit(CONDITIONS[30])))
        .when(fault == 14, F.parse_json(F.lit(CONDITIONS[31])))
        .when(fault != 8, F.parse_json(F.lit('["@"]')))
        .alias("c"),
    )
    frame_type = F.when(F.col("event_type") == "error", F.lit("ping")).otherwise(F.lit("trade"))
    return events.select(
        F.to_json(F.struct(frame_type.alias("type"), F.array(trade).alias("data"))).alias("value")
    )


# Fixed values of the test log: fault class per record is ``event_id % FAULT_CYCLE``.
FAULT_CYCLE = 40
DUPLICATE_EVERY = 10


def _kv(key: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{key}": '), value)


def _wire_parts(events: DataFrame, squeeze: int) -> DataFrame:
    """Per-event pieces, projected once so the text builder can reuse them."""
    staged = events.select(
        "event_id",
        "ts",
        "event_type",
        F.upper("event_type").alias("_sym"),
        F.col("value").alias("_price"),
        F.get_json_object("props", "$.k").cast("double").alias("_vol"),
        squeezed_ms("ts", squeeze).alias("_ms"),
        F.pmod(F.col("event_id"), F.lit(FAULT_CYCLE)).alias("_fault"),
    ).withColumn("_iso", iso_from_millis(F.col("_ms")))
    # Numbers rendered once; both the id text and the message use them.
    staged = staged.select(
        "*", python_float_text(F.col("_price")).alias("_price_txt"), python_float_text(F.col("_vol")).alias("_vol_txt")
    )
    canon = canonical_text_rendered(
        F.col("_sym"), F.col("_price_txt"), F.col("_vol_txt"), F.col("_iso"), F.col("_ms"), F.lit('["@"]'), F.lit(SOURCE_NAME)
    )
    staged = staged.withColumn("_eid", sha256_hex(canon))
    # Text pieces used by several fault branches: projected once, not per branch.
    return staged.select(
        "*",
        _kv("symbol", json_string(F.col("_sym"))).alias("_symbol_kv"),
        _kv("price", F.col("_price_txt")).alias("_price_kv"),
        _kv("volume", F.col("_vol_txt")).alias("_volume_kv"),
        _kv("timestamp", json_string(F.col("_iso"))).alias("_ts_kv"),
    )


# JSON of ``conditions`` by fault class; other classes have ["@"].
CONDITIONS = {
    21: '"x"',
    22: '{"a":[1,null,true],"b":1.5}',
    23: '[1.5,{"b":2}]',
    24: "null",
    25: '["a\\nb"," pad ","q\\"é"]',
    27: '[1.0,"é",{"b":1e3,"a":null},20000000000000000000]',
    30: '["a",null,"b"]',
    31: '{"z":[{"y":{"b":[1.0,2],"a":null}}]}',
}


def _conditions_kv(k: Column) -> Column:
    """Absent (with an extra field) in classes 20 and 28."""
    out = F.when(k.isin(20, 28), F.lit('"venue": "X"'))
    for fault, text in CONDITIONS.items():
        out = out.when(k == fault, F.lit(f'"conditions": {text}'))
    return out.otherwise(F.lit('"conditions": ["@"]'))


def _slots(parts: DataFrame) -> DataFrame:
    """Each key/value slot of the message, with the fault of its class applied."""
    k = F.col("_fault")

    def quoted(kv: str) -> Column:  # '"price": 12.5' -> '"price": "12.5"'
        return F.regexp_replace(F.col(kv), r": (.*)$", ': "$1"')

    return parts.select(
        "*",
        F.when(k == 2, F.lit('"symbol": "  "')).when(k == 17, F.lit('"symbol": 5')).otherwise(F.col("_symbol_kv")).alias("_s1"),
        F.when(k.isin(3, 16), F.lit('"price": 0')).when(k == 4, quoted("_price_kv")).when(k == 18, F.lit('"price": null'))
        .otherwise(F.col("_price_kv")).alias("_s2"),
        F.when(k == 5, F.lit('"volume": -1')).when(k == 19, quoted("_volume_kv")).otherwise(F.col("_volume_kv")).alias("_s3"),
        F.when(k == 6, F.lit('"timestamp": ""')).when(k == 14, F.lit('"timestamp": "garbage"')).when(k == 26, F.lit('"timestamp": "10:00"'))
        .when(k == 29, F.lit('"timestamp": "2024"')).otherwise(F.col("_ts_kv")).alias("_s4"),
        _kv("trade_timestamp_ms", F.concat(F.col("_ms").cast("string"), F.when(k == 7, F.lit(".0")).otherwise(F.lit("")))).alias("_s5"),
        _conditions_kv(k).alias("_s6"),
        F.when(k.isin(8, 16), F.lit('"source": "other"')).otherwise(F.lit(f'"source": "{SOURCE_NAME}"')).alias("_s7"),
        F.when(~k.isin(13, 27, 28, 30, 31), _kv("event_id", json_string(F.col("_eid")))).alias("_s8"),
    )


def wire_text() -> Column:
    """Wire JSON per event, written the way the producer's ``json.dumps`` writes
    it (insertion order, ``", "`` and ``": "`` separators), with a fault injected
    according to the record's fault class. Every event yields one record.

    Fault classes: 1 only a symbol, 2 blank symbol, 3 zero price, 4 price as text,
    5 negative volume, 6 empty timestamp, 7 fractional ms, 8 other source,
    9 trailing text, 10 not an object, 11 invalid UTF-8 (see :func:`log_from_events`),
    12 empty body, 13 no event_id (consumer derives it), 14 unparseable
    timestamp, 15 empty object, 16 zero price and other source, 17 numeric
    symbol, 18 null price, 19 volume as text, 20 extra field and no conditions,
    21 to 25 other JSON values of ``conditions``, 26 and 29 a time and a year for a
    timestamp, 27, 30 and 31 no event_id and nested ``conditions`` or a null among
    them, 28 neither event_id nor ``conditions``. Everything else is a valid trade. Reads the columns of :func:`_slots`.
    """
    k = F.col("_fault")
    full = F.concat(F.lit("{"), F.concat_ws(", ", *[F.col(f"_s{i}") for i in range(1, 9)]), F.lit("}"))
    return (
        F.when(k == 1, F.concat(F.lit("{"), F.col("_symbol_kv"), F.lit("}")))
        .when(k == 9, F.concat(full, F.lit(" x")))
        .when(k == 10, F.lit("[1]"))
        .when(k == 12, F.lit(None).cast("string"))
        .when(k == 15, F.lit("{}"))
        .otherwise(full)
    )


def log_from_events(
    events: DataFrame,
    squeeze: int = DEFAULT_SQUEEZE,
    topic: str = LOG_TOPIC,
    partitions: int = LOG_PARTITIONS,
) -> DataFrame:
    """Kafka-shaped test log built from every event, plus duplicate deliveries.

    Columns: key, value (BINARY), topic, partition, offset, timestamp, batch_id.
    ``partition = event_id % partitions``, ``offset = 2 * (event_id div partitions)``;
    arrival ``timestamp`` is the original event time and ``batch_id`` its day,
    which stands for the micro-batch the record arrives in. Events whose id is a
    multiple of 10 are delivered a second time: of these, every other one on the
    same day and the rest a day later (same partition, the odd offset that follows
    the first delivery's), so duplicates occur both across and inside batches.
    """
    parts = _slots(_wire_parts(events, squeeze)).withColumn("_text", wire_text())
    text = F.col("_text")
    k = F.col("_fault")
    body = F.when(k == 11, F.concat(F.unhex(F.lit("FF")), text.cast("binary"))).otherwise(text.cast("binary"))
    arrival = F.to_timestamp(F.col("ts").cast("string"))
    first_day = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    day = F.floor((F.unix_seconds(arrival) - F.unix_seconds(first_day)) / 86400).cast("long")
    base = parts.select(
        F.upper("event_type").cast("binary").alias("key"),
        body.alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.col("event_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.expr(f"2 * (event_id div {partitions})").alias("offset"),
        arrival.alias("timestamp"),
        day.alias("batch_id"),
        F.col("event_id").alias("_eid"),
    )
    later = F.pmod(F.expr(f"_eid div {DUPLICATE_EVERY}"), F.lit(2)).cast("int")
    dups = base.where(F.pmod(F.col("_eid"), F.lit(DUPLICATE_EVERY)) == 0).select(
        "key",
        "value",
        "topic",
        "partition",
        (F.col("offset") + 1).alias("offset"),
        (F.col("timestamp") + F.make_dt_interval(later)).alias("timestamp"),
        (F.col("batch_id") + later).alias("batch_id"),
        "_eid",
    )
    return base.unionByName(dups).drop("_eid")
