"""Declared schemas. Nothing in the engine infers a schema."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)

# Fixed values that must equal the reference for equal results.
SOURCE_NAME = "finnhub"
REQUIRED_FIELDS = ("price", "source", "symbol", "timestamp", "trade_timestamp_ms", "volume")

# One short-named vendor trade inside a frame. Numbers are kept as their JSON text
# and cast with try_cast, so numeric strings are accepted the way int()/float() do.
VENDOR_TRADE = StructType(
    [
        StructField("s", StringType()),
        StructField("p", StringType()),
        StructField("v", StringType()),
        StructField("t", StringType()),
        StructField("c", VariantType()),  # any JSON value; absent is not the same as null
    ]
)

FRAME = StructType(
    [
        StructField("type", StringType()),
        StructField("data", ArrayType(VENDOR_TRADE)),
    ]
)

# A normalized trade as it travels on the log (JSON object with these keys).
TRADE_WIRE = StructType(
    [
        StructField("event_id", StringType()),
        StructField("symbol", StringType()),
        StructField("price", DoubleType()),
        StructField("volume", DoubleType()),
        StructField("timestamp", StringType()),
        StructField("trade_timestamp_ms", LongType()),
        StructField("conditions", VariantType()),
        StructField("source", StringType()),
    ]
)

# A record of the partitioned log (Kafka source / sink shape).
LOG_RECORD = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

DEAD_LETTER = StructType(
    [
        StructField("key", BinaryType()),
        StructField("error", StringType()),
        StructField("source_topic", StringType()),
        StructField("source_partition", IntegerType()),
        StructField("source_offset", LongType()),
        StructField("original_value", StringType()),
    ]
)

TRADES = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("symbol", StringType(), False),
        StructField("price", DoubleType(), False),
        StructField("volume", DoubleType(), False),
        StructField("trade_time", TimestampType(), False),
        StructField("trade_timestamp_ms", LongType(), False),
        StructField("conditions", StringType(), False),  # JSON text of any value, "[]" by default
        StructField("source", StringType(), False),
        StructField("received_at", TimestampType(), False),
    ]
)

# Archive rows: the wire columns, the whole message (``body``) with its key, and the
# log coordinates. ``symbol`` and ``date`` are the partition directories.
ARCHIVE = StructType(
    [
        StructField("event_id", StringType()),
        StructField("price", DoubleType()),
        StructField("volume", DoubleType()),
        StructField("timestamp", StringType()),
        StructField("trade_timestamp_ms", LongType()),
        StructField("conditions", StringType()),
        StructField("source", StringType()),
        StructField("key", StringType()),
        StructField("body", StringType()),
        StructField("topic", StringType()),
        StructField("source_partition", IntegerType()),
        StructField("source_offset", LongType()),
        StructField("symbol", StringType()),
        StructField("date", StringType()),
    ]
)

BAR_COLUMNS = (
    "symbol",
    "minute",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "volume",
    "trade_count",
    "vwap",
)
