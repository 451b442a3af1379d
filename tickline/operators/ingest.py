"""Vendor frames → normalized trades → ids → wire records.

``decode_frames`` parses each frame once with a declared schema, keeps trade
frames and explodes their ``data`` array; ``normalize_trades`` renames and casts
the short vendor fields; ``with_event_id`` adds the SHA-256 id. All three are
narrow (no shuffle) and run inside one whole-stage-codegen span with the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions.fingerprint import canonical_text, conditions_text, sha256_hex
from tickline.functions.timefmt import iso_from_millis
from tickline.schemas import FRAME, SOURCE_NAME, TRADE_WIRE


def decode_frames(frames: DataFrame, column: str = "value") -> DataFrame:
    """Short-named vendor trades (s, p, v, t, c) of every ``type == "trade"`` frame.

    Frames that are not JSON, of another type, or without ``data`` yield no rows.
    """
    # One parse per frame: the type test sits inside the generator instead of a
    # Filter, which the optimizer would push below the parse and so parse twice.
    parsed = frames.select(F.from_json(F.col(column).cast("string"), FRAME).alias("f"))
    return parsed.select(F.inline(F.when(F.col("f.type") == "trade", F.col("f.data"))))


# The first and last millisecond of the years 1 to 9999, which ISO text can name.
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def _finite(text: str) -> Column:
    """A number; none for text that is no number, not a number or infinite."""
    x = F.expr(f"try_cast({text} AS DOUBLE)")
    return F.when(F.abs(x) < F.lit(float("inf")), x)  # NaN is greater than any number in Spark


def _typed(vendor: DataFrame, source: str) -> DataFrame:
    ms = F.coalesce(F.expr("try_cast(t AS BIGINT)"), F.expr("try_cast(try_cast(t AS DOUBLE) AS BIGINT)"))
    ms = F.when(ms.between(FIRST_MS, LAST_MS), ms)
    return vendor.select(
        F.col("s").alias("symbol"),
        _finite("p").alias("price"),
        _finite("v").alias("volume"),
        iso_from_millis(ms).alias("timestamp"),
        ms.alias("trade_timestamp_ms"),
        F.coalesce(F.col("c"), F.parse_json(F.lit("[]"))).alias("conditions"),
        F.lit(source).alias("source"),
        F.struct("s", "p", "v", "t", "c").alias("_vendor"),
    )


def _readable() -> Column:
    return F.col("symbol").isNotNull() & F.col("price").isNotNull() & F.col("volume").isNotNull() & F.col("trade_timestamp_ms").isNotNull()


def normalize_trades(vendor: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """Vendor trades → wire columns with ``event_id``.

    Numbers are cast with ``try_cast`` (numeric text is accepted, as ``float()``
    and ``int()`` accept it). ``conditions`` is any JSON value (VARIANT), ``[]`` where
    the element has none. Elements whose symbol, price, volume or time cannot be read
    (no finite number, or a time outside the years 1 to 9999) are not here but in
    :func:`normalize_rejects`; the rest of the frame is kept.
    """
    return with_event_id(_typed(vendor, source).where(_readable()).drop("_vendor"))


def normalize_rejects(vendor: DataFrame, source: str = SOURCE_NAME) -> DataFrame:
    """The vendor elements that cannot be normalized: ``error`` (the first field that
    cannot be read) and ``original_value`` (the element as JSON text)."""
    bad = _typed(vendor, source).where(~_readable())
    reason = (
        F.when(F.col("symbol").isNull(), F.lit("s"))
        .when(F.col("price").isNull(), F.lit("p"))
        .when(F.col("volume").isNull(), F.lit("v"))
        .otherwise(F.lit("t"))
    )
    return bad.select(F.concat(F.lit("unreadable vendor field: "), reason).alias("error"), F.to_json("_vendor").alias("original_value"))


def event_id(df: DataFrame) -> Column:
    return sha256_hex(
        canonical_text(
            F.col("symbol"),
            F.col("price"),
            F.col("volume"),
            F.col("timestamp"),
            F.col("trade_timestamp_ms"),
            conditions_text(F.col("conditions")),
            F.col("source"),
        )
    )


def with_event_id(trades: DataFrame) -> DataFrame:
    """Add ``event_id``: keep a non-empty given id, else derive it from the fields."""
    derived = event_id(trades)
    if "event_id" in trades.columns:
        derived = F.coalesce(F.nullif(F.col("event_id"), F.lit("")), derived)
    cols = [c for c in trades.columns if c != "event_id"]
    return trades.select(derived.alias("event_id"), *cols)


def to_wire(trades: DataFrame) -> DataFrame:
    """Keyed log records: key = symbol, value = wire JSON of the trade."""
    fields = [f.name for f in TRADE_WIRE.fields if f.name != "event_id"] + ["event_id"]
    return trades.select(
        F.col("symbol").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def parse_symbols(text: Column) -> Column:
    """Comma list → array of trimmed, upper-cased, non-empty symbols."""
    parts = F.filter(F.split(text, ","), lambda s: F.trim(s) != "")
    return F.transform(parts, lambda s: F.upper(F.trim(s)))


def subscribe(trades: DataFrame, symbols: list[str]) -> DataFrame:
    """Keep only subscribed symbols (an IN list; folded into the scan filter)."""
    return trades.where(F.col("symbol").isin(list(symbols)))

