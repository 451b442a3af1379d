"""Validation rules for wire messages, as one first-failing-rule column.

Order and wording are fixed values that must equal the reference:

1. message must be a JSON object
2. missing fields: <sorted, comma-separated names>
3. symbol must be a non-empty string
4. price must be greater than zero
5. volume must be zero or greater
6. timestamp must be a non-empty string
7. trade_timestamp_ms must be an integer
8. source must be finnhub

Our additions: ``invalid UTF-8`` and ``invalid JSON`` before rule 1 (the reference
reports the decoder's exception text there), and, on the table path only,
``timestamp must be parseable`` after rule 8 (the reference lets such a record
break the whole database batch). An empty record body is reported as rule 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickline.functions.fingerprint import variant_type
from tickline.schemas import REQUIRED_FIELDS, SOURCE_NAME

# Error texts in rule order.
ERR_UTF8 = "invalid UTF-8"
ERR_JSON = "invalid JSON"
ERR_OBJECT = "message must be a JSON object"
ERR_MISSING = "missing fields: "
ERR_SYMBOL = "symbol must be a non-empty string"
ERR_PRICE = "price must be greater than zero"
ERR_VOLUME = "volume must be zero or greater"
ERR_TIMESTAMP = "timestamp must be a non-empty string"
ERR_MS = "trade_timestamp_ms must be an integer"
ERR_SOURCE = "source must be " + SOURCE_NAME
ERR_TIMESTAMP_PARSE = "timestamp must be parseable"

_SENTINEL = '"#end-of-message"'


def message_text(value: Column) -> Column:
    """Record body as text (BINARY from a log, or already STRING)."""
    return value.cast("string")


def parse_message(text: Column) -> Column:
    """Strict parse of one JSON value, as VARIANT; NULL if the text is not exactly
    one JSON value. Wrapping as ``[text,"sentinel"]`` and demanding two elements
    rejects trailing text, which a bare parse would ignore."""
    wrapped = F.concat(F.lit("["), F.try_validate_utf8(text), F.lit("," + _SENTINEL + "]"))
    arr = F.try_variant_get(F.try_parse_json(wrapped), "$", "array<variant>")
    ok = (F.size(arr) == 2) & (F.try_variant_get(arr[1], "$", "string") == F.lit(_SENTINEL.strip('"')))
    return F.when(ok, arr[0])


def is_number(kind: Column) -> Column:
    return (kind == "BIGINT") | (kind == "DOUBLE") | (kind == "FLOAT") | kind.startswith("DECIMAL")


def _is_true(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def field_kinds(msg: Column) -> list[Column]:
    """Per required field, its VARIANT type name (VOID for JSON null), aliased
    ``_kind_<field>``; NULL when the message has no such field."""
    return [variant_type(msg, f).alias(f"_kind_{f}") for f in REQUIRED_FIELDS]


def error_column(value: Column, msg: Column, table_path: bool = False) -> Column:
    """First failing rule for a record, NULL when valid.

    ``value`` is the raw body, ``msg`` its :func:`parse_message` result, and the
    ``_kind_<field>`` columns of :func:`field_kinds` must be present: they tell a
    missing field (NULL) from a JSON null (``VOID``), so the text is parsed once.
    """
    text = message_text(value)
    # REQUIRED_FIELDS is in alphabetical order, so the missing names come out sorted.
    missing = F.array_compact(F.array(*[F.when(F.col(f"_kind_{f}").isNull(), F.lit(f)) for f in REQUIRED_FIELDS]))

    def kind(field: str) -> Column:
        return F.col(f"_kind_{field}")

    def num(field: str) -> Column:
        return F.try_variant_get(msg, f"$.{field}", "double")

    def txt(field: str) -> Column:
        return F.try_variant_get(msg, f"$.{field}", "string")

    symbol_ok = (kind("symbol") == "STRING") & txt("symbol").rlike(r"(?U)\S")
    price_ok = is_number(kind("price")) & (num("price") > 0)
    volume_ok = is_number(kind("volume")) & (num("volume") >= 0)
    timestamp_ok = (kind("timestamp") == "STRING") & (F.length(txt("timestamp")) > 0)
    ms_ok = kind("trade_timestamp_ms") == "BIGINT"
    source_ok = (kind("source") == "STRING") & (txt("source") == F.lit(SOURCE_NAME))

    chain = (
        F.when(value.isNull(), F.lit(ERR_OBJECT))
        .when(~F.is_valid_utf8(text), F.lit(ERR_UTF8))
        .when(msg.isNull(), F.lit(ERR_JSON))
        .when(~F.schema_of_variant(msg).startswith("OBJECT"), F.lit(ERR_OBJECT))
        .when(F.size(missing) > 0, F.concat(F.lit(ERR_MISSING), F.array_join(missing, ", ")))
        .when(~_is_true(symbol_ok), F.lit(ERR_SYMBOL))
        .when(~_is_true(price_ok), F.lit(ERR_PRICE))
        .when(~_is_true(volume_ok), F.lit(ERR_VOLUME))
        .when(~_is_true(timestamp_ok), F.lit(ERR_TIMESTAMP))
        .when(~_is_true(ms_ok), F.lit(ERR_MS))
        .when(~_is_true(source_ok), F.lit(ERR_SOURCE))
    )
    if table_path:
        chain = chain.when(table_time(txt("timestamp")).isNull(), F.lit(ERR_TIMESTAMP_PARSE))
    return chain


def table_time(text: Column) -> Column:
    """Timestamp text → TIMESTAMP; NULL where it has no full date or cannot be read. (A cast alone takes a
    time of day for today, and a bare year for its first day.)"""
    return F.when(text.rlike(r"^\s*\d{4,6}-\d{1,2}-\d{1,2}"), F.try_to_timestamp(text))
