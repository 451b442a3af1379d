"""Deterministic trade ids: SHA-256 of a canonical JSON text.

The canonical text is the trade's fingerprint fields with keys in alphabetical
order and no spaces, numbers printed the way Python prints them, e.g.::

    {"conditions":["@"],"price":250.5,"source":"finnhub","symbol":"AAPL",
     "timestamp":"2026-10-07T18:00:00+00:00","trade_timestamp_ms":1791396000000,"volume":100.0}

Two builders exist: one for typed columns (a normalized trade, all seven fields
present) and one for a parsed wire message (VARIANT), which keeps only the fields
present and prints integers on the wire without ``.0`` as the consumer path does.
Limit: integers of more than 38 digits print as floats.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickline.functions.jsontext import json_string, python_float_text
from tickline.schemas import SOURCE_NAME

def canonical_text(
    symbol: Column,
    price: Column,
    volume: Column,
    timestamp: Column,
    trade_timestamp_ms: Column,
    conditions: Column,
    source: Column,
) -> Column:
    """Canonical text of a normalized trade (doubles for price and volume, JSON text for conditions)."""
    return canonical_text_rendered(
        symbol, python_float_text(price), python_float_text(volume), timestamp, trade_timestamp_ms, conditions, source
    )


def canonical_text_rendered(
    symbol: Column,
    price_text: Column,
    volume_text: Column,
    timestamp: Column,
    trade_timestamp_ms: Column,
    conditions: Column,
    source: Column,
) -> Column:
    """:func:`canonical_text` with price and volume already rendered as text."""
    return F.concat(
        F.lit('{"conditions":'),
        conditions,
        F.lit(',"price":'),
        price_text,
        F.lit(',"source":'),
        json_string(source),
        F.lit(',"symbol":'),
        json_string(symbol),
        F.lit(',"timestamp":'),
        json_string(timestamp),
        F.lit(',"trade_timestamp_ms":'),
        trade_timestamp_ms.cast("long").cast("string"),
        F.lit(',"volume":'),
        volume_text,
        F.lit("}"),
    )


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def variant_type(msg: Column, field: str) -> Column:
    """Type name of ``msg.field``: BIGINT, DOUBLE, DECIMAL(p,s), STRING, BOOLEAN,
    VOID (JSON null) ... and NULL when the field is absent."""
    return F.schema_of_variant(F.try_variant_get(msg, f"$.{field}", "variant"))


def _number(kind: Column, value: Column) -> Column:
    """A VARIANT number the way Python prints it: integers of any width up to 38
    digits as integers, everything else as a float. (A decimal does not tell 93.0
    from 93, but an integer that fits 64 bits is a BIGINT; beyond, it counts as one.)"""
    wide = F.try_variant_get(value, "$", "decimal(38,0)")
    exact = F.try_variant_get(value, "$", "decimal(38,10)")
    integer = (kind == "BIGINT") | (kind.startswith("DECIMAL") & (F.abs(wide) > F.lit(2**63 - 1)) & F.coalesce(exact == wide, F.lit(True)))
    return F.when(integer, wide.cast("string")).otherwise(python_float_text(F.try_variant_get(value, "$", "double")))


def _number_text(msg: Column, field: str) -> Column:
    return _number(variant_type(msg, field), F.try_variant_get(msg, f"$.{field}", "variant"))


def _step(state: Column) -> Column:
    """Print the value on top of the stack, or put its items there in its place.

    An item of the stack is the text that goes before it and, unless that is all (a closing bracket), a value.
    """
    top = F.element_at(state["stack"], -1)
    rest = F.slice(state["stack"], 1, F.size(state["stack"]) - 1)
    kind = F.schema_of_variant(top["value"])
    items = F.try_variant_get(top["value"], "$", "array<variant>")
    members = F.try_variant_get(top["value"], "$", "map<string,variant>")
    names = F.array_sort(F.map_keys(members))

    def item(before: Column, value: Column) -> Column:
        return F.struct(before.alias("before"), value.alias("value"))

    def comma(i: Column, opening: str) -> Column:
        return F.when(i == 0, F.lit(opening)).otherwise(F.lit(","))

    nothing = F.lit(None).cast("variant")
    listed = F.transform(items, lambda x, i: item(comma(i, "["), x))
    named = F.transform(names, lambda n, i: item(F.concat(comma(i, "{"), json_string(n), F.lit(":")), F.element_at(members, n)))
    pushed = (
        F.when(kind.startswith("ARRAY") & (F.size(items) > 0), F.concat(F.array(item(F.lit("]"), nothing)), F.reverse(listed)))
        .when(kind.startswith("OBJECT") & (F.size(names) > 0), F.concat(F.array(item(F.lit("}"), nothing)), F.reverse(named)))
    )
    printed = (
        F.when(kind == "STRING", json_string(F.try_variant_get(top["value"], "$", "string")))
        .when((kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL"), _number(kind, top["value"]))
        .when(pushed.isNotNull() | top["value"].isNull(), F.lit(""))
        .otherwise(F.to_json(top["value"]))
    )
    return F.struct(
        F.concat(state["text"], top["before"], printed).alias("text"),
        F.when(pushed.isNotNull(), F.concat(rest, pushed)).otherwise(rest).alias("stack"),
    )


def variant_text(value: Column) -> Column:
    """Any JSON value, of any depth, in Python's compact form with sorted keys.

    A fold with a stack of the values still to print. It takes as many steps as the value has items and
    closing brackets; the brackets and commas of its JSON text bound them, and steps beyond the end do nothing.
    """
    marks = F.length(F.regexp_replace(F.to_json(value), r"[^\[{,]", ""))
    first = F.struct(F.lit("").alias("before"), value.alias("value"))
    start = F.struct(F.lit("").alias("text"), F.array(first).alias("stack"))
    steps = F.sequence(F.lit(0), 2 * marks)
    return F.aggregate(steps, start, lambda state, _: F.when(F.size(state["stack"]) > 0, _step(state)).otherwise(state), lambda state: state["text"])


def conditions_text(value: Column) -> Column:
    """The usual array of strings in one pass; anything else, arrays with a null included, in full."""
    strings = F.try_variant_get(value, "$", "array<string>")
    listed = F.concat(F.lit("["), F.array_join(F.transform(strings, json_string), ","), F.lit("]"))
    usual = (F.schema_of_variant(value) == "ARRAY<STRING>") & ~F.exists(strings, F.isnull)
    return F.when(usual, listed).otherwise(variant_text(value))


_built: dict[int, Column] = {}


def message_text_column() -> Column:
    """:func:`canonical_text_from_message` of the column ``msg``, built once per JVM: the expression has many
    parts, and every micro-batch asks for it."""
    jvm = id(SparkContext._active_spark_context._gateway)
    if jvm not in _built:
        _built.clear()
        _built[jvm] = canonical_text_from_message(F.col("msg"))
    return _built[jvm]


def canonical_text_from_message(msg: Column) -> Column:
    """Canonical text of a *validated* wire message.

    After validation the six required fields are present, symbol and timestamp
    are strings, source is the fixed source name, the ms an integer and price /
    volume numbers; only the optional ``conditions`` may be absent or hold any
    JSON value.
    """
    conditions = F.try_variant_get(msg, "$.conditions", "variant")
    cond_part = F.when(
        variant_type(msg, "conditions").isNotNull(),
        F.concat(F.lit('"conditions":'), conditions_text(conditions), F.lit(",")),
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit("{"),
        cond_part,
        F.lit('"price":'),
        _number_text(msg, "price"),
        F.lit(f',"source":"{SOURCE_NAME}","symbol":'),
        json_string(F.try_variant_get(msg, "$.symbol", "string")),
        F.lit(',"timestamp":'),
        json_string(F.try_variant_get(msg, "$.timestamp", "string")),
        F.lit(',"trade_timestamp_ms":'),
        F.try_variant_get(msg, "$.trade_timestamp_ms", "bigint").cast("string"),
        F.lit(',"volume":'),
        _number_text(msg, "volume"),
        F.lit("}"),
    )


def event_id_for_message() -> Column:
    """Of the column ``msg``: a non-empty ``event_id`` from the wire, else the derived one."""
    given = F.nullif(F.try_variant_get(F.col("msg"), "$.event_id", "string"), F.lit(""))
    return F.coalesce(given, sha256_hex(message_text_column()))
