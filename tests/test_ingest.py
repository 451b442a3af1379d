"""Vendor frames, wire records and ids, by operator."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tickline.operators import ingest, validate

# Fixed values of FIXTURES.md, section 1 and 2.
ELEMENT = {"s": "AAPL", "p": 250.50, "v": 100, "t": 1791396000000, "c": ["@"]}
WORKED_ID = "f6ff8ab5b5edd62883461b5fef6aad7aadbc21b291de53adf718fd0ea3ee6120"
WIRE = {"symbol": "AAPL", "price": 250.5, "volume": 100.0, "timestamp": "2026-10-07T18:00:00+00:00", "trade_timestamp_ms": 1791396000000, "conditions": ["@"], "source": "finnhub"}


def python_id(wire):
    return hashlib.sha256(json.dumps(wire, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def frames(spark, *bodies):
    df = spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "value string")
    return ingest.decode_frames(df)


def checked(spark, *wires, table_path=False):
    rows = [(None, json.dumps(w).encode(), "t", 0, i) for i, w in enumerate(wires)]
    return validate.validate(spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long"), table_path)


@pytest.mark.parametrize(
    "change,conditions",
    [({}, ["@"]), ({"c": None}, None), ({"c": "x"}, "x"), ({"c": ["a", None, ""]}, ["a", None, ""]), ({"c": [[[{"z": 1.0, "a": {"b": [None]}}]]]}, [[[{"z": 1.0, "a": {"b": [None]}}]]]), ({"c": [1.0, {"b": 1, "a": "\u00e9"}]}, [1.0, {"b": 1, "a": "\u00e9"}]), ({"s": "\u00c5\x7f\U0001f642"}, ["@"]), ({"p": 1e-7}, ["@"]), ({"p": "251.5"}, ["@"])],
)
def test_normalized_ids(spark, change, conditions):
    element = {**ELEMENT, **change}
    row = ingest.normalize_trades(frames(spark, {"type": "trade", "data": [element]})).withColumn("conditions", F.to_json("conditions")).first()
    wire = {**WIRE, "symbol": element["s"], "price": float(element["p"]), "conditions": conditions}
    assert row.event_id == python_id(wire) and json.loads(row.conditions) == conditions
    if not change:
        assert row.event_id == WORKED_ID and row.timestamp == WIRE["timestamp"]


def test_absent_conditions_are_an_empty_list(spark):
    element = {k: v for k, v in ELEMENT.items() if k != "c"}
    row = ingest.normalize_trades(frames(spark, {"type": "trade", "data": [element]})).first()
    assert row.event_id == python_id({**WIRE, "conditions": []})


def test_unreadable_elements_go_to_the_rejects(spark):
    data = [ELEMENT, {**ELEMENT, "p": "abc"}, {**ELEMENT, "v": None}, {k: v for k, v in ELEMENT.items() if k != "s"}, {**ELEMENT, "t": "soon"}]
    vendor = frames(spark, {"type": "trade", "data": data}, {"type": "ping"}, "not json", {"type": "trade"})
    assert ingest.normalize_trades(vendor).count() == 1
    bad = ingest.normalize_rejects(vendor).collect()
    assert sorted(r.error[-1] for r in bad) == ["p", "s", "t", "v"]
    assert {json.loads(r.original_value).get("p") for r in bad} == {"abc", "250.5"}


@pytest.mark.parametrize("field,value", [("t", 99999999999999999), ("t", 10**18), ("t", 2**63 - 1), ("t", 253402300800000), ("p", "NaN"), ("p", "-Infinity"), ("v", "Infinity"), ("v", "1e999")])
def test_numbers_out_of_range_are_rejects(spark, field, value):
    vendor = frames(spark, {"type": "trade", "data": [ELEMENT, {**ELEMENT, field: value}]})
    assert [r.event_id for r in ingest.normalize_trades(vendor).collect()] == [WORKED_ID]
    assert [r.error[-1] for r in ingest.normalize_rejects(vendor).collect()] == [field]


def test_wire_records_validate_to_the_same_trade(spark):
    wire = ingest.to_wire(ingest.normalize_trades(frames(spark, {"type": "trade", "data": [ELEMENT, {**ELEMENT, "c": None}]})))
    bodies = [json.loads(bytes(r.value)) for r in wire.collect()]
    assert bytes(wire.first().key) == b"AAPL" and [b["conditions"] for b in bodies] == [["@"], None]
    out = validate.valid_messages(checked(spark, *bodies)).collect()
    assert [r.event_id for r in out] == [b["event_id"] for b in bodies] and not any(r.id_given for r in out)


def test_ids_on_the_wire(spark):
    whole = {**WIRE, "volume": 100}
    wires = [whole, {**whole, "event_id": ""}, {**whole, "event_id": "mine"}, {**whole, "event_id": python_id(whole)}, {k: v for k, v in whole.items() if k != "conditions"}]
    out = {r.offset: (r.event_id, r.id_given, r.conditions) for r in validate.valid_messages(checked(spark, *wires)).collect()}
    derived = python_id(whole)
    assert out == {0: (derived, False, '["@"]'), 1: (derived, False, '["@"]'), 2: ("mine", True, '["@"]'), 3: (derived, False, '["@"]'), 4: (python_id(wires[4]), False, None)}


@pytest.mark.parametrize("text,good", [("2026-10-07T18:00:00+00:00", True), ("2026-10-07", True), ("10:00", False), ("T10:00:05", False), ("2024", False), ("garbage", False)])
def test_the_table_takes_full_dates_only(spark, text, good):
    rows = validate.valid_messages(checked(spark, {**WIRE, "timestamp": text}, table_path=True))
    assert validate.to_table_rows(rows).where("trade_time is not null").count() == int(good)


def test_symbol_lists(spark):
    row = spark.sql("SELECT ' aapl, msft,, ' AS t").select(ingest.parse_symbols(F.col("t")).alias("s")).first()
    assert row.s == ["AAPL", "MSFT"]
