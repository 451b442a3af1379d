"""Rule matrix: one record per rule and edge case, first failing rule wins."""

import json

import pytest
from pyspark.sql import functions as F

from tickline.functions import rules
from tickline.operators import validate

GOOD = {
    "symbol": "AAPL",
    "price": 250.5,
    "volume": 100.0,
    "timestamp": "2026-10-07T18:00:00+00:00",
    "trade_timestamp_ms": 1791396000000,
    "conditions": ["@"],
    "source": "finnhub",
}


def with_(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is _DROP:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()

MISSING_ALL = "missing fields: price, source, symbol, timestamp, trade_timestamp_ms, volume"

CASES = [
    ("[1]", rules.ERR_OBJECT),
    ("3", rules.ERR_OBJECT),
    ("null", rules.ERR_OBJECT),
    (None, rules.ERR_OBJECT),
    ('{"symbol":"AAPL"}', "missing fields: price, source, timestamp, trade_timestamp_ms, volume"),
    ("{}", MISSING_ALL),
    (with_(symbol="  "), rules.ERR_SYMBOL),
    (with_(symbol=5), rules.ERR_SYMBOL),
    (with_(symbol=None), rules.ERR_SYMBOL),
    (with_(price=0), rules.ERR_PRICE),
    (with_(price=-1), rules.ERR_PRICE),
    (with_(price="250"), rules.ERR_PRICE),
    (with_(price=None), rules.ERR_PRICE),
    (with_(price=True), rules.ERR_PRICE),
    (with_(volume=-1), rules.ERR_VOLUME),
    (with_(volume="1"), rules.ERR_VOLUME),
    (with_(volume=None), rules.ERR_VOLUME),
    (with_(timestamp=""), rules.ERR_TIMESTAMP),
    (with_(timestamp=5), rules.ERR_TIMESTAMP),
    (with_(trade_timestamp_ms=1.0), rules.ERR_MS),
    (with_(trade_timestamp_ms="1"), rules.ERR_MS),
    (with_(source="other"), rules.ERR_SOURCE),
    (with_(source=None), rules.ERR_SOURCE),
    (with_(price=0, source="other"), rules.ERR_PRICE),
    ('{"a":1} x', rules.ERR_JSON),
    ("{'a':1}", rules.ERR_JSON),
    ("", rules.ERR_JSON),
    ('{"a":1},{"b":2}', rules.ERR_JSON),
    ('{"price": NaN}', rules.ERR_JSON),
    (b"\xffA", rules.ERR_UTF8),
    # valid
    (with_(volume=0), None),
    (with_(price=250), None),
    (with_(price=1e20), None),
    (with_(price=12345678901234567890), None),
    (with_(venue="X"), None),
    (with_(event_id="abc"), None),
    (with_(conditions=_DROP), None),
    (with_(timestamp="garbage"), None),
    ('{"symbol":"AAPL","price":0,"price":250.5,"volume":1.0,"timestamp":"t","trade_timestamp_ms":1,"source":"finnhub"}', None),
]


@pytest.fixture(scope="module")
def checked(spark):
    rows = [
        (None if v is None else (v if isinstance(v, bytes) else v.encode()), "t", 0, i)
        for i, (v, _) in enumerate(CASES)
    ]
    log = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    log = log.withColumn("key", F.lit(None).cast("binary"))
    archive = {r.offset: r.error for r in validate.validate(log).select("offset", "error").collect()}
    table = {r.offset: r.error for r in validate.validate(log, table_path=True).select("offset", "error").collect()}
    return archive, table


@pytest.mark.parametrize("i", range(len(CASES)))
def test_rule(checked, i):
    archive, _ = checked
    value, expected = CASES[i]
    assert archive[i] == expected, (value, archive[i])


def test_table_path_rejects_unparseable_timestamp(checked):
    archive, table = checked
    i = next(j for j, (v, _) in enumerate(CASES) if v == with_(timestamp="garbage"))
    assert archive[i] is None
    assert table[i] == rules.ERR_TIMESTAMP_PARSE
    # other records keep their archive-path result
    assert all(table[j] == archive[j] for j in archive if j != i and not (isinstance(CASES[j][0], str) and '"timestamp":"t"' in CASES[j][0]))


def test_dead_letters_keep_coordinates_and_text(spark, checked):
    log = spark.createDataFrame(
        [(b"\xffA", "trades", 2, 77), (with_(price=0).encode(), "trades", 1, 5), (with_().encode(), "trades", 0, 9)],
        "value binary, topic string, partition int, offset long",
    ).withColumn("key", F.lit(b"AAPL").cast("binary"))
    dl = {r.source_offset: r for r in validate.dead_letters(validate.validate(log)).collect()}
    assert set(dl) == {77, 5}
    assert dl[77].error == rules.ERR_UTF8 and dl[77].original_value == "�A"
    assert dl[5].error == rules.ERR_PRICE and dl[5].source_topic == "trades" and dl[5].source_partition == 1
    summary = {r.error: r.records for r in validate.rejection_summary(validate.validate(log)).collect()}
    assert summary == {rules.ERR_UTF8: 1, rules.ERR_PRICE: 1}


def test_duplicate_keys_last_wins(spark):
    log = spark.createDataFrame(
        [('{"symbol":"A","price":0,"price":2.5,"volume":1,"timestamp":"t","trade_timestamp_ms":1,"source":"finnhub"}'.encode(), "t", 0, 0)],
        "value binary, topic string, partition int, offset long",
    )
    (row,) = validate.valid_messages(validate.validate(log)).collect()
    assert row.price == 2.5


def test_dead_letter_messages_shape(spark):
    from tickline.sinks.dead_letters import dead_letter_messages

    log = spark.createDataFrame(
        [(b"AAPL", b"[1]", "trades", 2, 7)], "key binary, value binary, topic string, partition int, offset long"
    )
    (row,) = dead_letter_messages(validate.dead_letters(validate.validate(log))).collect()
    assert bytes(row.key) == b"AAPL"
    assert json.loads(row.value) == {
        "error": rules.ERR_OBJECT,
        "source_topic": "trades",
        "source_partition": 2,
        "source_offset": 7,
        "original_value": "[1]",
    }
