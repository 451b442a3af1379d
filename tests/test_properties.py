"""Property tests (hypothesis): Python float text, and the rule chain against a
small Python model of the validation rules."""

import hashlib
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickline.functions import rules
from tickline.functions.jsontext import python_float_text
from tickline.operators import validate

SETTINGS = dict(max_examples=100, deadline=None, suppress_health_check=list(HealthCheck))


@settings(**SETTINGS)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=20, max_size=60))
def test_python_float_text(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", python_float_text(F.col("x")).alias("t")).collect():
        assert r.t == repr(r.x), (r.x, r.t)


REQUIRED = ("price", "source", "symbol", "timestamp", "trade_timestamp_ms", "volume")


def model_error(msg):
    """Rules as stated (first failing wins); booleans are not numbers here."""
    if not isinstance(msg, dict):
        return rules.ERR_OBJECT
    missing = sorted(set(REQUIRED) - msg.keys())
    if missing:
        return rules.ERR_MISSING + ", ".join(missing)

    def num(v):
        return isinstance(v, (int, float)) and not isinstance(v, bool)

    if not isinstance(msg["symbol"], str) or not msg["symbol"].strip():
        return rules.ERR_SYMBOL
    if not num(msg["price"]) or msg["price"] <= 0:
        return rules.ERR_PRICE
    if not num(msg["volume"]) or msg["volume"] < 0:
        return rules.ERR_VOLUME
    if not isinstance(msg["timestamp"], str) or not msg["timestamp"]:
        return rules.ERR_TIMESTAMP
    if not isinstance(msg["trade_timestamp_ms"], int) or isinstance(msg["trade_timestamp_ms"], bool):
        return rules.ERR_MS
    if msg["source"] != "finnhub":
        return rules.ERR_SOURCE
    return None


scalar = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(min_value=-(10**12), max_value=10**15),
    st.floats(allow_nan=False, allow_infinity=False, min_value=-1e9, max_value=1e9).filter(lambda f: not f.is_integer()),
    st.sampled_from(["", "  ", "AAPL", "finnhub", "other", "2026-10-07T18:00:00+00:00"]),
)
field_value = {
    "symbol": st.one_of(st.sampled_from(["AAPL", " ", "", "x y"]), scalar),
    "price": st.one_of(st.floats(min_value=-5, max_value=500, allow_nan=False).filter(lambda f: not f.is_integer()), scalar),
    "volume": st.one_of(st.floats(min_value=-5, max_value=500, allow_nan=False).filter(lambda f: not f.is_integer()), scalar),
    "timestamp": st.one_of(st.sampled_from(["2026-10-07T18:00:00+00:00", ""]), scalar),
    "trade_timestamp_ms": st.one_of(st.integers(min_value=0, max_value=2**53), scalar),
    "source": st.one_of(st.just("finnhub"), scalar),
}
message = st.fixed_dictionaries({}, optional={**field_value, "conditions": st.lists(st.text(max_size=3), max_size=2), "venue": scalar})
anything = st.one_of(message, scalar, st.lists(scalar, max_size=2))


@settings(**SETTINGS)
@given(st.lists(anything, min_size=30, max_size=60))
def test_rule_chain_matches_model(spark, msgs):
    rows = [(json.dumps(m).encode(), "t", 0, i) for i, m in enumerate(msgs)]
    log = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    got = {r.offset: r.error for r in validate.validate(log).select("offset", "error").collect()}
    for i, m in enumerate(msgs):
        expected = model_error(m)
        # JSON has no integer/float distinction for 1.0 vs 1 once dumped: json.dumps(1.0) == "1.0" (a float)
        assert got[i] == expected, (m, got[i], expected)


wire_value = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-(10**25), 10**25), st.floats(allow_nan=False, allow_infinity=False).filter(lambda f: not f.is_integer()), st.text(max_size=4)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=3), inner, max_size=3)),
    max_leaves=6,
)


def nested(value, levels):
    """The value inside `levels` arrays and objects by turns, beside a null and a whole float."""
    for k in range(levels):
        value = [value, None, 1.0] if k % 2 else {"z": value, "a": None, "é": [1.0]}
    return value


@settings(**{**SETTINGS, "max_examples": 30})
@given(
    st.lists(
        st.tuples(
            st.text(min_size=1, max_size=6).filter(str.strip),
            st.floats(1e-320, 1e12).filter(lambda f: not f.is_integer()),
            st.one_of(wire_value, st.builds(nested, wire_value, st.integers(3, 6)), st.lists(st.one_of(st.none(), st.text(max_size=2)), max_size=3)),
        ),
        min_size=10,
        max_size=30,
    )
)
def test_derived_ids_match_python(spark, rows):
    """Ids of messages without one, for any symbol, price and conditions, against json and hashlib."""
    msgs = [
        {"symbol": s, "price": p, "volume": 10**20, "timestamp": "2026-10-07T18:00:00+00:00", "trade_timestamp_ms": 1, "source": "finnhub", "conditions": c}
        for s, p, c in rows
    ]
    log = spark.createDataFrame([(json.dumps(m).encode(), "t", 0, i) for i, m in enumerate(msgs)], "value binary, topic string, partition int, offset long")
    got = {r.offset: r.event_id for r in validate.valid_messages(validate.validate(log)).select("offset", "event_id").collect()}
    for i, m in enumerate(msgs):
        assert got[i] == hashlib.sha256(json.dumps(m, sort_keys=True, separators=(",", ":")).encode()).hexdigest(), m
