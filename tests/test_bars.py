"""Bars, indicators and serving: hand-made cases and invariants."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tickline.operators import audit, bars, serve
from tickline.sources.events import read_events, trades_from_events

from conftest import SF_MID, SF_SMALL

T0 = dt.datetime(2026, 10, 7, 18, 0, 0)
SCHEMA = "event_id string, symbol string, price double, volume double, trade_time timestamp"


def trades(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_open_close_tie_break_on_event_id(spark):
    t = T0 + dt.timedelta(seconds=5)
    rows = [
        ("b", "X", 2.0, 1.0, t),
        ("a", "X", 1.0, 1.0, t),  # same time: "a" opens, "b" closes
        ("c", "X", 9.0, 2.0, T0 + dt.timedelta(seconds=1)),
        ("d", "X", 3.0, 0.0, T0 + dt.timedelta(seconds=5)),
    ]
    (b,) = bars.minute_bars(trades(spark, rows)).collect()
    assert b.open_price == 9.0  # earliest time
    assert b.close_price == 3.0  # latest time, largest id among ties ("d")
    assert b.high_price == 9.0 and b.low_price == 1.0
    assert b.trade_count == 4 and b.volume == 4.0
    assert abs(b.vwap - (2 + 1 + 18 + 0) / 4.0) < 1e-12


def test_vwap_null_on_zero_volume(spark):
    (b,) = bars.minute_bars(trades(spark, [("a", "X", 5.0, 0.0, T0)])).collect()
    assert b.vwap is None


def test_moving_averages_count_bars_not_minutes(spark):
    # bars at minutes 0, 1, 10, 11, 100: the 5-bar average at the last one spans all 5
    rows = [(str(i), "X", float(i + 1), 1.0, T0 + dt.timedelta(minutes=m)) for i, m in enumerate([0, 1, 10, 11, 100])]
    m = bars.one_minute_metrics(trades(spark, rows)).orderBy("minute").collect()
    assert m[-1].moving_average_5 == 3.0
    assert m[0].rolling_volatility_15 is None
    assert m[1].moving_average_15 == 1.5
    seg = serve.gap_segments_by_symbol(bars.minute_bars(trades(spark, rows))).orderBy("minute").collect()
    assert [r.segment for r in seg] == [0, 0, 1, 1, 2]


def test_bars_invariant_under_shuffle_and_duplication(spark):
    base = trades_from_events(read_events(spark, SF_SMALL)).select("event_id", "symbol", "price", "volume", "trade_time")
    rows = base.collect()
    random.Random(7).shuffle(rows)
    shuffled = spark.createDataFrame(rows, base.schema).repartition(7)
    key = ["symbol", "minute"]
    a = bars.minute_bars(base).orderBy(key).collect()
    b = bars.minute_bars(shuffled).orderBy(key).collect()
    assert [(r.open_price, r.close_price, r.high_price, r.low_price, r.trade_count) for r in a] == [
        (r.open_price, r.close_price, r.high_price, r.low_price, r.trade_count) for r in b
    ]
    # duplicates of a trade (same id) do not change open/close/high/low
    doubled = bars.minute_bars(base.unionByName(base)).orderBy(key).collect()
    assert [(r.open_price, r.close_price, r.high_price, r.low_price) for r in a] == [
        (r.open_price, r.close_price, r.high_price, r.low_price) for r in doubled
    ]


def test_ohlcv_invariants_and_volume_conservation(spark):
    t = trades_from_events(read_events(spark, SF_MID))
    m = bars.one_minute_metrics(t)
    (v,) = audit.ohlcv_violations(m).collect()
    assert v.invalid_rows == 0 and v.bars > 0
    bad_vwap = m.where((F.col("vwap") < F.col("low_price") - 1e-9) | (F.col("vwap") > F.col("high_price") + 1e-9)).count()
    assert bad_vwap == 0
    total_trades = t.agg(F.sum("volume")).first()[0]
    total_bars = m.agg(F.sum("volume")).first()[0]
    assert abs(total_trades - total_bars) < 1e-6
    (u,) = audit.unique_ids(t).collect()
    assert u.ok and u.total == u.unique_ids


def test_latest_day_from_bars_equals_full_view(spark):
    t = trades_from_events(read_events(spark, SF_MID))
    b = bars.minute_bars(t)
    for symbol in ("VIEW", "CLICK"):
        full = serve.latest_day_metrics(bars.indicators(b), symbol).collect()
        pruned = serve.latest_day_metrics_from_bars(b, symbol).collect()
        assert len(full) == len(pruned) == 120
        for x, y in zip(full, pruned):
            assert x.minute == y.minute and x.close_price == y.close_price
            assert abs(x.moving_average_15 - y.moving_average_15) < 1e-9
            assert (x.rolling_volatility_15 is None) == (y.rolling_volatility_15 is None)


def test_warm_up_follows_the_frames(spark):
    b = bars.minute_bars(trades_from_events(read_events(spark, SF_SMALL), squeeze=20))
    for frames in ({"short": 3, "long": 60, "vol": 40}, {"short": 30, "long": 2, "vol": 2}):
        full = serve.latest_day_metrics(bars.indicators(b, **frames), "VIEW").collect()
        pruned = serve.latest_day_metrics_from_bars(b, "VIEW", **frames).collect()
        name = f"moving_average_{max(frames['short'], frames['long'])}"
        assert [round(r[name], 9) for r in full] == [round(r[name], 9) for r in pruned]


def test_latest_bar_and_feed_summary(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    m = bars.one_minute_metrics(t)
    latest = {r.symbol: (r.minute, round(r.moving_average_15, 9)) for r in serve.latest_bar_per_symbol(bars.minute_bars(t)).collect()}
    expected = {r.symbol: (r.b.minute, round(r.b.moving_average_15, 9)) for r in m.groupBy("symbol").agg(F.max_by(F.struct("minute", "moving_average_15"), "minute").alias("b")).collect()}
    assert latest == expected
    texts = serve.feed_caption_texts(serve.feed_summary(t)).first()
    newest = serve.latest_trades(t).first()
    assert texts.last_event == newest.trade_time.strftime("%H:%M:%S UTC") and texts.latest_trade == f"{newest.symbol}  ${newest.price:.2f}"
    feed = serve.latest_trades(t).collect()
    (s,) = serve.feed_summary(t).collect()
    assert s.rows_displayed == len(feed) == 200
    assert s.latest_symbol == feed[0].symbol and s.latest_price == feed[0].price
    (f,) = serve.freshness(t).collect()
    assert f.available and f.latest_received is not None
    long = serve.long_form(serve.gap_segments(serve.latest_day_metrics(m, "VIEW")))
    assert long.count() == 3 * serve.latest_day_metrics(m, "VIEW").count()


def test_caption_texts_match_python_formatting(spark):
    t = trades_from_events(read_events(spark, SF_MID))
    m = bars.one_minute_metrics(t)
    for symbol in ("VIEW", "CLICK", "ERROR"):
        s = serve.latest_bar_summary(serve.latest_day_metrics(m, symbol))
        (raw,) = s.collect()
        (txt,) = serve.caption_texts(s).collect()
        assert txt.caption == "Latest completed minute: " + raw.minute.strftime("%Y-%m-%d %H:%M UTC")
        assert txt.close == f"${raw.close_price:.2f}"
        assert txt.change == f"{raw.price_change:.2f}"
        assert txt.high == f"${raw.high_price:.2f}" and txt.low == f"${raw.low_price:.2f}"
        assert txt.volume == f"{raw.volume:,.0f}"
        assert txt.vwap == f"${raw.vwap:.2f}"
        assert txt.trades == f"{raw.trade_count:,.0f}"


def test_format_number_half_even_like_python(spark):
    vals = [2.5, 3.5, 2.675, 1.005, 1234567.125, 0.125, 1e6 + 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", F.format_number("x", 2).alias("two"), F.format_number("x", 0).alias("zero")).collect():
        assert r.two == f"{r.x:,.2f}", r
        assert r.zero == f"{r.x:,.0f}", r


def test_latest_day_completed_only(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    m = bars.one_minute_metrics(t)
    full = serve.latest_day_metrics(m, "VIEW").collect()
    last = full[-1].minute
    cut = serve.latest_day_metrics(m, "VIEW", completed_before=last).collect()
    day = last.replace(hour=0, minute=0)
    earlier = sorted(r.minute for r in m.where(F.col("symbol") == "VIEW").collect() if day <= r.minute < last)
    assert [r.minute for r in cut] == earlier[-120:]
    # indicators of the kept bars are unchanged
    same = {r.minute: r.moving_average_15 for r in full}
    assert all(same[r.minute] == r.moving_average_15 for r in cut if r.minute in same)
