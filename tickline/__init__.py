"""tickline: a Spark-native trade-stream engine.

Raw trade frames are decoded and normalized, every trade gets a deterministic id,
records are validated (bad ones go to a dead-letter table with the reason and the
source offset), valid ones land in a replay-safe archive and a deduplicated trades
table, and one-minute OHLCV bars with VWAP, moving averages and rolling volatility
are served together with the feed, latest-day, gap-segment and data-quality queries.

Everything is a DataFrame transformation; the streaming entry points wrap the same
functions in Structured Streaming queries.
"""

from tickline.session import configure, get_session

__all__ = ["configure", "get_session"]
