"""Structured Streaming entry points (see ``queries``)."""

from tickline.streaming.queries import (
    dedup_within_watermark,
    first_trades,
    kafka_reader,
    kafka_writer,
    start_quarantine_query,
    read_log_stream,
    start_archive_query,
    start_bars_query,
    start_publish_query,
    start_state_table_query,
    start_table_query,
    watermarked_bars,
)

__all__ = [
    "dedup_within_watermark",
    "first_trades",
    "kafka_reader",
    "kafka_writer",
    "start_quarantine_query",
    "read_log_stream",
    "start_archive_query",
    "start_bars_query",
    "start_publish_query",
    "start_state_table_query",
    "start_table_query",
    "watermarked_bars",
]
