"""Structured Streaming entry points.

Each query is a source → ``foreachBatch`` pipeline. Spark writes the batch's
offsets to the checkpoint before the batch runs and the commit after the
function returns, so a failed batch is re-run with the same records. Every sink
below inserts a record only where it is absent, told by its log coordinates or its
id and never by the batch number: re-runs, queries that start again from the first
offset and other batch bounds give the same tables (exactly-once results from
at-least-once delivery).

* archive query: validate → archive + dead letters (and, if asked, a dead-letter topic).
* table query: validate (strict timestamp) → insert-if-absent into ``trades``,
  optional bars refresh and a per-batch progress row.
* publish query: vendor frames → normalized, id-stamped wire records; elements that
  cannot be normalized go to a quarantine.
* bars query (opt-in): event-time tumbling bars with a watermark, append mode.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tickline.operators import ingest, validate
from tickline.schemas import BAR_COLUMNS, LOG_RECORD
from tickline.session import configure, scratch_path
from tickline.sinks import archive, bars_table, dead_letters, folders, metrics_table, trades_table


def read_log_stream(
    spark: SparkSession,
    source: str | dict[str, str],
    max_records_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """The trade log as a stream with the Kafka record columns.

    ``source`` is either Kafka options (``{"kafka.bootstrap.servers": ...,
    "subscribe": topic}``; read from the earliest offset, the checkpoint replaces
    consumer-group offsets) or a folder of Parquet files with the same columns.
    ``min_partitions`` splits large topic partitions into more input tasks per
    micro-batch (a topic with few partitions would otherwise cap the parallelism
    of validation at the partition count).
    """
    configure(spark)
    if isinstance(source, dict):
        reader = spark.readStream.format("kafka").option("startingOffsets", "earliest").option("failOnDataLoss", "true")
        for k, v in source.items():
            reader = reader.option(k, v)
        if max_records_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_records_per_trigger))
        if min_partitions:
            reader = reader.option("minPartitions", str(min_partitions))
        return reader.load()
    reader = spark.readStream.schema(LOG_RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(source)


def kafka_reader(bootstrap: str, topic: str, **extra: str) -> dict[str, str]:
    """Source options for a topic (see :func:`read_log_stream`)."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, **extra}


def kafka_writer(bootstrap: str, topic: str, **extra: str) -> dict[str, str]:
    """Sink options for a topic; the producer is idempotent and waits for all replicas."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true", **extra}


def _checkpoint(spark: SparkSession, checkpoint: str | None, name: str) -> str:
    return checkpoint or scratch_path(spark, f"streams/{name}")


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": "5 seconds"}))


def archive_batch(
    archive_root: str, dead_letter_root: str, fmt: str = "parquet", dead_letter_topic: dict[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of the archive query."""

    def run(batch: DataFrame, batch_id: int) -> None:
        checked = validate.validate(batch).persist()
        try:
            valid = validate.valid_messages(checked, extra=(F.col("key"), F.col("value")))
            archive.write_archive(archive.archive_rows(valid), archive_root, fmt)
            rejected = validate.dead_letters(checked)
            dead_letters.write_dead_letters(rejected, dead_letter_root)
            if dead_letter_topic:
                dead_letters.publish_dead_letters(rejected, dead_letter_topic)
        finally:
            checked.unpersist()

    return run


def start_archive_query(
    log_stream: DataFrame,
    archive_root: str,
    dead_letter_root: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    fmt: str = "parquet",
    dead_letter_topic: dict[str, str] | None = None,
) -> StreamingQuery:
    """``dead_letter_topic``: :func:`kafka_writer` options of a topic that gets the dead letters as well."""
    spark = log_stream.sparkSession
    writer = log_stream.writeStream.foreachBatch(archive_batch(archive_root, dead_letter_root, fmt, dead_letter_topic))
    writer = writer.option("checkpointLocation", _checkpoint(spark, checkpoint, "archive"))
    return _trigger(writer, trigger).queryName("trade_archive").start()


def table_batch(
    trades_path: str,
    progress_path: str | None = None,
    bars_path: str | None = None,
    bars_mode: str = "touched",
    metrics_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of the table query.

    ``metrics_path`` (with ``bars_path``): a table of bars with their indicators that
    follows the bars, see :mod:`tickline.sinks.metrics_table`.

    ``bars_mode``: ``"touched"`` re-aggregates only the (symbol, minute) bars the
    batch touched; ``"dates"`` recomputes whole touched dates. A progress row is told
    by its first record's coordinates, so that a replayed batch replaces its own row.
    It is written before the trades: a batch that is run again after a crash anywhere
    in between counts the same new trades, or finds the row of its first run.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = validate.validate(batch, table_path=True)
        if progress_path:
            checked = checked.persist()  # read twice
        rows = validate.to_table_rows(validate.valid_messages(checked)).persist()
        try:
            progress = (lambda result: _write_progress(checked, result, batch_id, progress_path)) if progress_path else None
            result = trades_table.upsert_trades(rows, trades_path, progress)
            if result.received and bars_path and bars_mode == "touched":
                bars_table.refresh_touched_bars(spark, trades_path, bars_path, rows)
            elif result.received and bars_path:
                bars_table.refresh_bars(spark, trades_path, bars_path, bars_table.touched_dates(rows))
            if result.received and bars_path and metrics_path:
                metrics_table.refresh_metrics(spark, bars_path, metrics_path, rows)
        finally:
            rows.unpersist()
            checked.unpersist()

    return run


PROGRESS = StructType(
    [StructField(c, LongType()) for c in ("batch_id", "received", "inserted", "duplicates", "rejected")]
    + [StructField("written_at", TimestampType()), StructField("first_record", StringType())]
)


def _write_progress(checked: DataFrame, result: trades_table.UpsertResult, batch_id: int, path: str) -> None:
    spark = checked.sparkSession
    first, rejected = checked.agg(F.min(F.struct("topic", "partition", "offset")), F.count_if(F.col("error").isNotNull())).first()
    if first is None:
        return
    name = f"{first['topic']}-{first['partition']}-{first['offset']}"
    before = folders.read_folders(spark, path, [folders.folder_name(spark, "first_record", name)], PROGRESS)
    earlier = before.collect() if before is not None else []
    # an earlier run of this batch may have inserted its trades already
    inserted = max([result.inserted, *[r.inserted for r in earlier]])
    if any((r.received, r.inserted, r.rejected) == (result.received, inserted, rejected) for r in earlier):
        return
    row = (batch_id, result.received, inserted, result.received - inserted, int(rejected), datetime.now(timezone.utc), name)
    (
        spark.createDataFrame([row], PROGRESS)
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("first_record")
        .parquet(path)
    )


def start_table_query(
    log_stream: DataFrame,
    trades_path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    progress_path: str | None = None,
    bars_path: str | None = None,
    bars_mode: str = "touched",
    metrics_path: str | None = None,
) -> StreamingQuery:
    spark = log_stream.sparkSession
    body = table_batch(trades_path, progress_path, bars_path, bars_mode, metrics_path)
    writer = log_stream.writeStream.foreachBatch(body)
    writer = writer.option("checkpointLocation", _checkpoint(spark, checkpoint, "table"))
    return _trigger(writer, trigger).queryName("trade_table").start()


def start_publish_query(
    frames_stream: DataFrame,
    sink: str | dict[str, str],
    checkpoint: str | None = None,
    trigger: dict | None = None,
    column: str = "value",
) -> StreamingQuery:
    """Vendor frames → normalized trades with ids → keyed wire records.

    ``sink`` is Kafka options (:func:`kafka_writer`) or a folder (Parquet file
    sink, exactly-once). Spark's Kafka sink is at-least-once; the table query's
    insert-if-absent removes repeats downstream. Elements that cannot be normalized
    are the output of :func:`start_quarantine_query`.
    """
    spark = frames_stream.sparkSession
    records = ingest.to_wire(ingest.normalize_trades(ingest.decode_frames(frames_stream, column)))
    writer = _to(records, sink).option("checkpointLocation", _checkpoint(spark, checkpoint, "publish"))
    return _trigger(writer, trigger).queryName("trade_publish").start()


def start_quarantine_query(
    frames_stream: DataFrame,
    sink: str | dict[str, str],
    checkpoint: str | None = None,
    trigger: dict | None = None,
    column: str = "value",
) -> StreamingQuery:
    """The vendor elements that :func:`start_publish_query` cannot normalize, with the reason: a folder of
    (error, original_value), or JSON messages on a topic."""
    spark = frames_stream.sparkSession
    rejects = ingest.normalize_rejects(ingest.decode_frames(frames_stream, column))
    if isinstance(sink, dict):
        rejects = rejects.select(F.to_json(F.struct("error", "original_value")).alias("value"))
    writer = _to(rejects, sink).option("checkpointLocation", _checkpoint(spark, checkpoint, "quarantine"))
    return _trigger(writer, trigger).queryName("trade_quarantine").start()


def _to(rows: DataFrame, sink: str | dict[str, str]):
    if isinstance(sink, dict):
        return rows.writeStream.format("kafka").options(**sink)
    return rows.writeStream.format("parquet").option("path", sink)


def watermarked_bars(trades_stream: DataFrame, delay: str = "1 minute", width: str = "1 minute") -> DataFrame:
    """Event-time tumbling bars for a trades stream (opt-in mode).

    Emits a bar once the watermark passes its end; trades later than ``delay``
    are dropped by the watermark, unlike the table + refresh path which never
    drops late trades. Moving averages over bars are not available here (Spark
    refuses row frames on streams); compute them on the bars sink.
    """
    order = F.struct("trade_time", "event_id")
    t = trades_stream.withColumn("trade_time", F.col("trade_time").cast("timestamp"))
    return (
        t.withWatermark("trade_time", delay)
        .groupBy("symbol", F.window("trade_time", width).alias("w"))
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
            (F.sum(F.col("price") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0.0))).alias("vwap"),
        )
        .select("symbol", F.col("w.start").alias("minute"), *BAR_COLUMNS[2:])
    )


def first_trades(log_stream: DataFrame) -> DataFrame:
    """Table rows of a log stream, the first of each ``event_id`` over the whole life of the query.

    The ids seen are keyed state (no watermark, so a repeat may come any time later);
    the table is not looked at. Which of several copies inside one micro-batch stays is
    not defined: copies of a hashed id are equal, those of a given id may differ.
    """
    rows = validate.to_table_rows(validate.valid_messages(validate.validate(log_stream, table_path=True)))
    return trades_table.with_folders(rows).select(*trades_table.TABLE_COLUMNS, *trades_table.FOLDERS).dropDuplicates(["event_id"])


def start_state_table_query(log_stream: DataFrame, trades_path: str, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """The trades table by keyed state instead of table probes, in an exactly-once file sink.

    State lives in the RocksDB state store (on executors' disks, with changelogs in the
    checkpoint), so it may grow far beyond memory; it is spread over
    ``spark.sql.shuffle.partitions`` of the first start, which a checkpoint keeps. To be
    used where probing the table per batch costs more than keeping its ids, and the
    checkpoint lives as long as the table does. Only this query may write the table.
    """
    spark = log_stream.sparkSession
    writer = first_trades(log_stream).writeStream.outputMode("append").format("parquet").option("path", trades_path).partitionBy(*trades_table.FOLDERS)
    writer = _trigger(writer.option("checkpointLocation", _checkpoint(spark, checkpoint, "table-state")), trigger).queryName("trade_table_state")
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        return writer.start()  # takes a copy of the session's settings
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def dedup_within_watermark(trades_stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Opt-in bounded dedup for a trades stream: drops a repeated ``event_id``
    seen within ``delay`` of event time, keeping state only for that span. The
    default path (``start_table_query``) dedups against the whole table instead,
    with no bound on how late a repeat may arrive."""
    t = trades_stream.withColumn("trade_time", F.col("trade_time").cast("timestamp"))
    return t.withWatermark("trade_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def start_bars_query(
    trades_stream: DataFrame,
    path: str,
    checkpoint: str | None = None,
    trigger: dict | None = None,
    delay: str = "1 minute",
) -> StreamingQuery:
    spark = trades_stream.sparkSession
    writer = watermarked_bars(trades_stream, delay).writeStream.outputMode("append").format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", _checkpoint(spark, checkpoint, "bars"))
    return _trigger(writer, trigger).queryName("trade_bars").start()


__all__ = [
    "read_log_stream",
    "kafka_reader",
    "kafka_writer",
    "start_quarantine_query",
    "start_archive_query",
    "start_table_query",
    "start_publish_query",
    "start_bars_query",
    "watermarked_bars",
    "dedup_within_watermark",
    "first_trades",
    "start_state_table_query",
]
