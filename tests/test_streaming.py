"""Streaming queries over a file source with the log's record columns:
several micro-batches, a restart in the middle, a replayed batch; the result
must equal the one-batch computation."""

import os

from pyspark.sql import functions as F

from tickline.operators import validate
from tickline.sinks import archive, dead_letters
from tickline.sources.events import log_from_events, read_events
from tickline.streaming import queries as Q

from conftest import SF_SMALL

LOG_COLS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def write_log_files(spark, root, groups=3):
    """The test log split into ``groups`` files by arrival day."""
    log = log_from_events(read_events(spark, SF_SMALL))
    log = log.withColumn("g", F.least(F.floor(F.col("batch_id") * groups / 30), F.lit(groups - 1)))
    for g in range(groups):
        log.where(F.col("g") == g).select(*LOG_COLS).coalesce(1).write.mode("overwrite").parquet(os.path.join(root, f"g={g}"))
    return log


def move_in(src_root, dst, g):
    os.makedirs(dst, exist_ok=True)
    src = os.path.join(src_root, f"g={g}")
    for name in os.listdir(src):
        if name.endswith(".parquet"):
            os.link(os.path.join(src, name), os.path.join(dst, f"g{g}-{name}"))


def run_available(q_factory):
    q = q_factory()
    q.awaitTermination(300)
    assert q.exception() is None


def test_table_and_archive_streams_equal_batch(spark, workdir):
    staged = os.path.join(workdir, "staged")
    incoming = os.path.join(workdir, "incoming")
    log = write_log_files(spark, staged)
    trades = os.path.join(workdir, "trades")
    progress = os.path.join(workdir, "progress")
    bars_path = os.path.join(workdir, "bars")
    arch = os.path.join(workdir, "archive")
    dls = os.path.join(workdir, "dead_letters")
    ck_t = os.path.join(workdir, "ck_table")
    ck_a = os.path.join(workdir, "ck_archive")
    once = {"availableNow": True}

    def table_query():
        s = Q.read_log_stream(spark, incoming, max_files_per_trigger=1)
        return Q.start_table_query(s, trades, ck_t, once, progress_path=progress, bars_path=bars_path)

    def archive_query():
        s = Q.read_log_stream(spark, incoming, max_files_per_trigger=1)
        return Q.start_archive_query(s, arch, dls, ck_a, once)

    # first two files, then a restart with the third
    move_in(staged, incoming, 0)
    move_in(staged, incoming, 1)
    run_available(table_query)
    run_available(archive_query)
    move_in(staged, incoming, 2)
    run_available(table_query)
    run_available(archive_query)

    whole = log.select(*LOG_COLS)
    checked = validate.validate(whole, table_path=True)
    expected_ids = {r.event_id for r in validate.valid_messages(checked).select("event_id").distinct().collect()}
    stored = spark.read.parquet(trades)
    assert stored.count() == len(expected_ids)
    assert {r.event_id for r in stored.select("event_id").collect()} == expected_ids

    prog = spark.read.parquet(progress).orderBy("batch_id").collect()
    assert [p.batch_id for p in prog] == [0, 1, 2]
    assert sum(p.inserted for p in prog) == len(expected_ids)
    assert sum(p.received for p in prog) == validate.valid_messages(checked).count()

    # bars table refreshed for every touched date equals bars from the whole table
    from tickline.operators.bars import minute_bars
    from tickline.sinks.bars_table import read_bars

    b1 = {(r.symbol, r.minute): (r.open_price, r.close_price, r.trade_count) for r in read_bars(spark, bars_path).collect()}
    b2 = {(r.symbol, r.minute): (r.open_price, r.close_price, r.trade_count) for r in minute_bars(stored).collect()}
    assert b1 == b2

    # archive: every valid archive-path record once; dead letters once per rejected record
    a_checked = validate.validate(whole)
    assert archive.read_archive(spark, arch).count() == validate.valid_messages(a_checked).count()
    dl = dead_letters.read_dead_letters(spark, dls)
    assert dl.count() == validate.dead_letters(a_checked).count()
    assert dl.select("source_partition", "source_offset").distinct().count() == dl.count()


def test_touched_bars_refresh_equals_full_recompute(spark, workdir):
    from tickline.operators.bars import minute_bars
    from tickline.sinks import bars_table, trades_table
    from tickline.sources.events import trades_from_events

    t = trades_from_events(read_events(spark, SF_SMALL)).withColumn("batch", F.floor(F.dayofmonth("received_at") / 8))
    trades_path = os.path.join(workdir, "trades")
    bars_path = os.path.join(workdir, "bars")
    for b in sorted(r.batch for r in t.select("batch").distinct().collect()):
        part = t.where(F.col("batch") == b).drop("batch")
        trades_table.upsert_trades(part, trades_path)
        bars_table.refresh_touched_bars(spark, trades_path, bars_path, part)
    got = {(r.symbol, r.minute): (r.open_price, r.close_price, r.trade_count, r.volume) for r in bars_table.read_bars(spark, bars_path).collect()}
    want = {(r.symbol, r.minute): (r.open_price, r.close_price, r.trade_count, r.volume) for r in minute_bars(t).collect()}
    assert got == want


def test_replayed_batch_changes_nothing(spark, workdir):
    staged = os.path.join(workdir, "staged")
    incoming = os.path.join(workdir, "incoming")
    write_log_files(spark, staged, groups=2)
    move_in(staged, incoming, 0)
    trades = os.path.join(workdir, "trades")
    arch = os.path.join(workdir, "archive")
    dls = os.path.join(workdir, "dl")
    batch = spark.read.parquet(incoming)
    table_body = Q.table_batch(trades)
    archive_body = Q.archive_batch(arch, dls)
    table_body(batch, 0)
    archive_body(batch, 0)
    n_trades = spark.read.parquet(trades).count()
    n_arch = archive.read_archive(spark, arch).count()
    n_dl = dead_letters.read_dead_letters(spark, dls).count()
    # the same records again: after a crash before the checkpoint commit, and from a query that counts anew
    for number, part in ((0, batch), (7, batch.where("offset % 2 = 0")), (0, batch.where("offset % 2 = 1"))):
        table_body(part, number)
        archive_body(part, number)
    assert spark.read.parquet(trades).count() == n_trades
    assert archive.read_archive(spark, arch).count() == n_arch
    assert dead_letters.read_dead_letters(spark, dls).count() == n_dl


def test_publish_query_writes_wire_records(spark, workdir):
    from tickline.sources.events import vendor_frames_from_events

    frames_dir = os.path.join(workdir, "frames")
    vendor_frames_from_events(read_events(spark, SF_SMALL)).coalesce(2).write.text(frames_dir)
    out = os.path.join(workdir, "published")
    stream = spark.readStream.text(frames_dir)
    q = Q.start_publish_query(stream, out, os.path.join(workdir, "ck_pub"), {"availableNow": True})
    q.awaitTermination(300)
    pub = spark.read.parquet(out)
    sent = read_events(spark, SF_SMALL).where(F.col("event_type") != "error")
    bad = sent.where("event_id % 40 in (5, 6, 9, 10, 11, 12)").count()
    assert pub.count() == sent.count() - bad
    held = os.path.join(workdir, "quarantine")
    q = Q.start_quarantine_query(spark.readStream.text(frames_dir), held, os.path.join(workdir, "ck_q"), {"availableNow": True})
    q.awaitTermination(300)
    assert spark.read.parquet(held).count() == bad
    # records validate cleanly and keep their ids
    log = pub.select("key", "value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))
    checked = validate.validate(log)
    assert checked.where(F.col("error").isNotNull()).count() == 0


def test_watermarked_bars_stream(spark, workdir):
    from tickline.sources.events import trades_from_events
    from tickline.operators.bars import minute_bars

    src = os.path.join(workdir, "tr")
    t = trades_from_events(read_events(spark, SF_SMALL)).select("event_id", "symbol", "price", "volume", "trade_time")
    t.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(t.schema).parquet(src)
    out = os.path.join(workdir, "bars")
    q = Q.start_bars_query(stream, out, os.path.join(workdir, "ck_bars"), {"availableNow": True}, delay="0 seconds")
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    # append mode emits closed windows only: all but the last bar of the stream
    total = minute_bars(t).count()
    assert 0 < got.count() <= total


def test_kafka_options_and_reader(spark):
    sink = Q.kafka_writer("broker:9092", "trades")
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"
    assert sink["topic"] == "trades" and "subscribe" not in sink
    source = Q.kafka_reader("broker:9092", "trades", maxOffsetsPerTrigger="100")
    assert source["subscribe"] == "trades" and "topic" not in source and source["maxOffsetsPerTrigger"] == "100"
    # the file source has the Kafka record columns
    import tempfile

    d = tempfile.mkdtemp(prefix="tickline-log-")
    s = Q.read_log_stream(spark, d, max_files_per_trigger=2)
    assert s.isStreaming
    assert s.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]


def test_dedup_within_watermark(spark, workdir):
    from tickline.sources.events import trades_from_events

    src = os.path.join(workdir, "tr")
    t = trades_from_events(read_events(spark, SF_SMALL)).select("event_id", "symbol", "price", "volume", "trade_time")
    t.unionByName(t).coalesce(2).write.parquet(src)
    stream = spark.readStream.schema(t.schema).parquet(src)
    out = os.path.join(workdir, "dedup")
    q = (
        Q.dedup_within_watermark(stream, "1 hour")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", os.path.join(workdir, "ck_dedup"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    assert got.count() == t.count() == got.select("event_id").distinct().count()


def test_read_frames_text_and_status(spark, workdir):
    from tickline.operators import ingest, serve
    from tickline.sources.frames import read_frames
    from tickline.sources.events import vendor_frames_from_events

    d = os.path.join(workdir, "frames")
    vendor_frames_from_events(read_events(spark, SF_SMALL)).write.text(d)
    frames = read_frames(spark, d, streaming=False)
    n = ingest.normalize_trades(ingest.decode_frames(frames)).count()
    assert n == read_events(spark, SF_SMALL).where("event_type <> 'error' and event_id % 40 not in (5, 6, 9, 10, 11, 12)").count()
    assert read_frames(spark, d).isStreaming
    (missing,) = serve.table_status(spark, os.path.join(workdir, "nope")).collect()
    assert missing.available is False and missing.latest_received is None


def test_staged_log_files_and_their_splits_stay_small(spark, workdir, monkeypatch):
    """A larger log has more files of the same size and as many batches, and no task reads many of the files at once."""
    from tickline.plans import catalog
    from tickline.sources import layout

    monkeypatch.setattr(catalog, "balance", lambda df: layout.balance(df, rows=50))
    incoming, per_trigger = catalog._stage_log(spark, SF_SMALL, os.path.join(workdir, "staged"))
    staged = spark.read.parquet(incoming)
    held = [r["count"] for r in staged.groupBy(F.input_file_name()).count().collect()]
    assert len(held) >= 20 and max(held) <= 100
    assert 3 <= -(-len(held) // per_trigger) <= catalog.STREAM_FILES
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
