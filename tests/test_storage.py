"""Insert-if-absent table, archive round trip and replay safety."""

import os

from pyspark.sql import functions as F

from tickline.operators import validate
from tickline.sinks import archive, trades_table
from tickline.sources.events import log_from_events, read_events

from conftest import SF_SMALL


def table_rows(spark, log):
    # 30 daily batches folded into 4 larger ones to keep the test short.
    rows = validate.to_table_rows(validate.valid_messages(validate.validate(log, table_path=True), extra=(F.col("batch_id"),)))
    return rows.withColumn("batch_id", F.floor(F.col("batch_id") / 8))


def test_upsert_batches_and_replay(spark, workdir):
    log = log_from_events(read_events(spark, SF_SMALL))
    rows = table_rows(spark, log).persist()
    path = os.path.join(workdir, "trades")
    batches = sorted(r.batch_id for r in rows.select("batch_id").distinct().collect())
    seen = set()
    total_inserted = 0
    for b in batches:
        part = rows.where(F.col("batch_id") == b).drop("batch_id")
        ids = [r.event_id for r in part.select("event_id").collect()]
        res = trades_table.upsert_trades(part, path)
        expected_new = len(set(ids) - seen)
        assert res.received == len(ids)
        assert res.inserted == expected_new, b
        assert res.duplicates == len(ids) - expected_new
        seen |= set(ids)
        total_inserted += res.inserted
    # replaying a batch inserts nothing
    again = trades_table.upsert_trades(rows.where(F.col("batch_id") == batches[0]).drop("batch_id"), path)
    assert again.inserted == 0 and again.received > 0
    stored = spark.read.parquet(path)
    assert stored.count() == total_inserted == len(seen)
    assert stored.select("event_id").distinct().count() == stored.count()
    # first copy by (partition, offset) wins inside a batch; the stored copy is the first delivery
    assert stored.where(F.col("conditions").isNull()).count() == 0
    # an id given to another trade is found on any date, a hashed one on its own
    first = rows.where(~F.col("id_given")).limit(1).drop("batch_id")
    moved = first.withColumns({"trade_time": F.col("trade_time") + F.expr("INTERVAL 400 DAYS"), "id_given": F.lit(True)})
    assert trades_table.upsert_trades(moved, path).inserted == 0
    assert trades_table.upsert_trades(first.withColumn("event_id", F.lit("new")), path).inserted == 1


def test_archive_keeps_whole_messages_once(spark, workdir):
    bodies = ['{"a":"line\nbreak","x":1}', '  {"a":" pad "}  ', '{"q":"say \\"hi\\", ok"}', "", "\\N"]
    rows = [("id%d" % i, 1.5, 2.0, "2024-01-02T03:04:05", 5, None if i else '{"b":[1]}', "finnhub", "k", b, "t", 0, i, "A B", "2024-01-02") for i, b in enumerate(bodies)]
    from tickline.schemas import ARCHIVE

    df = spark.createDataFrame(rows, ARCHIVE)
    for fmt in ("parquet", "csv"):
        root = os.path.join(workdir, fmt)
        archive.write_archive(df.where("source_offset < 3"), root, fmt)
        archive.write_archive(df.where("source_offset > 0"), root, fmt)  # another batch, which overlaps
        archive.write_archive(df, root, fmt)
        back = archive.read_archive(spark, root, fmt=fmt).orderBy("source_offset").collect()
        want = [b for b in bodies if fmt == "parquet" or b != "\\N"]
        assert [r.body for r in back][: len(want)] == want and len(back) == len(rows)
        assert [r.conditions for r in back] == ['{"b":[1]}', None, None, None, None]


def test_files_are_sorted_and_compacted(spark, workdir):
    from tickline.sources.events import trades_from_events

    path = os.path.join(workdir, "trades")
    t = trades_from_events(read_events(spark, SF_SMALL))
    trades_table.upsert_trades(t.where("trade_timestamp_ms % 2 = 0"), path)
    trades_table.upsert_trades(t.where("trade_timestamp_ms % 2 = 1"), path)
    trades_table.compact_dates(spark, path, [])
    trades_table.compact_dates(spark, path, ["2024-01-01"], files_per_date=4)
    files = trades_table.data_files(spark, path, ["2024-01-01"])
    assert len(files) == 4 and spark.read.parquet(path).count() == t.count()
    for f in files:
        held = [(r.symbol, r.trade_time) for r in spark.read.parquet(f).collect()]
        assert held == sorted(held)


def test_archive_round_trip(spark, workdir):
    log = log_from_events(read_events(spark, SF_SMALL))
    valid = validate.valid_messages(validate.validate(log), extra=(F.col("key"), F.col("value")))
    rows = archive.archive_rows(valid).persist()
    root = os.path.join(workdir, "archive")
    archive.write_archive(rows, root)
    n = rows.count()
    # a part of the log again, in another batch
    archive.write_archive(rows.where("source_offset % 3 = 0"), root)
    back = archive.read_archive(spark, root)
    assert back.count() == n
    # partition filters and schema
    sym = archive.read_archive(spark, root, symbol="VIEW", dates=("2024-01-01", "2024-01-01"))
    assert sym.where(F.col("symbol") != "VIEW").count() == 0
    assert dict(sym.dtypes)["date"] == "string"
    files = archive.list_archive(spark, root, "*.parquet")
    assert files.count() > 0 and files.where(F.col("length") <= 0).count() == 0
    # what was archived replays to the same valid messages
    again = validate.valid_messages(validate.validate(archive.archive_log(back)))
    assert {tuple(r) for r in again.select("event_id", "conditions", "offset").collect()} == {tuple(r) for r in valid.select("event_id", "conditions", "offset").collect()}


def test_offset_spans_round_trip(spark):
    log = log_from_events(read_events(spark, SF_SMALL))
    spans = archive.offset_spans(log).orderBy("batch_id").collect()
    parsed = spark.createDataFrame([(s.offset_span,) for s in spans], "s string").select(archive.parse_offset_span(F.col("s")).alias("p"))
    for span, row in zip(spans, parsed.collect()):
        assert [p.partition for p in row.p] == sorted(p.partition for p in row.p)
        assert sum(p.last_offset - p.first_offset + 1 for p in row.p) == span.span_width


def test_conditions_text_both_forms(spark):
    df = spark.createDataFrame([('["@"]',), ("['@', 'T']",), ("[]",), (None,)], "c string")
    got = [r.a for r in df.select(archive.conditions_array(F.col("c")).alias("a")).collect()]
    assert got == [["@"], ["@", "T"], [], []]


def test_latest_trades_from_table_prunes_dates(spark, workdir):
    from tickline.operators import serve
    from tickline.sources.events import trades_from_events

    # unsqueezed events span 30 days -> 30 trade_date partitions
    t = trades_from_events(read_events(spark, SF_SMALL), squeeze=1)
    path = os.path.join(workdir, "trades")
    trades_table.upsert_trades(t, path)
    assert len(trades_table.partition_values(spark, path)) == 30
    for symbol, limit in ((None, 200), ("VIEW", 50), ("VIEW", 10_000)):
        got = [tuple(r) for r in trades_table.latest_trades(spark, path, symbol, limit).collect()]
        want = [tuple(r) for r in serve.latest_trades(t, symbol, limit).collect()]
        assert got == want


def test_compaction_and_date_refresh(spark, workdir):
    from tickline.operators.bars import minute_bars
    from tickline.sinks import bars_table
    from tickline.sources.events import trades_from_events

    t = trades_from_events(read_events(spark, SF_SMALL), squeeze=1)
    path = os.path.join(workdir, "trades")
    # many small appends, then compaction of two dates
    for d in range(1, 6):
        trades_table.upsert_trades(t.where(F.dayofmonth("trade_time") == d), path)
    before = spark.read.parquet(path)
    n = before.count()
    trades_table.compact_dates(spark, path, ["2024-01-01", "2024-01-02"])
    after = spark.read.parquet(path)
    assert after.count() == n
    files = archive.list_archive(spark, os.path.join(path, "trade_date=2024-01-01"), "*.parquet").count()
    assert files == 1
    # whole-date bar refresh equals bars of the stored trades
    bars_path = os.path.join(workdir, "bars")
    bars_table.refresh_bars(spark, path, bars_path, bars_table.touched_dates(after))
    got = {(r.symbol, r.minute): r.trade_count for r in bars_table.read_bars(spark, bars_path).collect()}
    want = {(r.symbol, r.minute): r.trade_count for r in minute_bars(after).collect()}
    assert got == want


def test_query_dataframe_parameters(spark):
    from tickline.operators import serve

    df = serve.query_dataframe(spark, "SELECT :a + 1 AS x, :s AS s", a=41, s="VIEW")
    assert df.collect()[0].asDict() == {"x": 42, "s": "VIEW"}


def _numbered(spark, ids, day="2024-01-05", given=True):
    rows = spark.createDataFrame([(i,) for i in ids], "event_id string")
    return rows.selectExpr(
        "event_id", "'A' AS symbol", "1.0D AS price", "1.0D AS volume", f"TIMESTAMP '{day} 10:00:00' AS trade_time", "0L AS trade_timestamp_ms",
        "'[]' AS conditions", "'s' AS source", "TIMESTAMP '2024-01-09 00:00:00' AS received_at", f"{str(given).lower()} AS id_given",
    )


def test_given_ids_read_their_buckets_only(spark, workdir):
    from tickline.sinks import folders, id_index

    path = os.path.join(workdir, "trades")
    known = [f"id {k}" for k in range(3000)]
    assert trades_table.upsert_trades(_numbered(spark, known), path).inserted == 3000
    hexes = ["ab" * 32, "cd" * 32]
    assert trades_table.upsert_trades(_numbered(spark, hexes[:1], given=False), path).inserted == 1
    id_index.compact(spark, path)
    assert not folders.files(spark, [f"{id_index.root_of(path)}/kind=free/bucket=new"])
    # found on another date than the batch's, new ids beside them
    again = trades_table.upsert_trades(_numbered(spark, ["id 7", "id 2999", "id x"], day="2025-06-01"), path)
    assert (again.received, again.inserted) == (3, 1)
    # a given id that is the hash of another trade, and a hash that was given to another trade
    assert trades_table.upsert_trades(_numbered(spark, hexes, day="2025-06-02"), path).inserted == 1
    assert trades_table.upsert_trades(_numbered(spark, hexes[1:], day="2025-06-03", given=False), path).inserted == 0
    id_index.compact(spark, path)
    firsts = trades_table.with_folders(_numbered(spark, ["id 5", "id 6"])).withColumn("id_kind", id_index.kind())
    free, hexed, hashed = firsts.agg(*id_index.asked_buckets(firsts)).first()
    hits = id_index.lookup(firsts, path, free, hexed, hashed)
    assert hits.count() == 2
    read = {f.split("/")[-2] for f in hits.inputFiles()}
    assert read == {f"bucket={b}" for b in free} and 1 <= len(read) <= 2
    # an index that is lost is made again
    folders.delete(spark, [id_index.root_of(path)])
    assert trades_table.upsert_trades(_numbered(spark, ["id 7", "id y"], day="2025-06-01"), path).inserted == 1


def test_an_index_entry_without_its_trade_hides_nothing(spark, workdir):
    from tickline.sinks import id_index

    path = os.path.join(workdir, "trades")
    trades_table.upsert_trades(_numbered(spark, ["a"]), path)
    lost = trades_table.with_folders(_numbered(spark, ["b", "c"]))
    id_index.append(lost, path)  # a crash before the trades were written
    assert trades_table.upsert_trades(_numbered(spark, ["a", "b", "c"]), path).inserted == 2
    assert spark.read.parquet(path).count() == 3


def test_wide_topics_and_blocks(spark, workdir):
    from tickline.sinks import coordinates, dead_letters

    log = spark.range(20000).selectExpr("'k' AS key", "'e' AS error", "'t' AS source_topic", "cast(id % 5000 AS int) AS source_partition", "id div 5000 + 999998 AS source_offset", "'v' AS original_value")
    log = log.withColumn("key", F.col("key").cast("binary"))
    root = os.path.join(workdir, "dead")
    dead_letters.write_dead_letters(log.where("source_offset < 1000000"), root)
    dead_letters.write_dead_letters(log, root)
    dead_letters.write_dead_letters(log.where("source_partition % 2 = 0"), root)
    back = dead_letters.read_dead_letters(spark, root)
    assert back.count() == 20000 == back.select("source_partition", "source_offset").distinct().count()
    assert sorted(os.listdir(root))[-2:] == ["offset_block=0", "offset_block=1"]
    assert coordinates.not_stored(log, back, *dead_letters.COORDINATES).count() == 0


def test_a_batch_lists_its_own_folders(spark, workdir):
    from tickline.sinks import folders

    path = os.path.join(workdir, "trades")
    for d in range(1, 6):
        trades_table.upsert_trades(_numbered(spark, [f"id {d}"], day=f"2024-01-0{d}"), path)
    part = trades_table.read_dates(spark, path, ["2024-01-02", "2030-01-01"])
    assert len(part.inputFiles()) == 1 and "trade_date=2024-01-02" in part.inputFiles()[0]
    assert trades_table.read_dates(spark, path, ["2030-01-01"]) is None and trades_table.read_trades(spark, path + "-none") is None
    assert folders.folder_name(spark, "symbol", "A/B") == "symbol=A%2FB" and folders.folder_name(spark, "symbol", None).endswith("HIVE_DEFAULT_PARTITION__")


def test_faults_other_than_no_table_are_errors(spark, workdir):
    import pytest

    bad = os.path.join(workdir, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        trades_table.read_trades(spark, bad).count()


def test_bar_versions(spark, workdir):
    from tickline.sinks import bars_table

    path, bars_path = os.path.join(workdir, "trades"), os.path.join(workdir, "bars")
    for n, ids in enumerate((["a", "b"], ["c"], ["c", "d"])):
        batch = _numbered(spark, ids)
        trades_table.upsert_trades(batch, path)
        assert bars_table.refresh_touched_bars(spark, path, bars_path, batch) == 1
        # a reader that started before, or that starts now, sees the whole date
        assert [r.trade_count for r in bars_table.read_bars(spark, bars_path).collect()] == [2 + n]
    open_reader = bars_table.read_bars(spark, bars_path, ["2024-01-05"])
    assert len(open_reader.inputFiles()) == 3
    bars_table.compact_bars(spark, bars_path, ["2024-01-05", "2024-01-06"])
    after = bars_table.read_bars(spark, bars_path, ["2024-01-05"])
    assert len(after.inputFiles()) == 1 and [r.trade_count for r in after.collect()] == [4]
    assert bars_table.read_bars(spark, bars_path, ["1999-01-01"]).count() == 0


def test_stored_metrics_follow_late_trades(spark, workdir):
    from tickline.operators.bars import one_minute_metrics
    from tickline.sinks import bars_table, metrics_table
    from tickline.sources.events import trades_from_events

    # sparse bars over 30 dates, of which later batches touch single ones, in the middle too
    t = trades_from_events(read_events(spark, SF_SMALL), squeeze=1).persist()
    path, bars_path, root = (os.path.join(workdir, n) for n in ("trades", "bars", "metrics"))
    late = F.dayofmonth("trade_time").isin(9, 20) & (F.minute("trade_time") % 2 == 0)
    for batch in (t.where(~late & (F.dayofmonth("trade_time") < 25)), t.where(late & (F.dayofmonth("trade_time") == 9)), t.where((F.dayofmonth("trade_time") >= 25)), t.where(late & (F.dayofmonth("trade_time") == 20))):
        trades_table.upsert_trades(batch, path)
        bars_table.refresh_touched_bars(spark, path, bars_path, batch)
        metrics_table.refresh_metrics(spark, bars_path, root, batch)
    names = ("symbol", "minute", "close_price", "moving_average_5", "moving_average_15", "rolling_volatility_15", "trade_count")
    rounded = lambda df: {tuple(round(r[c], 6) if isinstance(r[c], float) else r[c] for c in names) for r in df.collect()}
    want = rounded(one_minute_metrics(t))
    assert rounded(metrics_table.read_metrics(spark, root)) == want
    first, last = (spark.read.parquet(f"{root}/refresh={n}").count() for n in (1, 4))
    assert last < first / 2  # a late day rewrites its own rows and the few after them
    metrics_table.compact_metrics(spark, root)
    assert rounded(metrics_table.read_metrics(spark, root)) == want and os.listdir(f"{root}/refresh=4")
