"""Plan shape: filters reach the scan, one Window node, no Python on the
default path, aggregation is partial before the shuffle."""


from pyspark.sql import functions as F

from tickline.operators import bars, ingest, serve, validate
from tickline.sources.events import log_from_events, read_events, trades_from_events

from conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_symbol_filter_reaches_scan(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    q = serve.latest_day_metrics(bars.one_minute_metrics(t), "VIEW")
    p = plan_of(q)
    assert "PushedFilters: [IsNotNull(value), IsNotNull(event_type), GreaterThan(value,0.0)]" in p
    # symbol = upper(event_type): the predicate sits directly on the scan output,
    # below the aggregation and the Window
    opt = optimized(q)
    window_at = opt.find("Window [")
    filter_at = opt.rfind("(upper(event_type")
    assert window_at != -1 and filter_at > window_at


def test_one_window_node_for_three_indicators(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    p = optimized(bars.indicators(bars.minute_bars(t)))
    assert p.count("Window [") == 1


def test_partial_aggregation_before_shuffle(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    p = plan_of(bars.minute_bars(t))
    assert "partial_min_by" in p and "partial_sum" in p


def test_column_pruning(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    p = plan_of(serve.available_symbols(t))
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_no_python_on_default_path(spark):
    ev = read_events(spark, SF_SMALL)
    plans = [
        plan_of(validate.valid_messages(validate.validate(log_from_events(ev)))),
        plan_of(ingest.normalize_trades(ingest.decode_frames(spark.createDataFrame([("{}",)], "value string")))),
        plan_of(bars.one_minute_metrics(trades_from_events(ev))),
    ]
    for p in plans:
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_top_k_is_take_ordered(spark):
    t = trades_from_events(read_events(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan_of(serve.latest_trades(t))


def test_validation_parses_once(spark):
    ev = read_events(spark, SF_SMALL)
    p = optimized(validate.valid_messages(validate.validate(log_from_events(ev))))
    # the rule chain is not pushed into a Filter below the parse
    assert "Filter" not in p.split("Generate")[0] or "error" not in p.split("Generate")[0].split("Filter")[1][:200]
    assert p.count("parseJson") == 1 or p.count("parse_json") <= 1


def test_balance_is_a_noop_on_partitioned_input(spark):
    from tickline.sources.layout import balance

    wide = spark.range(0, 1000, numPartitions=16)
    assert balance(wide, min_partitions=8) is wide
    narrow = spark.range(0, 1000, numPartitions=1)
    spread = balance(narrow, min_partitions=8)
    assert spread.rdd.getNumPartitions() == 8
    assert spread.count() == 1000


def test_balance_spreads_rows_that_lie_in_few_or_large_partitions(spark):
    from tickline.sources.layout import balance

    def sizes(df):
        return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]

    # as of a file of one row group that is cut into 16 splits
    one = spark.range(0, 16_000, numPartitions=16).where("id < 1000")
    assert one.rdd.getNumPartitions() == 16 and sizes(one) == [1000]
    spread = balance(one, min_partitions=8)
    assert len(sizes(spread)) == 8 and max(sizes(spread)) <= 150
    assert spread.distinct().count() == 1000
    # partitions stay as large as they are when the table grows
    large = balance(spark.range(0, 5000, numPartitions=16), min_partitions=8, rows=100)
    assert len(sizes(large)) == 56 and max(sizes(large)) <= 150
    assert balance(spark.range(0), min_partitions=3).count() == 0


def test_upsert_reads_only_the_dates_of_a_batch(spark, workdir):
    import os

    from tickline.sinks import trades_table

    t = trades_from_events(read_events(spark, SF_SMALL), squeeze=1).withColumn("id_given", F.lit(False))
    path = os.path.join(workdir, "trades")
    trades_table.upsert_trades(t, path)
    one = trades_table.with_folders(t.where("dayofmonth(trade_time) = 3")).select(*trades_table.TABLE_COLUMNS, *trades_table.FOLDERS)
    new = trades_table.new_rows(one, spark.read.parquet(path), any_given=False)
    assert new.count() == 0
    plan = plan_of(new)
    assert "dynamicpruning" in plan.lower() and "id_given" in plan
    assert plan.count("LeftAnti") >= 1


def test_no_window_holds_a_symbols_bars(spark):
    b = bars.minute_bars(trades_from_events(read_events(spark, SF_SMALL)))
    for df in (bars.one_minute_metrics(trades_from_events(read_events(spark, SF_SMALL))), serve.gap_segments_by_symbol(b), serve.latest_bar_per_symbol(b)):
        for line in plan_of(df).splitlines():
            if "Window [" in line and "windowspecdefinition(symbol#" in line and "_day#" not in line.split("windowspecdefinition")[1]:
                # over days, or over as many bars as the longest frame holds
                assert "minute#" in line and "_rank" not in line or "_day" in line or "RowFrame" in line


def test_json_is_parsed_once(spark):
    p = optimized(validate.validate(log_from_events(read_events(spark, SF_SMALL))))
    assert "json_object_keys" not in p
