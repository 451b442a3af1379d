"""Lossless raw archive, one folder per (symbol, date).

Layout ``<root>/symbol=S/date=YYYY-MM-DD/part-*``. A row holds the whole message as
it arrived (``body``), its key and log coordinates, and the wire fields as columns.
Rows are inserted only where their coordinates are absent, so a replayed batch, a
query that starts again from the first offset, or one with other batch bounds adds
nothing twice and replaces nothing. The offset span that the reference puts into
object names is kept per row and summarized by :func:`offset_spans`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.schemas import ARCHIVE
from tickline.sinks import folders
from tickline.sinks.coordinates import not_stored

PARTITION_COLUMNS = ("symbol", "date")
COORDINATES = ("topic", "source_partition", "source_offset")
#: Text may hold line breaks, quotes and blanks at either end; null is not empty text.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "quoteAll": "true", "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N", "emptyValue": "",
}


def archive_rows(valid: DataFrame) -> DataFrame:
    """Valid messages (with ``key`` and ``value`` carried along) → archive rows.

    ``date`` is the first 10 characters of the ``timestamp`` text (not a parsed
    date); ``conditions`` is its JSON text, NULL where the message has none.
    """
    return valid.select(
        "event_id",
        "price",
        "volume",
        "timestamp",
        "trade_timestamp_ms",
        "conditions",
        "source",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("body"),
        "topic",
        F.col("partition").cast("int").alias("source_partition"),
        F.col("offset").cast("long").alias("source_offset"),
        "symbol",
        F.substring("timestamp", 1, 10).alias("date"),
    )


def write_archive(rows: DataFrame, root: str, fmt: str = "parquet") -> None:
    """Append the rows whose coordinates are not archived yet.

    A record always has the same folder, so only the folders of the batch are listed
    and read (their names go through the driver, which lists them for the write anyway). Rows are clustered by the partition columns (``rebalance``) so each task writes
    few files; AQE splits a folder that holds a large share of the batch (a hot
    symbol) over several tasks instead of sending it to one writer.
    """
    options = CSV_OPTIONS if fmt == "csv" else {}
    spark = rows.sparkSession
    names = ["/".join(folders.folder_name(spark, c, r[c]) for c in PARTITION_COLUMNS) for r in rows.select(*PARTITION_COLUMNS).distinct().collect()]
    stored = folders.read_folders(spark, root, names, ARCHIVE, fmt, **options) if folders.exists(spark, root) else None
    new = not_stored(rows, stored, *COORDINATES, same=PARTITION_COLUMNS)
    (
        new.hint("rebalance", *PARTITION_COLUMNS)
        .sortWithinPartitions(*PARTITION_COLUMNS, "trade_timestamp_ms")  # the writer's own order first
        .write.mode("append")
        .options(**options)
        .format(fmt)
        .partitionBy(*PARTITION_COLUMNS)
        .save(root)
    )


def read_archive(
    spark: SparkSession,
    root: str,
    symbol: str | None = None,
    dates: tuple[str, str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Archive as a DataFrame with the declared schema (no inference).

    ``symbol`` and the inclusive ``dates`` range are partition filters, so only
    the matching folders are listed and read.
    """
    df = spark.read.schema(ARCHIVE).format(fmt).options(**(CSV_OPTIONS if fmt == "csv" else {})).load(root)
    if symbol is not None:
        df = df.where(F.col("symbol") == F.lit(symbol))
    if dates is not None:
        df = df.where(F.col("date").between(F.lit(dates[0]), F.lit(dates[1])))
    return df


def archive_log(archived: DataFrame) -> DataFrame:
    """Archived rows back as log records (key, value, topic, partition, offset), to replay them."""
    return archived.select(
        F.col("key").cast("binary").alias("key"),
        F.col("body").cast("binary").alias("value"),
        "topic",
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
    )


def conditions_array(text: Column) -> Column:
    """Archive ``conditions`` text → array<string>; accepts JSON (``["@"]``, what
    we write) and Python list text (``['@']``, what older CSV objects hold)."""
    as_json = F.when(text.startswith("['"), F.regexp_replace(text, "'", '"')).otherwise(text)
    return F.coalesce(F.from_json(as_json, "array<string>"), F.array().cast("array<string>"))


def list_archive(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Files under the archive root (path, length, modificationTime); contents
    are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def offset_spans(log: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch, the offset span text ``p0-<first>-<last>_p1-...`` over the log
    partitions in order, and the number of offsets it covers.

    Two small aggregations: by (batch, partition), then by batch over at most one
    row per log partition.
    """
    per_partition = log.groupBy(batch, "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )
    piece = F.struct("partition", "first_offset", "last_offset")
    spans = per_partition.groupBy(batch).agg(
        F.array_sort(F.collect_list(piece)).alias("_spans"),
        F.sum(F.col("last_offset") - F.col("first_offset") + 1).alias("span_width"),
    )
    text = F.array_join(
        F.transform(
            "_spans",
            lambda s: F.concat(
                F.lit("p"), s["partition"].cast("string"), F.lit("-"), s["first_offset"].cast("string"), F.lit("-"), s["last_offset"].cast("string")
            ),
        ),
        "_",
    )
    return spans.select(batch, text.alias("offset_span"), F.col("span_width").cast("long").alias("span_width"))


def parse_offset_span(name: Column) -> Column:
    """Inverse of the span text: array of (partition, first, last) structs."""
    pieces = F.regexp_extract_all(name, F.lit(r"(p\d+-\d+-\d+)"), 1)
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.regexp_extract(p, r"^p(\d+)-", 1).cast("int").alias("partition"),
            F.regexp_extract(p, r"^p\d+-(\d+)-", 1).cast("long").alias("first_offset"),
            F.regexp_extract(p, r"-(\d+)$", 1).cast("long").alias("last_offset"),
        ),
    )
