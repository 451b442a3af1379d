"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a partition, where each costs as much as a message to build and parse.
ROWS = 100_000


def balance(df: DataFrame, min_partitions: int | None = None, rows: int = ROWS) -> DataFrame:
    """Spread a scan over partitions of about ``rows`` rows, and over every core at least.

    A row group is read by one task, whatever the number of partitions that Spark cuts
    the file into: a table of few row groups leaves most of them empty, and the
    per-record CPU work (JSON parsing, SHA-256) runs on few cores. The rows of each
    partition are counted (for Parquet files from their footers); where one has too many
    or too few have any, all are dealt out in turn, so that a partition stays as large
    as it is when the table grows. Otherwise this is a no-op and adds no shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    held = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    used, largest, total = held.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    if used >= target and largest <= rows:
        return df
    waves = -(-(total or 0) // (rows * target))  # whole ones: no core waits for a last few partitions
    return df.repartition(target * max(1, waves))
