"""Dead-letter table: rejected records with key, reason and source coordinates.

Rows are inserted only where their coordinates are absent, so a replayed batch, or a
query that starts again from the first offset, adds no second copy and replaces
nothing; (source_topic, source_partition, source_offset) stays unique. Folders hold
blocks of offsets, so a batch lists and reads those of its own blocks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickline.schemas import DEAD_LETTER
from tickline.sinks import folders
from tickline.sinks.coordinates import not_stored

COORDINATES = ("source_topic", "source_partition", "source_offset")
#: Offsets of a folder, of every log partition.
BLOCK = 1_000_000
STORED = StructType([*DEAD_LETTER.fields, StructField("offset_block", StringType())])


def write_dead_letters(rejected: DataFrame, root: str) -> None:
    spark = rejected.sparkSession
    block = F.floor(F.col("source_offset") / BLOCK).cast("string")
    rows = rejected.select(*[f.name for f in DEAD_LETTER.fields], block.alias("offset_block"))
    stored = None
    if folders.exists(spark, root):
        names = [folders.folder_name(spark, "offset_block", r.offset_block) for r in rows.select("offset_block").distinct().collect()]
        stored = folders.read_folders(spark, root, names, STORED)
    (
        not_stored(rows, stored, *COORDINATES, same=("offset_block",))
        .hint("rebalance", "offset_block")  # few files per batch; a flood of rejects still spreads over tasks
        .sortWithinPartitions("offset_block", *COORDINATES)
        .write.mode("append")
        .partitionBy("offset_block")
        .parquet(root)
    )


def read_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(root).select(*[f.name for f in DEAD_LETTER.fields])


def dead_letter_messages(rejected: DataFrame) -> DataFrame:
    """Kafka-sink shape (key, value JSON) for publishing dead letters to a topic; the record's key is kept."""
    fields = [f.name for f in DEAD_LETTER.fields if f.name != "key"]
    return rejected.select(F.col("key"), F.to_json(F.struct(*fields)).alias("value"))


def publish_dead_letters(rejected: DataFrame, options: dict[str, str]) -> None:
    """Send a batch's dead letters to the topic of ``options`` (see ``kafka_writer``); at least once."""
    dead_letter_messages(rejected).write.format("kafka").options(**options).save()
