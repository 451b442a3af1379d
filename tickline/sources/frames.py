"""Raw vendor frames as a DataFrame of text (one frame per row, column ``value``).

The socket client of the reference is not rebuilt; frames arrive as text files
(one JSON frame per line) or as the values of a Kafka topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.session import configure


def read_frames(spark: SparkSession, source: str | dict[str, str], streaming: bool = True) -> DataFrame:
    """Frames from a folder of text files or from Kafka options (``subscribe``)."""
    configure(spark)
    if isinstance(source, dict):
        reader = spark.readStream if streaming else spark.read
        reader = reader.format("kafka")
        for k, v in source.items():
            reader = reader.option(k, v)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return (spark.readStream if streaming else spark.read).text(source)
