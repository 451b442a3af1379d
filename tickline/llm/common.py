"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; one of our own only where none is set, as in tests."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = getattr(spark, "_llm_scratch", None) or tempfile.mkdtemp(prefix="llm-shared-")
        spark._llm_scratch = root
    return root.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """Bound the text that goes to a Python worker at once, unless the caller has set a bound.

    Spark's own bounds are 10,000 rows and 64 MB; a worker holds several times that as Arrow,
    Python objects and results, and an executor has a worker a core.
    """
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps survive lost executors
    and do not compute it again. Each call takes a folder of its own."""
    spark = df.sparkSession
    path = os.path.join(shared_root(spark), f"{what}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete what `stored` wrote for these frames, once later tables no longer need them."""
    for df in frames:
        hadoop = df.sparkSession._jvm.org.apache.hadoop.fs
        for file in df.inputFiles()[:1]:
            folder = hadoop.Path(file).getParent()
            folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
