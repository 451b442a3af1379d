"""Session settings the engine relies on.

Two settings change results, so every public entry point applies them through
:func:`configure`:

* ``spark.sql.session.timeZone = UTC``: bars are cut at UTC minute and day
  boundaries and ISO text carries ``+00:00``.
* ``spark.sql.variant.allowDuplicateKeys = true``: a JSON message with a repeated
  key keeps the last value (as a Python ``dict`` does) instead of failing to parse.

The rest are scale settings, applied only when the caller has not set them.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_ROOT: str | None = None

# Settings that decide results: always applied.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for plan quality: applied only where unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A compressed log record grows some tenfold when it is parsed and kept for a
    # micro-batch; small splits bound what one task reads and holds.
    "spark.sql.files.maxPartitionBytes": "16m",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a
    # whole-stage-codegen method that large would run interpreted. At this limit
    # Spark falls back to per-operator codegen for such a subtree instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the engine depends on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "tickline",
    extra: dict[str, str] | None = None,
    driver_memory: str = "8g",
) -> SparkSession:
    """Build a session for tests and local runs (UI off, UTC, AQE on).

    On a cluster, create the session with the cluster's own settings and call
    :func:`configure` on it instead.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged data.

    Uses the cluster's ``spark.checkpoint.dir``. Where it is unset, only a local
    session (one machine, as in tests) gets a fresh scratch folder; on a cluster the
    executors could not share one and a restarted driver would lose it.
    """
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir, or give the folder, to one that driver and executors share")
        if _LOCAL_ROOT is None:
            _LOCAL_ROOT = tempfile.mkdtemp(prefix="tickline-ckpt-")
        root = _LOCAL_ROOT
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A named folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), name)
