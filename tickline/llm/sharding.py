"""Place rows on shards by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: a start
and a step drawn from its name, so the order visits every slot once. Shards take turns;
at its turn a shard claims the first slot of its order that is still free. All shards end
with the same number of slots but one, and when a shard comes or goes most slots keep
their owner. A row's slot is a hash of its key modulo the table size; the table (exactly
`slots` rows, a fixed number) is broadcast, so placement costs one lookup and no shuffle.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 65_537
SHARDS = tuple(f"shard-{k:03d}" for k in range(64))


def _draw(name: str, use: str, below: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}/{name}".encode()).digest()[:8], "big") % below


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, weights: dict[str, int] | None = None) -> np.ndarray:
    """The shard index that owns each slot. A shard of weight w takes w turns a round."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table size must be prime")
    turns = [(weights or {}).get(s, 1) for s in shards]
    if min(turns) < 0 or not any(turns):
        raise ValueError("weights must not be negative, one positive at least")
    at = [_draw(s, "start", slots) for s in shards]
    step = [1 + _draw(s, "step", slots - 1) for s in shards]
    owner, free = np.full(slots, -1, np.int32), slots
    while free:
        for k, n in enumerate(turns):
            for _ in range(min(n, free)):
                while owner[at[k]] >= 0:
                    at[k] = (at[k] + step[k]) % slots
                owner[at[k]] = k
                free -= 1
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; keys are hashed as text, so 7 and '7' share a slot."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("long")


def slot_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, weights: dict[str, int] | None = None) -> DataFrame:
    owner = lookup_table(shards, slots, weights)
    schema = T.StructType([T.StructField("__slot", T.LongType(), False), T.StructField("__shard", T.StringType(), False)])
    return spark.createDataFrame([(k, shards[s]) for k, s in enumerate(owner.tolist())], schema)


def assign(
    df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, weights: dict[str, int] | None = None, slot_col: str = "slot", shard_col: str = "shard"
) -> DataFrame:
    """Each row with its slot and shard.

    Rows of equal keys share a shard; repeated rows stay. A null key has no owner to be
    kept near, so such rows are spread by a hash of their other columns. Columns that are
    already named `slot_col` or `shard_col` are replaced. An empty table stays empty.
    """
    plain = [f"`{c}`" for c, t in df.dtypes if "map<" not in t and "variant" not in t]  # Spark can't hash those
    slot = F.when(df[f"`{key}`"].isNotNull(), slot_of(df[f"`{key}`"], slots)).otherwise(F.pmod(F.xxhash64(*plain), F.lit(slots)).cast("long"))
    own = [c for c in df.columns if c not in (slot_col, shard_col)]
    if key in (slot_col, shard_col):
        raise ValueError("the key column would be replaced")
    placed = df.withColumn("__slot", slot).join(F.broadcast(slot_frame(df.sparkSession, shards, slots, weights)), "__slot", "left")
    return placed.select(*[f"`{c}`" for c in own], F.col("__slot").alias(slot_col), F.col("__shard").alias(shard_col))


def write_shards(df: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder a shard; a shard that holds far more rows than others is written by several tasks."""
    df.hint("rebalance", F.col(shard_col)).write.mode("overwrite").partitionBy(shard_col).parquet(path)
