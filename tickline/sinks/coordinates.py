"""Insert-if-absent by log coordinates (topic, partition, offset).

A record's coordinates never change, so a replay finds its rows whatever the batch
number, the batch bounds or the checkpoint of the query that replays them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_stored(rows: DataFrame, stored: DataFrame | None, topic: str, partition: str, offset: str, same: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose coordinates ``stored`` does not hold.

    Only the offsets between the batch's first and last of each log partition are
    looked at: one row per log partition goes through the driver and is joined with the
    stored rows, and the range over all of them reaches the scan, where row groups
    outside it are skipped. ``same`` names columns that follow from the record, such as
    partition folders, which narrow the scan further.
    """
    if stored is None:
        return rows
    spans = rows.groupBy(topic, partition).agg(F.min(offset).alias("_lo"), F.max(offset).alias("_hi"))
    found = spans.collect()
    if not found:
        return rows
    spans = rows.sparkSession.createDataFrame(found, spans.schema).withColumnsRenamed({topic: "_topic", partition: "_partition"})
    cols = [*same, topic, partition, offset]
    held = stored.where(F.col(offset).between(min(s["_lo"] for s in found), max(s["_hi"] for s in found))).select(*cols)
    inside = F.col(topic).eqNullSafe(F.col("_topic")) & (F.col(partition) == F.col("_partition")) & F.col(offset).between(F.col("_lo"), F.col("_hi"))
    # one row per partition of the log: bounded, whatever the batch holds
    known = held.join(F.broadcast(spans), inside, "left_semi").select(*[F.col(c).alias(f"_{c}") for c in cols])
    match = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(known[f"_{c}"]) for c in cols])
    return rows.join(known, match, "left_anti")
