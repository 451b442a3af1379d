"""Timestamp text and truncation helpers (session zone is UTC, see ``session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_from_millis(ms: Column) -> Column:
    """Epoch milliseconds as ISO-8601 UTC text, the form Python's ``isoformat`` gives.

    ``2026-10-07T18:00:00+00:00`` for whole seconds, otherwise six fraction digits
    (``2026-10-07T18:00:00.123000+00:00``).
    """
    ms = ms.cast("long")
    frac = F.pmod(ms, F.lit(1000))
    seconds = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(frac == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad((frac * 1000).cast("string"), 6, "0"))
    )
    return F.concat(seconds, fraction, F.lit("+00:00"))

