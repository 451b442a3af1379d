"""Validation of log records and routing to trades or dead letters.

``validate`` adds two columns to a log DataFrame: ``msg`` (the message parsed
once into VARIANT) and ``error`` (first failing rule, NULL when valid). Every
later step reads fields from ``msg``; the text is never parsed again per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions import rules
from tickline.functions.fingerprint import message_text_column, sha256_hex


def validate(log: DataFrame, table_path: bool = False, value: str = "value") -> DataFrame:
    """Add ``msg`` and ``error`` to log records (any columns, ``value`` the body)."""
    text = rules.message_text(F.col(value))
    # Stage 1: parse once. Stage 2: field types. Stage 3: the rule chain.
    # Separate projections keep each generated method small.
    staged = log.withColumn("msg", rules.parse_message(text))
    staged = staged.select("*", *rules.field_kinds(F.col("msg")))
    error = rules.error_column(F.col(value), F.col("msg"), table_path)
    kinds = [c for c in staged.columns if c.startswith("_kind_")]
    return staged.withColumn("error", error).drop(*kinds)


def route(df: DataFrame, keep: Column, *cols: Column) -> DataFrame:
    """Rows where ``keep`` holds, projected to ``cols``, without a Filter node.

    A Filter on ``error`` would be pushed below the projection that parses the
    message, with the parse substituted into every rule that reads it: the JSON
    would be parsed once per rule per row and the optimizer's expression tree
    would grow with every projection underneath. Emitting zero or one row per
    input through ``inline`` evaluates the rule chain once, in the projection
    where it is defined (one codegen stage, no shuffle).
    """
    return df.select(F.inline(F.when(keep, F.array(F.struct(*cols)))))


def valid_messages(validated: DataFrame, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Wire fields of valid records, with ``event_id`` kept or derived.

    ``conditions`` is the JSON text of any value, NULL where the message has none.
    ``id_given`` tells an id that is not the hash of the trade's own fields.
    ``extra`` columns of the log (e.g. ``batch_id``) are carried along. The
    routing step carries only the parsed message; the fields are read from it in
    the projection after, which keeps each generated method small."""
    carried = [F.col("msg"), F.col("topic"), F.col("partition"), F.col("offset"), *extra]
    valid = route(validated, F.col("error").isNull(), *carried)
    m = F.col("msg")
    extra_names = [c for c in valid.columns if c not in ("msg", "topic", "partition", "offset")]
    given = F.nullif(F.try_variant_get(m, "$.event_id", "string"), F.lit(""))
    valid = valid.select("*", given.alias("_given"))
    # only an id that looks like a hash can be the trade's own
    own = F.col("_given").isNull() | F.col("_given").rlike(r"\A[0-9a-f]{64}\z")
    valid = valid.select("*", F.when(own, sha256_hex(message_text_column())).alias("_derived"))
    return valid.select(
        F.coalesce("_given", "_derived").alias("event_id"),
        F.try_variant_get(m, "$.symbol", "string").alias("symbol"),
        F.try_variant_get(m, "$.price", "double").alias("price"),
        F.try_variant_get(m, "$.volume", "double").alias("volume"),
        F.try_variant_get(m, "$.timestamp", "string").alias("timestamp"),
        F.try_variant_get(m, "$.trade_timestamp_ms", "bigint").alias("trade_timestamp_ms"),
        F.to_json(F.try_variant_get(m, "$.conditions", "variant")).alias("conditions"),
        F.try_variant_get(m, "$.source", "string").alias("source"),
        "topic",
        "partition",
        "offset",
        (F.col("_given").isNotNull() & ~F.col("_given").eqNullSafe(F.col("_derived"))).alias("id_given"),
        *extra_names,
    )


def to_table_rows(valid: DataFrame, received_at=None) -> DataFrame:
    """Wire fields → ``trades`` table rows (timestamp parsed, conditions default ``[]``).

    ``received_at`` defaults to ``current_timestamp()``, one value per query, i.e.
    per micro-batch.
    """
    return valid.select(
        "event_id",
        "symbol",
        "price",
        "volume",
        rules.table_time(F.col("timestamp")).alias("trade_time"),
        "trade_timestamp_ms",
        F.coalesce(F.col("conditions"), F.lit("[]")).alias("conditions"),
        "source",
        (received_at if received_at is not None else F.current_timestamp()).alias("received_at"),
        *[c for c in ("partition", "offset", "batch_id", "id_given") if c in valid.columns],
    )


def dead_letters(validated: DataFrame) -> DataFrame:
    """Rejected records: error, source coordinates and the body as text
    (invalid UTF-8 replaced by U+FFFD). The record key is kept."""
    return route(
        validated,
        F.col("error").isNotNull(),
        F.col("key"),
        F.col("error"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.make_valid_utf8(F.col("value").cast("string")).alias("original_value"),
    )


def rejection_summary(validated: DataFrame) -> DataFrame:
    """Rejected records per error text (partial aggregation before the shuffle)."""
    rejected = route(validated, F.col("error").isNotNull(), F.col("error"))
    return rejected.groupBy("error").agg(F.count(F.lit(1)).alias("records"))
