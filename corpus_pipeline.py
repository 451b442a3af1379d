"""A training corpus from the `documents` table, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the
cluster's shared folder and read again as the next stage's `docs`. All but the last return the columns
of `docs`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import bpe, decontaminate, line_dedup, ngram_join, quality_rules
from tickline.llm.common import stored, table

#: The place of the tokenizer's ranks; any path that Spark reads.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents stay in the last of them; `n_chars`, if there, follows the text."""
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.select(*_columns(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more on five words, the one of the smallest id stays."""
    return ngram_join.one_of_each(docs, spec=ngram_join.Spec(n=5, percent=80)).select(*_columns(docs))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a test item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and digests of the ids and of what they decode to."""
    codec = bpe.Codec(spark, bpe.read_ranks(spark, RANKS), public_tokenizers.PATTERN)
    coded = codec.decode(codec.encode(docs.select("doc_id", "text")).select("doc_id", "ids"))
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_sha256("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_copies), ("decontamination", benchmark), ("byte_bpe", tokens)]

#: SQL cannot express the merges of the last stage; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
