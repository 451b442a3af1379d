"""The registered queries of this folder, each over its whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm import bpe, decontaminate, html, line_dedup, manifest, mil_quality, ngram_join, pii, quality_rules, secrets, sharding, suffix_dedup, whitening
from tickline.llm.common import table
from tickline.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    codec = bpe.Codec(spark, bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    coded = codec.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = codec.decode(coded.select("doc_id", "ids"))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_sha256("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "source", "slot", "shard")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op4_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query
def op6_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = mil_quality.fit(documents, table(spark, sf_dir, "labels").where(~held_out))
    scored = mil_quality.score(documents, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = secrets.corpus(documents)
    model = secrets.train(secrets.labelled_findings(documents), known)
    found = secrets.scan(documents, known, model)
    return found.select("doc_id", "rule", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score", "secret")


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents").select("doc_id", "text"), spec=ngram_join.Spec(n=4, percent=85))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(documents, pii.train(pii.labelled(documents)))
    base = F.sha2(pii.span_text(pii.base_of(F.col("spans"))), 256)
    return found.select("doc_id", *[pii.count_of(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS], base.alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    checked = manifest.verify(documents, tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.proof_text(F.col("path")), 256).alias("proof_sha256"), "folded_root", "verified")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(embeddings, whitening.fit(embeddings))
