"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse.llm import (decontaminate, fill_in_middle, language_id, lexical_search, license_scan, line_dedup, oracle, packing,
                             quality_cascade, quality_classifier, simhash, substring_dedup, toxicity, warc)
from memberpulse.llm.common import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_cascade.cascade(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files: the source is a repository, digits of the id name folders; ids ending in 0 are licence files."""
    folder = F.when(F.col("doc_id") % 100 == 0, "").when(
        F.col("doc_id") % 10 == 0, F.concat(F.lit("/d"), (F.floor(F.col("doc_id") / 100) % 10).cast("string")))
    folder = folder.otherwise(F.concat(F.lit("/d"), (F.floor(F.col("doc_id") / 100) % 10).cast("string"),
                                       F.lit("/e"), (F.floor(F.col("doc_id") / 10) % 10).cast("string")))
    name = F.when(F.col("doc_id") % 10 == 0, "LICENSE-").otherwise("file-")
    path = F.concat("source", folder, F.lit("/"), name, F.col("doc_id").cast("string"))
    return docs.select("doc_id", path.alias("path"), "text")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(document_files(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = Workspace(spark).path("archive")
    warc.write_warc(table(spark, sf_dir, "pages"), root, shard_bytes=32 << 20, roll_bytes=8 << 20)
    return warc.read_warc(spark, root, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                             table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")).select(
        F.col("row.doc_id").alias("doc_id"), "held_out", "score", "predicted")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return fill_in_middle.restore(cut).select(
        F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_toxicity": op10_toxicity,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE: dict[str, str] = {
    "op3_quality_rules": oracle.QUALITY,
    "op5_line_dedup": oracle.LINES,
    "op8_warc": oracle.WARC,
    "op9_decontamination": oracle.DECONTAMINATION,
    "op12_fill_in_middle": oracle.FILL_IN_MIDDLE,
    "op13_lexical_search": oracle.LEXICAL_SEARCH,
}
