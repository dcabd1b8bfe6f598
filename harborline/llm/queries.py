"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import compact_windows, licenses, line_windows, mixing, ngram_join, phrases, pii_weak, pivot_dedup, prefix_trie, quality_fm, secrets_crf, segment_lid, simhash_windows
from harborline.llm.tables import table

QUERIES, ORACLES = {}, {}


def _register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_register
def op3_pivot_permutation_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@_register
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


@_register
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.fit(docs, table(spark, sf_dir, "labels")))


@_register
def op2_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_windows.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register
def op5_secrets_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets_crf.scan(docs, secrets_crf.fit(docs))


@_register
def op6_segmented_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return segment_lid.predict(docs, segment_lid.fit(docs))


@_register
def op7_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.repeated_passages(table(spark, sf_dir, "documents"))


@_register
def op8_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_weak.scan(table(spark, sf_dir, "documents"))


@_register
def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "tokens", "domain", "rate", "posterior")


@_register
def op10_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_windows.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), "text")


ORACLES["op10_line_windows"] = line_windows.ORACLE_SQL


@_register
def op11_license_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


@_register
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations")).drop("k1", "k2", "n_ends")


ORACLES["op13_conversation_trie"] = prefix_trie.ORACLE_SQL


@_register
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_collocations"] = phrases.ORACLE_SQL
