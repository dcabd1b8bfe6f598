"""The corpus pipeline: documents to a deduplicated, decontaminated and weighted training set.

Every stage takes and returns the columns of ``documents``; the last adds ``mix_domain`` and
``mix_rate``. Each is written and read again before the next one starts, so a lost
executor costs no more than the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import line_windows, mixing, ngram_join, segment_lid, simhash_windows
from harborline.llm.tables import fresh, table
from harborline.session import written_once


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; the others go."""
    return segment_lid.in_known_language(docs)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later copies of three-line windows; ``n_chars`` follows, and documents of which nothing is left go."""
    counts = fresh(docs, "_lines"), fresh(docs, "_removed")
    removed = F.col(counts[1])
    cut = line_windows.drop_repeated_lines(docs, counts=counts).where(F.coalesce(F.col("text").rlike("\\S"), F.lit(True)) | (removed == 0))
    own = F.when(removed > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", own).select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity of 0.8) the document with the smallest id stays."""
    return ngram_join.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return simhash_windows.without_items(docs, table(spark, sf_dir, "benchmark"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that bring the expected tokens of each domain to the target weights; documents of rate 0 go."""
    return mixing.with_rates(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_copies", one_of_near_copies),
    ("decontamination", decontaminated),
    ("mixing", weighted),
]

#: The stages are trained and iterative, so no SQL stands for them; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
