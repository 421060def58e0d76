"""The corpus pipeline: documents through five operators to packed token windows.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshcat.llm.common import stage, table
from freshcat.llm.decontaminate import drop_contaminated
from freshcat.llm.packing import pack_documents
from freshcat.llm.quality_rules import keep_good, trusted_ids
from freshcat.llm.queries import vocabulary_path
from freshcat.llm.sentence_spans import remove_repeated_spans
from freshcat.llm.simhash import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs, trusted_ids(table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated sentence spans; ``n_chars`` follows the text. A
    document of which nothing but white space is left goes (one that came so stays)."""
    done = remove_repeated_spans(docs)
    text, names = F.col("left"), docs.columns
    cut = done.select(F.col("text").alias("left"), "n_removed", "whole").where((F.col("n_removed") == 0) | F.col("left").rlike("\\S"))
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, text).otherwise(F.col("whole.text")),
           "n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("whole.n_chars")) if "n_chars" in names else None}
    return cut.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"whole.`{c}`") for c in names])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 4096 tokens."""
    return pack_documents(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: XXH64 hashing and token ids are not to be had in SQL; the tests have a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
