"""Corpus pipeline: stages over ``documents``, each written as Parquet and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
it keeps with the columns of documents, the last one the encoded documents (doc_id, ids, n_ids,
n_chars, lossless). Each stage works on all that its predecessor kept.

Cases are those of the operators. Extra columns of documents pass through all stages but the last;
an empty table passes through as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import decontaminate, line_dedup, near_dedup, quality_rules, sentencepiece_bpe
from carelake.llm.common import materialize, read_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that three or more share, but for one holder; n_chars follows the text."""
    d = line_dedup.dedup(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    changed = F.col("n_dropped") > 0
    return d.select(*[F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c)
                      for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return near_dedup.filter_documents(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate.filter_documents(docs, read_table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sub-word ids."""
    return sentencepiece_bpe.encode(docs, sentencepiece_bpe.load_vocabulary(spark))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_duplicate_stage),
          ("decontaminate", decontaminate_stage), ("sentencepiece", encode_stage)]

#: Near-duplicate components, edit distance and the merge agenda are not SQL; tests compare brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
