"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``. Null texts
are texts without words: they pass every filter and are packed as an end id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inforce.llm.common import written
from inforce.llm.decontaminate import without_contaminated
from inforce.llm.near_duplicates import without_near_duplicates
from inforce.llm.packing import pack_documents
from inforce.llm.pii import fit_pii, redact_pii
from inforce.llm.toxicity import fit_toxicity, without_toxic
from inforce.sources.tables import read_table

#: Stages cannot be expressed in SQL (trained models, tokenizers); see tests/llm.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    return without_toxic(docs, fit_toxicity(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the document with the smallest id, of each near-duplicate group
    (five words, similarity 0.8); rows are judged, not ids, so an id that names two
    texts loses neither to the other."""
    return without_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets."""
    return redact_pii(docs, fit_pii(docs)).withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences. Workers that ran the stages
    before keep a smaller table of sub-words."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), table_chunks=400_000)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("decontamination", decontamination), ("pii", pii), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
