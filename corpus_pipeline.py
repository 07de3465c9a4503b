"""The corpus pipeline: toxicity, near duplicates, repeated passages, contamination, packing.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that its
predecessor kept; ``run`` writes each stage's result to the shared folder and rereads it.
All but the last return the columns of ``documents``; the suffix-array stage shortens texts
(and their ``n_chars``), the last returns one row per packed piece. SQL can express neither
the trained classifier nor the tokenizer, so there is no SQL twin; the tests hold each
stage against a brute-force version of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trilake.llm.common import materialise
from trilake.llm.decontaminate import drop_contaminated
from trilake.llm.packing import pack_documents
from trilake.llm.queries import table, vocabulary
from trilake.llm.simhash import drop_near_duplicates
from trilake.llm.suffix_dedup import remove_repeats
from trilake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that start earlier in the corpus."""
    return remove_repeats(docs, length=100).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, packed into sequences."""
    return pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("simhash", near_duplicates), ("suffix_dedup", repeated_passages),
          ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
