"""From raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), where
docs holds what its predecessor kept, and returns a DataFrame. All but the last
return the columns of documents. Rows without an id stay unless a stage judges
their text; rows with one id are one document and stay or go together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, kneser, minhash, packing, pii, quality
from tidemark.llm.shared import cut


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of two thirds of the ids."""
    model = quality.train(docs, _table(spark, sf_dir, "labels"), seen=~kneser.held_out("doc_id", 3, 1))
    return quality.score(docs, model, out="__quality").filter("__quality >= 0.5").drop("__quality")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five words, 0.8)."""
    found = minhash.near_duplicates(docs, words=5, percent=80)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, up to a twentieth of edits."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def redact_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by tags, and their new length."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in clean.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact_private),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage keeps is written once before the next reads it."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
