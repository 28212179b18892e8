"""From raw documents to packed training sequences, in five stages.

1. quality classifier: importance resampling; what it does not draw goes
2. exact dedup: of texts equal but for white space the longest stays, then the least id
3. n-gram Jaccard join: one document of each group of near copies stays, that of the least id
4. mixing sources to target weights: rows as often as the mix takes them, in mixed order
5. best-fit packing: pieces of documents and their places in sequences of 1024 tokens

Nulls, empty texts, ties, repeated rows, empty tables and further columns have the results
that the operators' docstrings name; a stage before the last returns the columns it was given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.chosen_path import drop_near_copies
from eventloom.llm.common import documents, keep_table
from eventloom.llm.dedup import exact_dedup
from eventloom.llm.importance import resample
from eventloom.llm.mixing import Mix
from eventloom.llm.packing import pack


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resample(docs, labels).select(*[f"`{c}`" for c in docs.columns])


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs, carry=True).where("kept").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return Mix(docs).rows()


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

# A trained model, sketches, a hash-ordered mix and a token vocabulary are not SQL; the
# stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {}
