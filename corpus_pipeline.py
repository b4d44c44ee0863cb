"""From raw documents to packed training windows: five stages, each one operator of gableboard.llm.

Each stage reads what the one before has kept, as Parquet. The first four return the columns of documents.
Every table given may be empty, hold nulls and repeated rows; see the operators for what each then does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gableboard.llm import credentials, decontaminate, jaccard, language_id, packing
from gableboard.llm.tables import read, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the documents themselves are labelled with."""
    return language_id.identified(docs, language_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.75."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in benchmark windows."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with reported secrets masked."""
    return credentials.redacted(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents in windows of 1024, with their ids."""
    return packing.pack(docs)


STAGES = [("language_id", languages), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", windows)]

#: Language models, components and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's table stands in the shared folder until the next is done."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
