"""Training-data pipeline over the documents: five stages, each written as Parquet and read again as the next one's input.

All stages take any columns besides those they read, whatever their names, texts of any length, and empty tables, which
give empty results; the first four return the columns they got.

Language identification drops texts without a language, near-duplicates are reduced to one document a group, documents with
benchmark passages are dropped, sources are mixed to target weights, and what is left is packed into rows of token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from bazaarframe.llm import decontaminate, language, mixing, near_dups, packing
from bazaarframe.llm.queries import tune
from bazaarframe.llm.store import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts that are null, empty or have no letter go.

    Repeated rows go or stay together; a null id or language is no reason to go. Without any labelled text nothing can be
    told, and all go.
    """
    tune(spark)
    return language.with_language(docs, language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8: the one with the smallest id.

    Null and blank texts are linked with nothing and stay, as do rows without an id. Rows with one id are one document and
    stay or go together, repeated rows as well.
    """
    tune(spark)
    return near_dups.keep_one(docs, shingle=5, part=80, whole=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; each row is judged by its own text, with an id or without.

    Null and empty texts stay, repeated rows go or stay together; with an empty benchmark all stay.
    """
    tune(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), spare_without_id=False)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole; rows are told apart even if they repeat one another.

    A null source is a source of its own; null and blank texts have no words and are not taken.
    """
    tune(spark)
    return mixing.mixed_documents(docs)


def token_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of 2,048 token ids, a document that is too long for one divided without loss.

    A null or empty text is its end token alone; repeated rows are packed each.
    """
    tune(spark)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return packing.pack(docs, path, length=2048, end_id=50256, pad_id=50256)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_rows", token_rows),
]

# Similarity links, seeded mixing and token ids cannot be stated in SQL; the operators are tested singly in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
