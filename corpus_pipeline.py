"""From raw documents to token ids: quality, exact and near duplicates, mixing, tokens.

Every stage reads what the stage before wrote. All but the last give rows with
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlake.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality
from countlake.llm.common import read_table
from countlake.session import write_through


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; the others go.

    Null, empty and blank texts are scored as one empty passage. Rows repeated
    whole are judged alike.
    """
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (white space aside), the fullest.

    Null counts as empty; of rows that are equal in text and id one stays.
    """
    return exact_dedup.drop_duplicates(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Texts without words are linked with nothing and stay. Rows with a null or
    repeated id are judged one by one.
    """
    return near_dedup.keep_first(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order.

    Null sources are one source; texts without words have size 0 and are taken
    like others. Rows alike in id, source and text keep their own other columns.
    """
    return mixing.draw(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every document of the mix; null and empty texts have no ids."""
    return byte_bpe.encode(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("mixing", mixed_documents),
    ("byte_bpe", token_ids),
]

#: SQL can express neither the classifier nor the tokens; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
