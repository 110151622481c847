"""The training-data pipeline: five stages over ``documents``, each written and read again by the next.

Rows whose metrics fail the quality rules go; of equal texts and of each group of near copies one row stays (near: a
Jaccard similarity of 0.8 or more of the sets of 5-word shingles); sources are brought to
their target weights by Poisson replication, so a row may come out several times or not at all; the rest is packed.
Every stage takes null ids, texts and sources, repeated rows, empty tables and further columns as its operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chunkloom.llm import exact_dedup, mixing, near_copies, packing, quality_rules
from chunkloom.llm.common import clear, documents, materialize, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that pass the quality rules.

    Null and empty texts have no words and go; ids and sources are not looked at; repeated rows pass or go
    alike; columns of any name are kept; an empty table gives an empty one.
    """
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest with the smallest id.

    Null texts count as empty, null ids come last, and of rows that repeat the id and length of the one that stays
    one stays.  Columns of any name are kept; an empty table gives an empty one.
    """
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the row with the smallest id.

    Texts without words, null ones too, are one component; null ids come last, then the hash of the text decides; rows that repeat an
    id stay or go by their own texts.  Columns of any name are kept; an empty table gives an empty one.
    """
    return near_copies.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its draw at the source's rate says, shuffled.

    Null sources are a source of their own; a null id or text draws as the word "null" does; rows that
    repeat id and text share a draw.  Columns of any name are kept; an empty table gives an empty one.
    """
    return mixing.mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each row: bucket, shard, batch and slot, with its tokens and padding.

    Null and empty texts have one token; copies of a row are placed by chance, each for itself; of the columns
    only doc_id is kept; an empty table gives an empty one.
    """
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality_rules", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixed), ("packing", packed)]

#: SQL cannot express the shingles' hashes and the components; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is a Parquet table in the shared folder, and tables of earlier stages are deleted."""
    docs, mark = documents(spark, sf_dir), written()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
