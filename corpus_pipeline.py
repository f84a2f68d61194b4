"""From raw documents to piece ids: quality, language, near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; its result is written as Parquet and read again.  ``run`` applies them to
the documents table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm.common import Shared, shared_path, table
from tallyroom.llm.language_id import fit, keep_identified, learnable
from tallyroom.llm.line_quality import keep_quality
from tallyroom.llm.mixing import mix
from tallyroom.llm.piece_codec import Pieces, round_trip
from tallyroom.llm.simhash_dedup import keep_one_of_each

PIECE_MODEL = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their frequent lines; null, empty and short texts go.  All columns stay."""
    return keep_quality(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with a score of 0.5 or more; without labelled rows none is.  All columns stay."""
    return keep_identified(docs, fit(learnable(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the smallest id, null last, and of those the smallest text hash.  All columns stay."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document none, one or two times, so that sources come near their targets.  All columns stay."""
    return mix(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document with its ids and whether they decode to its text; a null text has null ids."""
    return round_trip(docs, Shared(spark, Pieces(public_tokenizers.path(PIECE_MODEL))))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("SentencePiece encoding and decoding", pieces),
]

#: SQL can express neither the fingerprints nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, root = table(spark, sf_dir, "documents"), shared_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{root}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
