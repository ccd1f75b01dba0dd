"""The corpus pipeline: documents are filtered, deduplicated, mixed and encoded.

Every stage takes all that its predecessor kept, as written Parquet, and returns a DataFrame;
all but the last return the columns of `documents`. Nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns are treated as the operator of the stage says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fareline.llm import exact_dedup, jaccard_join, mixing, quality, sentence_pieces
from fareline.llm.common import stored, table

PIECES = "piece_bpe_32k.model"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all of them, does not reject."""
    return quality.good_documents(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared shingles, the row with the smallest id."""
    return jaccard_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with `piece_ids` and `decoded_text`."""
    return sentence_pieces.encode_and_decode(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

# The classifier and the tokenizer are beyond SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
