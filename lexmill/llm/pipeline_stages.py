"""Stages of a corpus pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame.

All but the last return the columns of ``docs``, extra ones too, whatever their names; an empty table
stays empty. Null text counts as empty text and null doc_ids are kept apart by their rows' texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import line_dedup, mixing, ngram_join, packing, quality
from lexmill.session import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts, fitted on the labels of the folder.

    Every row is judged by its own whole text, so rows of one doc_id may part; null and empty texts have
    the score of the empty text. Without labels the network answers as it begins.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that other documents hold; n_chars is counted anew.

    Rows of equal doc_id are one document, null ids another that sorts last. A document that
    loses all its lines stays, with an empty text; null text becomes empty.
    """
    return line_dedup.without_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of least doc_id; of equal rows one stays.

    Documents without words all stay. Rows of one doc_id with dissimilar texts both stay.
    """
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times; documents without words are not taken.

    A null source is a source of its own; ties in the queue fall by md5 of doc_id, then by text.
    """
    return mixing.mixed_documents(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row is packed, repeated ones each; a row of empty or null text is one piece, its end id.
    """
    return packing.op8(docs)


STAGES = [
    ("quality_network", keep_good),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_tokens),
]
