"""Corpus pipeline: quality, near duplicates, mixing, encoding, each a stage over all its predecessor kept.

Stages take (spark, docs, sf_dir) and return a DataFrame. ``run`` writes each stage's result as Parquet under the
shared folder and rereads it as the next stage's docs, so a lost executor repeats one stage at most. All
stages but the last return the columns of ``documents``; the last adds ids and their decoded text.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prefspark.llm import bpe, mixing, quality, simhash
from prefspark.llm.common import materialized, read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the model of trusted text rejects go."""
    judged = quality.classify(docs, read_table(spark, sf_dir, "labels"), keep_text=True)
    return judged.where("kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each SimHash component stays, the one of smallest id."""
    return simhash.keep_one(docs, words_each=4, radius=4).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the words the mix takes. A document repeats once a lap, a cut is a row of its own.

    A cut has the document's id, the cut text, and its number of characters.
    """
    mixed = mixing.take(mixing.mix(docs, mixing.word_count(), block_words=2048))
    return mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: ids of the whole text, their number, and whether they decode to the very bytes of the text."""
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.encode(docs, vocabulary, bytes_col="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Quality thresholds, SimHash components and BPE merges are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir))
    return docs
