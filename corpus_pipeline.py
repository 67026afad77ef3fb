"""A training corpus in stages: each takes (spark, docs, sf_dir), works on all that the one before kept, and is stored.

Rules drop poor documents, SimHash leaves one document of each group, repeated byte strings go, personal data gives way
to surrogates, and what is left is packed into sequences. All stages but the last return the columns of ``documents``;
``n_chars`` follows the text. Null and empty texts fail the quality rules; of repeated rows the second stage keeps one;
null keys, sources and languages and further columns of any name stay as they are, and an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.llm import common, lines, packing, simhash, suffixes, surrogates
from panelwright.session import stored

SURROGATE_KEY = "panelwright corpus"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
# Bytes of a repeated string that goes. Of all runs of 51 words in texts like these 98 in 100 are longer, so that
# passages of over 50 words are caught in any of the languages.
REPEAT_BYTES = 240
# Bytes that a task takes in at once; the stages share executors, so that each has to leave the others room.
BATCH_BYTES = 2 << 20


def _counted(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, n_chars (if there is one) counted anew."""
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, without the lines that too many documents share."""
    common.sharing(spark, BATCH_BYTES)
    return _counted(lines.clean(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of texts linked within 4 bits of SimHash over 4-word shingles."""
    common.sharing(spark, BATCH_BYTES)
    return simhash.first_of_each(docs, words=4, radius=4, seed=42)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of REPEAT_BYTES bytes that occur more than once."""
    common.sharing(spark, BATCH_BYTES)
    return _counted(suffixes.without_repeats(docs, length=REPEAT_BYTES), docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced by surrogates."""
    return _counted(surrogates.replace(docs, SURROGATE_KEY, count="_n_entities"), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    common.sharing(spark, BATCH_BYTES)
    return packing.pack(packing.pieces(docs, VOCABULARY, size=2048, end=0), size=2048)


STAGES = [
    ("quality rules", quality), ("SimHash near-dedup", near_duplicates), ("suffix-array dedup", repeats),
    ("PII", private_data), ("best-fit packing", packed),
]
# SimHash, byte strings and tokenizers have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs, f"stage-{k}")
    return docs
