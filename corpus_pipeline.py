"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes all that its predecessor kept, written and read again, and
returns the columns of documents; the last returns the pieces of sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewright.llm.common import Scratch, table
from tidewright.llm.mixing import mixed_documents
from tidewright.llm.ngram_join import one_of_each
from tidewright.llm.packing import pack_sequences
from tidewright.llm.quality import good_documents
from tidewright.llm.substring import deduplicated_documents

#: Near copies are documents whose sets of 5-word shingles are alike by 0.8 and more.
SHINGLE_WORDS, LIKE = 5, (80, 100)
#: Pieces that packing's tokenizer remembers and bytes of text that it encodes together: its workers live beside what earlier stages left.
PIECES, STEP = 100_000, 2 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs, size=SHINGLE_WORDS, like=LIKE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words of passages that occur earlier."""
    return deduplicated_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; a document comes as often as words of it are taken."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), 50257, 0, entries=PIECES, step=STEP)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality), ("n-gram Jaccard join", near_copies), ("substring dedup", repeated_passages), ("source mixing", mixing), ("packing", packing),
]

#: SQL can express neither the fitted classifier nor packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`; what a stage returns is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    try:
        for name, stage in STAGES[:-1]:
            now = Scratch(spark, "stage-" + name.replace(" ", "-"))
            try:
                docs = now.write(stage(spark, docs, sf_dir))
            finally:
                if before:
                    before.drop()
                before = now
        return STAGES[-1][1](spark, docs, sf_dir)  # packing is computed when it returns
    finally:
        if before:
            before.drop()
