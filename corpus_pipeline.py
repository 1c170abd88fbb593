"""A corpus pipeline: quality rules, near-duplicates, secrets, source mix, packed sequences.

Every stage takes what its predecessor kept, as a table that was written and read again, and its
decisions take effect: rejected documents go, one document of each near-duplicate group stays,
secrets are replaced in the texts, documents are repeated or left out to meet the source weights,
and what remains is cut into token pieces that are packed into sequences of 4096.

The rows of the last stage depend on a tokenizer and on numerical estimates, which SQL cannot
state; the tests hold each stage against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import mixing, neardup, packing, quality, secret_scan
from tickerloom.llm.common import materialize, read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Tokens that are packed at a time; a task holds their ids.
GROUP_TOKENS = 1 << 22

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest doc_id."""
    return neardup.drop_near_duplicates(docs).select(*docs.columns)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced; n_chars follows the text."""
    clean = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return clean.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights ask."""
    return mixing.mix(docs)


def packed_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place."""
    return packing.pack(packing.token_pieces(docs, TOKENIZER), group_tokens=GROUP_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("secrets", clean_documents),
    ("mix", mixed_documents),
    ("pack", packed_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each output is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
