"""The registered queries of this subpackage and the SQL that states their results.

Every query takes a whole table through its operator with production parameters and reads the
contract's columns off the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    covertree,
    edits,
    importance,
    mixing,
    neardup,
    packing,
    quality,
    repeats,
    secret_scan,
    spelling,
    suffixes,
    warc,
    wavelet,
)
from tickerloom.llm.common import read_table
from tickerloom.llm.oracles import ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

__all__ = ["ORACLE_SQL", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return wavelet.digest_documents(wavelet.write_shards(docs, BYTE_BPE, end_id=0))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    pieces = packing.token_pieces(docs, WORD_BPE, end_id=1, keep_ids=False)
    return packing.pack(pieces.drop("ids"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


def turn_edits(conversations: DataFrame) -> DataFrame:
    """An edit log from the conversations: turn t of conversation d rewrites a passage of
    document d with its text."""
    size = F.coalesce(F.length("text"), F.lit(0))
    start = (size * 37 + F.col("turn") * 101) % 3000
    return conversations.select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("seq"), start.alias("start"),
        (start + size * 13 % 120).alias("end"), F.col("text").alias("replacement"),
    )


def op3_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    log = turn_edits(read_table(spark, sf_dir, "conversations"))
    return edits.apply_edits(docs, edits.count_trees(docs, BYTE_BPE), log, BYTE_BPE)


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digest(repeats.find_repeats(read_table(spark, sf_dir, "documents")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link_counts(read_table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digest(secret_scan.find_secrets(read_table(spark, sf_dir, "documents")))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.link_counts(read_table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.write_archives(read_table(spark, sf_dir, "pages"), min_revisit=0)
    directory = warc.write_index(captures)
    return warc.read_records(warc.read_captures(directory), payloads=False).drop("payload", "url")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return importance.resample(docs, read_table(spark, sf_dir, "benchmark"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return spelling.group_variants(spelling.count_words(docs, one_in=spelling.ERROR_RATE))


def op13_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.long_repeat_digest(suffixes.find_long_repeats(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_wavelet": op1_wavelet,
    "op2_mix": op2_mix,
    "op3_edit_counts": op3_edit_counts,
    "op4_repeats": op4_repeats,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_secrets": op6_secrets,
    "op7_pack": op7_pack,
    "op8_quality": op8_quality,
    "op9_cover_tree": op9_cover_tree,
    "op10_warc": op10_warc,
    "op11_importance": op11_importance,
    "op12_spelling": op12_spelling,
    "op13_suffixes": op13_suffixes,
}
