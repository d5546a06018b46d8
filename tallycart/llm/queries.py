"""Registered queries of the operators; ``pipeline`` is in corpus_pipeline.py."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, codebooks, jaccard, language, line_dedup, mixing, mtree, negatives, neighbours, pii, sharding, token_files, toxicity
from .common import held_out, share_package
from ..sources.scratch import scratch_path

#: The end id behind every document in token files.
END_ID = 2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.span_digests(pii.with_spans(table(spark, folder, "documents")))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.slot_mix(mixing.sized(table(spark, folder, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(table(spark, folder, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = held_out(F.col("doc_id"))
    # The flag rides along as part of the id, so that no join is needed.
    marked = docs.select(F.struct("doc_id", out.alias("held_out")).alias("doc_id"), "text")
    found = language.predict(marked, language.fit(docs.filter(~out)))
    return found.select("doc_id.doc_id", "doc_id.held_out", "lang_pred", "score")


def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.components(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = held_out(F.col("doc_id"))
    model = toxicity.fit(docs, labels.filter(~out))
    marked = docs.select(F.struct("doc_id", out.alias("held_out")).alias("doc_id"), "text")
    found = toxicity.scored(marked, model)
    return found.select("doc_id.doc_id", "doc_id.held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID, path)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digests(table(spark, folder, "documents"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codebooks.code_report(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(table(spark, folder, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_pii,
        op2_mixing,
        op3_exact_top_k,
        op4_sharding,
        op5_byte_bpe,
        op6_neighbours,
        op7_language,
        op8_jaccard,
        op9_toxicity,
        op10_token_files,
        op11_line_dedup,
        op12_vector_codes,
        op13_hard_negatives,
    )
    return {f.__name__: f for f in registered}
