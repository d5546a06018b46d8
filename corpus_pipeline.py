"""A corpus pipeline of five of the operators: filter, deduplicate, redact, mix, encode.

Each stage takes (spark, docs, sf_dir) and works on what the one before it kept, written as
Parquet and read again. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.llm import bpe, jaccard, mixing, pii, toxicity
from tallycart.llm.common import held_out, share_package, store


#: Near copies of the pipeline: five-word shingles, similarity 0.8 or more.
NEAR = jaccard.Rule(words=5, similarity=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from labelled rows outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    return toxicity.accepted(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the row that names the group.

    Rows without an id are kept unless they share a group with one that has an id. Rows with one id and one text are copies
    too, and one of them stays.
    """
    return jaccard.representatives(docs, NEAR)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the names of its kinds."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of a source in part."""
    return mixing.taken_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of their decoded bytes."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", redact_personal_data),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: The classifier, the join and the encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored before the next stage reads it."""
    share_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = store(docs, "pipeline-stage")
    return docs
