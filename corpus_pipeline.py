"""A training-corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

The first four return the columns of documents; the last one returns a row of digests per document it got. SQL can't
express the stages, so ORACLE_SQL is None; tests/llm holds every stage against a plain version of it.

Defined results, stage by stage. A null text counts as empty everywhere. An empty table gives an empty one. Other columns,
whatever their names, go through the first four stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociflow.llm import bpe, exact_dedup, mixing, near_dedup, quality
from lociflow.llm.common import read, stored

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Rows are judged by their text alone, so null or repeated doc_ids keep a row each
    and equal texts share a fate; an empty text gets a score like any other."""
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays, one without doc_id only if none of them has one. Of rows that
    repeat doc_id and text one stays. Empty texts are equal to each other."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8 or more) the document with the smallest doc_id stays,
    one without doc_id only where no other is linked with it. Texts without words all stay. Of rows that repeat doc_id and text
    one stays."""
    return near_dedup.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources meet their target weights: documents beyond a source's budget go, those of further epochs come again. The
    one document at which a budget is cut stays whole. Texts without words take nothing of a budget and go; rows without source
    are a source; repeated rows are documents of their own."""
    names = docs.columns
    kept = mixing.mix_sources(docs, keep=[F.col(n) for n in names])
    kept = kept.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return kept.select(*(F.col(f"_keep{i}").alias(n) for i, n in enumerate(names)))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the token ids and of the bytes they decode to, a row for each row that comes in."""
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_tokens=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
