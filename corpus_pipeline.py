"""Corpus pipeline: from raw documents to token ids.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir), works on all
rows that its predecessor kept and returns a frame that is written as Parquet
and read again as the next one's documents.  All but the last return the
columns of ``documents``.

Defined cases, over all stages: a null text counts as empty; an empty or null
text has the quality score of the labels' share, is one text with its copies,
has no near copies and no benchmark words, and encodes to no tokens; a text of
any length is taken whole; of rows with equal texts the largest doc_id stays
(one without doc_id only if no other has one); rows that share a null or repeated
doc_id are judged by their own texts; labels without a document, or of a missing
quality, teach nothing; an empty table gives an empty result; other columns,
whatever their names, pass through to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from windrose.llm import bytepair, contamination, minhash, quality, quotient
from windrose.llm.common import materialise, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote for good quality."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return quotient.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the one with the smallest doc_id."""
    return minhash.drop_near(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return contamination.remove(docs, table(spark, sf_dir, "benchmark"), what="documents")


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every remaining document, as digests of ids and of the decoded text."""
    return bytepair.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [("quality", good_quality), ("exact_dedup", without_copies), ("near_dedup", without_near_copies),
          ("decontaminate", without_benchmark), ("byte_bpe", as_tokens)]

# the vote of learnt neighbours has no SQL form; tests/llm compares run() with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
