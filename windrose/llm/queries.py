"""The named corpus queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrose.llm import (bytepair, contamination, jaccard, licenses, merkle, minhash, pii, quality, quotient, repeats, secrets,
                          structure, urls)
from windrose.llm.common import table
from windrose.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def span_line(column: str) -> Column:
    """kind:start:end of each span, comma-joined in the spans' order."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of documents by merged counting quotient filters."""
    return quotient.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in documents, by broadcast sets of window hashes."""
    return contamination.report(contamination.scan_benchmark(table(spark, sf_dir, "documents"),
                                                             table(spark, sf_dir, "benchmark")))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the text they decode to, as digests."""
    return bytepair.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in documents: base patterns and structurally confirmed candidates."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(span_line("base"), 256).alias("base_sha256"),
                        span_line("spans").alias("spans"))


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signature rules over documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of documents by the vote of labelled latent-semantic neighbours."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by rules and by its host's path templates."""
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in documents: base patterns and candidates that boosted trees select."""
    found = pii.scan_pii(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("email").alias("n_email"), count("ip").alias("n_ip"),
                        count("card").alias("n_card"), count("phone").alias("n_phone"),
                        F.sha2(span_line("base"), 256).alias("base_sha256"), span_line("spans").alias("spans"))


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents by min-max hashing."""
    return minhash.near_dedup(table(spark, sf_dir, "documents"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes that stand anywhere else, removed from every document."""
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles agree, by rare-first prefix filtering."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of documents, and a check of a copy whose text a third of the rows changed."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.manifest(docs, F.when(changed, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text")))


@query
def op13_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations and the cheapest edits that give them a legal structure again."""
    rows = table(spark, sf_dir, "conversations")
    return structure.repair(structure.damaged(rows), rows)
