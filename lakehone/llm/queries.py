"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, htmltext, langid, license_scan, mixing, neardup, quality, secretscan, tokenio
from .common import table, work_dir
from .oracles import ORACLES


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all sources takes of each document."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op2_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents, by sets of two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2).select("doc_id", "n_shingles", "component_id", "kept")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates in each document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs.where(~langid.held_out("doc_id")))
    found = langid.identify(docs, net)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th vector."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 20 = 0"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the text they decode to."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of each document."""
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each document."""
    return secretscan.scan(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What token files of all documents hold of each, read back from them."""
    target = f"{work_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokenio.write(table(spark, sf_dir, "documents"), target, end=2)
    return tokenio.read(spark, target, digest=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline from documents to token ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_mix, op2_minhash_neardup, op3_license_scan, op4_language_id, op5_nearest_neighbours, op6_bpe_round_trip, op7_html_text, op8_quality_rules, op9_secret_scan, op10_token_files, pipeline)}

__all__ = ["ORACLES", "QUERIES"]
