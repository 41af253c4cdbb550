"""The corpus pipeline: quality rules, near-duplicates, secrets, the mix of sources, token ids."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lakehone.llm import bpe, mixing, neardup, quality, secretscan
from lakehone.llm.common import remove, scratch, table, work_dir, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the likelihood ratio keep: their rows and columns as they are.

    Texts that are null, blank or shorter than 50 words go; ties with the threshold stay; rows that repeat are judged alike; empty stays empty.
    """
    return quality.assess(docs, table(spark, sf_dir, "labels"), keep=docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more): that of the smallest doc_id, null last.

    Of rows that are equal in all columns one stays; texts that are null or without words all stay; ties go by hash; empty stays empty.
    """
    return neardup.deduplicated(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by its kind and n_chars counted again; null texts and all other columns as they are; empty stays empty."""
    return secretscan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass in which the mix takes a document, each partition in the order of the schedule.

    Null and blank texts are never taken; the last document of a source's quota is cut after the last word taken; rows that repeat are
    documents of their own; reruns agree; empty stays empty.
    """
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and digests of each row; a null text is the empty one, rows that repeat, repeat; empty stays empty."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [("quality rules", quality_rules), ("minhash near-dedup", near_dedup), ("secret scan", secret_scan), ("mix sources", mix_sources), ("bpe encode and decode", encode)]

#: The verdicts of the fitted ratio and the forest have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written and read again.

    What a stage needs meanwhile, and what the stage before it returned, is deleted as soon as its own result is written; only the
    last stage's input stays in the shared folder, for its rows are made as they are read.
    """
    docs, held = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        target = f"{work_dir(spark).rstrip('/')}/{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        with scratch(spark):
            docs = written(stage(spark, docs, sf_dir), target)
        if held:
            remove(spark, held)
        held = target
    return STAGES[-1][1](spark, docs, sf_dir)
