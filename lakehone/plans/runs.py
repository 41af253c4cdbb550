"""Runs: a lock, manifests that say whether a stage's output still holds, and progress that a later run goes on from."""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsons import compact
from ..sources.sinks import write_json


@contextlib.contextmanager
def locked(path: str) -> Iterator[None]:
    """Holds an exclusive lock of the driver for a run; BlockingIOError if another process holds it."""
    with open(path, "a+") as file:
        fcntl.flock(file, fcntl.LOCK_EX | fcntl.LOCK_NB)
        try:
            yield
        finally:
            fcntl.flock(file, fcntl.LOCK_UN)


def fingerprint(config: dict, inputs: dict[str, int], code: str = "", benchmarks: dict[str, str] | None = None) -> str:
    """One hash of what a stage's output depends on: configuration, code, benchmark files and the row counts of its inputs."""
    return hashlib.sha256(compact({"config": config, "inputs": inputs, "code": code, "benchmarks": benchmarks or {}}).encode()).hexdigest()


def stage(spark: SparkSession, target: str, manifest: str, identity: str, make) -> DataFrame:
    """make()'s rows, written to target; taken from there if the manifest has the same identity and the count that the files have.

    The manifest is written last, so that output without one is never taken for whole.
    """
    if os.path.exists(manifest):
        with open(manifest, encoding="utf-8") as file:
            known = json.load(file)
        if known.get("identity") == identity and spark.read.parquet(target).count() == known.get("rows"):
            return spark.read.parquet(target)
        os.remove(manifest)
    make().write.mode("overwrite").option("compression", "zstd").parquet(target)
    out = spark.read.parquet(target)
    write_json(manifest, {"identity": identity, "rows": out.count()})
    return out


def remaining(rows: DataFrame, done: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows that a run before did not commit."""
    return rows.join(done.select(id_col).distinct(), id_col, "left_anti")


def commit(results: DataFrame, target: str) -> None:
    """Adds results to those committed: a job's files appear together or not at all."""
    results.write.mode("append").option("compression", "zstd").parquet(target)


def committed(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """What was committed so far; nothing before the first time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target)


def progress(done: DataFrame, expected: int) -> DataFrame:
    """rows, expected, complete of a run."""
    return done.agg(F.count("*").alias("rows")).select("rows", F.lit(expected).cast("long").alias("expected"), (F.col("rows") == expected).alias("complete"))
