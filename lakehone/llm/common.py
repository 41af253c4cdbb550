"""What the corpus operators share: reading, cutting lineage in shared storage, word hashing, components of a graph."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ARROW_BYTES, ARROW_ROWS, lower_batches  # noqa: F401  operators take the last from here

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until df has no such column."""
    known = {c.lower() for c in df.columns}
    while name.lower() in known:
        name += "_"
    return name


def hashable(df: DataFrame) -> list[Column]:
    """All columns, in a form that Spark can hash: those with maps as JSON."""
    return [F.to_json(F.struct(df[f.name])) if "map<" in f.dataType.simpleString() else df[f.name] for f in df.schema.fields]


@contextlib.contextmanager
def options(spark: SparkSession, **values: str):
    """Session options that hold inside; those of the caller come back."""
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for k, name in names.items():
        spark.conf.set(name, values[k])
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_batches(spark: SparkSession):
    """Few rows and bytes in an Arrow batch, for jobs that run inside."""
    return options(spark, execution__arrow__maxRecordsPerBatch=str(ARROW_ROWS), execution__arrow__maxBytesPerBatch=str(ARROW_BYTES))


#: Folders of scratch(), the innermost last.
_scratch: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.  Only local sessions may do without, in a temporary folder; on a cluster that is an error, as each executor would write to its own disk."""
    if path := spark.conf.get("spark.checkpoint.dir", None):
        return path
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not getattr(sc, "_lakehone_work", None):
        sc._lakehone_work = "file://" + tempfile.mkdtemp(prefix="lakehone-")
    return sc._lakehone_work


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store that Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """What operators write to the shared folder inside is deleted at the end: what is still needed must have been written elsewhere by then."""
    path = f"{work_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    _scratch.append(path)
    try:
        yield
    finally:
        _scratch.remove(path)
        remove(spark, path)


def written(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """df written as Parquet to a path and read again."""
    spark = df.sparkSession
    with small_batches(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends there and survives a lost executor.

    The files stay for as long as the results of an operator may need them: until the scratch() around it ends, or the shared folder is cleared.
    """
    folder = _scratch[-1] if _scratch else work_dir(df.sparkSession).rstrip("/")
    return written(df, f"{folder}/{name}-{uuid.uuid4().hex}", codec)


@contextlib.contextmanager
def interpreted(spark: SparkSession):
    """Without whole-stage code: loops of many plans over few rows else fill the driver's memory with compiled classes."""
    with options(spark, codegen__wholeStage="false"):
        yield


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered up to a bound."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words; of the whole sequence if it is shorter."""
    n = min(n, len(hashes))
    if not n:
        return hashes
    out = mix64(hashes[: len(hashes) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - n + 1 + i])
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): node, root (its smallest node), by alternating large-star and small-star steps.

    Each step only takes minima by node, so that a node with very many links needs no large group.
    """
    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    spark = edges.sparkSession
    folder = f"{_scratch[-1] if _scratch else work_dir(spark).rstrip('/')}/edges-{uuid.uuid4().hex}"
    with interpreted(spark):
        step = 0
        e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{folder}/0")
        seen = mark(e)
        while seen[0]:
            both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
            step += 1
            e = written(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{folder}/{step}")
            remove(spark, f"{folder}/{step - 1}")
            if (now := mark(e)) == seen:
                break
            seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
