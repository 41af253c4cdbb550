"""Duplicates, held-out inputs and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_kept(df: DataFrame, key: list[str], order: list[str], id_col: str) -> DataFrame:
    """df with duplicate_of: the id of the key's first row, null for that row itself.

    A minimum by key joins back, so a key with very many rows is combined before the shuffle and the join can be split.
    """
    first = df.groupBy(*key).agg(F.min(F.struct(*order, F.col(id_col).alias("_id"))).alias("_first"))
    same = F.col("_first._id") == F.col(id_col)
    return df.join(first, key).withColumn("duplicate_of", F.when(~same, F.col("_first._id"))).drop("_first")


def conflict_free(df: DataFrame, key: list[str], label: str, order: list[str]) -> DataFrame:
    """The first row of each key whose rows agree on the label, with n rows; keys with several labels go altogether."""
    names = [c for c in df.columns if c not in key]
    grouped = df.groupBy(*key).agg(F.min(label).alias("_low"), F.max(label).alias("_high"), F.min(F.struct(*order, *(c for c in names if c not in order))).alias("_r"), F.count("*").alias("copies"))
    return grouped.where("_low = _high").select(*key, *(F.col(f"_r.{c}").alias(c) for c in names), "copies")


def hash_share(seed, group: Column) -> Column:
    """First 64 bits of SHA-256 of "seed:group" as a decimal."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), group), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")


def hash_split(seed, group: Column, fraction: float) -> Column:
    """validation for about this fraction of groups, else train."""
    return F.when(hash_share(seed, group) < F.lit(int(fraction * 2**64)).cast("decimal(20,0)"), "validation").otherwise("train")


def grouped_split(df: DataFrame, group: str, seed, fraction: float, fixed: str | None = None) -> DataFrame:
    """df with split: that of the group's rows with a fixed one (test before validation before train), else by hash."""
    if fixed is None:
        return df.withColumn("split", hash_split(seed, F.col(group), fraction))
    rank = F.min(F.when(F.col(fixed) == "test", 0).when(F.col(fixed) == "validation", 1).when(F.col(fixed) == "train", 2)).alias("_rank")
    ranks = df.groupBy(group).agg(rank)
    named = F.element_at(F.array(*map(F.lit, ("test", "validation", "train"))), F.col("_rank") + 1)
    return df.join(ranks, group).withColumn("split", F.when(F.col("_rank").isNotNull(), named).otherwise(hash_split(seed, F.col(group), fraction))).drop("_rank")


def unseen(df: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows none of whose keys is in the history: one anti-join a key, never one with an OR."""
    for key in keys:
        df = df.join(history.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return df
