"""Samples that are the same in every run: ranks are hashes of seed and id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_hash(seed, id_col: Column) -> Column:
    """SHA-256 of "seed:id"."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256)


def list_hash(*parts: Column) -> Column:
    """SHA-256 of a JSON list of numbers and plain strings, with spaced separators."""
    return F.sha2(F.concat(F.lit("["), F.concat_ws(", ", *parts), F.lit("]")), 256)


def row_key(*parts: Column) -> Column:
    """SHA-256 of a compact JSON list of texts."""
    return F.sha2(F.to_json(F.array(*(p.cast("string") for p in parts))), 256)


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text.cast("string"), F.lit('"'))


def top_by_hash(df: DataFrame, id_col: str, k: int, seed=42) -> DataFrame:
    """The k rows of smallest rank hash."""
    return df.orderBy(rank_hash(seed, F.col(id_col)), id_col).limit(k)


def top_per_group(df: DataFrame, group: list[str], id_col: str, k: int, seed=42) -> DataFrame:
    """At most k rows of each group, by rank hash; the limit is applied before the shuffle as well as after it."""
    w = Window.partitionBy(*group).orderBy(rank_hash(seed, F.col(id_col)), id_col)
    return df.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)


def round_robin(df: DataFrame, group: list[str], id_col: str, limit: int, seed=42, first: Column | None = None) -> DataFrame:
    """`limit` rows taken in turn from the sorted groups, each in order of its rank hash; rows for which `first` holds come before all."""
    rank = list_hash(F.lit(str(seed)), quoted(F.col(id_col)))
    w = Window.partitionBy(*group).orderBy("_rank", id_col)
    ranked = df.withColumn("_rank", rank).withColumn("_lead", ~first if first is not None else F.lit(True))
    turn = ranked.where("_lead").withColumn("position", F.row_number().over(w)).where(F.col("position") <= limit)
    lead = ranked.where("not _lead").withColumn("position", F.lit(0))
    return lead.unionByName(turn).orderBy("_lead", "position", *group, "_rank", id_col).limit(limit).drop("_rank", "_lead")


def systematic(df: DataFrame, index: str, total: int, budget: int, page: int = 25, seed=42) -> DataFrame:
    """About `budget` rows in whole pages, one page in each of equal strata of the row index, at an offset by hash."""
    strata = max(1, -(-budget // page))
    width = max(1, total // strata)
    stratum = F.least(F.floor(F.col(index) / width), F.lit(strata - 1))
    offset = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), stratum.cast("string")), 256), 1, 8), 16, 10).cast("long") % F.lit(max(1, width - page + 1))
    at = F.col(index) - stratum * width
    return df.where((at >= offset) & (at < offset + page))
