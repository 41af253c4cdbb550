"""Overlap of texts with benchmarks: equal, contained, and alike by shingles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import spaced, word_shingles

#: A side of more bytes than this is joined by a shuffle.
SMALL_BYTES = 64 << 20
#: Bytes that Spark spends on a row of a broadcast table besides its values, about.
ROW_BYTES = 48


def fits(df: DataFrame) -> bool:
    """Whether the rows of df, with what a hash table adds to each, take SMALL_BYTES at most.

    Fixed-width columns are counted, strings and arrays measured.
    """
    widths = {"string": lambda c: F.octet_length(c), "binary": lambda c: F.octet_length(c)}
    size = F.lit(ROW_BYTES)
    for field in df.schema.fields:
        kind, c = field.dataType.simpleString(), F.col(f"`{field.name}`")
        size = size + F.coalesce(widths[kind](c) if kind in widths else 16 * F.size(c) if kind.startswith("array") else F.lit(8), F.lit(0))
    return (df.agg(F.sum(size.cast("long"))).first()[0] or 0) <= SMALL_BYTES


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if its bytes are found to be few."""
    return F.broadcast(df) if fits(df) else df


def equal_texts(docs: DataFrame, reference: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id and the sorted item ids whose text is the same but for white space."""
    key = F.sha2(spaced(F.col("text")), 256)
    right = reference.select(key.alias("key"), item_id).distinct()
    pairs = docs.select(doc_id, key.alias("key")).join(maybe_broadcast(right), "key")
    return pairs.groupBy(doc_id).agg(F.array_sort(F.collect_set(item_id)).alias("items"))


def shingle_pairs(docs: DataFrame, reference: DataFrame, n: int = 5, least: int = 8, doc_id: str = "doc_id", item_id: str = "item_id") -> DataFrame:
    """doc_id, item_id, shared, doc_shingles, item_shingles of all pairs that share a shingle: an inverted list of the reference side.

    Lists are keyed by 128 bits of hash, not by the words: 16 bytes for each shingle of the reference, which is broadcast while that is little.
    """
    keys = lambda s: F.transform(s, lambda g: F.struct(F.xxhash64(g).alias("h"), F.xxhash64(F.lit(1), g).alias("h2")))
    right = reference.select(item_id, word_shingles(F.col("text"), n, least).alias("s")).select(item_id, F.size("s").alias("item_shingles"), F.explode(keys(F.col("s"))).alias("g"))
    right = right.select(item_id, "item_shingles", "g.h", "g.h2")
    left = docs.select(doc_id, word_shingles(F.col("text"), n, least).alias("s")).where("size(s) > 0")
    left = left.select(doc_id, F.size("s").alias("doc_shingles"), F.explode(keys(F.col("s"))).alias("g")).select(doc_id, "doc_shingles", "g.h", "g.h2")
    pairs = left.join(maybe_broadcast(right), ["h", "h2"])
    return pairs.groupBy(doc_id, item_id, "doc_shingles", "item_shingles").agg(F.count("*").alias("shared"))


def alike(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Pairs with this Jaccard similarity."""
    jaccard = F.col("shared") / (F.col("doc_shingles") + F.col("item_shingles") - F.col("shared"))
    return pairs.withColumn("jaccard", F.round(jaccard, 6)).where(jaccard >= threshold)


def contained(pairs: DataFrame, percent: int = 80) -> DataFrame:
    """Pairs in which the document holds this share of the item's shingles."""
    return pairs.where(F.col("shared") * 100 >= F.col("item_shingles") * percent)


def overlap_kinds(parts: DataFrame, reference: DataFrame, row_id: str = "id", threshold: float = 0.85) -> DataFrame:
    """id, part, kind of every part (id, part, text) of an evaluation row: `exact` if the reference has its text but for white space, else `near` if one of its texts is
    alike by shingles, else `none`."""
    named = parts.withColumn("_key", F.concat_ws("\x1f", F.col(row_id).cast("string"), F.col("part").cast("string")))
    texts = named.select(F.col("_key").alias("doc_id"), "text")
    numbered = reference.select(F.xxhash64("text").alias("item_id"), "text").dropDuplicates(["item_id"])
    exact = equal_texts(texts, numbered).select(F.col("doc_id").alias("_key"), F.lit(True).alias("_exact"))
    near = alike(shingle_pairs(texts, numbered), threshold).select(F.col("doc_id").alias("_key")).distinct().withColumn("_near", F.lit(True))
    found = named.join(exact, "_key", "left").join(near, "_key", "left")
    return found.select(row_id, "part", F.when(F.col("_exact"), "exact").when(F.col("_near"), "near").otherwise("none").alias("kind"))


def overlap_summary(kinds: DataFrame) -> DataFrame:
    """kind, parts and rows of overlap_kinds()."""
    return kinds.groupBy("kind").agg(F.count("*").alias("parts"), F.countDistinct("id").alias("rows"))


def without_overlap(rows: DataFrame, kinds: DataFrame, row_id: str = "id") -> DataFrame:
    """rows of which no part, prompt or reference, is in the reference texts."""
    return rows.join(kinds.where("kind <> 'none'").select(row_id).distinct(), row_id, "left_anti")
