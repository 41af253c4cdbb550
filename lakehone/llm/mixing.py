"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, hashable, materialize

BLOCK = 1024
#: Sources have weights set by hand; more than this many are an error, not a silent cut.
MAX_SOURCES = 1_000_000
#: Rows of a bucket of a source's shuffled order, about: prefix sums go bucket by bucket.
BUCKET = 1 << 12
CHUNK = 1 << 16
#: Passes of one content that a task joins, at most.
SLICE = 4096
#: Rows that count the slots of sources in chunks: at most this many are broadcast.
FEW = 2_000_000


class Mix(NamedTuple):
    rows: DataFrame  #: doc_id, h, h2, h3, src, bucket, rn, size, source_size, target, quota, start: a row for each document
    slots: DataFrame  #: slot, src, block: the schedule
    segments: DataFrame  #: src, bucket, rn, epoch, block, p, words: words of a document in a block of its source, and the pass's place in its stream


def fill(sizes: list[int], weights: list[float], share: float, most: float = 2.0) -> list[float]:
    """Targets by weight that stop at `most` times the size; the excess is reshared until none is above."""
    out, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0]
    total = share * sum(sizes)
    while left:
        unit = (total - sum(most * sizes[i] for i in range(len(sizes)) if out[i])) / sum(weights[i] for i in left)
        over = {i for i in left if weights[i] * unit > most * sizes[i]}
        for i in over or left:
            out[i] = most * sizes[i] if over else weights[i] * unit
        left = [i for i in left if i not in over] if over else []
    return out


def schedule(first: int, n: int, cumulative: np.ndarray) -> np.ndarray:
    """Sources of slots first..first+n-1: the golden-ratio sequence through the cumulative weights."""
    i = np.arange(first + 1, first + n + 1, dtype=np.uint64)
    points = (i * np.uint64(0x9E3779B97F4A7C15)).astype(np.float64) / 2.0**64
    return np.minimum(np.searchsorted(cumulative, points, side="right"), len(cumulative) - 1)


def keys(docs: DataFrame, seed: int, *names: str) -> list[Column]:
    """Hashes that order a source's rows: two of doc_id, text and source, and one of all columns, so that rows that agree in all three are equal."""
    return [F.xxhash64(F.lit(seed), "doc_id", "text", "source").alias(names[0]), F.xxhash64(F.lit(seed + 1), "text", "doc_id", "source").alias(names[1]), F.xxhash64(F.lit(seed + 2), *hashable(docs)).alias(names[2])]


def mix(docs: DataFrame, weights=(5.0, 2.0, 1.0), share: float = 1.5, block: int = BLOCK, seed: int = 7) -> Mix:
    """Plans a mix of `share` times all words of docs (doc_id, text, source).

    Sources in code-point order, null last, take the weights in turn; a source gives at most twice its words.  Each
    source's documents are shuffled by hash into one stream, read up to twice, and cut into blocks of equal words.
    Slot i goes to the source that the golden-ratio point of i meets in the cumulative weights; the r-th slot of a
    source takes its block r.  Slots beyond a source's quota fall out; what the sequence still owes (a few
    blocks, by its discrepancy) follows at the end, so each source meets its target to the word.

    Null or blank texts have no words and are never taken; rows that repeat are documents of their own; an empty table
    gives an empty mix; other columns are ignored.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(docs.select("doc_id", "source", size.alias("size"), *keys(docs, seed, "h", "h2", "h3")), "sized")
    found = sized.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    bits = max(1, min(30, math.ceil(math.log2(max((r.rows for r in found), default=1) / BUCKET + 1))))
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [int(r.n) for r in found]
    targets = fill(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share)
    quotas = [int(t) for t in targets]
    need = [-(-q // block) for q in quotas]
    sources = F.broadcast(spark.createDataFrame([(r.source, i, s, t, q, k) for i, (r, s, t, q, k) in enumerate(zip(found, sizes, targets, quotas, need))], "name string, src int, source_size long, target double, quota long, need long"))
    known = sized.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits)).join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name", "need")

    sums = known.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("src", "bucket", (F.sum("words").over(Window.partitionBy("src").orderBy("bucket")) - F.col("words")).alias("before"))
    inside = Window.partitionBy("src", "bucket").orderBy("h", "h2", "h3", "doc_id", "size")
    rows = known.select("*", F.row_number().over(inside).alias("rn"), (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("within"))
    rows = materialize(rows.join(before, ["src", "bucket"]).withColumn("start", F.col("before") + F.col("within")).drop("before", "within"), "placed")

    total = sum(need)
    cumulative = np.cumsum(need) / max(total, 1)
    chunks = -(-total // CHUNK)
    grid = spark.range(0, chunks, 1, max(1, min(chunks, 4096)))

    def in_chunks(count: bool):
        def slots(batches):
            for batch in batches:
                for c in batch.column(0).to_pylist():
                    n = min(CHUNK, total - c * CHUNK)
                    src = schedule(c * CHUNK, n, cumulative).astype(np.int32)
                    order = np.argsort(src, kind="stable")
                    there, at, many = np.unique(src[order], return_index=True, return_counts=True)
                    if count:
                        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(np.full(len(there), c)), pa.array(many.astype(np.int64))], ["src", "chunk", "n"])
                        continue
                    rank = np.empty(n, np.int64)
                    rank[order] = np.arange(n) - np.repeat(at, many)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int64) + c * CHUNK), pa.array(src), pa.array(np.full(n, c)), pa.array(rank)], ["slot", "src", "chunk", "rank"])

        return slots

    counts = grid.mapInArrow(in_chunks(True), "src int, chunk long, n long")
    base = counts.select("src", "chunk", (F.sum("n").over(Window.partitionBy("src").orderBy("chunk")) - F.col("n")).alias("base"))
    base = F.broadcast(base) if chunks * len(found) <= FEW else base.hint("merge")
    planned = grid.mapInArrow(in_chunks(False), "slot long, src int, chunk long, rank long").join(base, ["src", "chunk"])
    planned = planned.select("slot", "src", (F.col("rank") + F.col("base")).alias("block")).join(sources.select("src", "need"), "src").where("block < need").drop("need")
    owed = sources.select("src", "need").join(counts.groupBy("src").agg(F.sum("n").alias("got")), "src", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
    owed = owed.select("src", "got", F.explode(F.sequence("got", F.col("need") - 1)).alias("block"))
    owed = owed.select((F.lit(total) + F.col("src") + len(found) * (F.col("block") - F.col("got"))).alias("slot"), "src", "block")
    slots = planned.unionByName(owed)

    passes = rows.where("size > 0").select("src", "bucket", "rn", "size", "quota", F.explode(F.array(F.struct(F.lit(0).alias("epoch"), F.col("start").alias("p")), F.struct(F.lit(1).alias("epoch"), (F.col("start") + F.col("source_size")).alias("p")))).alias("e"))
    passes = passes.select("*", "e.epoch", "e.p", F.least(F.expr("e.p + size"), "quota").alias("q")).where("p < q").drop("e")
    blocks = passes.select("*", F.explode(F.sequence(F.expr(f"p div {block}"), F.expr(f"(q - 1) div {block}"))).alias("block"))
    words = F.least("q", (F.col("block") + 1) * block) - F.greatest("p", F.col("block") * block)
    return Mix(rows, slots, blocks.select("src", "bucket", "rn", "epoch", "block", "p", words.alias("words")))


def scheduled(m: Mix) -> DataFrame:
    """slot, src, bucket, rn, epoch, p, words: the schedule joined with the blocks."""
    # Spark takes the schedule for as small as its range of chunks and would broadcast it; it grows with the words.
    return m.segments.join(m.slots.hint("merge"), ["src", "block"])


def taken(m: Mix, by: tuple = ("src", "bucket", "rn")) -> DataFrame:
    return scheduled(m).groupBy(*by).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document."""
    m = mix(docs, **options)
    key = ["src", "bucket", "rn"]
    out = m.rows.join(taken(m), key, "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents with the columns of docs: a row for each pass in which a document is taken, in whole or (where a quota ends) up to the last word that is taken.

    Each partition holds a part of the mix drawn by hash, in the order of the schedule: documents stand by the slot of their first words.
    Passes are planned on hashes and sizes, then whole texts are joined to them once.  Null or blank texts are never taken; of rows that
    are equal in all columns each is taken as often as its place in the stream says; rows that share doc_id, text and source
    but differ elsewhere are told apart; ties go by hash, so reruns agree; an empty table gives an empty mix; clashing names do no harm.
    """
    m, seed = mix(docs, **options), options.get("seed", 7)
    key = h, h2, h3 = [fresh(docs, c) for c in ("h_", "h2_", "h3_")]
    slot, place, end, part, many = (fresh(docs, c) for c in ("slot_", "place_", "end_", "part_", "many_"))
    rows = m.rows.select("src", "bucket", "rn", F.col("h").alias(h), F.col("h2").alias(h2), F.col("h3").alias(h3), "size")
    passes = scheduled(m).groupBy("src", "bucket", "rn", "epoch").agg(F.sum("words").alias("taken"), F.min("slot").alias(slot), F.min("p").alias(place)).join(rows, ["src", "bucket", "rn"])
    passes = materialize(passes.select(*key, slot, place, F.when(F.col("taken") < F.col("size"), F.col("taken")).alias(end)), "passes")
    again = materialize(rows.groupBy(*key).count().where("count > 1").select(*key), "repeated")

    keyed = docs.withColumns(dict(zip(key, keys(docs, seed, *key))))
    narrow = lambda df: df.hint("shuffle_hash")  # noqa: E731  the side without texts is the one that is built
    if again.isEmpty():
        out = keyed.join(narrow(passes), key)
    else:
        # Of equal rows one stands for all; their passes are dealt to slices, each joined with its own copy of the text.
        single = keyed.join(narrow(again), key, "left_anti").join(narrow(passes), key)
        slices = passes.join(again, key).withColumn(part, F.pmod(F.xxhash64(slot, place), F.lit(1 << 20)))
        sizes = slices.groupBy(*key).agg(F.ceil(F.count("*") / SLICE).cast("int").alias(many))
        slices = slices.join(sizes, key).withColumn(part, F.pmod(part, many).cast("int")).drop(many)
        once = keyed.join(narrow(sizes), key).dropDuplicates(key).withColumn(part, F.explode(F.sequence(F.lit(0), F.col(many) - 1))).drop(many)
        out = single.unionByName(once.join(slices, [*key, part]).select(single.columns))
    out = out.withColumn("text", F.when(F.col(end).isNull(), F.col("text")).otherwise(first_words("text", end)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(end).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.sortWithinPartitions(slot, place, *key).select(docs.columns)


def first_words(text: str, n: str) -> Column:
    """The text up to the end of its n-th word."""
    blank = "[\\x20\\x09-\\x0D]+"
    lead = F.col(text).rlike("^" + blank).cast("int")
    pieces = F.split(F.col(text), blank, (F.col(n) + lead + 1).cast("int"))
    rest = F.when(F.size(pieces) > F.col(n) + lead, F.length(F.element_at(pieces, -1))).otherwise(0)
    return F.regexp_replace(F.substring(F.col(text), F.lit(1), F.length(text) - rest), blank + "$", "")
