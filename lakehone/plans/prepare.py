"""The decision on each row: kept, held out, excluded or quarantined; as joins and aggregations, free of row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.adapt import METADATA, adapted, metadata
from ..functions.text import overlap_keys
from ..operators.dedup import grouped_split, hash_split
from ..session import lower_batches

#: What decisions are made of, besides the keys of user texts.
DECIDING = ["id", "dataset", "split", "original_split", "row_index", "official", "preserved", "labeled", "job_rank", "problems", "example_hash", "input_hash", "reserved_hash"]
#: Order of jobs: preserved test, validation and training splits before all others.
RANKS = {"test": 0, "validation": 1, "train": 2}


def prepared(raw: DataFrame) -> DataFrame:
    """raw (dataset, repo, revision, config, kind, preserved, labeled, original_split, row_index, source, task, messages_json, tools_json, and what there is of METADATA) adapted and identified."""
    identity = F.concat(F.col("repo"), F.lit("@"), "revision", F.lit(":"), "config", F.lit(":"), "original_split", F.lit(":"), F.col("row_index").cast("string"))
    known = raw.withColumns({"source": F.coalesce("source", F.lit("unknown")), "task": F.coalesce("task", F.lit("unknown"))})
    rows = known.select(*(c for c in known.columns if c not in ("messages_json", "tools_json", *METADATA)), metadata(raw.columns).alias("metadata_json"), adapted("messages_json", "tools_json", "kind", ~F.col("labeled")).alias("a"))
    rows = rows.select(*(c for c in rows.columns if c != "a"), "a.*")
    nameless = (F.col("source") == "unknown") | (F.col("task") == "unknown")
    official = F.col("preserved") & (F.col("original_split") != "train")
    split = F.when(F.col("original_split") == "dev", "validation").otherwise(F.col("original_split"))
    rank = F.when(F.col("preserved"), F.coalesce(*(F.when(split == k, v) for k, v in RANKS.items()), F.lit(3))).otherwise(3)
    return rows.withColumns({
        "id": F.sha2(identity, 256),
        "problems": F.when(nameless, F.array_append("problems", F.lit("missing_source_or_task"))).otherwise(F.col("problems")),
        "official": official,
        "split": split,
        "job_rank": rank,
    })


def decided(rows: DataFrame, benchmarks: DataFrame, seed=42, fraction: float = 0.02) -> DataFrame:
    """rows of prepared() with decision, reason, split, duplicate_of, benchmark_matches.  text_hashes, the overlap_keys() of user_texts, can stand in their place.

    The rows are read five times, once for each thing that is known of all of them, and the UDFs before them are dear: only what decides
    (ids, hashes, splits, keys of user texts) is kept in memory or on disk meanwhile, and decisions are joined to the rows by id.

    Joins on a key want it not null, and Spark moves that test below the UDF's place and evaluates the UDF for it once more, in a second
    Python worker of the same task: keys of user texts are kept with the rows, and those of benchmarks can't be null.
    """
    lower_batches(rows.sparkSession)
    keys = F.col("text_hashes") if "text_hashes" in rows.columns else overlap_keys("user_texts").alias("text_hashes")
    rows, whole = rows.select(*DECIDING, keys).persist(), rows
    good = F.size("problems") == 0
    reserved = rows.where("official").select(F.coalesce("input_hash", "reserved_hash").alias("input_hash"), "split").where("input_hash is not null")
    reserved = reserved.groupBy("input_hash").agg(F.min("split").alias("held"))  # test before validation
    texts = rows.where(good).select("id", F.explode(F.array_distinct("text_hashes")).alias("hash"))
    matches = texts.join(benchmarks.withColumn("hash", F.coalesce("hash", F.lit(""))), "hash").groupBy("id").agg(F.array_sort(F.collect_set("name")).alias("benchmark_matches"))
    own = F.when(F.col("preserved") & (F.col("split") == "train"), F.lit("train"))
    trained = rows.where(good & own.isNotNull()).select("input_hash").distinct().withColumn("in_train", F.lit(True))
    # A null hash joins nothing: quarantined rows keep their place without a shuffle to one task.
    first = F.struct("job_rank", "dataset", "split", "row_index", "id")
    out = rows.join(reserved, "input_hash", "left").join(trained, "input_hash", "left").join(matches, "id", "left")
    out = out.withColumn("early", F.when(~good, "quarantine").when(~F.col("official") & F.col("held").isNotNull(), "official_holdout_overlap").when(~F.col("official") & F.col("benchmark_matches").isNotNull(), "benchmark_overlap"))
    firsts = out.where("early is null").groupBy("example_hash").agg(F.min(first).getField("id").alias("first_id"))
    out = out.join(firsts, "example_hash", "left")
    repeated = F.col("early").isNull() & ~F.col("official") & (F.col("first_id") != F.col("id"))
    split = F.when(~good | F.col("official"), F.col("split")).when(F.col("held").isNotNull(), F.col("held")).when(F.col("in_train"), "train").otherwise(hash_split(seed, F.col("input_hash"), fraction))
    told = out.select(
        "id",
        F.when(F.col("early") == "quarantine", "quarantine").when(F.col("early").isNotNull() | repeated, "exclude").when(F.col("labeled"), "keep").otherwise("holdout").alias("decision"),
        F.when(F.col("early") == "quarantine", F.col("problems")).when(F.col("early").isNotNull(), F.array("early")).when(repeated, F.array(F.lit("exact_duplicate"))).otherwise(F.array().cast("array<string>")).alias("reasons"),
        split.alias("split"),
        F.when(repeated, F.col("first_id")).alias("duplicate_of"),
        F.coalesce("benchmark_matches", F.array().cast("array<string>")).alias("benchmark_matches"),
    )
    return whole.select(*(c for c in whole.columns if c not in ("split", "reserved_hash", "user_texts", "text_hashes"))).join(told, "id")


__all__ = ["decided", "grouped_split", "prepared"]
