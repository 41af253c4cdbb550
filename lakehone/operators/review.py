"""Review of a prepared run: which rows are looked at, how many there are, what was found, and what people and judges say of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import list_hash, quoted, rank_hash, top_per_group


def eligible(rows: DataFrame, original: bool = False) -> DataFrame:
    """Labeled rows of the training split (with `original`: of the original one as well).  A plain filter, so that it stands before any UDF and reaches the scan."""
    test = F.col("is_labeled") & (F.col("split") == "train")
    return rows.where(test & (F.col("original_split") == "train") if original else test)


def populations(rows: DataFrame, group: list[str], k: int) -> DataFrame:
    """population and sampled (k at most) of each group, without drawing the sample."""
    counted = rows.groupBy(*group).agg(F.count("*").alias("population"))
    return counted.withColumn("sampled", F.least("population", F.lit(k)).cast("long"))


def flag_counts(rows: DataFrame, flags: str = "flags", checks: str = "checks") -> DataFrame:
    """kind (flag, check or skipped), name, n: rows with each; a name that a row has twice counts once."""
    tagged = lambda names, kind: F.transform(F.array_distinct(names), lambda x: F.struct(kind(x).alias("kind"), x.alias("name")))
    skipped = lambda x: F.when(x.contains("_skipped_"), "skipped").otherwise("check")
    every = F.concat(tagged(flags, lambda x: F.lit("flag")), tagged(checks, skipped))
    return rows.select(F.explode(every).alias("t")).groupBy("t.kind", "t.name").agg(F.count("*").alias("n"))


def flag_samples(rows: DataFrame, flags: str, id_col: str, k: int, seed=42) -> DataFrame:
    """At most k rows of each flag, by rank hash; a row may stand under several flags."""
    return top_per_group(rows.withColumn("flag", F.explode(F.array_distinct(flags))), ["flag"], id_col, k, seed)


def first_by_rank(rows: DataFrame, key: str, id_col: str, seed=42) -> DataFrame:
    """The row of the smallest rank hash of each key: a minimum that is combined before the shuffle."""
    row = F.struct(rank_hash(seed, F.col(id_col)).alias("rank"), *(c for c in rows.columns if c != key))
    least = rows.groupBy(key).agg(F.min(row).alias("row"))
    return least.select(*(F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns))


def shown_order(rows: DataFrame, id_col: str, seed=42) -> DataFrame:
    """rows with place, from 1, in an order that tells nothing of their origin.  For packs of bounded size: all rows are numbered in one order."""
    rank = list_hash(F.lit(str(seed)), quoted(F.lit("display")), quoted(F.col(id_col)))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(rank, id_col)))


def exactly(rows: DataFrame, n: int) -> DataFrame:
    """rows, if there are n of them at least; ValueError otherwise."""
    if (have := rows.limit(n).count()) < n:
        raise ValueError(f"{have} rows, not {n}")
    return rows


def labels_joined(sample: DataFrame, labels: DataFrame) -> DataFrame:
    """sample (id, example_hash, ...) with label and note of labels (id, example_hash, label, note), null where there are none.

    ValueError if an id is labelled twice or a label's hash is not that of the row: labels of another text must not be counted.
    """
    known = labels.select("id", F.col("example_hash").alias("_hash"), "label", "note")
    twice = known.groupBy("id").count().where("count > 1").agg(F.count("*").alias("n"))
    other = sample.select("id", "example_hash").join(known, "id").where(~F.col("example_hash").eqNullSafe(F.col("_hash"))).agg(F.count("*").alias("n"))
    bad = twice.select(F.lit("labelled twice").alias("what"), "n").union(other.select(F.lit("of another text"), "n")).where("n > 0").collect()
    if bad:
        raise ValueError("; ".join(f"{r.n} labels {r.what}" for r in bad))
    return sample.join(known.drop("_hash"), "id", "left")


def judged(labels: DataFrame, judgments: DataFrame, words: dict[str, str]) -> DataFrame:
    """labels with judge: the judgment's decision in the words of people, `unjudged` where there is none or it is no known decision."""
    said = judgments.select("id", F.coalesce(*(F.when(F.col("decision") == k, v) for k, v in words.items())).alias("judge"))
    return labels.join(said, "id", "left").withColumn("judge", F.coalesce("judge", F.lit("unjudged")))


def attempted(sample: DataFrame, attempts: DataFrame) -> DataFrame:
    """Rows of the sample with their attempts; a row without one is left out."""
    return sample.join(attempts, "id")


def rubric(task: Column, hint: Column, rubrics: dict[str, str], default: str) -> Column:
    """The rubric of the task, else of the hint, else the default."""
    of = lambda name: F.coalesce(*(F.when(name == k, v) for k, v in rubrics.items()), F.lit(None).cast("string"))
    return F.coalesce(of(task), of(hint), F.lit(default))


#: What a judge may see of a message.
SHOWN = ["role", "content", "tool_calls", "tool_call_id", "name"]


def judge_payload(messages: Column, fields: list[str], tools: Column, structural: Column) -> Column:
    """JSON of the allowed keys of messages, the tools and whether the structure is sound; stored reasoning, labels and flags are not among them.

    messages: an array of structs with `fields`; tools: JSON text.
    """
    shown = F.transform(messages, lambda m: F.struct(*(m[f].alias(f) for f in SHOWN if f in fields)))
    return F.to_json(F.struct(shown.alias("messages"), tools.alias("tools"), (F.size(structural) == 0).alias("structure_valid")))


def blind(rows: DataFrame, shown: list[str]) -> DataFrame:
    """ids and what may be shown, nothing of origin, flags or judgments."""
    return rows.select("id", "example_hash", "input_hash", *shown)
