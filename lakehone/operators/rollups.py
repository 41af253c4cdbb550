"""Counts and accuracy by group."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def accuracy_sets(df: DataFrame, outer: str, inner: str, correct: Column, unparsed: Column | None = None) -> DataFrame:
    """n, correct, accuracy, unparsed by outer group and by outer and inner group (null for all of the outer one)."""
    flagged = df.select(outer, inner, correct.cast("boolean").alias("_ok"), (unparsed if unparsed is not None else F.lit(False)).alias("_un"))
    return flagged.groupingSets([[outer], [outer, inner]], outer, inner).agg(
        F.count("*").alias("n"), F.count_if("_ok").alias("correct"), F.round(F.count_if("_ok") / F.count("*"), 6).alias("accuracy"), F.count_if("_un").alias("unparsed"), F.grouping(inner).cast("int").alias("whole")
    )


def confusion(df: DataFrame, reference: str, judged: str) -> DataFrame:
    return df.groupBy(reference, judged).agg(F.count("*").alias("n"))


def agreement(df: DataFrame, group: str, human: str, judge: str, good, bad) -> DataFrame:
    """n, agreed, flawed_kept, usable_rejected, unjudged by group."""
    h, j = F.col(human), F.col(judge)
    return df.groupBy(group).agg(
        F.count("*").alias("n"), F.count_if(h == j).alias("agreed"), F.count_if((h == bad) & (j == good)).alias("flawed_kept"), F.count_if((h == good) & (j == bad)).alias("usable_rejected"), F.count_if(j.isNull()).alias("unjudged")
    )


def exploded_counts(df: DataFrame, flags: str, name: str = "flag") -> DataFrame:
    """Rows that have each flag; a flag that a row has twice counts once."""
    return df.select(F.explode(F.array_distinct(flags)).alias(name)).groupBy(name).agg(F.count("*").alias("n"))


def metric_means(df: DataFrame, group: list[str], metrics: list[str]) -> DataFrame:
    return df.groupBy(*group).agg(F.count("*").alias("n"), *(F.round(F.avg(m), 4).alias(m) for m in metrics))


def judge_scores(df: DataFrame, task: str, score: str) -> DataFrame:
    """Mean, least, greatest and number of scores by task and over all (null)."""
    return df.rollup(task).agg(F.round(F.avg(score), 5).alias("mean"), F.min(score).alias("least"), F.max(score).alias("greatest"), F.count(score).alias("n"))


def costs(prompt_tokens: Column, output_tokens: Column, prefill: str, sample: str) -> Column:
    """Price of prompt and output tokens, given per million of each, rounded to six places; sums are exact decimals."""
    price = lambda tokens, each: tokens.cast("decimal(20,0)") * F.lit(Decimal(each))
    return F.round((price(prompt_tokens, prefill) + price(output_tokens, sample)) * F.lit(Decimal("0.000001")), 6).cast("double")


def cost_sums(attempts: DataFrame, group: list[str] | None = None) -> DataFrame:
    """n, reserved, charged and committed (a charge where it is known, else its reservation), exact decimal sums of text amounts."""
    amount = lambda c: F.col(c).cast("decimal(38,12)")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,12)")
    return attempts.groupBy(*(group or [])).agg(F.count("*").alias("n"), total(amount("reservation")).alias("reserved"), total(amount("charge")).alias("charged"), total(F.coalesce(amount("charge"), amount("reservation"))).alias("committed"))


def missing_sources(df: DataFrame, source: str, expected: list[str]) -> DataFrame:
    """observed: the sources that are there, missing: those expected that are not; both sorted, in one row.  There are as many sources as names in a configuration."""
    seen = F.array_sort(F.collect_set(source))
    wanted = F.array(*map(F.lit, sorted(set(expected)))) if expected else F.array().cast("array<string>")
    return df.agg(seen.alias("observed")).select("observed", F.array_except(wanted, "observed").alias("missing"))


def reason_summary(df: DataFrame, decision: str, reasons: str) -> DataFrame:
    """decision, reason, n: rows by decision (reason null) and by decision and reason; a reason that a row has twice counts once."""
    rows = df.select(F.col(decision).alias("decision"), F.explode(F.concat(F.array(F.lit(None).cast("string")), F.array_distinct(reasons))).alias("reason"))
    return rows.groupBy("decision", "reason").agg(F.count("*").alias("n"))


def curation_counts(df: DataFrame) -> DataFrame:
    """counter, name, n: rows of curated() by decision, reason, flag, check, dialect, and source with decision."""
    one = lambda counter, name: F.array(F.struct(F.lit(counter).alias("counter"), name.alias("name")))
    each = lambda counter, names: F.transform(F.array_distinct(names), lambda x: F.struct(F.lit(counter).alias("counter"), x.alias("name")))
    every = F.concat(one("decision", F.col("decision")), each("reason", F.col("reasons")), each("flag", F.col("flags")), each("check", F.col("checks")), one("dialect", F.col("dialect")), one("source", F.concat_ws("/", "source", "decision")))
    return df.select(F.explode(every).alias("c")).groupBy("c.counter", "c.name").agg(F.count("*").alias("n"))


def reconciled(inspected: int, skipped: int, footer: int) -> None:
    """ValueError unless the rows that were looked at and those that were passed over are all rows of the files."""
    if inspected + skipped != footer:
        raise ValueError(f"{inspected} rows inspected and {skipped} skipped are not the {footer} of the files")


def ensembled(scores: DataFrame, item: list[str], score: str) -> DataFrame:
    """n, mean and median of the scores that several judges give an item; nulls do not count."""
    return scores.groupBy(*item).agg(F.count(score).alias("n"), F.round(F.avg(score), 5).alias("mean"), F.round(F.median(score), 5).alias("median"))


def batch_stats(scores: DataFrame, group: list[str], score: str, threshold: float = 0.5) -> DataFrame:
    """n, mean, median and pass_rate of the scores of each group."""
    passed = F.avg(F.when(F.col(score).isNotNull(), (F.col(score) >= threshold).cast("double")))
    return scores.groupBy(*group).agg(F.count(score).alias("n"), F.round(F.avg(score), 5).alias("mean"), F.round(F.median(score), 5).alias("median"), F.round(passed, 5).alias("pass_rate"))


def normalised(score: Column, thirds: bool = False) -> Column:
    """A judge's score between 0 and 1: of 3 points a third each, others cut off at the ends."""
    return F.round(score / 3, 5) if thirds else F.greatest(F.lit(0.0), F.least(F.lit(1.0), score.cast("double")))


def passes(score: Column, threshold: float = 0.5) -> Column:
    return score >= threshold


def task_average(scores: DataFrame, task: str, metric: str, score: str) -> DataFrame:
    """score of each task and, with task null, the mean of all tasks, rounded to four places.  ROUGE is stood for by rougeLsum; a task has one score, the mean of its rows."""
    chosen = scores.where(~F.col(metric).isin("rouge1", "rouge2", "rougeL"))
    each = chosen.groupBy(F.col(task).alias("task")).agg(F.avg(score).alias("score"))
    every = each.agg(F.lit(None).cast(scores.schema[task].dataType).alias("task"), F.avg("score").alias("score"))
    return each.union(every).select("task", F.round("score", 4).alias("score")).where("score is not null or task is not null")
