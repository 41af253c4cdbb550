"""Curation of kept training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import signalled
from ..operators.conversations import routed
from ..operators.review import eligible

#: Columns of a candidate that curation passes on, if it has them.
COMMON = ("id", "dataset", "revision", "source", "task", "original_split", "split", "row_index", "is_labeled", "example_hash", "input_hash")
SCOPE = "offline_rules"


def policy(col: str, rules: dict[str, str]) -> Column:
    """The reason that a configuration gives for a source or task; a configuration's names become one expression, no join."""
    return F.coalesce(*(F.when(F.col(col) == k, v) for k, v in rules.items()), F.lit(None).cast("string"))


def curated(candidates: DataFrame, repair_flags: list[str], review_sources: dict[str, str], review_tasks: dict[str, str], no_call_sources: list[str] = (), scope: str = SCOPE) -> DataFrame:
    """COMMON columns, task_hint, dialect, tool_behavior, decision, reasons, flags, checks and scope of labeled training rows.

    The filter stands before the UDF, so held-out JSON is never parsed.
    """
    rows = signalled(eligible(candidates), no_call_sources)
    rows = rows.withColumns({"p1": policy("source", review_sources), "p2": policy("task", review_tasks)})
    reasons = F.array_sort(F.array_distinct(F.array_compact(F.concat("structural", "flags", F.array("p1", "p2")))))
    dialect = F.get_json_object("metadata_json", "$.dialect") if "metadata_json" in candidates.columns else F.lit(None).cast("string")
    return rows.select(
        *(c for c in COMMON if c in candidates.columns),
        F.coalesce("hint", F.lit("")).alias("task_hint"),
        F.coalesce(dialect, F.lit("unspecified")).alias("dialect"),
        "tool_behavior",
        routed(F.col("structural"), F.col("flags"), F.coalesce("p1", "p2"), list(repair_flags)).alias("decision"),
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("offline_checks_passed"))).alias("reasons"),
        "flags",
        "checks",
        F.lit(scope).alias("scope"),
    )
