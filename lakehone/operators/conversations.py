"""Checks of typed conversations, natively; those that need JSON parsing are Arrow UDFs in functions.toolcalls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.toolcalls import ROLES


def assembled(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """conv_id, messages: turns in order as an array of role and content."""
    ordered = F.array_sort(F.collect_list(F.struct(turn, "role", "text")))
    return turns.groupBy(conv).agg(F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content"))).alias("messages"))


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def reasons(messages: Column, blind: bool = False) -> Column:
    """Reason codes of text conversations, sorted: those of roles and contents."""
    known = F.array(*map(F.lit, ROLES))
    has = lambda test: F.exists(messages, test)
    last = F.element_at(messages, -1)
    said = lambda m: (m["role"] == "assistant") & blank(m["content"])
    codes = {
        "invalid_role": has(lambda m: ~F.coalesce(F.array_contains(known, m["role"]), F.lit(False))),
        "invalid_message_content": has(lambda m: F.when(m["role"] == "user", blank(m["content"])).when(m["role"].isin("system", "developer", "tool"), m["content"].isNull()).otherwise(F.lit(False))),
        "empty_assistant": F.exists(F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0))), said) if blind else has(said),
        "missing_user": ~has(lambda m: F.coalesce(m["role"] == "user", F.lit(False))),
        **({} if blind else {"missing_assistant": ~has(lambda m: F.coalesce(m["role"] == "assistant", F.lit(False))), "final_message_not_assistant": F.coalesce(last["role"] != "assistant", F.lit(True))}),
    }
    found = F.array_compact(F.array(*(F.when(test, code) for code, test in sorted(codes.items()))))
    return F.when(F.size(messages) > 0, found).otherwise(F.array(F.lit("invalid_messages")))


def input_key(messages: Column) -> Column:
    """SHA-256 of the messages without a last one by the assistant; roles and contents as JSON."""
    asked = F.when(F.element_at(messages, -1)["role"] == "assistant", F.slice(messages, 1, F.size(messages) - 1)).otherwise(messages)
    return F.sha2(F.to_json(asked), 256)


def routed(structural: Column, flags: Column, policy: Column, repair: list[str]) -> Column:
    """exclude, repair, review or accept."""
    return F.when(F.size(structural) > 0, "exclude").when(F.arrays_overlap(flags, F.array(*map(F.lit, repair))) if repair else F.lit(False), "repair").when((F.size(flags) > 0) | policy.isNotNull(), "review").otherwise("accept")
