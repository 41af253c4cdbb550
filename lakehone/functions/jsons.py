"""JSON in canonical forms, and strict parsing."""

from __future__ import annotations

import hashlib
import json
import math

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def stored(value) -> str:
    """Sorted keys and spaced separators: what is written to columns."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, allow_nan=False)


def compact(value) -> str:
    """Sorted keys and tight separators: what is hashed."""
    return json.dumps(value, ensure_ascii=False, sort_keys=True, allow_nan=False, separators=(",", ":"))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprints(messages: list, tools: list) -> tuple[str, str]:
    """Hashes of a whole example, and of its input: without a last message by the assistant."""
    last = messages[-1] if messages else None
    asked = messages[:-1] if isinstance(last, dict) and last.get("role") == "assistant" else messages
    return tuple(sha256(compact({"messages": m, "tools": tools})) for m in (messages, asked))


def _constant(text: str):
    raise ValueError(f"not JSON: {text}")


def _once(pairs: list) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a key stands twice")
    return out


def strict(text: str):
    """Parses JSON without NaN, infinities and repeated keys."""
    return json.loads(text, parse_constant=_constant, object_pairs_hook=_once)


def finite(value) -> bool:
    """Whether a value has JSON's types only, with finite numbers and string keys."""
    if isinstance(value, dict):
        return all(isinstance(k, str) and finite(v) for k, v in value.items())
    if isinstance(value, list):
        return all(map(finite, value))
    return math.isfinite(value) if isinstance(value, float) else value is None or isinstance(value, (str, bool, int))


@pandas_udf(T.BooleanType())
def is_strict(texts: pd.Series) -> pd.Series:
    """Whether each text is JSON of finite numbers in which no key stands twice; null for null."""
    def one(text):
        try:
            return None if text is None else finite(strict(text))
        except (ValueError, RecursionError):
            return False

    return texts.map(one)
