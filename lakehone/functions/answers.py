"""Predictions in the forms that scores compare."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Words before a colon that announce an answer.
ANNOUNCE = ("answer", "response", "result", "choice", "option", "الإجابة", "الجواب")
#: Punctuation of all scripts but the backslash, and symbols that are split off with it.
MARKS = r"([[\p{P}`÷×<>^~¦+|ـ]&&[^\\]])"


def apart(text: Column, braces: bool = False, vowels: bool = False) -> Column:
    """Spaces around each punctuation mark; with `braces` curly ones become square; with `vowels` short-vowel marks go."""
    out = F.regexp_replace(text, MARKS, " $1 ")
    out = F.translate(out, "{}", "[]") if braces else out
    return F.regexp_replace(out, "[ً-ْ]", "") if vowels else out


def leading(text: str | None) -> str:
    """The announced word of the first line, the line if it has three words at most, or its first word."""
    line = re.sub(r"[^\w\s]+$", "", (text or "").strip().split("\n")[0].strip())
    said = re.match(r"([^:]+):\s*(\S+)", line)
    if said and any(w in said[1].lower() for w in ANNOUNCE):
        return re.sub(r"[^\w\s]", "", said[2]).strip()
    words = line.split()
    return line if len(words) <= 3 else re.sub(r"[^\w\s]", "", words[0]).strip()


def heard(text: str | None) -> str:
    """The text of a transcription: the text or first string of a JSON object, a JSON string, or what quotes enclose."""
    text = (text or "").strip()
    try:
        value = json.loads(text)
    except ValueError:
        value = None
    if isinstance(value, str):
        return value
    if isinstance(value, dict):
        if "text" in value:
            return value["text"] if isinstance(value["text"], str) else str(value["text"] or "")
        first = next((v for v in value.values() if isinstance(v, str)), None)
        if first is not None:
            return first
    quoted = text[:1] in ('"', "'") and text[:1] == text[-1:]
    return text[1:-1] if quoted else text


def option_text(answer: Column, options: Column) -> Column:
    """The text of an option named by its letter (A, or A followed by a bracket) in a map of options; other answers trimmed; null is empty."""
    answer = F.trim(answer)
    letter = F.upper(F.regexp_extract(answer, r"^([A-Za-z])(?:\)|$)", 1))
    return F.coalesce(F.when(letter != "", F.try_element_at(options, letter)), answer, F.lit(""))


def plain_answer(text: Column) -> Column:
    """Lower case, punctuation to spaces, white space collapsed."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}\p{M}_\s]", " "), r"\s+", " ")))


def file_name(text: str | None) -> str | None:
    """A name for ids and files: compatibility form, lower case, 255 characters, no spaces, dots and slashes."""
    if text is None:
        return None
    return re.sub(r"[ ./]", "_", unicodedata.normalize("NFKC", text).lower().replace("\0", "").strip()[:255])


def alike(a: str, b: str) -> float:
    """Twice the longest common subsequence by both lengths."""
    if not a or not b:
        return float(a == b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    # One bit a character: zeros mark where the common subsequence grows.
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        there = row & places.get(c, 0)
        row = (row + there | row - there) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def alike_in_part(a: str, b: str) -> float:
    """The best likeness of the shorter text to a window of its length, cut at the ends, of the longer one."""
    short, long = sorted((a, b), key=len)
    return max((alike(short, long[max(0, i) : i + len(short)]) for i in range(1 - len(short), len(long))), default=float(a == b))


def matches(a: str, b: str, least: float = 0.85) -> bool | None:
    """Whether two normalised answers are alike as wholes or in part; null if one is empty."""
    return alike(a, b) >= least or alike_in_part(a, b) >= least if a and b else None


def _udf(f, kind):
    return pandas_udf(lambda s: s.map(f), kind)


@pandas_udf(T.BooleanType())
def match(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([matches(x or "", y or "") for x, y in zip(a, b)], dtype=object)


@pandas_udf(T.StringType())
def leading_words(texts: pd.Series) -> pd.Series:
    return texts.map(leading)


@pandas_udf(T.StringType())
def heard_texts(texts: pd.Series) -> pd.Series:
    return texts.map(heard)


@pandas_udf(T.StringType())
def file_names(texts: pd.Series) -> pd.Series:
    return texts.map(file_name)


def score_columns(scores: Column) -> Column:
    """nGramScore, mcqScore and judge scores from a map of metric names to values: rougeLsum before bleu."""
    get = lambda *names: F.coalesce(*(F.try_element_at(scores, F.lit(n)) for n in names))
    return F.struct(get("rougeLsum", "rouge", "bleu").alias("nGramScore"), get("accuracy").alias("mcqScore"), get("llm_as_judge", "llm_judge_score").alias("llmAsJudgeScore"), get("mcq_llm_as_judge", "mcq_llm_judge_score").alias("MCQllmAsJudgeScore"))
