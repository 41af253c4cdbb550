"""Answer metrics."""

from __future__ import annotations

import math
import re
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

CHOICE = r"(?:answer|option|الإجابة|الجواب|الخيار)"
LAST_LINE = re.compile(rf"(?:{CHOICE}\s*[:：]?\s*)?\(?([A-E])\)?[.!،]?", re.I)
LABELLED = re.compile(rf"{CHOICE}\s*[:：]?\s*\(?([A-E])\)?\b", re.I)


def choice(text: str | None) -> str | None:
    """The letter of a lone choice on the last line, or of the one labelled choice; reasoning between think tags aside."""
    text = re.sub(r"(?is)<think>.*?</think>", "", text or "").strip()
    lines = [x for x in map(str.strip, text.splitlines()) if x]
    if lines and (found := LAST_LINE.fullmatch(lines[-1])):
        return found[1].upper()
    labelled = LABELLED.findall(text)
    return labelled[0].upper() if len(labelled) == 1 else None


def plain(text: str) -> str:
    return " ".join(re.sub(r"[^\w\s]", " ", text.casefold()).split())


def fuzzy(prediction: str, references: list[str], least: float = 0.85) -> float:
    """1 if the prediction, or a part as long as the reference, is alike to a reference.

    The characters that match are a common subsequence, so a part whose longest one is too short is not compared; with each step of
    the part that one grows by one character at most, so as many steps are passed over as are missing.
    """
    p = plain(prediction)
    for r in filter(None, map(plain, references)) if p else ():
        places = positions(r)
        if 2 * common_length(places, p) >= least * (len(r) + len(p)) - 1e-6 and SequenceMatcher(None, r, p).ratio() >= least:
            return 1.0
        i, last = 0, max(0, len(p) - len(r))
        while i <= last:
            x = p[i : i + len(r)]
            missing = math.ceil(least * (len(r) + len(x)) / 2 - 1e-6) - common_length(places, x)
            if missing <= 0 and SequenceMatcher(None, r, x).ratio() >= least:
                return 1.0
            i += max(1, missing)
    return 0.0


def grams(words: list[str], n: int) -> Counter:
    return Counter(zip(*(words[i:] for i in range(n))))


def bleu(prediction: str, references: list[str]) -> float:
    """Sentence BLEU of orders 1 to 4, one added to each count, brevity by the closest reference."""
    p, refs = prediction.split(), [r.split() for r in references if r]
    if not p or not refs:
        return 0.0
    near = min(map(len, refs), key=lambda k: (abs(k - len(p)), k))
    total = 0.0
    for n in range(1, 5):
        own, best = grams(p, n), Counter()
        for r in refs:
            best |= grams(r, n)
        total += math.log(((own & best).total() + 1) / (own.total() + 1)) / 4
    return min(1.0, math.exp(1 - near / len(p))) * math.exp(total)


def f1(common: int, a: int, b: int) -> float:
    return 2 * common / (a + b) if common else 0.0


def positions(a) -> dict:
    """The places of each element of a, as bits."""
    out = {}
    for i, x in enumerate(a):
        out[x] = out.get(x, 0) | 1 << i
    return out


def common_length(places: dict, b) -> int:
    """Length of the longest common subsequence with b of the sequence of these places, a row at a time as bits (Hyyrö)."""
    full = (1 << max((m.bit_length() for m in places.values()), default=0)) - 1
    row = full
    for y in b:
        if m := places.get(y):
            both = row & m
            row = (row + both | row - both) & full
    return full.bit_count() - row.bit_count()


def common_subsequence(a: list[str], b: list[str]) -> int:
    return common_length(positions(a), b)


def rouge(prediction: str, references: list[str]) -> dict[str, float]:
    """F1 of words, word pairs and the longest common subsequence, each the best over the references."""
    p = prediction.split()
    out = {"rouge1": 0.0, "rouge2": 0.0, "rougeL": 0.0}
    for r in map(str.split, references) if p else ():
        for n in (1, 2):
            a, b = grams(p, n), grams(r, n)
            out[f"rouge{n}"] = max(out[f"rouge{n}"], f1((a & b).total(), a.total(), b.total()))
        out["rougeL"] = max(out["rougeL"], f1(common_subsequence(p, r), len(p), len(r)))
    return out


def edits(a, b) -> int:
    """Least number of insertions, deletions and replacements, a row of the table at a time as bits (Myers, Hyyrö)."""
    if not a or not b:
        return len(a) + len(b)
    places, full, last = positions(a), (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, count = full, 0, len(a)
    for y in b:
        same = places.get(y, 0)
        across = ((same & up) + up ^ up) | same
        more, less = down | full & ~(across | up), up & across
        count += bool(more & last) - bool(less & last)
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | full & ~(same | down | more), more & (same | down)
    return count


def word_errors(prediction: str, reference: str) -> float | None:
    """Word edits by reference words; null for an empty pair."""
    p, r = prediction.split(), reference.split()
    return edits(p, r) / len(r) if p and r else None


@pandas_udf(T.StringType())
def answer_choice(texts: pd.Series) -> pd.Series:
    return texts.map(choice)


@pandas_udf(T.StructType([T.StructField("bleu", T.DoubleType()), T.StructField("rouge1", T.DoubleType()), T.StructField("rouge2", T.DoubleType()), T.StructField("rougeL", T.DoubleType()), T.StructField("accuracy", T.DoubleType()), T.StructField("wer", T.DoubleType())]))
def scored(predictions: pd.Series, references: pd.Series) -> pd.DataFrame:
    """All metrics of a prediction against an array of references."""
    rows = []
    for p, refs in zip(predictions, references):
        p, refs = p or "", [r for r in (refs if refs is not None else []) if r is not None]
        rates = [w for r in refs if (w := word_errors(p, r)) is not None]
        rows.append({"bleu": bleu(p, refs), **rouge(p, refs), "accuracy": fuzzy(p, refs), "wer": min(rates, default=None)})
    return pd.DataFrame(rows, columns=["bleu", "rouge1", "rouge2", "rougeL", "accuracy", "wer"]).astype(float)


@pandas_udf(T.DoubleType())
def character_errors(predictions: pd.Series, references: pd.Series) -> pd.Series:
    """Character edits by reference characters; null for an empty pair."""
    return pd.Series([edits(p, r) / len(r) if p and r else None for p, r in zip(predictions, references)], dtype=float)


def rouge_words(prediction: Column, reference: Column) -> Column:
    """ROUGE-1 F1 of one reference, natively: words that both have, as often as both have them."""
    words = lambda t: F.filter(F.split(F.coalesce(t, F.lit("")), r"\s+"), lambda w: w != "")

    def score(a: Column, b: Column) -> Column:
        times = lambda x, w: F.size(F.filter(x, lambda y: y == w))
        common = F.aggregate(F.transform(F.array_intersect(a, b), lambda w: F.least(times(a, w), times(b, w))), F.lit(0), lambda n, x: n + x)
        return F.when(F.size(a) + F.size(b) > 0, 2 * common / (F.size(a) + F.size(b))).otherwise(F.lit(0.0))

    return F.get(F.transform(F.array(F.struct(words(prediction).alias("a"), words(reference).alias("b"))), lambda x: score(x["a"], x["b"])), F.lit(0))


#: Metrics by name, in the order in which names are looked for.
REGISTERED = ("accuracy", "bleu", "cer", "new_metric", "rouge", "wer")


def detected(name: str) -> str | None:
    """The first registered metric whose name is part of a name."""
    return next((m for m in REGISTERED if m in name.lower()), None)


def dispatched(metric: Column, scores: Column) -> Column:
    """What a row's metric takes of scored(): accuracy, bleu, or the rouge values; any other name is an error."""
    name = F.lower(metric)
    pick = lambda *names: F.create_map(*(x for n in names for x in (F.lit(n), scores[n])))
    return F.when(name == "accuracy", pick("accuracy")).when(name == "bleu", pick("bleu")).when(name == "rouge", pick("rouge1", "rouge2", "rougeL")).otherwise(F.raise_error(F.concat(F.lit("no such metric: "), F.coalesce(metric, F.lit("null")))))


def plain_bleu(prediction: str, reference: str) -> float | None:
    """BLEU of orders 1 to 4 without smoothing: 0 if an order has no match; null for an empty pair."""
    p, r = prediction.split(), reference.split()
    if not p or not r:
        return None
    shares = [(grams(p, n) & grams(r, n)).total() / max(1, len(p) - n + 1) for n in range(1, 5)]
    return math.exp(sum(map(math.log, shares)) / 4 + min(0.0, 1 - len(r) / len(p))) if min(shares) > 0 else 0.0


def matched(a: list[str], b: list[str]) -> set[int]:
    """Places of b in one longest common subsequence with a."""
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[j]))
        rows.append(row)
    i, j, out = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.add(j)
        elif rows[i - 1][j] >= rows[i][j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def rouge_lines(prediction: str, reference: str) -> float:
    """ROUGE-Lsum F1: words of each reference line in a common subsequence with some line of the prediction, no word more often than both have it."""
    p, r = ([line.split() for line in t.split("\n") if line.strip()] for t in (prediction, reference))
    left = [Counter(w for line in t for w in line) for t in (p, r)]
    sizes = [c.total() for c in left]
    common = 0
    for line in r:
        for at in sorted(set().union(*(matched(x, line) for x in p))) if p else ():
            if left[0][line[at]] > 0 and left[1][line[at]] > 0:
                left[0][line[at]] -= 1
                left[1][line[at]] -= 1
                common += 1
    return f1(common, *sizes)


@pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("bleu", "rouge1", "rouge2", "rougeL", "rougeLsum")]))
def corpus_scored(predictions: pd.Series, references: pd.Series) -> pd.DataFrame:
    """Of each pair what a corpus's mean is taken of: BLEU without smoothing (null for an empty pair, which no mean counts) and ROUGE with its value by lines."""
    rows = [{"bleu": plain_bleu(p or "", r or ""), **rouge(p or "", [r or ""]), "rougeLsum": rouge_lines(p or "", r or "")} for p, r in zip(predictions, references)]
    return pd.DataFrame(rows, columns=["bleu", "rouge1", "rouge2", "rougeL", "rougeLsum"]).astype(float)
