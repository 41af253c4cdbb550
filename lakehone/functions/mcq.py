"""Multiple-choice rows of three layouts, their options and prompts; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "ABCDE"
#: The columns of each layout, and the words of prompts.
LAYOUTS = {
    "keyed": {"id": ["ID", "id"], "question": "Question", "context": "Context", "options": ["Option 1", "Option 2", "Option 3", "Option 4", "Option 5"], "gold": "Answer Key", "few_shot": "is_few_shot"},
    "indexed": {"id": ["id"], "question": "query", "context": None, "options": ["sol1", "sol2", "sol3", "sol4", "sol5"], "gold": "label", "few_shot": None},
    "lettered": {"id": ["id"], "question": "question", "context": None, "options": ["A", "B", "C", "D"], "gold": "answer", "few_shot": None},
}
CONTEXT, QUESTION, CHOICES = "السياق:\n", "السؤال:\n", "الخيارات:\n"
CHOOSE, COMPLETE = "\nأجب بنص الخيار الصحيح فقط.", "\nاتبع التعليمات وأكمل المهمة."
#: What str.strip() takes off.
EDGES = r"^[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$"


def stripped(text: Column) -> Column:
    """White space taken off both ends; null is empty."""
    return F.coalesce(F.regexp_replace(text.cast("string"), EDGES, ""), F.lit(""))


def options(columns: list[Column]) -> Column:
    """letter and text of the options that are not blank; a blank one keeps its letter for itself.  Empty unless two are left."""
    pairs = [F.struct(F.lit(letter).alias("letter"), stripped(c).alias("text")) for letter, c in zip(LETTERS, columns)]
    left = F.filter(F.array(*pairs), lambda o: o["text"] != "")
    return F.when(F.size(left) >= 2, left).otherwise(F.slice(left, 1, 0))


def gold_letter(layout: str, gold: Column) -> Column:
    """The letter that a gold answer names: a letter of its own, or (`indexed`) the place of the option, counted from 0; null if it names none."""
    if layout == "indexed":
        return F.get(F.array(*map(F.lit, LETTERS)), gold.try_cast("int"))
    text = F.upper(stripped(gold))
    return F.when(text.rlike(f"^[{LETTERS}]$"), text)


def question_text(question: Column, context: Column, choices: Column) -> Column:
    """The prompt: the context, if there is one, the question and its lettered choices."""
    lines = F.array_join(F.transform(choices, lambda o: F.concat(o["letter"], F.lit(". "), o["text"])), "\n")
    asked = F.when(context != "", F.concat(F.lit(CONTEXT), context, F.lit("\n\n" + QUESTION), question)).otherwise(question)
    return F.concat(asked, F.lit("\n\n" + CHOICES), lines)


def completion_text(instruction: Column, inputs: Column, choices: Column) -> Column:
    """The prompt of an evaluation row: its parts that are not empty, then the choices (array<string>) and what to do with them, or what to do without."""
    parts = F.array_join(F.filter(F.array(instruction, inputs), lambda p: F.coalesce(p, F.lit("")) != ""), "\n\n")
    letters = F.transform(choices, lambda c, i: F.concat(F.char(i + 65), F.lit(". "), c))
    listed = F.concat(F.lit("\n\n" + CHOICES), F.array_join(letters, "\n"), F.lit(CHOOSE))
    return F.concat(parts, F.when(F.coalesce(F.size(choices), F.lit(0)) > 0, listed).otherwise(F.lit(COMPLETE)))


def items(rows: DataFrame, layout: str, subset: Column | None = None, index: str | None = None) -> DataFrame:
    """id ("subset:id"), subset, question (the prompt), choices (letters), gold of the rows that are whole.

    Rows that are to be shown as examples, that have no question or fewer than two options, or whose gold answer is not the letter of an
    option that is there are left out.  index: the column that counts rows, for layouts and rows without ids.
    """
    names = LAYOUTS[layout]
    col = lambda c: F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string")
    subset = F.lit("") if subset is None else subset
    shown = F.coalesce(~col(names["few_shot"]).cast("string").isin("0", "false", ""), F.lit(False)) if names["few_shot"] else F.lit(False)
    identity = F.coalesce(*(col(c).cast("string") for c in names["id"]), *([F.col(index).cast("string")] if index else []), F.lit(""))
    parts = rows.select(
        F.concat(subset, F.lit(":"), identity).alias("id"),
        subset.alias("subset"),
        stripped(col(names["question"])).alias("question"),
        (stripped(col(names["context"])) if names["context"] else F.lit("")).alias("context"),
        options([col(c) for c in names["options"]]).alias("options"),
        gold_letter(layout, col(names["gold"])).alias("gold"),
        shown.alias("shown"),
    )
    whole = (F.col("question") != "") & F.exists("options", lambda o: o["letter"] == F.col("gold"))
    found = parts.where(~F.col("shown") & whole)
    return found.select("id", "subset", question_text(F.col("question"), F.col("context"), F.col("options")).alias("question"), F.transform("options", lambda o: o["letter"]).alias("choices"), "gold")
