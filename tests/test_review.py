"""Review operators, runs, multiple-choice rows, task files, sinks and metrics of corpora."""

import hashlib
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from lakehone.functions import mcq, metrics
from lakehone.operators import overlap, review, rollups, sampling
from lakehone.plans import runs
from lakehone.sources import readers, sinks, tasks


def test_exact_sizes(spark):
    rows = spark.range(5)
    assert review.exactly(rows, 5).count() == 5
    with pytest.raises(ValueError, match="5 rows, not 6"):
        review.exactly(rows, 6)


def test_labels_must_be_of_the_text(spark):
    sample = spark.createDataFrame([("1", "h1"), ("2", "h2")], "id string, example_hash string")
    label = lambda *rows: spark.createDataFrame(rows, "id string, example_hash string, label string, note string")
    got = {r.id: r.label for r in review.labels_joined(sample, label(("1", "h1", "usable", ""))).collect()}
    assert got == {"1": "usable", "2": None}
    for bad, why in ((label(("1", "h1", "a", ""), ("1", "h1", "b", "")), "labelled twice"), (label(("2", "h1", "a", "")), "of another text"), (label(("2", None, "a", "")), "of another text")):
        with pytest.raises(ValueError, match=why):
            review.labels_joined(sample, bad)


def test_payload_shows_what_is_allowed(spark):
    rows = spark.createDataFrame([([("user", "hi", "secret")],)], "m array<struct<role:string,content:string,think:string>>")
    (r,) = rows.select(review.judge_payload(F.col("m"), ["role", "content", "think"], F.lit("[]"), F.array().cast("array<string>")).alias("p")).collect()
    assert json.loads(r.p) == {"messages": [{"role": "user", "content": "hi"}], "tools": "[]", "structure_valid": True}


def test_reconciled():
    rollups.reconciled(3, 4, 7)
    with pytest.raises(ValueError):
        rollups.reconciled(3, 3, 7)


def test_lock_and_stages(spark, tmp_path):
    with runs.locked(f"{tmp_path}/lock"), pytest.raises(BlockingIOError), runs.locked(f"{tmp_path}/lock"):
        pass
    with runs.locked(f"{tmp_path}/lock"):
        pass
    made = []

    def make():
        made.append(1)
        return spark.range(4)

    one = runs.fingerprint({"seed": 1}, {"a": 4})
    assert one == runs.fingerprint({"seed": 1}, {"a": 4}) != runs.fingerprint({"seed": 1}, {"a": 5})
    for identity in (one, one, "other", "other"):
        assert runs.stage(spark, f"{tmp_path}/out", f"{tmp_path}/manifest.json", identity, make).count() == 4
    assert len(made) == 2
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/out")
    assert runs.stage(spark, f"{tmp_path}/out", f"{tmp_path}/manifest.json", "other", make).count() == 4 and len(made) == 3


def test_progress(spark, tmp_path):
    target, rows = f"{tmp_path}/done", spark.createDataFrame([(str(i),) for i in range(10)], "id string")
    assert runs.committed(spark, target, "id string").count() == 0
    runs.commit(rows.where("id < '4'"), target)
    left = runs.remaining(rows, runs.committed(spark, target, "id string"))
    assert sorted(r.id for r in left.collect()) == [str(i) for i in range(4, 10)]
    assert runs.progress(runs.committed(spark, target, "id string"), 10).first().complete is False
    runs.commit(left, target)
    done = runs.progress(runs.committed(spark, target, "id string"), 10).first()
    assert (done.rows, done.complete) == (10, True)


def test_indexed_over_files(spark, tmp_path):
    for name, low, high in (("b", 0, 7), ("a", 7, 12)):
        spark.range(low, high, 1, 1).write.parquet(f"{tmp_path}/{name}")
    spark.range(12, 20, 1, 2).write.parquet(f"{tmp_path}/c")
    got = readers.indexed(spark, [f"{tmp_path}/b", f"{tmp_path}/a", f"{tmp_path}/c"]).collect()
    assert {r.row_index: r.id for r in got} == {i: i for i in range(20)}
    readers.checked_counts(spark, {f"{tmp_path}/a": 5, f"{tmp_path}/c": 8})
    with pytest.raises(ValueError):
        readers.checked_counts(spark, {f"{tmp_path}/a": 6})


def test_bounded_lines_and_messages(spark, tmp_path):
    path = tmp_path / "train.jsonl"
    rows = [{"id": "x", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": None}, {"content": " "}, {"content": 3}, {"content": "é"}]}, {"messages": [{"content": "no id"}]}, {"id": "y"}]
    path.write_text("﻿" + "\n".join(map(json.dumps, rows)) + "\n\n", encoding="utf-8")
    got, digest = readers.bounded_lines(str(path))
    assert got == rows and digest == hashlib.sha256(path.read_bytes()).hexdigest()
    with pytest.raises(ValueError):
        readers.bounded_lines(str(path), 10)
    path.write_text("\n".join(map(json.dumps, rows)), encoding="utf-8")
    texts = {(r.label, r.text) for r in readers.message_texts(spark, str(tmp_path)).collect()}
    assert texts == {("train.jsonl:x:0", "hi"), ("train.jsonl:x:4", "é"), ("train.jsonl:unknown:0", "no id")}


def test_evaluation_rows(spark, tmp_path):
    one = {"task": "T", "metric": "BLEU", "json": {"name": "N", "data": {"dev": [{"id": 7, "instruction": " do ", "input": ["a ", " ", "b"], "output": ["x", " "], "mcq": ["p", "q"]}, {"output": "y"}, {"instruction": "i", "output": " "}, {"instruction": "i", "output": "z"}]}}}
    two = {"category": "C", "metric_list": [{"metric": "rouge"}], "data": {"dev": [{"input": "in", "output": "out"}]}}
    with zipfile.ZipFile(tmp_path / "arch.zip", "w") as z:
        z.writestr("one.json", json.dumps(one))
        z.writestr("deep/two.json", json.dumps(two))
        z.writestr("note.txt", "x")
    got = {r.id: r for r in readers.evaluation_rows(readers.zip_members(spark, f"{tmp_path}/arch.zip")).collect()}
    assert set(got) == {"arch:one.json:7", "arch:one.json:3", "arch:deep/two.json:0"}
    a, b, c = (got[k] for k in ("arch:one.json:7", "arch:one.json:3", "arch:deep/two.json:0"))
    assert (a.task, a.task_name, a.metric, a.references, a.choices, a.input) == ("T", "N", "bleu", ["x"], ["p", "q"], "a\nb")
    assert a.prompt == "do\n\na\nb\n\n" + mcq.CHOICES + "A. p\nB. q" + mcq.CHOOSE and b.prompt == "i" + mcq.COMPLETE
    assert (c.task, c.task_name, c.metric, c.references) == ("C", "C", "rouge", ["out"])


def test_layouts(spark):
    indexed = spark.createDataFrame([("q1", "a", " ", "c", None, None, "2", 0), ("q2", "a", "b", None, None, None, "1", 1), ("q3", "a", None, None, None, None, "0", 2), ("q4", "a", "b", None, None, None, "9", 3), ("q5", "a", "b", None, None, None, "x", 4), (" ", "a", "b", None, None, None, "0", 5)], "query string, sol1 string, sol2 string, sol3 string, sol4 string, sol5 string, label string, n int")
    got = {r.id: (r.choices, r.gold) for r in mcq.items(indexed, "indexed", F.lit("s"), "n").collect()}
    assert got == {"s:0": (["A", "C"], "C"), "s:1": (["A", "B"], "B")}
    lettered = spark.createDataFrame([("7", " what ", "x", "y", "z", "w", " b ")], "id string, question string, A string, B string, C string, D string, answer string")
    (r,) = mcq.items(lettered, "lettered").collect()
    assert (r.id, r.gold, r.question) == (":7", "B", "what\n\n" + mcq.CHOICES + "A. x\nB. y\nC. z\nD. w")


def test_json_tasks(spark, tmp_path):
    task = {"name": "t", "metric": "bleu", "data": {"dev": [{"id": "1", "input": ["a", "b"], "output": "o", "mcq": ["x", ""], "difficulty": 3}], "test": [{"id": "2", "input": "alone"}]}}
    (tmp_path / "t.json").write_text(json.dumps(task))
    got = {r.id: r for r in tasks.task_rows(spark, f"{tmp_path}/t.json", "json").collect()}
    assert got["1"].meta == {"name": "t", "metric": "bleu"} and got["1"].input == ["a", "b"] and got["1"].mcq == ["x"] and got["1"].more == {"split": "dev", "difficulty": "3"}
    assert got["2"].input == ["alone"] and got["2"].mcq is None and got["2"].more == {"split": "test"}


def test_frozen_and_reported(spark, tmp_path):
    path, receipt = f"{tmp_path}/labels.jsonl", f"{tmp_path}/frozen.json"
    sinks.freeze(path, [{"id": "1", "label": "é"}], receipt)
    assert sinks.unchanged(path, receipt)
    with pytest.raises(FileExistsError):
        sinks.freeze(path, [], receipt)
    with open(path, "a") as file:
        file.write(" ")
    assert not sinks.unchanged(path, receipt)
    df = spark.createDataFrame([("b", 2), ("a|c", None)], "name string, n int")
    text = sinks.report("Run", {"Counts": df}, {"rows": 2})
    assert text == "# Run\n\n- rows: 2\n\n## Counts\n\n| name | n |\n|---|---|\n| a\\|c |  |\n| b | 2 |\n"
    with pytest.raises(ValueError):
        sinks.report("Run", {"Counts": df}, limit=1)
    sinks.write_json(f"{tmp_path}/x.json", {"b": 1})
    assert json.load(open(f"{tmp_path}/x.json")) == {"b": 1}
    assert sinks.write_sample(df, f"{tmp_path}/s.jsonl", ["name"]) == 2 and open(f"{tmp_path}/s.jsonl").read() == '{"name":"a|c"}\n{"name":"b","n":2}\n'


def test_fan_out(spark, tmp_path):
    df = spark.createDataFrame([("1", "keep"), ("2", "holdout"), ("3", "exclude")], "id string, decision string")
    sinks.fan_out(df, f"{tmp_path}/run")
    counts = {n: spark.read.parquet(f"{tmp_path}/run/{n}").count() for n in ("candidates", "holdout", "decisions")}
    assert counts == {"candidates": 1, "holdout": 1, "decisions": 3}
    with pytest.raises(FileExistsError):
        sinks.fan_out(df, f"{tmp_path}/run")


def slow_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return row[-1]


def test_edits(spark):
    rng = random.Random(1)
    pairs = [("".join(rng.choice("abé") for _ in range(rng.randint(0, 12))), "".join(rng.choice("abcé") for _ in range(rng.randint(0, 12)))) for _ in range(3000)]
    assert all(metrics.edits(a, b) == slow_edits(a, b) for a, b in pairs)
    some = pairs[:100] + [(None, "a"), ("a", None)]
    got = spark.createDataFrame([(i, *p) for i, p in enumerate(some)], "i int, a string, b string").select("i", metrics.character_errors("a", "b").alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [slow_edits(a, b) / len(b) if a and b else None for a, b in some]


def test_corpus_metrics(spark):
    assert metrics.plain_bleu("a b c", "a b c") == 0.0 and metrics.plain_bleu("a b c d", "a b c d") == 1.0 and metrics.plain_bleu("", "a") is None
    assert abs(metrics.plain_bleu("a b c d", "a b c d e f") - 2.718281828459045**-0.5) < 1e-12
    assert metrics.rouge_lines("a b\nc d", "c d\na b") == 1.0 and metrics.rouge_lines("", "a") == 0.0
    assert metrics.rouge_lines("a b c", "a x c") == metrics.rouge("a b c", ["a x c"])["rougeL"]
    assert [metrics.detected(n) for n in ("fuzzy_accuracy", "sacreBLEU", "nothing")] == ["accuracy", "bleu", None]
    rows = spark.createDataFrame([("a b c d", "a b c d"), ("", "x"), (None, None)], "p string, r string")
    means = rollups.metric_means(rows.select(F.lit(1).alias("g"), metrics.corpus_scored("p", "r").alias("s")).select("g", "s.*"), ["g"], ["bleu", "rougeLsum"]).first()
    assert means.bleu == 1.0 and abs(means.rougeLsum - 0.3333) < 1e-9
    scored = spark.createDataFrame([("rouge", "a b"), ("BLEU", "a"), ("accuracy", "a b")], "metric string, t string").select("metric", metrics.scored("t", F.array(F.lit("a b"))).alias("s"))
    got = {r.metric: r.d for r in scored.select("metric", metrics.dispatched(F.col("metric"), F.col("s")).alias("d")).collect()}
    assert set(got["rouge"]) == {"rouge1", "rouge2", "rougeL"} and set(got["BLEU"]) == {"bleu"} and got["accuracy"] == {"accuracy": 1.0}
    with pytest.raises(Exception, match="no such metric"):
        scored.withColumn("metric", F.lit("other")).select(metrics.dispatched(F.col("metric"), F.col("s")).alias("d")).collect()


def test_overlap_of_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    reference = spark.createDataFrame([(long,), ("short text",)], "text string")
    parts = spark.createDataFrame([("1", 0, long.replace(" ", "  ")), ("1", 1, "free"), ("2", 0, long + " more"), ("3", 0, "free"), ("4", 0, None)], "id string, part int, text string")
    kinds = overlap.overlap_kinds(parts, reference)
    assert {(r.id, r.part): r.kind for r in kinds.collect()} == {("1", 0): "exact", ("1", 1): "none", ("2", 0): "near", ("3", 0): "none", ("4", 0): "none"}
    assert {r.kind: (r.parts, r.rows) for r in overlap.overlap_summary(kinds).collect()} == {"exact": (1, 1), "near": (1, 1), "none": (3, 3)}
    rows = parts.select("id").distinct()
    assert sorted(r.id for r in overlap.without_overlap(rows, kinds).collect()) == ["3", "4"]
    small = overlap.SMALL_BYTES
    try:
        overlap.SMALL_BYTES = 0
        assert not overlap.fits(reference) and sorted(map(tuple, overlap.overlap_kinds(parts, reference).collect())) == sorted(map(tuple, kinds.collect()))
    finally:
        overlap.SMALL_BYTES = small


def test_systematic(spark):
    got = [r.id for r in sampling.systematic(spark.range(1000), "id", 1000, 100).orderBy("id").collect()]
    assert len(got) == 100 and all(sum(250 * s <= i < 250 * (s + 1) for i in got) == 25 for s in range(4))


def test_unknown_groups(spark):
    scores = spark.createDataFrame([("t", "rouge1", 0.1), ("t", "rougeLsum", 0.5), ("u", "accuracy", 1.0)], "task string, metric string, score double")
    assert {r.task: r.score for r in rollups.task_average(scores, "task", "metric", "score").collect()} == {"t": 0.5, "u": 1.0, None: 0.75}
    assert rollups.missing_sources(spark.createDataFrame([], "s string"), "s", ["a"]).first().missing == ["a"]
