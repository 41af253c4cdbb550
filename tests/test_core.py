"""Functions, operators and plans of conversational curation."""

import collections
import io
import json
import random
import re
import tarfile
import zipfile
from decimal import Decimal
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from lakehone import queries
from lakehone.functions import adapt, checks, jsons, metrics, text, toolcalls
from lakehone.operators import conversations, dedup, sampling
from lakehone.plans import curate, judge, prepare
from lakehone.sources import readers, sinks

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def value(v):
    return tuple(v) if isinstance(v, list) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, sf, con, name):
    df, sql = queries.QUERIES[name](spark, sf), con.sql(queries.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(sql.columns)
    own = collections.Counter(tuple(value(r[c]) for c in cols) for r in df.collect())
    assert own == collections.Counter(tuple(value(r[sql.columns.index(c)]) for c in cols) for r in sql.fetchall())


USER, SAYS = {"role": "user", "content": "hi"}, {"role": "assistant", "content": "yes"}
TOOL = {"type": "function", "function": {"name": "f", "parameters": {"type": "object", "properties": {"n": {"type": "integer"}, "k": {"enum": [1, "a"]}, "l": {"type": "array", "items": {"type": "string"}}}, "required": ["n"], "additionalProperties": False}}}


def call(arguments, name="f"):
    return [USER, {"role": "assistant", "content": None, "tool_calls": [{"type": "function", "function": {"name": name, "arguments": arguments}}]}]


@pytest.mark.parametrize(
    ("messages", "tools", "want"),
    [
        ([USER, SAYS], [], []),
        ([], [], ["invalid_messages"]),
        ("x", None, ["invalid_tools", "invalid_messages"]),
        ([USER, 3, SAYS], [], ["invalid_message"]),
        ([USER, {"role": "robot"}, SAYS], [], ["invalid_role"]),
        ([{"role": "user", "content": " "}, SAYS], [], ["invalid_message_content"]),
        ([USER, {"role": "assistant", "content": ""}], [], ["empty_assistant"]),
        ([SAYS], [], ["missing_user"]),
        ([USER], [], ["missing_assistant", "final_message_not_assistant"]),
        ([{**USER, "tool_calls": None}, SAYS], [], ["invalid_tool_calls"]),
        (call({"n": 3.0}), [TOOL], []),
        (call('{"n": 1, "n": 2}'), [TOOL], ["invalid_tool_arguments", "empty_assistant"]),
        (call('{"n": NaN}'), [TOOL], ["invalid_tool_arguments", "empty_assistant"]),
        (call({"n": True}), [TOOL], ["tool_argument_type", "empty_assistant"]),
        (call({"n": 1, "k": True}), [TOOL], ["tool_argument_enum", "empty_assistant"]),
        (call({"l": ["a", 1], "z": 1}), [TOOL], ["missing_required_tool_argument", "tool_argument_type", "unexpected_tool_argument", "empty_assistant"]),
        (call({}, "g"), [TOOL], ["unknown_tool", "empty_assistant"]),
        ([USER, SAYS], [TOOL, TOOL], ["duplicate_tool_name"]),
        ([USER, SAYS], [{"name": "q", "parameters": {"type": "array"}}, {"name": ""}, {"name": "r", "parameters": {"required": ["a", "a"]}}], ["invalid_tool_schema", "invalid_tool_definition"]),
    ],
)
def test_problems(messages, tools, want):
    assert toolcalls.problems(messages, tools) == want


def test_blind_rows():
    blank = {"role": "assistant", "content": "", "tool_calls": None}
    assert toolcalls.problems([USER, blank], [], True) == [] == toolcalls.problems([USER], [], True)
    assert toolcalls.problems([{"role": "user", "content": ""}, blank], [], True) == ["invalid_message_content"]


def test_native_reasons_agree(spark):
    rng = random.Random(0)
    roles, contents = ["user", "assistant", "system", "tool", "robot"], ["a", "", " ", None]
    rows = [(i, [(rng.choice(roles), rng.choice(contents)) for _ in range(rng.randint(1, 4))]) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>")
    got = {r.id: set(r.c) for r in df.select("id", conversations.reasons(F.col("messages")).alias("c")).collect()}
    for i, ms in rows:
        assert got[i] == set(toolcalls.problems([{"role": r, "content": c} for r, c in ms], []))


def test_text_keys(spark):
    assert text.numbers("١٬٢٣٤٫٥ and 1,234.5 and -7e2 x9 9x") == {Decimal("1234.5"), Decimal("-700")}
    for bad in ("1" * 300, "1e99999"):
        with pytest.raises(text.TokenLimit):
            text.numbers(bad)
    assert text.without_vowels("كَتَبَ  أ") == "كتب أ"
    assert text.shingle_set("a b c d e f g") == set() and len(text.shingle_set("a b c d e f g h")) == 4
    df = spark.createDataFrame([("é  x",), ("é x ",), (None,)], "t string")
    keys = [r.k for r in df.select(text.overlap_key("t").alias("k")).collect()]
    assert keys[0] == keys[1] and keys[2] is None
    got = spark.createDataFrame([("One two-three FOUR five six seven eight nine",)], "t string").select(text.word_shingles(F.col("t")).alias("s")).first().s
    assert {tuple(g.split()) for g in got} == text.shingle_set("One two-three FOUR five six seven eight nine")


def test_fingerprints():
    whole, asked = jsons.fingerprints([USER, SAYS], [])
    assert asked == jsons.fingerprints([USER, {**SAYS, "content": "no"}], [])[1] != whole
    assert jsons.fingerprints([USER, SAYS], [TOOL])[1] != asked
    assert jsons.stored({"b": 1, "a": "é"}) == '{"a": "é", "b": 1}' and jsons.compact([1, 2]) == "[1,2]"


def test_padding():
    messages = call({"n": 1, "k": None, "z": None})
    tools = [{"name": "f", "parameters": {"type": "object", "properties": {"n": {"type": "integer", "enum": None}, "k": {"type": ["null", "string"]}, "z": None}, "required": None}}]
    m, t, notes = adapt.tool_row(messages, tools)
    assert m[1]["tool_calls"][0]["function"]["arguments"] == {"n": 1, "k": None}
    assert t[0]["parameters"] == {"type": "object", "properties": {"n": {"type": "integer"}, "k": {"type": ["null", "string"]}}}
    assert notes == ["argument_padding_removed", "schema_padding_removed"]
    assert adapt.tool_row([], None)[1:] == ([], ["missing_candidate_tools"])
    assert adapt.nullable({"anyOf": [{"type": "string"}, {"type": "null"}]}) and not adapt.nullable({"enum": [1]}) and not adapt.nullable({"anyOf": []})


CASES = [
    ("diacritization", checks.DIACRITIZE + "كتب", "كَتَبَ", set()),
    ("diacritization", checks.DIACRITIZE + "كتب", "قرأ", {"underlying_text_changed", "no_diacritics_added"}),
    ("summarization", "لخّص النص التالي بشكل موجز:\n\nفي عام 2020", "عام ٢٠٢٠", set()),
    ("summarization", "لخّص النص التالي بشكل موجز:\n\nفي عام 2020", "عام 2021", {"transformation_numbers_unverified"}),
    ("chat", "Write a Python function", "```python\nx = 1\n```", {"python_function_missing"}),
    ("chat", "Write a Python function", "```python\ndef f(:\n```", {"python_syntax_invalid"}),
    ("chat", "Write a Python function", "sorry no", {"python_answer_unparsed"}),
    ("chat", "Write a Python program", "```python\npass\n```", {"python_code_empty"}),
    ("chat", "اكتب قصة\n" + checks.NO_COMMA, "أ، ب", {"forbidden_comma_present"}),
    ("chat", "اكتب قصة\nابدأ القصة حرفيا بـ «كان»", "كان يا ما كان", set()),
    ("chat", "hi", "a�b", {"replacement_character_present"}),
    ("chat", "Write a Python function", "x = lambda: 1", set()),
    ("tool_use", "Write a Python function", "no", set()),
    ("summarization", "something else", "9", {"unsupported_task_wrapper"}),
    ("chat", "Write a story\nاختم القصة حرفيا بـ «نهاية».", "x", {"literal_end_mismatch"}),
    ("chat", "Write a story\nmake it long", "a, b", set()),
    ("translation", "ترجم النص التالي من الإنجليزية إلى العربية:\n\nIn 1,000 days", "في ١٠٠٠ يوم", set()),
    ("sentiment_analysis", checks.SENTIMENT + "x", "محايد ", set()),
    ("diacritization", "no prefix", "x", {"unsupported_task_wrapper"}),
    ("summarization", "لخّص النص التالي بشكل موجز:\n\n" + "1" * 300, "2", {"numeric_token_check_skipped_limit"}),
]


def signals(spark, rows, **options):
    """Flags and checks of (messages, tools, source, task) rows."""
    df = spark.createDataFrame([(i, json.dumps(m), json.dumps(t), s, k) for i, (m, t, s, k) in enumerate(rows)], "id int, messages_json string, tools_json string, source string, task string")
    return [({*r.flags}, {*r.checks}, r) for r in sorted(checks.signalled(df, **options).collect(), key=lambda r: r.id)]


def test_checks(spark):
    rows = [([{"role": "user", "content": prompt}, {"role": "assistant", "content": answer}], [], "s", task) for task, prompt, answer, _ in CASES]
    got = signals(spark, rows)
    for (task, prompt, answer, want), (flags, checked, _) in zip(CASES, got):
        assert flags == want, (task, prompt, answer)
        assert {"structure", "semantic_quality_skipped_offline"} <= checked
    tweets = [([{"role": "user", "content": checks.SENTIMENT + "x"}, {"role": "assistant", "content": a}], [], "twitter_sentiment", "sentiment_analysis") for a in ("محايد ", "ok")]
    more = [*tweets, ([USER], [], "s", "chat"), ([USER, {**SAYS, "think": " so "}], [], "s", "chat"), ([USER, {**SAYS, "content": checks.NO_CALL}], [], "quiet", "tool_use"), ([USER, {"role": "assistant", "content": "x", "\ufffd": 1}], [], "s", "chat")]
    flags = [f for f, _, _ in signals(spark, more, no_call_sources=["quiet"])]
    assert flags == [set(), {"invalid_sentiment_label"}, set(), {"assistant_reasoning_fields_present"}, {"generic_no_call_target"}, set()]
    assert signals(spark, more)[2][2].structural == ["missing_assistant", "final_message_not_assistant"]


def test_grounding(spark):
    def row(said, arguments):
        messages = call(arguments)
        messages[0] = {"role": "user", "content": said}
        return messages, [TOOL], "s", "tool_use"

    rows = [row("give me 1,000 of them", {"n": 1000}), row("give me 12", {"n": 13}), row("order 00123", {"order_id": "123", "n": 123}), row("order ٠٠١٢٣", {"order_id": "00123", "n": 123}), row("x", {"n": 10**400})]
    lax = [{"name": "f", "parameters": {"type": "object"}}]
    got = signals(spark, [(m, lax, s, k) for m, _, s, k in rows])
    assert [f for f, _, _ in got] == [set(), {"tool_argument_tokens_unverified"}, {"tool_argument_tokens_unverified"}, set(), {"numeric_token_check_skipped_limit"}]
    assert all(r.tool_behavior == "call" for _, _, r in got)
    default = [{"name": "f", "parameters": {"type": "object", "properties": {"n": {"type": "integer", "default": 7}, "l": {"type": "array", "items": {"type": "integer"}}}}}]
    assert [f for f, _, _ in signals(spark, [(row("x", {"n": 7})[0], default, "s", "tool_use"), (row("1 and 2", {"n": 7, "l": [1, 2, 3]})[0], default, "s", "tool_use")])] == [set(), {"tool_argument_tokens_unverified"}]


def test_metrics():
    assert metrics.bleu("a b c d e", ["a b c d e"]) == 1.0 and metrics.bleu("", ["a"]) == 0.0
    assert metrics.bleu("a", ["a"]) == 1.0 and 0 < metrics.bleu("a b", ["b a x"]) < 1
    got = metrics.rouge("a b c", ["a x c", "b"])
    assert abs(got["rouge1"] - 2 / 3) < 1e-12 and got["rouge2"] == 0 and abs(got["rougeL"] - 2 / 3) < 1e-12
    assert metrics.fuzzy("The answer: Paris!", ["paris"]) == 1.0 and metrics.fuzzy("london", ["paris"]) == 0.0
    assert metrics.word_errors("a b d", "a b c") == 1 / 3 and metrics.word_errors("", "a") is None
    for said, want in {"<think>A</think>\nB.": "B", "The answer is\nالإجابة: ج\nanswer: c": "C", "option A or option B here": None, "It is option D because": "D", "": None, "(E)": "E"}.items():
        assert metrics.choice(said) == want


def sequential(rows, benchmarks, seed, fraction):
    """The decisions, one row after the other."""
    import hashlib

    seen, out = {}, {}
    held, trained = {}, set()
    for r in rows:
        if r["official"] and r["hash"]:
            held[r["input"]] = "test" if "test" in (r["split"], held.get(r["input"])) else r["split"]
        if r["preserved"] and r["split"] == "train" and r["good"]:
            trained.add(r["input"])
    for r in sorted(rows, key=lambda r: r["order"]):
        share = int(hashlib.sha256(f"{seed}:{r['input']}".encode()).hexdigest()[:16], 16)
        split = r["split"] if not r["good"] or r["official"] else held.get(r["input"]) or ("train" if r["input"] in trained else "validation" if share < int(fraction * 2**64) else "train")
        if not r["good"]:
            got = "quarantine", None
        elif not r["official"] and r["input"] in held or not r["official"] and r["text"] in benchmarks:
            got = "exclude", None
        elif not r["official"] and r["hash"] in seen:
            got = "exclude", seen[r["hash"]]
        else:
            seen.setdefault(r["hash"], r["key"])
            got = "keep" if r["labeled"] else "holdout", None
        out[r["key"]] = (*got, split)
    return out


def test_prepare(spark):
    rng = random.Random(5)
    jobs = [("a", True, "test", True), ("a", True, "dev", True), ("a", True, "train", True), ("b", False, "train", True), ("c", False, "train", False)]
    raw, model = [], []
    for at, (name, preserved, split, labeled) in enumerate(jobs):
        for i in range(40):
            said, answer = f"q{rng.randrange(40)}", rng.choice(["x", "y", ""])
            messages = [{"role": "user", "content": said}, {"role": "assistant", "content": answer}]
            raw.append((name, f"r/{name}", "1", "c", "dialogue", preserved, labeled, split, i, "s", "t", json.dumps(messages), None))
            good = bool(answer) or not labeled
            whole, asked = jsons.fingerprints(messages, [])
            own = "validation" if split == "dev" else split
            model.append({"key": (name, split, i), "order": (at, i), "official": preserved and split != "train", "preserved": preserved, "good": good, "labeled": labeled, "split": own, "hash": whole, "input": asked, "text": said})
    schema = "dataset string, repo string, revision string, config string, kind string, preserved boolean, labeled boolean, original_split string, row_index long, source string, task string, messages_json string, tools_json string"
    bench = {"q3", "q7"}
    marks = spark.createDataFrame([(b, "m") for b in bench], "t string, name string").select(text.overlap_key("t").alias("hash"), "name")
    rows = prepare.prepared(spark.createDataFrame(raw, schema).repartition(5)).persist()
    got = prepare.decided(rows, marks, 42, 0.3).collect()
    names = {r.id: (r.dataset, r.original_split, r.row_index) for r in got}
    have = {names[r.id]: (r.decision, names.get(r.duplicate_of), r.split) for r in got}
    assert have == sequential(model, bench, 42, 0.3)


def test_prepare_hashes_texts_once(spark, sf):
    """Keys are not computed again for the joins' tests for null, and whole texts go to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    plan = queries.prepare_decisions(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "isnotnull(pythonUDF" not in plan
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_prepare_shuffles_no_texts(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries.prepare_decisions(spark, sf)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert dealt and not any("text#" in columns for columns in dealt)


def test_prepare_null_texts(spark):
    """A null among the user texts or the benchmarks' keys matches nothing, the texts beside it do; a text said twice counts once."""
    raw = [(i, "d", "train", "train", n, False, False, True, 3, [], i, i, None, texts) for n, (i, texts) in enumerate([("a", [None]), ("b", [None, "x  y", "x y"]), ("c", None), ("d", [""])])]
    rows = spark.createDataFrame(raw, "id string, dataset string, split string, original_split string, row_index long, official boolean, preserved boolean, labeled boolean, job_rank int, problems array<string>, example_hash string, input_hash string, reserved_hash string, user_texts array<string>")
    marks = spark.createDataFrame([(None, "none"), ("x y", "m")], "t string, name string").select(text.overlap_key("t").alias("hash"), "name")
    got = {r.id: (r.decision, r.benchmark_matches) for r in prepare.decided(rows, marks).collect()}
    assert got == {"a": ("keep", []), "b": ("exclude", ["m"]), "c": ("keep", []), "d": ("keep", [])}


def test_curated(spark):
    rows = [("1", True, "train", "s", "t", [USER, SAYS]), ("2", True, "train", "s", "t", [USER]), ("3", True, "train", "odd", "t", [USER, SAYS]), ("4", True, "train", "s", "t", [USER, {"role": "assistant", "content": "�"}]), ("5", True, "test", "s", "t", None)]
    df = spark.createDataFrame([(i, "d", lab, sp, so, ta, "h", "i", "not json" if m is None else json.dumps(m), "[]") for i, lab, sp, so, ta, m in rows], "id string, dataset string, is_labeled boolean, split string, source string, task string, example_hash string, input_hash string, messages_json string, tools_json string")
    got = {r.id: (r.decision, r.reasons) for r in curate.curated(df, ["replacement_character_present"], {"odd": "odd_source"}, {}).collect()}
    extra = df.withColumns({"metadata_json": F.lit('{"dialect":"gulf"}'), "revision": F.lit("r"), "original_split": F.lit("train"), "row_index": F.lit(1)})
    out = curate.curated(extra, [], {}, {}).where("id = '1'").first()
    assert (out.dialect, out.revision, out.row_index, out.scope, out.task_hint) == ("gulf", "r", 1, "offline_rules", "")
    assert got == {"1": ("accept", ["offline_checks_passed"]), "2": ("exclude", ["final_message_not_assistant", "missing_assistant"]), "3": ("review", ["odd_source"]), "4": ("repair", ["replacement_character_present"])}


def test_samples(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 7)
    assert sorted(r.g for r in sampling.round_robin(df, ["g"], "id", 21).collect()) == sorted(list(range(7)) * 3)
    lead = sampling.round_robin(df, ["g"], "id", 10, first=F.col("id") < 4).collect()
    assert {r.id for r in lead[:4]} == {0, 1, 2, 3} and len(lead) == 10
    assert sampling.systematic(df, "id", 500, 100).count() == 100
    assert sampling.top_per_group(df, ["g"], "id", 3).count() == 21
    assert dedup.unseen(df, spark.range(10).withColumn("g", F.lit(3)), ["id", "g"]).where("id < 10 or g = 3").count() == 0


GOOD = {"decision": "keep", "reasons": ["fine"], "dimensions": dict.fromkeys(judge.DIMENSIONS, "pass")}


def test_ledger(tmp_path):
    sent = []

    def send(payload):
        sent.append(payload)
        if payload == "stop":
            raise KeyboardInterrupt
        if payload == "lost":
            raise OSError("no answer")
        return (json.dumps(GOOD) if payload != "bad" else "{}"), Decimal("0.9" if payload == "dear" else "0.4")

    def ledger(name, budget=2):
        return judge.Ledger(str(tmp_path / name), "run", Decimal(budget))

    half = Decimal("0.5")
    one = ledger("a")
    with pytest.raises(KeyboardInterrupt):
        one.run([("1", "a"), ("2", "stop"), ("3", "c")], half, send)
    one = ledger("a")
    assert one.spent() == Decimal("0.9")  # the charge of one, the reservation of the other
    got = one.run([("1", "a"), ("2", "stop"), ("3", "c"), ("4", "d"), ("5", "e")], half, send)
    assert sent == ["a", "stop", "c", "d"] and {*got} == {"1", "3", "4"} and one.stopped == "budget_exhausted" and one.spent() == Decimal("1.7")
    for payload, why in (("bad", "stopped_on_error"), ("lost", "stopped_on_error"), ("dear", "charge_above_reservation"), ("x" * 200_000, "request_too_large")):
        other = ledger(why + payload[:4])
        other.run([("1", "a"), ("2", payload), ("3", "c")], half, send)
        assert other.stopped == why and "3" not in other.results()
    many = ledger("many", 100)
    assert len(many.run(((str(i), f"p{i}") for i in range(40)), half, send, workers=4)) == 40 and many.stopped is None
    assert many.spent() == Decimal(16) and many.run([("0", "p0"), ("0", "p0")], half, send) and len([x for x in sent if x == "p0"]) == 1
    with pytest.raises(ValueError):
        judge.Ledger(str(tmp_path / "a"), "another", Decimal(1))


def test_judgments(spark):
    marks = GOOD["dimensions"]
    reason = lambda r: {**GOOD, "reasons": r}
    failed = {**marks, "correctness": "fail"}
    good = [GOOD, reason(["a\nb", "a\tb", "نص\u200c"]), {**GOOD, "decision": "review", "dimensions": failed}, {**GOOD, "decision": "drop", "dimensions": failed}, reason(["x" * 2000])]
    bad = [3, [], {}, {**GOOD, "more": 1}, {**GOOD, "decision": "no"}, {**GOOD, "decision": 1}, {**GOOD, "decision": ["keep"]}, reason([]), reason(["a"] * 4), reason([" "]), reason([3]), reason("fine"), reason(["a\rb"]), reason(["a\x7f"]), reason(["x" * 2001])]
    bad += [{**GOOD, "dimensions": x} for x in ([], {}, {**marks, "more": "pass"}, {**marks, "correctness": "good"}, {**marks, "correctness": ["pass"]}, {**marks, "correctness": None}, failed, {**marks, "correctness": "uncertain"})]
    bad += [{**GOOD, "decision": "repair"}, {**GOOD, "decision": "drop", "dimensions": {**marks, "correctness": "uncertain"}}]
    texts = [json.dumps(x) for x in good + bad] + ['{"decision": "keep", "decision": "keep"}', "no json"]
    want = []
    for t in texts:
        try:
            judge.judgment(t)
            want.append(None)
        except ValueError as error:
            want.append(str(error))
    assert [w is None for w in want] == [True] * len(good) + [False] * (len(bad) + 2)
    got = [r.f for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", judge.judgment_fault(F.col("t")).alias("f")).orderBy("i").collect()]
    names = {"keys", "decision", "reasons", "dimensions", "contradiction"}
    assert [g is None for g in got] == [w is None for w in want]
    assert all(g == w for g, w in zip(got, want) if w in names and g != "json")



def test_sources(spark, sf, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(5).coalesce(1).write.parquet(a)
    spark.range(100, 103).coalesce(1).write.parquet(b)
    assert sorted((r.row_index, r.id) for r in readers.indexed(spark, [b, a]).collect()) == list(enumerate([100, 101, 102, 0, 1, 2, 3, 4]))
    (tmp_path / "m.jsonl").write_text('﻿{"prompt": "p", "variants": ["v", "p "]}\n\n{"prompt": "v"}\n', encoding="utf-8")
    assert readers.benchmarks(spark, {"m": str(tmp_path / "m.jsonl"), "none": None}).count() == 2
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("x/t.json", json.dumps({"task": "t", "metric": "bleu", "json": {"data": {"dev": [{"id": "1", "input": "i", "output": ["a", " "]}, {"id": "2", "input": "i", "output": " b "}]}}}))
        z.writestr("x/readme.md", "no")
    got = readers.evaluation_rows(readers.zip_members(spark, str(tmp_path / "z.zip"))).collect()
    assert [(r.task, r.metric, r.id, r.references) for r in got] == [("t", "bleu", "z:x/t.json:1", ["a"]), ("t", "bleu", "z:x/t.json:2", ["b"])]
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../t.json", "{}")
    with pytest.raises(Exception, match="not acceptable"):
        readers.zip_members(spark, str(tmp_path / "bad.zip")).collect()
    with tarfile.open(tmp_path / "h.tar.gz", "w:gz") as t:
        data = b'{"id": "1", "example_hash": "e"}\n'
        info = tarfile.TarInfo("r/sample.jsonl")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    assert [tuple(r) for r in readers.tar_lines(spark, str(tmp_path / "h.tar.gz")).collect()] == [("1", "e", None)]
    sinks.publish({"d": spark.range(3)}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/d")).count() == 3
    with pytest.raises(FileExistsError):
        sinks.publish({"d": spark.range(3)}, str(tmp_path / "out"))


def test_udfs(spark, sf):
    rows = spark.createDataFrame([("A", json.dumps([USER, SAYS]), "[]", False), ("the answer", "no json", None, False)], "t string, m string, tools string, blind boolean")
    got = rows.select(metrics.answer_choice("t").alias("c"), toolcalls.conversation_problems("m", "tools", "blind").alias("p")).collect()
    assert [(r.c, r.p) for r in got] == [("A", []), (None, ["invalid_tools", "invalid_messages"])]
    assert queries.answer_metrics(spark, sf).where("rouge1 between 0 and 1").count() == queries.answer_metrics(spark, sf).count() > 0
    assert queries.overlap_keys(spark, sf).count() == 200


def test_whole_turns(spark, tmp_path):
    same = " ".join(f"word{i}" for i in range(60))
    turns = [(1, 0, "user", same + " é then one ending"), (1, 1, "assistant", same + " è and quite another tail of it"), (2, 0, "user", "short é"), (2, 1, "assistant", "short è"), (2, 2, "user", ""), (2, 3, "assistant", "after nothing"), (3, 0, "user", None), (3, 1, "assistant", "first")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    pairs = [(c, t, y, x) for (c0, _, _, x), (c, t, _, y) in zip(turns, turns[1:]) if c0 == c and x is not None]
    got = {(r.conv_id, r.turn): r.cer for r in queries.cer_turns(spark, str(tmp_path)).collect()}
    assert got == {(c, t): round(metrics.edits(y, x) / len(x), 6) for c, t, y, x in pairs if x and y}
    assert got[1, 1] > 0 and got[2, 1] == round(1 / 7, 6)
    rows = {(r.conv_id, r.turn): r for r in queries.answer_metrics(spark, str(tmp_path)).collect()}
    assert rows.keys() == {(1, 1), (2, 1), (2, 3)}
    for c, t, y, x in pairs:
        if r := rows.get((c, t)):
            assert (r.bleu, r.rouge1, r.rouge2, r.rougeL, r.accuracy) == (metrics.bleu(y, [x]), *metrics.rouge(y, [x]).values(), metrics.fuzzy(y, [x])) and r.wer == metrics.word_errors(y, x)
    assert rows[1, 1].wer == 7 / 64


def test_fuzzy_parts():
    """Parts that are passed over are not alike: the same as when every part is compared."""
    def brute(p, r):
        parts = (p, *(p[i : i + len(r)] for i in range(max(1, len(p) - len(r) + 1))))
        return float(any(SequenceMatcher(None, r, x).ratio() >= 0.85 for x in parts))

    rnd = random.Random(2)
    for _ in range(400):
        r = "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 50)))
        p = "".join(rnd.choice("abuv") for _ in range(rnd.randint(0, 40))) + "".join(c if rnd.random() < 0.88 else rnd.choice("axy") for c in r) + "z" * rnd.randint(0, 9)
        assert metrics.fuzzy(p, [r]) == brute(p, r)
