"""Queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import answers, jsons, mcq, metrics, text
from .operators import conversations, dedup, overlap, review, rollups, sampling
from .plans import curate, judge, prepare, runs
from .session import lower_batches
from .sources import readers, tasks

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("""select doc_id, case when first_id <> doc_id then first_id end as duplicate_of from
(select doc_id, first_value(doc_id) over (partition by sha256(text) order by doc_id) as first_id from documents)""")
def exact_dedup_first(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return dedup.first_kept(docs, ["key"], ["doc_id"], "doc_id").select("doc_id", "duplicate_of")


@query("""select source, lang, count(*) as n, count(*) filter (where n_chars >= 1000) as long_texts, count(distinct sha256(text)) as texts from documents group by source, lang""")
def decision_counts(spark, sf):
    docs = read(spark, sf, "documents")
    return docs.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") >= 1000).alias("long_texts"), F.countDistinct(F.sha2("text", 256)).alias("texts"))


@query("""select source, count(*) filter (where lang = 'de') as de, count(*) filter (where lang = 'en') as en, count(*) filter (where lang = 'es') as es, count(*) filter (where lang = 'fr') as fr from documents group by source""")
def source_lang_pivot(spark, sf):
    return read(spark, sf, "documents").groupBy("source").pivot("lang", ["de", "en", "es", "fr"]).count().na.fill(0)


SHARE = "cast('0x' || substr(sha256('42:' || cast({} as varchar)), 1, 16) as ubigint)"


@query(f"""select doc_id, case when {SHARE.format('doc_id')} < 368934881474191032 then 'validation' else 'train' end as split from documents""")
def hash_split(spark, sf):
    return read(spark, sf, "documents").select("doc_id", dedup.hash_split(42, F.col("doc_id").cast("string"), 0.02).alias("split"))


@query(f"""with g as (select doc_id, sha256(text) as grp, source from documents), f as (select grp, max(case when source = 'src1' then 1 else 0 end) as fixed from g group by grp)
select doc_id, case when fixed = 1 then 'train' when {SHARE.format('g.grp')} < 922337203685477580 then 'validation' else 'train' end as split from g join f using (grp)""")
def group_split_consistency(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("grp"), F.when(F.col("source") == "src1", "train").alias("fixed"))
    return dedup.grouped_split(docs, "grp", 42, 0.05, "fixed").select("doc_id", "split")


@query(r"""select doc_id, sha256(trim(regexp_replace(text, '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) as key from documents""")
def ws_normalised_key(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.sha2(text.spaced(F.col("text")), 256).alias("key"))


@query("""select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def holdout_anti_join(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels"), "doc_id", "left_anti")


@query("""select doc_id, source from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)""")
def holdout_semi_join(spark, sf):
    return read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels").where("quality = 1"), "doc_id", "left_semi")


GRAMS = r"""select {id}, list_distinct(case when len(w) >= 8 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) else [] end) as s
from (select {id}, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') as w from {t})"""
PAIRS = f"""with d as ({GRAMS.format(id='doc_id', t='documents')}), b as ({GRAMS.format(id='item_id', t='benchmark')}), de as (select doc_id, len(s) as doc_shingles, unnest(s) as g from d), be as (select item_id, len(s) as item_shingles, unnest(s) as g from b),
p as (select doc_id, item_id, doc_shingles, item_shingles, count(*) as shared from de join be using (g) group by all) """


def pairs(spark, sf):
    return overlap.shingle_pairs(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query(PAIRS + "select * from p")
def shingle_pairs(spark, sf):
    return pairs(spark, sf)


@query(PAIRS + "select *, round(shared / (doc_shingles + item_shingles - shared), 6) as jaccard from p where shared / (doc_shingles + item_shingles - shared) >= 0.02")
def shingle_jaccard(spark, sf):
    """Documents and benchmark items that are alike; none of these tables' are as alike as the default of 0.85 wants."""
    return overlap.alike(pairs(spark, sf), 0.02)


@query(PAIRS + "select * from p where shared * 100 >= item_shingles * 80")
def shingle_containment(spark, sf):
    return overlap.contained(pairs(spark, sf), 80)


@query(r"""with d as (select doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) as k from documents), f as (select k, min(doc_id) as first from d group by k)
select doc_id, [first] as items from d join f using (k) where doc_id <> first""")
def exact_overlap(spark, sf):
    """Documents whose text, but for white space, is that of an earlier one: the first of each text is the reference."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    first = docs.groupBy(F.sha2(text.spaced(F.col("text")), 256).alias("k")).agg(F.min("doc_id").alias("item_id"), F.min_by("text", "doc_id").alias("text")).drop("k")
    return overlap.equal_texts(docs, first).where(F.col("items")[0] != F.col("doc_id"))


ASSEMBLED = "(select conv_id, list(struct_pack(role := role, text := text) order by turn) as m from conversations group by conv_id)"


CODES = """list_sort(list_filter([
case when len(list_filter(m, lambda x: x.role not in ('system', 'developer', 'user', 'assistant', 'tool'))) > 0 then 'invalid_role' end,
case when len(list_filter(m, lambda x: x.role = 'user' and trim(coalesce(x.text, '')) = '' or x.role in ('system', 'developer', 'tool') and x.text is null)) > 0 then 'invalid_message_content' end,
case when len(list_filter(m, lambda x: x.role = 'assistant' and trim(coalesce(x.text, '')) = '')) > 0 then 'empty_assistant' end,
case when len(list_filter(m, lambda x: x.role = 'user')) = 0 then 'missing_user' end,
case when len(list_filter(m, lambda x: x.role = 'assistant')) = 0 then 'missing_assistant' end,
case when m[-1].role <> 'assistant' then 'final_message_not_assistant' end], lambda x: x is not null))"""


@query(f"""select conv_id, array_to_string({CODES}, ',') as reasons from {ASSEMBLED}""")
def conversation_reasons(spark, sf):
    rows = conversations.assembled(read(spark, sf, "conversations"))
    return rows.select("conv_id", F.array_join(conversations.reasons(F.col("messages")), ",").alias("reasons"))


@query("""select conv_id, max_by(role, turn) as last_role from conversations group by conv_id having max_by(role, turn) <> 'assistant'""")
def final_not_assistant(spark, sf):
    return read(spark, sf, "conversations").groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role")).where("last_role <> 'assistant'")


@query(f"""select conv_id, sha256(to_json(list_transform(case when m[-1].role = 'assistant' then m[1:len(m) - 1] else m end, lambda x: struct_pack(role := x.role, content := x.text)))::varchar) as key, len(m) as turns from {ASSEMBLED}""")
def input_hash_groups(spark, sf):
    """Key of each conversation's input: all turns but a last one by the assistant."""
    rows = conversations.assembled(read(spark, sf, "conversations"))
    return rows.select("conv_id", conversations.input_key(F.col("messages")).alias("key"), F.size("messages").cast("long").alias("turns"))


@query("""select doc_id, lang, source, position from (select *, row_number() over (partition by lang, source order by r, doc_id) as position from (select doc_id, lang, source, sha256('[42, "' || cast(doc_id as varchar) || '"]') as r from documents)) order by position, lang, source limit 100""")
def stratified_round_robin(spark, sf):
    docs = read(spark, sf, "documents").select("doc_id", "lang", "source")
    return sampling.round_robin(docs, ["lang", "source"], "doc_id", 100)


@query("""select doc_id from documents order by sha256('42:' || cast(doc_id as varchar)), doc_id limit 50""")
def hash_rank_topk(spark, sf):
    return sampling.top_by_hash(read(spark, sf, "documents").select("doc_id"), "doc_id", 50)


@query("""select doc_id, source, position from (select doc_id, source, row_number() over (partition by source order by sha256('42:' || cast(doc_id as varchar)), doc_id) as position from documents) where position <= 5""")
def per_group_topk(spark, sf):
    return sampling.top_per_group(read(spark, sf, "documents").select("doc_id", "source"), ["source"], "doc_id", 5)


@query("""select key, any_value(copies) as copies, min(doc_id) as doc_id, min(quality) as quality from (select sha256(text) as key, doc_id, quality, count(*) over (partition by sha256(text)) as copies from documents join labels using (doc_id)) group by key having min(quality) = max(quality)""")
def conflicting_label_dedup(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("key")).join(read(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return dedup.conflict_free(rows, ["key"], "quality", ["doc_id"]).select("key", "copies", "doc_id", "quality")


@query("""select source, lang, count(*) as n, count(*) filter (where quality = 1) as correct, round(count(*) filter (where quality = 1) / count(*), 6) as accuracy, count(*) filter (where toxic = 1) as unparsed, cast(grouping(lang) as integer) as whole
from documents join labels using (doc_id) group by grouping sets ((source), (source, lang))""")
def accuracy_grouping_sets(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source", "lang").join(read(spark, sf, "labels"), "doc_id")
    return rollups.accuracy_sets(rows, "source", "lang", F.col("quality") == 1, F.col("toxic") == 1)


@query("""select quality, toxic, count(*) as n from labels group by quality, toxic""")
def confusion_matrix(spark, sf):
    return rollups.confusion(read(spark, sf, "labels"), "quality", "toxic")


@query("""select source, count(*) as n, count(*) filter (where quality = 1 - toxic) as agreed, count(*) filter (where quality = 0 and 1 - toxic = 1) as flawed_kept, count(*) filter (where quality = 1 and 1 - toxic = 0) as usable_rejected, count(*) filter (where toxic is null) as unjudged
from documents join labels using (doc_id) group by source""")
def agreement_by_source(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels"), "doc_id").withColumn("judge", 1 - F.col("toxic"))
    return rollups.agreement(rows, "source", "quality", "judge", 1, 0)


@query(r"""select event_id, list_sort(list_distinct(list_transform(regexp_extract_all(props, '[0-9]+'), lambda x: ltrim(x, '0') || case when ltrim(x, '0') = '' then '0' else '' end))) as numbers from events where props is not null""")
def numeric_token_counts(spark, sf):
    """Values of the numbers in event properties, which are whole and stand alone there."""
    return read(spark, sf, "events").where("props is not null").select("event_id", text.numeric_tokens("props").alias("numbers"))


FLAGS = """list_filter([case when contains(text, '@') then 'mail' end, case when regexp_matches(text, '[0-9]') then 'number' end, case when n_chars < 200 then 'short' end, case when contains(text, chr(65533)) then 'replacement_character_present' end], lambda x: x is not null)"""


def flagged(spark, sf):
    flags = F.array_compact(F.array(F.when(F.col("text").contains("@"), "mail"), F.when(F.col("text").rlike("[0-9]"), "number"), F.when(F.col("n_chars") < 200, "short"), F.when(F.col("text").contains("�"), "replacement_character_present")))
    return read(spark, sf, "documents").select("doc_id", "source", flags.alias("flags"))


@query(f"""select flag, count(*) as n from (select unnest({FLAGS}) as flag from documents) group by flag""")
def flag_explode_counts(spark, sf):
    return rollups.exploded_counts(flagged(spark, sf), "flags")


@query(f"""select doc_id, case when len(f) > 0 and list_contains(f, 'mail') then 'repair' when len(f) > 0 or source = 'src2' then 'review' else 'accept' end as decision from (select doc_id, source, {FLAGS} as f from documents)""")
def route_decision(spark, sf):
    none = F.array().cast("array<string>")
    return flagged(spark, sf).select("doc_id", conversations.routed(none, F.col("flags"), F.when(F.col("source") == "src2", "policy"), ["mail"]).alias("decision"))


@query("""with k as (select doc_id, sha256(text) as text_key, sha256(source || lang) as group_key from documents), h as (select * from k where doc_id % 7 = 0), g as (select group_key from k group by group_key having count(*) < 5)
select doc_id from k where not exists (select 1 from h where h.doc_id = k.doc_id) and not exists (select 1 from h where h.text_key = k.text_key) and not exists (select 1 from g where g.group_key = k.group_key)""")
def history_three_key_anti(spark, sf):
    k = read(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("text_key"), F.sha2(F.concat("source", "lang"), 256).alias("group_key"))
    small = k.groupBy("group_key").count().where("count < 5")
    return dedup.unseen(dedup.unseen(k, k.where("doc_id % 7 = 0"), ["doc_id", "text_key"]), small, ["group_key"]).select("doc_id")


def follow_ups(spark, sf):
    """Turns with the text of the turn before."""
    return read(spark, sf, "conversations").withColumn("prev", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))


@query()
def cer_turns(spark, sf):
    """Character errors of each whole turn against the whole turn before; DuckDB counts edits of bytes, so a test compares them with brute force."""
    return follow_ups(spark, sf).select("conv_id", "turn", F.round(metrics.character_errors("text", "prev"), 6).alias("cer")).where("cer is not null")


@query(r"""with t as (select conv_id, turn, role, text, lag(text) over (partition by conv_id order by turn) as prev from conversations),
w as (select conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') as a, list_filter(regexp_split_to_array(prev, '\s+'), lambda x: x <> '') as b from t where role = 'assistant' and prev is not null)
select conv_id, turn, round(case when len(a) + len(b) > 0 then 2 * coalesce(list_sum(list_transform(list_distinct(list_intersect(a, b)), lambda x: least(len(list_filter(a, lambda y: y = x)), len(list_filter(b, lambda y: y = x))))), 0) / (len(a) + len(b)) else 0 end, 6)::double as rouge1 from w""")
def rouge_one(spark, sf):
    """ROUGE-1 of each whole assistant turn against the turn before."""
    rows = follow_ups(spark, sf).where("role = 'assistant' and prev is not null")
    return rows.select("conv_id", "turn", F.round(metrics.rouge_words(F.col("text"), F.col("prev")), 6).alias("rouge1"))


@query("""select event_type, count(*) as n, count(*) filter (where json_valid(props)) as valid, count(distinct json_extract_string(props, '$.page')) as pages from events group by event_type""")
def json_props_validation(spark, sf):
    events = read(spark, sf, "events").withColumn("ok", jsons.is_strict("props"))
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_if("ok").alias("valid"), F.countDistinct(F.get_json_object("props", "$.page")).alias("pages"))


@query("""select d.source, round(avg(l.quality), 5) as mean, min(l.quality) as least, max(l.quality) as greatest, count(l.quality) as n from documents d join labels l using (doc_id) group by rollup (d.source)""")
def judge_score_rollup(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels"), "doc_id")
    return rollups.judge_scores(rows, "source", "quality")


@query()
def answer_metrics(spark, sf):
    """BLEU, ROUGE, fuzzy accuracy and word errors of each whole assistant turn against the whole turn before; tests hold them against known values."""
    rows = follow_ups(spark, sf).where("role = 'assistant' and prev is not null")
    return rows.select("conv_id", "turn", metrics.scored("text", F.array("prev")).alias("s")).select("conv_id", "turn", "s.*")


@query()
def corpus_metrics(spark, sf):
    """Means of BLEU without smoothing and of ROUGE, by lines too, of all whole assistant turns against the turns before, by length of the conversation."""
    rows = follow_ups(spark, sf).where("role = 'assistant' and prev is not null")
    names = ["bleu", "rouge1", "rouge2", "rougeL", "rougeLsum"]
    return rollups.metric_means(rows.select("turn", metrics.corpus_scored("text", "prev").alias("s")).select("turn", "s.*"), ["turn"], names)


@query()
def overlap_keys(spark, sf):
    """NFC keys of all documents' texts; DuckDB's nfc_normalize is not what all builds have."""
    lower_batches(spark)
    return read(spark, sf, "documents").select("doc_id", text.overlap_key("text").alias("key"))


# Review of a run.

CHECKS = """list_filter(['structure', case when n_chars < 100 then 'numbers_skipped_short' else 'numbers' end, case when lang is null then 'language_skipped_unknown' else 'language' end], lambda x: x is not null)"""


def reviewed(spark, sf):
    checks = F.array(F.lit("structure"), F.when(F.col("n_chars") < 100, "numbers_skipped_short").otherwise("numbers"), F.when(F.col("lang").isNull(), "language_skipped_unknown").otherwise("language"))
    return flagged(spark, sf).join(read(spark, sf, "documents").select("doc_id", checks.alias("checks")), "doc_id")


@query(f"""select 'flag' as kind, name, count(*) as n from (select unnest({FLAGS}) as name from documents) group by name
union all select case when contains(name, '_skipped_') then 'skipped' else 'check' end as kind, name, count(*) as n from (select unnest({CHECKS}) as name from documents) group by name""")
def flag_check_counts(spark, sf):
    return review.flag_counts(reviewed(spark, sf))


@query("""select source, lang, count(*) as population, least(count(*), 20) as sampled from documents group by source, lang""")
def group_population(spark, sf):
    return review.populations(read(spark, sf, "documents"), ["source", "lang"], 20)


@query(f"""select flag, doc_id, position from (select flag, doc_id, row_number() over (partition by flag order by sha256('42:' || cast(doc_id as varchar)), doc_id) as position from (select doc_id, unnest({FLAGS}) as flag from documents)) where position <= 7""")
def diagnostics_per_flag(spark, sf):
    return review.flag_samples(flagged(spark, sf), "flags", "doc_id", 7).select("flag", "doc_id", "position")


@query("""select key, doc_id, source from (select sha256(text) as key, doc_id, source, row_number() over (partition by sha256(text) order by sha256('42:' || cast(doc_id as varchar)), doc_id) as r from documents) where r = 1""")
def unique_by_input(spark, sf):
    return review.first_by_rank(read(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("key")), "key", "doc_id").select("key", "doc_id", "source")


@query("""select item_id, row_number() over (order by sha256('[42, "display", "' || cast(item_id as varchar) || '"]'), item_id) as place from benchmark""")
def display_shuffle(spark, sf):
    """A pack of bounded size in the order in which it is shown."""
    return review.shown_order(read(spark, sf, "benchmark").select("item_id"), "item_id").select("item_id", F.col("place").cast("long").alias("place"))


@query("""select doc_id, source, lang from documents where lang = 'en' and source <> 'src1'""")
def eligible_rows(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source", "lang", (F.col("source") != "src1").alias("is_labeled"), F.when(F.col("lang") == "en", "train").otherwise("test").alias("split"))
    return review.eligible(rows).select("doc_id", "source", "lang")


JUDGMENTS = "select doc_id, case toxic when 1 then 'drop' else case when doc_id % 3 = 0 then 'review' else 'keep' end end as decision from labels where quality = 1 or toxic = 1"


def judgments(spark, sf):
    rows = read(spark, sf, "labels").where("quality = 1 or toxic = 1")
    return rows.select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, "drop").when(F.col("doc_id") % 3 == 0, "review").otherwise("keep").alias("decision"))


@query(f"""with j as ({JUDGMENTS}), h as (select doc_id, case quality when 1 then 'usable' else 'flawed' end as human from labels),
p as (select h.human, coalesce(case decision when 'keep' then 'usable' when 'review' then 'unsure' when 'drop' then 'flawed' end, 'unjudged') as judge from h left join j using (doc_id)) select human, judge, count(*) as n from p group by human, judge""")
def human_vs_judge(spark, sf):
    """Labels of people against judgments, where there are any."""
    human = read(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "usable").otherwise("flawed").alias("human"))
    return rollups.confusion(review.judged(human, judgments(spark, sf), judge.HUMAN), "human", "judge")


@query("""select doc_id as id, sha256(text) as example_hash, case quality when 1 then 'usable' when 0 then 'flawed' end as label from documents left join labels using (doc_id)""")
def labels_checked(spark, sf):
    """Labels joined to the rows that they were given for, by id and hash."""
    docs = read(spark, sf, "documents")
    sample = docs.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("example_hash"))
    labels = read(spark, sf, "labels").join(docs, "doc_id").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("example_hash"), F.when(F.col("quality") == 1, "usable").otherwise("flawed").alias("label"), F.lit("").alias("note"))
    return review.labels_joined(sample, labels).select("id", "example_hash", "label")


@query(f"""select d.doc_id as id, source, decision from documents d join ({JUDGMENTS}) j using (doc_id)""")
def sample_attempts(spark, sf):
    return review.attempted(read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source"), judgments(spark, sf))


@query("""select doc_id, case when source = 'src0' then 'prose' when lang = 'en' then 'english' else 'general' end as rubric from documents""")
def rubric_routing(spark, sf):
    return read(spark, sf, "documents").select("doc_id", review.rubric(F.col("source"), F.col("lang"), {"src0": "prose", "en": "english"}, "general").alias("rubric"))


@query(f"""select conv_id, sha256('{{"messages":' || to_json(m)::varchar || ',"tools":"[]","structure_valid":' || case when len(list_filter(m, lambda x: x.role = 'user')) > 0 then 'true' else 'false' end || '}}') as payload from (select conv_id, list_transform(m, lambda x: struct_pack(role := x.role, content := x.text)) as m from {ASSEMBLED})""")
def judge_payloads(spark, sf):
    """What a judge sees of each conversation, as a digest; its structure is sound here if a user speaks."""
    rows = conversations.assembled(read(spark, sf, "conversations"))
    spoken = F.exists("messages", lambda m: m["role"] == "user")
    faults = F.when(spoken, F.array().cast("array<string>")).otherwise(F.array(F.lit("missing_user")))
    return rows.select("conv_id", F.sha2(review.judge_payload(F.col("messages"), ["role", "content"], F.lit("[]"), faults), 256).alias("payload"))


@query("""select doc_id as id, sha256(text) as example_hash, sha256(lang || source) as input_hash, text from documents where lang is not null and source is not null""")
def blind_projection(spark, sf):
    rows = read(spark, sf, "documents").where("lang is not null and source is not null")
    return review.blind(rows.select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("example_hash"), F.sha2(F.concat("lang", "source"), 256).alias("input_hash"), "text", "lang", "source"), ["text"])


MADE = """'{"decision": "' || ['keep', 'repair', 'drop', 'review', 'maybe'][doc_id % 5 + 1] || '", "reasons": [' || ['"fine"', '', '"a", "b"', '" "', '3'][doc_id % 11 % 5 + 1] || '], "dimensions": {"correctness": "' || ['pass', 'fail', 'uncertain', 'good'][doc_id % 7 % 4 + 1] || '", "language_quality": "pass", "instruction_following": "' || case toxic when 1 then 'fail' else 'pass' end || '"}' || case when doc_id % 13 = 0 then ', "more": 1}' when doc_id % 17 = 0 then '' else '}' end"""


@query(f"""with t as (select doc_id, {MADE} as t from labels), v as (select doc_id, case when json_valid(t) then t::json end as j from t),
f as (select doc_id, j, json_extract_string(j, '$.decision') as d, json_extract(j, '$.reasons') as r, [json_extract_string(j, '$.dimensions.correctness'), json_extract_string(j, '$.dimensions.language_quality'), json_extract_string(j, '$.dimensions.instruction_following')] as m from v)
select doc_id, case when j is null then 'json' when len(json_keys(j)) <> 3 then 'keys' when d not in ('keep', 'review', 'repair', 'drop') then 'decision'
when json_array_length(r) = 0 or len(list_filter(range(json_array_length(r)::bigint), lambda i: json_type(r, '$[' || i || ']') <> 'VARCHAR' or trim(json_extract_string(r, '$[' || i || ']')) = '')) > 0 then 'reasons'
when len(list_filter(m, lambda x: x not in ('pass', 'fail', 'uncertain'))) > 0 then 'dimensions'
when d = 'keep' and (list_contains(m, 'fail') or list_contains(m, 'uncertain')) or d in ('repair', 'drop') and not list_contains(m, 'fail') then 'contradiction' end as fault from f""")
def judgment_validity(spark, sf):
    """What is wrong with judgments made from the labels, sound ones and all kinds of unsound ones."""
    of = lambda n, k, *xs: F.get(F.array(*map(F.lit, xs)), (F.col("doc_id") % n % k).cast("int"))
    parts = [
        F.lit('{"decision": "'), of(5, 5, "keep", "repair", "drop", "review", "maybe"), F.lit('", "reasons": ['), of(11, 5, '"fine"', "", '"a", "b"', '" "', "3"),
        F.lit('], "dimensions": {"correctness": "'), of(7, 4, "pass", "fail", "uncertain", "good"), F.lit('", "language_quality": "pass", "instruction_following": "'), F.when(F.col("toxic") == 1, "fail").otherwise("pass"),
        F.lit('"}'), F.when(F.col("doc_id") % 13 == 0, ', "more": 1}').when(F.col("doc_id") % 17 == 0, "").otherwise("}"),
    ]
    return read(spark, sf, "labels").select("doc_id", judge.judgment_fault(F.concat(*parts)).alias("fault"))


# Roll-ups.


@query("""select list_sort(list(distinct source)) as observed, ['src97', 'src98'] as missing from documents""")
def source_coverage(spark, sf):
    return rollups.missing_sources(read(spark, sf, "documents"), "source", ["src98", "src1", "src97"])


ROUTED = f"""select doc_id, source, lang, f, case when list_contains(f, 'mail') then 'repair' when len(f) > 0 then 'review' else 'accept' end as decision from (select doc_id, source, lang, {FLAGS} as f from documents)"""


def decisions(spark, sf):
    none = F.array().cast("array<string>")
    rows = reviewed(spark, sf).withColumn("decision", conversations.routed(none, F.col("flags"), F.lit(None), ["mail"]))
    return rows.withColumns({"reasons": F.when(F.size("flags") > 0, F.concat("flags", "flags")).otherwise(F.array(F.lit("offline_checks_passed"))), "dialect": F.lit("unspecified")})


@query(f"""with r as ({ROUTED}) select decision, null as reason, count(*) as n from r group by decision union all select decision, reason, count(*) as n from (select decision, unnest(case when len(f) > 0 then f else ['offline_checks_passed'] end) as reason from r) group by decision, reason""")
def reason_counts(spark, sf):
    return rollups.reason_summary(decisions(spark, sf), "decision", "reasons")


@query(f"""with r as ({ROUTED}), e as (select 'decision' as counter, decision as name from r union all select 'reason', unnest(case when len(f) > 0 then f else ['offline_checks_passed'] end) from r union all select 'flag', unnest(f) from r
union all select 'check', unnest({CHECKS}) from documents union all select 'dialect', 'unspecified' from r union all select 'source', concat_ws('/', source, decision) from r) select counter, name, count(*) as n from e group by counter, name""")
def curation_counters(spark, sf):
    return rollups.curation_counts(decisions(spark, sf))


@query("""select source, lang, count(*) as n, round(avg(quality), 4) as quality, round(avg(toxic), 4) as toxic from documents join labels using (doc_id) group by source, lang""")
def metric_averages(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source", "lang").join(read(spark, sf, "labels"), "doc_id")
    return rollups.metric_means(rows, ["source", "lang"], ["quality", "toxic"])


SCORES = "(select source, case doc_id % 4 when 0 then 'rouge1' when 1 then 'rougeLsum' when 2 then 'accuracy' else 'rouge2' end as metric, (quality + doc_id % 10 / 10.0) / 2 as score, quality * 3 as points, doc_id from documents join labels using (doc_id))"


def scores(spark, sf):
    rows = read(spark, sf, "documents").select("doc_id", "source").join(read(spark, sf, "labels"), "doc_id")
    place = F.col("doc_id") % 4
    metric = F.when(place == 0, "rouge1").when(place == 1, "rougeLsum").when(place == 2, "accuracy").otherwise("rouge2")
    return rows.select("doc_id", "source", metric.alias("metric"), ((F.col("quality") + F.col("doc_id") % 10 / F.lit(10.0)) / 2).alias("score"), (F.col("quality") * 3).alias("points"))


@query(f"""with t as (select source as task, avg(score) as s from {SCORES} where metric not in ('rouge1', 'rouge2', 'rougeL') group by source) select task, round(s, 4) as score from t union all select null, round(avg(s), 4) from t""")
def task_averages(spark, sf):
    return rollups.task_average(scores(spark, sf), "source", "metric", "score")


@query(f"""select metric, count(*) as n, round(avg(score), 5) as mean, round(median(score), 5) as median, round(avg(case when score >= 0.5 then 1.0 else 0.0 end), 5) as pass_rate from {SCORES} group by metric""")
def batch_statistics(spark, sf):
    return rollups.batch_stats(scores(spark, sf), ["metric"], "score")


@query(f"""select source, metric, count(*) as n, round(avg(score), 5) as mean, round(median(score), 5) as median from {SCORES} group by source, metric""")
def judge_ensemble(spark, sf):
    return rollups.ensembled(scores(spark, sf), ["source", "metric"], "score")


@query(f"""select doc_id, round(points / 3, 5) as third, greatest(0.0, least(1.0, score * 2 - 0.5))::double as clamped, round(points / 3, 5) >= 0.5 as passed from {SCORES}""")
def score_normalisation(spark, sf):
    rows = scores(spark, sf).withColumns({"third": rollups.normalised(F.col("points"), thirds=True), "clamped": rollups.normalised(F.col("score") * 2 - 0.5)})
    return rows.select("doc_id", "third", "clamped", rollups.passes(F.col("third")).alias("passed"))


@query("""select o_orderpriority, count(*) as n, sum((o_custkey || '.25')::decimal(38, 12)) as reserved, coalesce(sum(case when o_orderstatus = 'F' then (o_custkey || '.125')::decimal(38, 12) end), 0)::decimal(38, 12) as charged,
sum(case when o_orderstatus = 'F' then (o_custkey || '.125')::decimal(38, 12) else (o_custkey || '.25')::decimal(38, 12) end) as committed from orders group by o_orderpriority""")
def cost_totals(spark, sf):
    amount = lambda tail: F.concat(F.col("o_custkey").cast("string"), F.lit(tail))
    attempts = read(spark, sf, "orders").select("o_orderpriority", amount(".25").alias("reservation"), F.when(F.col("o_orderstatus") == "F", amount(".125")).alias("charge"))
    return rollups.cost_sums(attempts, ["o_orderpriority"])


@query("""select o_orderkey, round((o_custkey::decimal(20, 0) * 0.195 + o_orderkey::decimal(20, 0) * 0.495) * 0.000001, 6)::double as usd from orders""")
def token_costs(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", rollups.costs(F.col("o_custkey"), F.col("o_orderkey"), "0.195", "0.495").alias("usd"))


# Rows, prompts, keys.

ITEMS = """(select p_partkey, trim(p_name) as q, case when p_size % 3 = 0 then '' else p_brand end as c, list_filter([struct_pack(l := 'A', t := p_type), struct_pack(l := 'B', t := case when p_size % 5 = 0 then '  ' else p_brand end), struct_pack(l := 'C', t := case when p_size % 7 = 0 then p_type end), struct_pack(l := 'D', t := 'size ' || p_size), struct_pack(l := 'E', t := '')], lambda o: trim(coalesce(o.t, '')) <> '') as o, upper(['a', 'b', 'c', 'D', 'x'][p_partkey % 5 + 1]) as g, p_size % 11 = 0 as shown from part)"""


@query(f"""select 'parts:' || p_partkey as id, 'parts' as subset, case when c <> '' then 'السياق:' || chr(10) || c || chr(10) || chr(10) || 'السؤال:' || chr(10) || q else q end || chr(10) || chr(10) || 'الخيارات:' || chr(10) || array_to_string(list_transform(o, lambda x: x.l || '. ' || trim(x.t)), chr(10)) as question,
list_transform(o, lambda x: x.l) as choices, g as gold from {ITEMS} where not shown and len(o) >= 2 and list_contains(list_transform(o, lambda x: x.l), g)""")
def mcq_items(spark, sf):
    """Multiple-choice items of the five-option layout, with blank options, rows to show and gold answers that are no option."""
    size, blank = F.col("p_size"), F.lit("")
    rows = read(spark, sf, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_name").alias("Question"), F.when(size % 3 == 0, blank).otherwise(F.col("p_brand")).alias("Context"), F.col("p_type").alias("Option 1"), F.when(size % 5 == 0, "  ").otherwise(F.col("p_brand")).alias("Option 2"),
        F.when(size % 7 == 0, F.col("p_type")).alias("Option 3"), F.concat(F.lit("size "), size.cast("string")).alias("Option 4"), blank.alias("Option 5"),
        F.get(F.array(*map(F.lit, "abcDx")), (F.col("p_partkey") % 5).cast("int")).alias("Answer Key"), (size % 11 == 0).cast("int").alias("is_few_shot"),
    )
    return mcq.items(rows, "keyed", F.lit("parts"))


@query("""select s_suppkey, case when s_suppkey % 2 = 0 then s_name || chr(10) || chr(10) else '' end || 'nation ' || s_nationkey || case when s_suppkey % 3 = 0 then chr(10) || chr(10) || 'الخيارات:' || chr(10) || 'A. yes' || chr(10) || 'B. no' || chr(10) || 'أجب بنص الخيار الصحيح فقط.' else chr(10) || 'اتبع التعليمات وأكمل المهمة.' end as prompt from supplier""")
def evaluation_prompts(spark, sf):
    rows = read(spark, sf, "supplier")
    choices = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("yes"), F.lit("no"))).otherwise(F.array().cast("array<string>"))
    return rows.select("s_suppkey", mcq.completion_text(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")), F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")), choices).alias("prompt"))


@query("""select doc_id, sha256(replace(text, chr(10), '\\n')) as escaped from documents""")
def newline_escape(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.sha2(tasks.escaped(F.col("text")), 256).alias("escaped"))


@query(r"""select page_id, translate(url, '<>:/\|?*', '________') as name from pages""")
def file_names(spark, sf):
    return read(spark, sf, "pages").select("page_id", tasks.config_name(F.col("url")).alias("name"))


@query("""select count(*) as n, 0 as first, count(*) - 1 as last, count(*) as different from lineitem""")
def indexed_scan(spark, sf):
    """The row index runs through all rows once."""
    rows = readers.indexed(spark, [f"{sf}/lineitem.parquet"], ["l_orderkey"])
    return rows.agg(F.count("*").alias("n"), F.min("row_index").alias("first"), F.max("row_index").alias("last"), F.countDistinct("row_index").alias("different"))


@query("""with n as (select count(*) // 40 as width from events), s as (select event_id, width, least(event_id // width, 39) as stratum from events, n), o as (select *, ('0x' || substr(sha256('42:' || stratum), 1, 8))::bigint % greatest(1, width - 24) as off, event_id - stratum * width as place from s)
select event_id from o where place >= off and place < off + 25""")
def systematic_pages(spark, sf):
    """Whole pages of 25, one in each of 40 equal strata of the row index."""
    events = read(spark, sf, "events").select("event_id")
    return sampling.systematic(events, "event_id", events.count(), 1000)


@query("""select d.doc_id as id, d.source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)""")
def rows_left_to_do(spark, sf):
    """Rows that a run before did not commit."""
    return runs.remaining(read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source"), read(spark, sf, "labels").select(F.col("doc_id").alias("id")))


KINDS = PAIRS + """, x as (select distinct d.doc_id from documents d join benchmark b on sha256(trim(regexp_replace(d.text, '\\s+', ' ', 'g'))) = sha256(trim(regexp_replace(b.text, '\\s+', ' ', 'g')))), k as (select d.doc_id as id, case when x.doc_id is not null then 'exact' when exists (select 1 from p where p.doc_id = d.doc_id and shared / (doc_shingles + item_shingles - shared) >= 0.05) then 'near' else 'none' end as kind from documents d left join x on x.doc_id = d.doc_id) """


def kinds(spark, sf):
    parts = read(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.lit(0).alias("part"), "text")
    return overlap.overlap_kinds(parts, read(spark, sf, "benchmark"), threshold=0.05)


@query(KINDS + "select kind, count(*) as parts, count(distinct id) as rows from k group by kind")
def overlap_kind_summary(spark, sf):
    return overlap.overlap_summary(kinds(spark, sf))


@query(KINDS + "select doc_id as id, source from documents join k on k.id = doc_id where kind = 'none'")
def overlap_excluded(spark, sf):
    return overlap.without_overlap(read(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source"), kinds(spark, sf))


PREPARED = """(select doc_id, sha256(cast(doc_id as varchar)) as id, coalesce(lang, 'none') as dataset, case source when 'src1' then 'test' when 'src2' then 'validation' else 'train' end as split, source in ('src1', 'src2', 'src3') as preserved, quality is not null as labeled, n_chars >= 60 as good,
sha256(text) as example_hash, sha256(left(text, 40)) as input_hash, sha256(trim(regexp_replace(text, '[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'))) as key, toxic from (select * from documents where text is not null and source is not null and n_chars is not null) d left join labels using (doc_id))"""


@query(f"""with r as (select *, preserved and split <> 'train' as official, case when preserved then case split when 'test' then 0 when 'validation' then 1 else 2 end else 3 end as job_rank from {PREPARED}),
h as (select input_hash, min(split) as held from r where official group by input_hash), t as (select distinct input_hash from r where good and preserved and split = 'train'), b as (select distinct key from r where toxic = 1),
o as (select r.*, held, t.input_hash is not null as in_train, b.key is not null and good as hit from r left join h using (input_hash) left join t using (input_hash) left join b using (key)),
e as (select *, case when not good then 'quarantine' when not official and held is not null then 'official_holdout_overlap' when not official and hit then 'benchmark_overlap' end as early from o),
f as (select example_hash, arg_min(id, struct_pack(a := job_rank, b := dataset, c := split, d := doc_id)) as first_id from e where early is null group by example_hash),
z as (select e.*, first_id, early is null and not official and first_id <> id as repeated from e left join f using (example_hash))
select doc_id, case when early = 'quarantine' then 'quarantine' when early is not null or repeated then 'exclude' when labeled then 'keep' else 'holdout' end as decision,
case when early = 'quarantine' then 'too_short' when early is not null then early when repeated then 'exact_duplicate' else '' end as reason,
case when not good or official then split when held is not null then held when in_train then 'train' when {SHARE.format('input_hash')} < 922337203685477580 then 'validation' else 'train' end as split, case when repeated then first_id end as duplicate_of, case when hit then 'toxic' else '' end as matched from z""")
def prepare_decisions(spark, sf):
    """Decision, reason and split of each document: three sources keep their splits, toxic texts are the benchmark, short ones are unsound.

    Labels are joined to hashes: texts are read once and not shuffled.
    """
    lower_batches(spark)
    docs = read(spark, sf, "documents").where("text is not null and source is not null and n_chars is not null")
    hashes = F.sha2("text", 256).alias("whole"), F.sha2(F.substring("text", 1, 40), 256).alias("asked"), text.overlap_key("text").alias("key")
    docs = docs.select("doc_id", "lang", "source", "n_chars", *hashes).persist().join(read(spark, sf, "labels"), "doc_id", "left")
    split = F.when(F.col("source") == "src1", "test").when(F.col("source") == "src2", "validation").otherwise("train")
    kept = F.col("source").isin("src1", "src2", "src3")
    good, none = F.col("n_chars") >= 60, F.array().cast("array<string>")
    rank = F.when(kept, F.when(split == "test", 0).when(split == "validation", 1).otherwise(2)).otherwise(3)
    rows = docs.select(
        "doc_id", F.sha2(F.col("doc_id").cast("string"), 256).alias("id"), F.coalesce("lang", F.lit("none")).alias("dataset"), split.alias("split"), split.alias("original_split"), F.col("doc_id").alias("row_index"), kept.alias("preserved"), (kept & (split != "train")).alias("official"),
        F.col("quality").isNotNull().alias("labeled"), rank.alias("job_rank"), F.when(good, none).otherwise(F.array(F.lit("too_short"))).alias("problems"),
        F.when(good, F.col("whole")).alias("example_hash"), F.when(good, F.col("asked")).alias("input_hash"), F.when(~good, F.col("asked")).alias("reserved_hash"), F.when(good, F.array("key")).otherwise(none).alias("text_hashes"),
    )
    marks = docs.where("toxic = 1").select(F.col("key").alias("hash"), F.lit("toxic").alias("name")).distinct()
    out = prepare.decided(rows, marks, 42, 0.05)
    return out.select("doc_id", "decision", F.array_join("reasons", ",").alias("reason"), "split", "duplicate_of", F.array_join("benchmark_matches", ",").alias("matched"))


@query(r"""select item_id, sha256(regexp_replace(text, '([^\\\P{P}]|[`÷×<>^~¦+|ـ])', ' \1 ', 'g')) as apart from benchmark""")
def punctuation_apart(spark, sf):
    return read(spark, sf, "benchmark").select("item_id", F.sha2(answers.apart(F.col("text")), 256).alias("apart"))


@query(r"""select conv_id, turn, sha256(lower(trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}\p{M}_\s]', ' ', 'g'), '\s+', ' ', 'g')))) as plain from conversations where text is not null""")
def plain_answers(spark, sf):
    return read(spark, sf, "conversations").where("text is not null").select("conv_id", "turn", F.sha2(answers.plain_answer(F.col("text")), 256).alias("plain"))


@query(r"""with l as (select conv_id, turn, regexp_replace(trim(string_split(trim(text, e' \t\n\r'), chr(10))[1], e' \t\n\r'), '[^\p{L}\p{N}_\s]+$', '') as line from conversations where text is not null),
w as (select *, list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> '') as w from l)
select conv_id, turn, case when regexp_matches(line, '^[^:]+:\s*\S') and regexp_matches(lower(regexp_extract(line, '^([^:]+):', 1)), 'answer|response|result|choice|option|الإجابة|الجواب') then regexp_replace(regexp_extract(line, '^[^:]+:\s*(\S+)', 1), '[^\p{L}\p{N}_\s]', '', 'g')
when len(w) <= 3 then line else regexp_replace(w[1], '[^\p{L}\p{N}_\s]', '', 'g') end as leading from w""")
def leading_answers(spark, sf):
    return read(spark, sf, "conversations").where("text is not null").select("conv_id", "turn", answers.leading_words("text").alias("leading"))


@query("""select p_partkey, case p_partkey % 5 when 0 then p_type when 1 then p_brand when 2 then 'Z' when 3 then 'neither' else '' end as answer from part""")
def option_texts(spark, sf):
    """Letters of options as their texts, other answers as they are."""
    given = F.get(F.array(F.lit("A"), F.lit(" b) "), F.lit("Z"), F.lit("neither"), F.lit(None)), (F.col("p_partkey") % 5).cast("int"))
    options = F.create_map(F.lit("A"), F.col("p_type"), F.lit("B"), F.col("p_brand"))
    return read(spark, sf, "part").select("p_partkey", answers.option_text(given, options).alias("answer"))


@query("""select doc_id, case when quality = 1 then 0.5 else 0.25 end::double as ngram, toxic::double as mcq from labels""")
def score_keys(spark, sf):
    """rougeLsum stands before bleu; accuracy is the score of choices."""
    score = lambda c: F.col(c).cast("double")
    both = F.create_map(F.lit("bleu"), F.lit(0.25), F.lit("rougeLsum"), F.lit(0.5), F.lit("accuracy"), score("toxic"))
    one = F.create_map(F.lit("bleu"), F.lit(0.25), F.lit("accuracy"), score("toxic"))
    found = read(spark, sf, "labels").select("doc_id", answers.score_columns(F.when(F.col("quality") == 1, both).otherwise(one)).alias("s"))
    return found.select("doc_id", F.col("s.nGramScore").alias("ngram"), F.col("s.mcqScore").alias("mcq"))


@query(r"""select page_id, left(regexp_replace(trim(lower(url)), '[ ./]', '_', 'g'), 255) as name from pages""")
def id_names(spark, sf):
    return read(spark, sf, "pages").select("page_id", answers.file_names("url").alias("name"))


@query("""select doc_id, sha256('["' || coalesce(source, 'none') || '","' || coalesce(lang, 'none') || '","' || doc_id || '"]') as key from documents""")
def row_keys(spark, sf):
    return read(spark, sf, "documents").select("doc_id", sampling.row_key(F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id")).alias("key"))


# Whole procedures over conversations.


def raw_rows(spark, sf):
    """Conversations as raw rows of one dialogue dataset."""
    rows = conversations.assembled(read(spark, sf, "conversations"))
    plain = {"dataset": "talk", "repo": "own/talk", "revision": "r1", "config": "default", "kind": "dialogue", "original_split": "train", "source": "forum", "task": "chat", "tools_json": "[]", "dialect": "plain"}
    return rows.select(F.col("conv_id").alias("row_index"), F.to_json("messages").alias("messages_json"), F.lit(False).alias("preserved"), F.lit(True).alias("labeled"), *(F.lit(v).alias(k) for k, v in plain.items()))


STORED = "list_transform({}, lambda x: struct_pack(content := x.text, role := x.role))"


@query(f"""with c as (select conv_id, m, {CODES} as codes from {ASSEMBLED})
select sha256('own/talk@r1:default:train:' || conv_id) as id, array_to_string(codes, ',') as problems, case when len(codes) = 0 then sha256('{{"messages":' || to_json({STORED.format('m')})::varchar || ',"tools":[]}}') end as example_hash,
case when len(codes) = 0 then sha256('{{"messages":' || to_json({STORED.format("m[1:len(m) - 1]")})::varchar || ',"tools":[]}}') end as input_hash, 'plain' as dialect from c""")
def prepared_rows(spark, sf):
    """Identity, problems and fingerprints of each conversation as a row of a dataset; a sound one ends with the assistant."""
    rows = prepare.prepared(raw_rows(spark, sf))
    return rows.select("id", F.array_join(F.array_sort("problems"), ",").alias("problems"), "example_hash", "input_hash", F.get_json_object("metadata_json", "$.dialect").alias("dialect"))


@query(f"""with c as (select conv_id, {CODES} as codes, len(list_filter(m, lambda x: contains(coalesce(x.text, ''), chr(65533)))) > 0 as odd, len(list_filter(m, lambda x: x.role = 'system')) > 0 as watched from {ASSEMBLED})
select conv_id, case when len(codes) > 0 then 'exclude' when odd then 'repair' when watched then 'review' else 'accept' end as decision,
case when len(codes) > 0 then array_to_string(list_sort(list_concat(codes, case when watched then ['watched_source'] else [] end)), ',') when odd or watched then array_to_string(list_sort(list_filter([case when odd then 'replacement_character_present' end, case when watched then 'watched_source' end], lambda x: x is not null)), ',') else 'offline_checks_passed' end as reasons,
'plain' as dialect, 'offline_rules' as scope from c""")
def curated_conversations(spark, sf):
    """Decision and reasons of curation for each conversation; those with a system message come from a source that is watched."""
    rows = raw_rows(spark, sf).withColumns({"id": F.col("row_index").cast("string"), "is_labeled": F.lit(True), "split": F.lit("train"), "metadata_json": F.lit('{"dialect": "plain"}')})
    rows = rows.withColumn("source", F.when(F.col("messages_json").contains('"role":"system"'), "watched").otherwise("forum"))
    out = curate.curated(rows, ["replacement_character_present"], {"watched": "watched_source"}, {})
    return out.select(F.col("id").cast("long").alias("conv_id"), "decision", F.array_join("reasons", ",").alias("reasons"), "dialect", "scope")
