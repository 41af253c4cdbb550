"""DuckDB SQL of the operators whose rows SQL can express."""

from __future__ import annotations

from . import license_scan

#: Words of a text between ASCII white space, A-Z lower-cased.
UPPER, LOWER = license_scan.UPPER, license_scan.LOWER
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

NEAR = rf"""with recursive w as (select doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 2 then [w[1]] else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s from w),
n as (select doc_id, len(s) as n, list_sort(s) as s from s),
reps as (select min(doc_id) as rep, any_value(n) as n, s from n where n > 0 group by s),
g as (select rep, n, unnest(s) as g from reps),
p as (select x.rep as a, y.rep as b, count(*) as c, any_value(x.n) as nx, any_value(y.n) as ny from g x join g y on x.g = y.g and x.rep < y.rep and 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n) group by x.rep, y.rep having 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))),
e as (select a, b from p union select b, a from p),
r(a, b) as (select rep, rep from reps union select r.a, e.b from r join e on r.b = e.a),
c as (select a as rep, min(b) as component from r group by a)
select n.doc_id, n.n as n_shingles, coalesce(c.component, n.doc_id) as component_id, n.doc_id = coalesce(c.component, n.doc_id) as kept from n left join reps on reps.s = n.s left join c using (rep)"""


def license_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    templates = ", ".join(f"('{label}', '{t}')" for label, many in license_scan.TEMPLATES.items() for t in many)
    places = " union all ".join(
        f"select doc_id, unnest(list_filter(range(0, len(w) - {len(p.split()) - 1}), lambda i: {' and '.join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split()))})) as pos, '{label}' as label from d"
        for p, label in license_scan.PHRASES.items()
    )
    return f"""with d as (select doc_id, regexp_extract_all({FOLDED}, '{word}') as w, string_split({FOLDED}, chr(10)) as lines from documents),
t as (select label, list_distinct(string_split(t, ' ')) as t from (values {templates}) x(label, t)),
p as ({places}),
base as (select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word, list(distinct label) as labels from p group by doc_id),
b as (select doc_id, list_distinct(regexp_extract_all(line, '{word}')) as b from (select doc_id, unnest(lines) as line from d)),
m as (select doc_id, label, len(list_intersect(b, t)) as c, len(t) as n from b, t where len(b) * 1.0 >= {license_scan.THRESHOLD} * len(t)),
f as (select doc_id, list(distinct label) as labels, max(c / n) as share from m where c >= ceil({license_scan.THRESHOLD} * n - 1e-9) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(f.labels, [])))), ',') as labels, case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from d left join base using (doc_id) left join f using (doc_id)"""


ORACLES = {"op2_minhash_neardup": NEAR, "op3_license_scan": license_sql()}
