"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: Plain patterns, as the task states them (no look-around in this engine).
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?",
    "ssn": r"[0-9]+-[0-9]+-[0-9]+",
    "secret": r"(?:[Tt]oken|[Ss]ecret|[Aa]pi_key|[Pp]assword)[ ]{0,4}[:=][ ]{0,4}[\x22']?[A-Za-z0-9_/+.-]{16,}",
}
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""(list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k:
    case when (length({_DIGITS}) - k) % 2 = 0 then cast({_DIGITS}[k] as int)
         when cast({_DIGITS}[k] as int) * 2 > 9 then cast({_DIGITS}[k] as int) * 2 - 9
         else cast({_DIGITS}[k] as int) * 2 end)) % 10 = 0)"""
_IBAN = "replace(v, ' ', '')"
_MOD97 = f"""(list_reduce(list_prepend(0, list_transform(string_split({_IBAN}[5:] || {_IBAN}[:4], ''),
    lambda ch: case when ch between '0' and '9' then ascii(ch) - 48 else ascii(ch) - 55 end)),
    lambda a, b: (a * case when b > 9 then 100 else 10 end + b) % 97) = 1)"""
_CHECK = {
    "email": "true",
    "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda q: length(ltrim(q, '0')) <= 3 and cast('0' || right(q, 3) as int) <= 255 ))",
    "card": f"length({_DIGITS}) between 16 and 19 and {_LUHN}",
    "phone": f"length({_DIGITS}) between 8 and 15",
    "iban": "v is not null",
    "ssn": "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}') and regexp_matches(lower(before), 'ssn|social|security')",
    "secret": "true",
}


#: The longest part of a match, whole or up to a blank, that passes.
_ACCOUNT = f"""list_filter(list_transform(range(len(string_split(v0, ' ')), 0, -1), lambda k: array_to_string(string_split(v0, ' ')[1:k], ' ')),
      lambda v: length({_IBAN}) between 15 and 34 and regexp_full_match(v, '{_PLAIN["iban"]}') and {_MOD97})[1]"""


def _pii() -> str:
    parts = []
    for k, (kind, pattern) in enumerate(_PLAIN.items()):
        p = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""
  select rn, {k} as o, '{kind}' as kind, s, e from (
    select rn, m[i] as v0, {_ACCOUNT if kind == "iban" else "v0"} as v,
           cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as bigint) as s,
           s + length(m[i]) as e, text[greatest(1, s - 39):s] as before
    from (select rn, text, regexp_extract_all(text, {p}) as m, string_split_regex(text, {p}) as g from d), unnest(range(1, len(m) + 1)) as u(i))
  where {_CHECK[kind]}""")
    spans = "\n  union all".join(parts)
    return f"""
with d as (select row_number() over () as rn, doc_id, coalesce(text, '') as text from documents),
p as ({spans}
), g as (
  select rn, {', '.join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in list(_PLAIN)[:4])},
         string_agg(concat_ws(':', kind, s, e), ',' order by o, s) filter (where o < 4) as base,
         string_agg(concat_ws(':', kind, s, e), ',' order by o, s) as spans
  from p group by rn)
select doc_id, {', '.join(f"coalesce(n_{k}, 0) as n_{k}" for k in list(_PLAIN)[:4])},
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (rn)"""


_NEAR = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 4 then [ws]
    else list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) end) as sh from w),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as inter from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
l as (select x, y from c join n p on x = p.doc_id join n q on y = q.doc_id where 100 * inter >= 80 * (p.n + q.n - inter)),
r as (select doc_id as x, doc_id as y from documents union select r.x, l.y from r join l on r.y = l.x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id, d.doc_id = m.c as kept
from documents d left join n using (doc_id) join (select x, min(y) as c from r group by x) m on m.x = d.doc_id"""

_REPEATS = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
w as (select doc_id, i, substr(h, 2 * i + 1, 100) as s from d, unnest(range(0, length(h) // 2 - 49)) as u(i)),
f as (select w.doc_id, w.i from w join (select s, min(doc_id) as m from w group by s) using (s) where m < w.doc_id),
g as (select *, sum(new) over (partition by doc_id order by i) as g
      from (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as new from f)),
p as (select doc_id, g, min(i) as a, max(i) + 50 as b from g group by doc_id, g),
q as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from p group by doc_id),
k as (select doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by a) as h from (
        select p.doc_id, d.h, coalesce(lag(p.b) over (partition by p.doc_id order by p.a), 0) as a, p.a as b from p join d using (doc_id)
        union all select doc_id, any_value(d.h), max(b), length(any_value(d.h)) // 2 from p join d using (doc_id) group by doc_id)
      group by doc_id)
select doc_id, length(d.h) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(k.h, d.h))) as kept_sha256
from d left join q using (doc_id) left join k using (doc_id)"""


_DIVERGENCE = r"""
with d as (
  select row_number() over () as rn, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws
  from documents),
t as (select rn, lang, source, unnest(ws) as term from d),
k as (select lang, term, count(*) as whole from t group by all having count(distinct rn) >= 3),
v as (select lang, count(*) as size, sum(whole) as lang_total from k group by lang),
c as (select t.lang, t.source, t.term, count(*) as n from t join k using (lang, term) group by all),
g as (select x.lang, x.source, coalesce(sum(c.n), 0) as total from (select distinct lang, source from d) x left join c using (lang, source) group by all),
s as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
             1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.total + v.size)::hugeint as p,
             1 + (1000000000::hugeint * (k.whole + 1)) // (v.lang_total + v.size)::hugeint as q
      from g join k using (lang) join v using (lang) left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
r as (
  select lang, source, 'pair' as part, item, value from (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from s a join s b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
    union all
    select a.lang, a.source, b.source, 0 from g a join g b on a.lang = b.lang and a.source <> b.source where a.lang not in (select lang from v))
  union all
  select lang, source, 'term', term, (p - q) * (p - q) // q from s where n > 0 and p > q)
select lang, source, part, item, cast(value as bigint) as value, cast(n as int) as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as n from r)
where part = 'pair' or n <= 200"""


SQL: dict[str, str] = {"op1_pii": _pii(), "op9_suffix_dedup": _REPEATS, "op10_minhash": _NEAR, "op12_divergence": _DIVERGENCE}
