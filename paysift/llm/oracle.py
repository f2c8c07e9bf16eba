"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from paysift.llm.licenses import NOT_WORDS, PERCENT, TEMPLATES, UNIT_ENDS
from paysift.llm.quality_rules import LIMIT_DOCS, LIMIT_PERCENT, MAX_REPEATED, MIN_KEPT, MIN_WORDS
from paysift.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, MAX_EPOCHS, SEED
from paysift.llm.spelling_groups import MIN_COUNT, MIN_LETTERS, RATIO

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[\x20\x09-\x0D]"


def _case(column: str, known: dict[str, int], other: int) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {w}" for k, w in known.items()) + f" else {other} end"


def _mix_sql() -> str:
    levels = [("domain", _case("domain", DOMAIN_WEIGHTS, 1)), ("lang", _case("lang", LANG_WEIGHTS, 1)), ("source", "1")]
    steps, above = [], []
    for i, (name, weight) in enumerate(levels):
        path = [*above, name]
        parent = "p0" if i == 0 else f"p{i}"
        by = f"partition by {', '.join(above)}" if above else ""
        order = f"order by cap / w, {name}"
        join = f"join {parent} using ({', '.join(above)})" if above else f"cross join {parent}"
        steps.append(f"""
n{i} as (select {', '.join(path)}, cast({weight} as bigint) w, sum(tokens)::bigint * {MAX_EPOCHS} cap from leaves group by all),
b{i} as (select n.*, p.budget, coalesce(sum(cap) over ({by} {order} rows between unbounded preceding and 1 preceding), 0)::hugeint before_cap,
    sum(w) over ({by} {order} rows between current row and unbounded following)::hugeint w_rest
  from n{i} n {join.replace(parent, parent + ' p')} where cap > 0),
f{i} as (select *, cap::hugeint * w_rest <= (budget::hugeint - before_cap) * w filled from b{i}),
g{i} as (select *, budget - coalesce(sum(cap) filter (where filled) over ({by}), 0)::hugeint rest, sum(w) filter (where not filled) over ({by}) w_open from f{i}),
p{i + 1} as (select {', '.join(path)}, (case when filled then cap else rest * w // w_open end)::bigint budget from g{i}),""")
        above = path
    return f"""
with docs as (select doc_id, coalesce(cast(try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as bigint) % 4 as varchar), '(none)') domain,
    coalesce(lang, '(none)') lang, coalesce(source, '(none)') source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint n_tokens from documents),
counted as (select * from docs where n_tokens > 0),
leaves as (select domain, lang, source, sum(n_tokens)::bigint tokens from counted group by all),
p0 as (select least(sum(tokens) * {MAX_EPOCHS}, sum(tokens))::bigint budget from leaves),
{''.join(steps)}
spent as (select l.*, budget // tokens passes, budget % tokens rest from leaves l join p3 using (domain, lang, source) where budget > 0),
joined as (select c.*, s.passes, s.rest, md5(concat_ws(':', {SEED}, passes, doc_id)) h from counted c join spent s using (domain, lang, source)),
cut as (select *, sum(n_tokens) over (partition by domain, lang, source order by h, doc_id, n_tokens rows between unbounded preceding and current row)::bigint upto from joined where rest > 0)
select doc_id, domain, lang, source, unnest(range(passes)) epoch, n_tokens, n_tokens take_tokens from joined where passes > 0
union all
select doc_id, domain, lang, source, passes epoch, n_tokens, least(n_tokens, rest - upto + n_tokens) take_tokens from cut where rest - upto + n_tokens > 0
"""


_JACCARD = rf"""
with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') ws from documents),
places as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) i from words),
shingles as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') s from places),
sizes as (select doc_id, count(*) n from shingles group by 1),
pairs as (select a.doc_id x, b.doc_id y, count(*) i from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select x, y from pairs join sizes p on x = p.doc_id join sizes q on y = q.doc_id where 100 * i >= 80 * (p.n + q.n - i)),
reach as (select doc_id a, doc_id b from documents union select r.a, l.y from reach r join links l on r.b = l.x),
least_id as (select a, min(b) c from reach group by a)
select d.doc_id, coalesce(n, 0) n_shingles, c component_id from documents d join least_id on a = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

_EXACT = rf"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g') n from documents)
select doc_id, min(doc_id) over g keep_id, count(*) over g group_size, doc_id = min(doc_id) over g kept, sha256(n) text_sha256
from t window g as (partition by n)
"""

_CONTAMINATION = rf"""
with dw as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
iw as (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
ik as (select item_id, ws, least(10, len(ws)) k from iw where len(ws) > 0),
ip as (select *, unnest(range(1, len(ws) - k + 2)) i from ik),
windows as (select distinct item_id, k, array_to_string(ws[i:i + k - 1], ' ') w from ip),
dk as (select doc_id, ws, k from dw, (select distinct k from windows) where len(ws) >= k),
dp as (select *, unnest(range(1, len(ws) - k + 2)) i from dk),
found as (select doc_id, i, p.k, item_id from (select doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') w from dp) p join windows on windows.k = p.k and windows.w = p.w),
hit as (select doc_id, count(distinct pos) n_hit from (select doc_id, unnest(range(i, i + k)) pos from found) group by 1),
items as (select doc_id, count(*) n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) ids from (select distinct doc_id, item_id from found) group by 1)
select dw.doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from dw left join hit using (doc_id) left join items using (doc_id)
"""


def _license_sql() -> str:
    def lower(c: str) -> str:
        return f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def grams(source: str, keys: str) -> str:
        return f"""select {keys}, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) g
          from (select *, string_split(trim(regexp_replace({lower('notice')}, '{NOT_WORDS}', ' ', 'g')), ' ') w from {source})"""

    known = ", ".join(f"('{n}', '{t}')" for n, t in TEMPLATES)
    lines = f"string_split(regexp_replace(text, '{UNIT_ENDS}', '\\1' || chr(10), 'g'), chr(10))"
    return f"""
with templates(name, notice) as (values {known}),
tg as (select name, g, len(g) b from ({grams('templates', 'name')})),
lines as (select doc_id, {lines} l from documents),
units as (select doc_id, i - 1 unit, l[i] notice from (select doc_id, l, unnest(range(1, len(l) + 1)) i from lines)),
ug as (select *, len(g) a from ({grams('units', 'doc_id, unit, notice')}) where len(g) > 0),
met as (select doc_id, unit, notice, name, a, b, len(list_intersect(ug.g, tg.g)) i from ug, tg where 200 * least(a, b) >= {PERCENT} * (a + b)),
ranked as (select *, 2.0::double * i / (a + b) dice from met where 200 * i >= {PERCENT} * (a + b))
select doc_id, unit::int unit, name as template, a::int n_bigrams, dice, notice from ranked
qualify row_number() over (partition by doc_id, unit order by dice desc, name) = 1
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _crc32(codes: str) -> str:
    """The CRC-32 (polynomial 0xEDB88320) of a list of byte values."""
    step = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {step}), 4294967295::bigint)"


def _digit_codes(c: str) -> str:
    return f"list_transform(string_split({c}, ''), lambda z: ord(z)::bigint)"


_RUNS = rf"""
with hashed as (select doc_id, text, {_WORDS} ws, {_crc32(_digit_codes("cast(doc_id as varchar)"))} h from documents),
sized as (select *, len(ws) n, (h // 10) g from hashed),
cut as (select *, g % n a from sized where h % 10 = 0 and n > 0),
planted as (select *, 1 + (n - a) // (3 + g % 8) p from cut),
texts as (select doc_id, n, ws from sized where h % 10 <> 0 or n = 0 union all
  select doc_id, n, list_transform(range(n), lambda i: ws[case when i < a then i else a + (i - a) % p end + 1]) from planted),
places as (select doc_id, n, unnest(range(n)) i, unnest(ws) w from texts),
pairs as (select x.doc_id, x.i, y.i - x.i q from places x join places y on x.doc_id = y.doc_id and x.w = y.w and y.i > x.i and (y.i - x.i) * 4 <= x.n),
islands as (select *, i - row_number() over (partition by doc_id, q order by i) island from pairs),
stretches as (select doc_id, q, min(i) s, max(i) + q + 1 e from islands group by doc_id, q, island having max(i) + q + 1 - min(i) >= greatest(6, 4 * q)),
runs as (select doc_id, s, e - s l, min(q) p from stretches group by doc_id, s, e),
listed as (select doc_id, count(*) n_runs, string_agg(s || ',' || l || ',' || p || chr(10), '' order by s, p) t from runs group by doc_id),
ranked as (select *, row_number() over (partition by doc_id order by (1000000000::hugeint * l) // p desc, s, p) r from runs),
gone as (select distinct doc_id, unnest(range(s + p, s + l)) i from runs),
kept as (select doc_id, string_agg(w, ' ' order by i) t from places anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, coalesce(n_runs, 0) n_runs, s as start, l as length, p as period, 1000 * l // p exponent_milli, sha256(coalesce(listed.t, '')) runs_sha256, sha256(coalesce(kept.t, '')) collapsed_sha256
from documents d left join listed using (doc_id) left join kept using (doc_id) left join (select * from ranked where r = 1) b using (doc_id)
"""

_QUALITY = rf"""
with base as (select doc_id, coalesce(source, '') host, coalesce(text, '') t, {_WORDS} ws from documents),
wins as (select doc_id, len(ws) n, unnest(range(1, len(ws) - 1)) i, ws from base where len(ws) >= 3),
grams as (select doc_id, i, ws[i:i + 2] g from wins),
often as (select doc_id, i from grams qualify count(*) over (partition by doc_id, g) > 1),
spread as (select doc_id, count(distinct pos) n_repeat_words from (select doc_id, unnest(range(i, i + 3)) pos from often) group by doc_id),
split as (select doc_id, host, string_split(t, chr(10)) ls from base),
cut as (select doc_id, host, unnest(ls) l, unnest(range(len(ls))) k from split),
lines as (select doc_id, host, l, k, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) words,
    array_to_string(regexp_extract_all(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), ' ') norm from cut),
worded as (select * from lines where words > 0),
dup as (select doc_id, count(*) - count(distinct l) n_dup_lines from worded group by doc_id),
whole as (select doc_id, host, string_agg(norm, chr(10) order by k) whole from worded group by doc_id, host),
hosts as (select host, count(distinct whole) host_docs from whole group by host),
held as (select host, norm, count(distinct whole) n_docs from worded join whole using (doc_id, host) group by host, norm),
frequent as (select host, norm from held join hosts using (host) where n_docs > {LIMIT_DOCS} and n_docs * 100 > host_docs * {LIMIT_PERCENT}),
gone as (select doc_id, sum(words)::bigint gone from worded join frequent using (host, norm) group by doc_id),
all_ as (select doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
    coalesce(n_dup_lines, 0) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words, coalesce(gone, 0) n_removed_words
  from base left join dup using (doc_id) left join spread using (doc_id) left join gone using (doc_id)),
judged as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words base_failed from all_)
select *, not base_failed and (n_words - n_removed_words) * 100 >= n_words * {MIN_KEPT} kept from judged
"""

_SPELLING = rf"""
with recursive runs as (select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') w from documents),
long as (select * from runs where length(w) >= {MIN_LETTERS}),
bytes as (select doc_id, w, list_concat({_digit_codes("cast(doc_id as varchar)")}, list_prepend(58::bigint, flatten(list_transform(string_split(w, ''),
    lambda z: case when ord(z) < 128 then [ord(z)::bigint] else [195::bigint, ord(z)::bigint - 64] end)))) b from long),
hashed as (select w, {_crc32("b")} h from bytes),
spelt as (select case when h % 31 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end word from hashed),
words as (select word, count(*) n from spelt where length(word) >= {MIN_LETTERS} group by word having count(*) >= {MIN_COUNT}),
del as (select word, unnest(range(1, length(word) + 1)) i from words),
less as (select word, i, substr(word, 1, i - 1) || substr(word, i + 1) d from del),
pairs as (select a.word x, b.word y from less a join less b on a.i = b.i and a.d = b.d and a.word <> b.word
  union select l.d, l.word from less l join words on words.word = l.d
  union select l.word, l.d from less l join words on words.word = l.d),
ranked as (select x, y, m.n, count(*) over (partition by x) n_near, row_number() over (partition by x order by m.n desc, y) r from pairs join words m on m.word = y),
best as (select w.word, w.n, coalesce(n_near, 0) n_near, case when r.n >= {RATIO} * w.n then y end form, case when r.n >= {RATIO} * w.n then r.n end form_n
  from words w left join ranked r on r.x = w.word and r.r = 1),
follow as (select word, word as root from best union all select f.word, b.form from follow f join best b on b.word = f.root where b.form is not null),
ends as (select f.word, f.root from follow f join best b on b.word = f.root where b.form is null)
select word, form, root, n, n_near, form_n from best join ends using (word)
"""


ORACLE_SQL = {
    "op1_source_mix": _mix_sql(),
    "op4_licenses": _license_sql(),
    "op6_ngram_jaccard": _JACCARD,
    "op7_exact_dedup": _EXACT,
    "op10_decontaminate": _CONTAMINATION,
    "op11_periodic_runs": _RUNS,
    "op12_quality_rules": _QUALITY,
    "op13_spelling_groups": _SPELLING,
}
