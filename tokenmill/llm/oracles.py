"""DuckDB SQL of the queries that SQL can express."""

from tokenmill.llm.license_scan import PHRASES, TEMPLATES

WORDS = r"""regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def words(text: str) -> str:
    return WORDS.format(text=text)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LICENSE = f"""
with phrases(phrase, label) as (values {", ".join(f"({quoted(p)}, {quoted(v)})" for p, v in PHRASES.items())}),
templates as (
  select label, list_distinct({words("notice")}) as tokens, 2 * len({words("notice")}) as size
  from (values {", ".join(f"({quoted(v)}, {quoted(t)})" for v, t in TEMPLATES)}) as t(label, notice)
),
docs as (
  select doc_id, row_number() over () as row, {words("text")} as words from documents
),
places as (
  select row, label, i - 1 as word
  from docs, phrases, range(1, len(words) + 1) as r(i)
  where words[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')
),
near as (
  select row, label, words, tokens, size from docs, templates
  where 5 * len(list_intersect(tokens, list_distinct(words))) >= 4 * len(tokens)
),
hits as (
  select row, label, len(list_intersect(tokens, words[i:i + size - 1])) / len(tokens)::double as share
  from near, range(1, len(words) + 1) as r(i)
  where list_contains(tokens, words[i]) and 5 * len(list_intersect(tokens, words[i:i + size - 1])) >= 4 * len(tokens)
),
base as (
  select row, count(*) as n_base, min(word) as first_word, max(word) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels
  from places group by row
),
every as (select row, label, share from hits union all select row, label, 1.0 from places),
named as (
  select row, string_agg(distinct label, ',' order by label) as labels, max(share) as score from every group by row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from docs left join base using (row) left join named using (row)
"""

URL_RULES = r"""
with rules(host, path, verdict) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
parsed as (
  select page_id, row_number() over () as row,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages
),
fitting as (
  select row, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from parsed p join rules r
    on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  group by row
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parsed left join fitting using (row)
"""

DECONTAMINATE = f"""
with docs as (select doc_id, row_number() over () as row, {words("text")} as words from documents),
items as (select item_id, {words("text")} as words from benchmark),
windows as (
  select item_id, words[i:i + 9] as words, least(len(words), 10) as n
  from items, range(1, greatest(len(words) - 9, 1) + 1) as r(i) where len(words) > 0
),
places as (
  select row, i as start, n, words[i:i + n - 1] as words
  from docs, (select distinct n from windows) as lengths, range(1, len(words) - n + 2) as r(i)
),
hits as (select row, start, p.n, item_id from places p join windows w on p.words = w.words),
covered as (
  select row, count(distinct place) as n_hit from (select row, unnest(range(start, start + n)) as place from hits) group by row
),
listed as (
  select row, count(distinct item_id) as n_items,
    string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
  from hits group by row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (row) left join listed using (row)
"""

POISSON_MIX = """
with sizes as (
  select source, sum(coalesce(strlen(text), 0))::double as size from documents group by source
),
weighted as (select source, size, case when size > 0 then pow(size, 0.5) end as weight from sizes),
rates as (
  select source, weight / (select sum(weight) from weighted) * (select sum(size) from weighted) / size as rate
  from weighted where weight > 0
),
steps as (
  select source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) over (partition by source order by k) as p
  from (select source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::bigint + 1)) as k from rates)
),
docs as (
  select *, row_number() over () as row, concat_ws(':', coalesce(doc_id::varchar, ''), md5(coalesce(text, ''))) as named
  from documents
),
drawn as (
  select d.row, count(*) as times
  from docs d join steps s on d.source is not distinct from s.source
  where s.p <= ('0x' || substr(md5('mix:' || named), 1, 13))::bigint / pow(2, 52)
  group by d.row
)
select doc_id, source, text, copy, md5(concat_ws(':', 'mix', 'order', named, copy::varchar)) as mix_key
from (select docs.*, unnest(range(1, times + 1)) as copy from docs join drawn using (row))
"""

PREFERENCE = r"""
with replies as (
  select conv_id, max({'turn': turn, 'text': text}) as reply from conversations where role = 'assistant' group by conv_id
),
facts as (
  select a.conv_id, a.reply.turn as last_turn, b.reply.text as other
  from replies a left join replies b on b.conv_id = a.conv_id + 1
),
marked as (
  select c.*, other, coalesce(role = 'assistant' and turn = last_turn, false) as is_last
  from conversations c left join facts using (conv_id) where conv_id is not null
),
sided as (
  select conv_id as pair_id, 'chosen' as side, turn, role, text from marked
  union all
  select conv_id, 'rejected', turn, role, case when is_last then other else text end from marked
  where not (is_last and other is null)
),
messages as (
  select pair_id, turn, coalesce(role, 'user') as role, coalesce(text, '') as text,
    bool_or(side = 'chosen') as in_chosen, bool_or(side = 'rejected') as in_rejected
  from sided where turn is not null group by all
),
bounds as (
  select pair_id, min(turn) filter (in_chosen <> in_rejected) as cut,
    max(turn) filter (role = 'assistant' and in_chosen) as last_chosen,
    max(turn) filter (role = 'assistant' and in_rejected) as last_rejected
  from messages group by pair_id
),
parts as (
  select *, unnest(case when cut is null or turn < cut then ['prompt']
    else list_filter([case when in_chosen then 'chosen' end, case when in_rejected then 'rejected' end],
      lambda x: x is not null) end) as part
  from messages join bounds using (pair_id)
),
made as (
  select *, '<|im_start|>' || role || chr(10) as head, part <> 'prompt' and role = 'assistant' as counted from parts
)
select pair_id, part, turn, role, head || text || '<|im_end|>' || chr(10) as rendered,
  case when counted then length(head) end::bigint as loss_start,
  case when counted then length(head || text) + 10 end::bigint as loss_end,
  coalesce(last_chosen >= cut and last_rejected >= cut, false) as usable
from made
"""

DIVERGENCE = r"""
with docs as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
),
words as (select row, lang, source, unnest(terms) as term from docs),
kept as materialized (
  select lang, term, count(*) as all_n from words group by lang, term having count(distinct row) >= 3
),
counted as materialized (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by all),
lang_size as (select lang, count(*) as terms, sum(all_n) as lang_total from kept group by lang),
groups as (
  select lang, source, coalesce(any_value(total), 0) as total
  from (select distinct lang, source from docs) left join (
    select lang, source, sum(n) as total from counted group by lang, source) using (lang, source)
  group by lang, source
),
priced as materialized (
  select lang, source, term, n, all_n, 1 + (1000000000::hugeint * (coalesce(n, 0) + 1)) // (total + terms) as p,
    1 + (1000000000::hugeint * (all_n + 1)) // (lang_total + terms) as q
  from groups join lang_size using (lang) join kept using (lang) left join counted using (lang, source, term)
),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join priced x on x.lang = a.lang and x.source = a.source
  left join priced y on y.lang = b.lang and y.source = b.source and y.term = x.term
  where x.term is null or y.term is not null
  group by a.lang, a.source, b.source
),
every as (
  select lang, source, 'pair' as part, item, value from pairs
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from priced where n > 0 and p > q
)
select * from (
  select lang, source, part, item, value,
    (row_number() over (partition by lang, source, part order by value desc, item))::integer as rank from every
) where part = 'pair' or rank <= 200
"""


def rounds(n: int) -> str:
    """Assignment to the nearest entry and the moved codebook, ``n`` times; the last assignment is ``near{n}``."""
    made = []
    for i in range(n + 1):
        made.append(f"""near{i} as materialized (
  select r, p, struct_extract(best, 'd') as d, struct_extract(best, 'e') as e from (
    select r, p, min(struct_pack(d := list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := e)) as best
    from parts join book{i} using (p) group by r, p))""")
        if i < n:
            made.append(f"""sums{i} as (
  select p, e, i, sum(x[i]::hugeint) as s, count(*) as k
  from near{i} join parts using (r, p), range(1, len(x) + 1) as t(i) group by p, e, i
),
means{i} as (select p, e, list(((s - (s % k + k) % k) // k)::double order by i) as c from sums{i} group by p, e),
book{i + 1} as materialized (select p, e, coalesce(m.c, b.c) as c from book{i} b left join means{i} m using (p, e))""")
    return ",\n".join(made)


VECTOR_CODES = f"""
with kept as materialized (
  select vec_id, label, row_number() over (order by vec_id) - 1 as r,
    list_transform(embedding, lambda x: floor(1024 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)
),
parts as materialized (
  select r, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] as x from kept, range(4) as t(p)
),
book0 as materialized (select p, r as e, x as c from parts where r < 256),
{rounds(4)},
coded as (
  select r, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error from near4 group by r
),
entries as (
  select sha256(string_agg(c[i]::bigint::varchar, ',' order by p, e, i)) as codebooks_sha256
  from book4, range(1, len(c) + 1) as t(i)
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from kept join coded using (r), entries
"""

ORACLES = {
    "op5_decontaminate": DECONTAMINATE,
    "op3_url_rules": URL_RULES,
    "op8_poisson_mix": POISSON_MIX,
    "op9_preference_format": PREFERENCE,
    "op1_license_scan": LICENSE,
    "op12_source_divergence": DIVERGENCE,
    "op13_vector_codes": VECTOR_CODES,
}
