"""The thirteen operators over their whole tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.llm import (
    block_labeller, chat, fill_middle, jaccard, license_scan, line_rules, mixing, source_audit, spaced_seeds, toxicity, url_filter, vector_tree, warc,
)
from wxrisk.llm.common import table

# The rules of op6, and the families of junk hosts whose URLs make up its list.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
JUNK_HOSTS = r"(^|\.)(spam-farm|cheap-pills|adult-x|ads-track|casino-win|free-bets)\."


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fitted(docs, table(spark, sf_dir, "labels")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return block_labeller.extracted(pages, block_labeller.fitted(pages))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicate_components(table(spark, sf_dir, "documents"))


def junk_urls(pages: DataFrame) -> DataFrame:
    """The list of op6: (canonical), each known URL of a junk host once."""
    host = url_filter.host_of(F.col("url"))
    return pages.where(host.rlike(JUNK_HOSTS)).select(url_filter.canonical(host, url_filter.path_of(F.col("url"))).alias("canonical")).distinct()


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judged_urls(pages, junk_urls(pages), URL_RULES)


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rule_verdicts(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.neighbours(table(spark, sf_dir, "embeddings"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergences(table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transformed(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_license_scan, op3_html_text, op4_warc, op5_jaccard_join, op6_url_filter, op7_line_rules,
    op8_decontamination, op9_perspectives, op10_mixing, op11_vector_tree, op12_source_audit, op13_fill_middle)}

ORACLES: dict[str, str] = {}

ORACLES["op4_warc"] = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), q as (
  select *, min(page_id) over (partition by h) as first_id,
    row_number() over (partition by h order by page_id) as place,
    list_aggregate(list_transform(range(4), lambda k: list_aggregate(list_transform(range(8),
      lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        (((('0x' || substr(h, 1 + 10 * k::int, 10))::bigint >> (35 - 5 * j::int)) & 31) + 1)::int, 1)), 'string_agg', '')), 'string_agg', '') as b32
  from p
)
select page_id, strlen(html)::bigint as payload_bytes, b32 as payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type,
  case when place > 1 then first_id end as refers_to
from q"""

ORACLES["op5_jaccard_join"] = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda w: w <> '') as w
  from documents
), s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as g
  from d
), sets as (
  select min(doc_id) as rep, len(g) as n, list_sort(g) as g from s where len(g) > 0 group by list_sort(g), len(g)
), u as (
  select rep, n, unnest(g) as gram from sets
), links as (
  select a.rep as x, b.rep as y from u a join u b on a.gram = b.gram and a.rep < b.rep
  group by a.rep, b.rep, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), twoway as (
  select x, y from links union all select y, x from links
), reach(a, b) as (
  select rep, rep from sets union select r.a, l.y from reach r join twoway l on r.b = l.x
), named as (
  select a as rep, min(b) as component_id from reach group by a
), of_doc as (
  select s.doc_id, len(s.g) as n, t.rep from s left join sets t on t.g = list_sort(s.g)
)
select o.doc_id, o.n::bigint as n_shingles, coalesce(c.component_id, o.doc_id) as component_id
from of_doc o left join named c on c.rep = o.rep"""

_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

ORACLES["op6_url_filter"] = rf"""
with p as (
  select page_id, {_HOST} as host, {_PATH} as path from pages
), c as (
  select *, case when host <> '' then regexp_replace(host, '^(www|m)\.', '')
    || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') end as canonical from p
), rules(says, host, prefix) as (
  values {", ".join(str(r) for r in URL_RULES)}
), listed as (
  select distinct canonical from c where regexp_matches(host, '{JUNK_HOSTS}')
), ruled as (
  select c.*, r.says, r.host || r.prefix as rule, row_number() over (partition by c.page_id, c.host, c.path order by length(r.host || r.prefix) desc) as place
  from c left join rules r on (c.host = r.host or c.host like '%.' || r.host) and starts_with(c.path, r.prefix)
)
select page_id, host, path, rule,
  coalesce(says, case when canonical in (select canonical from listed) then 'block' else 'allow' end) as verdict,
  canonical, coalesce(canonical in (select canonical from listed), false) as is_listed
from ruled where place = 1"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _count_sql(text: str, letters: str) -> str:
    return f"(length({text}) - length(translate({text}, {_quoted(letters)}, '')))"


_SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LINE_WORDS = r"len(list_filter(regexp_split_to_array(x, '[ \t-\r]+'), lambda w: w <> ''))"
_LINE_END = f"right(rtrim(translate(x, {_SPACES_SQL}, '      ')), 1)"


def _no_flag(pattern: str) -> str:
    return _quoted(pattern.removeprefix("(?i)"))


ORACLES["op7_line_rules"] = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), w as (
  select r, doc_id, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda w: w <> '') as w, string_split(t, chr(10)) as lines from d
), pos as (
  select r, unnest(w) as word, generate_subscripts(w, 1) as k from w
), tri as (
  select r, k, word, lead(word) over v as b, lead(word, 2) over v as c from pos window v as (partition by r order by k)
), again as (
  select r, k, count(*) over (partition by r, word, b, c) as n from tri where c is not null
), hit as (
  select r, unnest([k, k + 1, k + 2]) as k from again where n > 1
), rep as (
  select r, count(distinct k) as n_repeat_words from hit group by r
), line as (
  select r, unnest(lines) as x from w
), flagged as (
  select r, length(translate(x, {_SPACES_SQL}, '')) as chars,
    case when length(translate(x, {_SPACES_SQL}, '')) = 0 then false
      when {_count_sql('x', line_rules.SYMBOLS)} > {_LINE_WORDS} * {line_rules.SYMBOLS_PER_WORD}::double then true
      when {_count_sql('x', '!')} > {_LINE_WORDS} * {line_rules.SHOUTS_PER_WORD}::double then true
      when regexp_matches(x, {_no_flag(line_rules.BOILERPLATE)}, 'i') then true
      when regexp_matches(x, {_no_flag(line_rules.NAVIGATION)}, 'i') then true
      else {_LINE_WORDS} >= 4 and not contains({_quoted(line_rules.LINE_ENDS)}, {_LINE_END}) end as fails
  from line
), lost as (
  select r, coalesce(sum(chars) filter (fails), 0) as lost_chars from flagged group by r
), n as (
  select w.r, doc_id, len(w)::bigint as n_words, length(translate(t, {_SPACES_SQL}, ''))::bigint as word_chars,
    {_count_sql('t', line_rules.SYMBOLS)}::bigint as n_symbols,
    (len(list_filter(lines, lambda x: length(translate(x, {_SPACES_SQL}, '')) > 0))
      - len(list_distinct(list_filter(lines, lambda x: length(translate(x, {_SPACES_SQL}, '')) > 0))))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, lost_chars::bigint as lost_chars
  from w join lost using (r) left join rep using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * lost_chars <= {line_rules.MOST_LOST_PERCENT} * word_chars as kept,
  lost_chars
from n"""


def _seed_sql() -> str:
    parts = []
    for number, mask in enumerate(spaced_seeds.MASKS):
        words = " || ' ' || ".join(f"lead(word, {k}) over v" if k else "word" for k, flag in enumerate(mask) if flag == "1")
        parts.append(f"select key, k, {number} as mask, {words} as seed from TOKENS window v as (partition by key order by k) "
                     f"qualify lead(word, {len(mask) - 1}) over v is not null")
    return " union all ".join(parts)


_WORDS_SQL = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
              r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

ORACLES["op8_decontamination"] = f"""
with dw as (
  select doc_id as key, {_WORDS_SQL} as w from documents
), iw as (
  select item_id as key, {_WORDS_SQL} as w from benchmark
), dt as (
  select key, unnest(w) as word, generate_subscripts(w, 1) - 1 as k from dw
), it as (
  select key, unnest(w) as word, generate_subscripts(w, 1) - 1 as k from iw
), ds as ({_seed_sql().replace('TOKENS', 'dt')}
), ss as ({_seed_sql().replace('TOKENS', 'it')}
), hit as (
  select distinct ds.key as doc_id, ss.key as item_id, ds.k - ss.k as starts_at, ss.k as item_at
  from ds join ss on ds.mask = ss.mask and ds.seed = ss.seed
), aligned as (
  select h.*, len(iw.w) as n,
    greatest(0, least(item_at - {(spaced_seeds.RUN - spaced_seeds.SPAN) // 2}, len(iw.w) - {spaced_seeds.RUN})) as b
  from hit h join iw on iw.key = h.item_id
), agreed as (
  select a.doc_id, a.item_id, a.starts_at, a.item_at, a.n, least(a.n, a.b + {spaced_seeds.RUN}) - a.b as run, count(*) as matched,
    count(*) filter (it.k >= a.b and it.k < a.b + {spaced_seeds.RUN}) as run_matched
  from aligned a join it on it.key = a.item_id join dt on dt.key = a.doc_id and dt.k = it.k + a.starts_at and dt.word = it.word
  group by all
), ranked as (
  select *, row_number() over (partition by doc_id, item_id order by matched desc, run_matched desc, n desc, starts_at desc) as place
  from agreed where 100 * matched >= {spaced_seeds.LEAST_PERCENT} * n or 100 * run_matched >= {spaced_seeds.LEAST_PERCENT} * run
)
select doc_id, item_id, n::bigint as item_words, matched::bigint as matched, run_matched::bigint as run_matched, starts_at::bigint as starts_at
from ranked where place = 1"""

ORACLES["op9_perspectives"] = r"""
with said as (
  select conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') as speaker, replace(coalesce(text, ''), '<|', '< |') as said from conversations
), sides as (
  select distinct conv_id, speaker as perspective from said where speaker <> 'system'
), paired as (
  select s.*, p.perspective,
    case when speaker = 'system' then 'system' when speaker = perspective then 'assistant' else 'user' end as chat_role
  from said s join sides p on s.conv_id is not distinct from p.conv_id
), headed as (
  select *, '<|im_start|>' || chat_role || case when chat_role = 'user' then ' name=' || regexp_replace(speaker, '[\s<|>]+', '_', 'g') else '' end || chr(10) as head from paired
)
select conv_id, perspective, turn, speaker, chat_role, head || said || '<|im_end|>' || chr(10) as segment, length(head)::bigint as loss_start,
  (length(head) + case when chat_role = 'assistant' then length(said) + 11 else 0 end)::bigint as loss_end, chat_role = 'assistant' as trained
from headed"""

ORACLES["op10_mixing"] = r"""
with d as (
  select doc_id, source, text, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> ''))::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) - 1 as place from d group by source
), w as (
  select *, [5, 2, 1][(place % 3 + 1)::int]::bigint as weight from s
), o as (
  select *, sum(source_size) over () * 150 - coalesce(sum(source_size) over (order by source_size / weight, source is null, source rows between unbounded preceding and 1 preceding), 0) * 200 as rest,
    sum(weight) over (order by source_size / weight, source is null, source rows between current row and unbounded following) * 100 as shares,
    row_number() over (order by source_size / weight, source is null, source) as rank
  from w
), f as (
  select min(rank) as rank from o where rest * weight <= source_size * 200 * (shares / 100)
), t as (
  select o.source, o.source_size, case when f.rank is null or o.rank < f.rank then (2 * o.source_size)::double
    else (l.rest * o.weight)::double / l.shares::double end as target
  from o cross join f left join o l on l.rank = f.rank
), r as (
  select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target, size * (floor(rate)::bigint
  + case when ('0x' || substr(md5(concat_ws('|', '20', doc_id, text)), 1, 13))::bigint / 4503599627370496.0::double < rate - floor(rate) then 1 else 0 end) as taken
from r"""


def _share_sql(count: str, total: str, terms: str) -> str:
    return f"(1 + ((1000000000::hugeint * ({count} + {source_audit.ADDED})) // ({total} + {source_audit.ADDED} * {terms})))"


ORACLES["op12_source_audit"] = rf"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents
), words as (
  select r, lang, source, unnest(w) as term from d
), kept as (
  select lang, term from words group by lang, term having count(distinct r) >= {source_audit.LEAST_DOCS}
), counts as (
  select lang, source, term, count(*)::hugeint as n from words semi join kept using (lang, term) group by all
), langs as (
  select lang, (select count(*) from kept k where k.lang = d.lang)::hugeint as terms from d group by lang
), groups as (
  select lang, source, terms, coalesce((select sum(n) from counts c where c.lang = d.lang and c.source = d.source), 0)::hugeint as total
  from (select distinct lang, source from d) d join langs using (lang)
), lang_counts as (
  select lang, term, sum(n)::hugeint as n from counts group by all
), grid as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, {_share_sql("coalesce(c.n, 0)", "g.total", "g.terms")} as p
  from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), pairs as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from grid a join grid b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), all_pairs as (
  select a.lang, a.source, b.source as item, coalesce(p.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
), terms as (
  select g.lang, g.source, g.term as item, (g.p - q.p)::bigint as value
  from grid g join (
    select l.lang, l.term, {_share_sql("l.n", "sum(l.n) over (partition by l.lang)", "count(*) over (partition by l.lang)")} as p from lang_counts l
  ) q on q.lang = g.lang and q.term = g.term where g.n > 0 and g.p > q.p
)
select lang, source, 'pair' as part, item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from all_pairs
union all
select lang, source, 'term', item, value, (row_number() over (partition by lang, source order by value desc, item))::int as rank from terms
qualify rank <= {source_audit.TERM_RANKS}"""

ORACLES["op13_fill_middle"] = rf"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), h as (
  select *, len(u) as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from d
), c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from h
), p as (
  select *, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:n], '') as suffix from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(prefix)::bigint end as prefix_chars, case when form <> 'plain' then length(middle)::bigint end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(text) as restored_sha256
from p"""
