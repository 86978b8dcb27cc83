"""The same queries in SQL for an independent engine, over the same tables.

The SQL takes other routes than the library where it can: windows over page pieces in place of the
fold, token rows in place of in-row counting, self-joins in place of slices.
"""

from __future__ import annotations

from ..functions import fixed_values as fixed
from ..functions import porter
from ..functions.fixed_values import ANALYZER_STOP_WORDS, KEYWORD_STOP_WORDS
from . import queries as q

ORACLE: dict[str, str] = {}


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


def _decode(expr: str) -> str:
    """Character references to text."""
    names = " ".join(
        f"when regexp_replace(x, '[&;]', '', 'g') = '{n}' then '{c}'"
        for n, c in (("lt", "<"), ("gt", ">"), ("amp", "&"), ("quot", '"'), ("apos", "''"))
    )
    return (
        f"array_to_string(list_transform(regexp_extract_all({expr}, "
        "'&[a-zA-Z][-.a-zA-Z0-9]*;?|&#[0-9]+;?|[^&]+|&'), lambda x: case "
        "when x like '&#%' then case when try_cast(regexp_extract(x, '([0-9]+)', 1) as int) "
        "between 1 and 127 then chr(try_cast(regexp_extract(x, '([0-9]+)', 1) as int)) else '' end "
        f"when x like '&_%' then case {names} else '' end else x end), '')"
    )


_TITLE = _decode("regexp_extract(html, '(?is)<title[^<>]*>(.*?)</title>', 1)")

ARTICLES = f"""
pieces as (
  select page_id, unnest(l) p, generate_subscripts(l, 1) i from (
    select page_id, regexp_extract_all(
      regexp_replace(html, '(?s)<!--.*?--\\s*>', '', 'g'), '<[^<>]*>|[^<]+|<') l
    from pages)),
marked as (
  select *, case when regexp_matches(p, '^(?i:<article)([^-_.a-zA-Z0-9<>][^<>]*)?>$') then 1
                 when regexp_matches(p, '^(?i:</article)([^-_.a-zA-Z0-9<>][^<>]*)?>$') then -1
                 else 0 end step
  from pieces),
walked as (
  select *, sum(step) over (partition by page_id order by i) s from marked),
levels as (
  select *, s - least(0, min(s) over (partition by page_id order by i)) level from walked),
grabbed as (
  select *, last_value(case
      when regexp_matches(p, '^(?i:<p)([^-_.a-zA-Z0-9<>][^<>]*)?>$') and level > 0 then 1
      when regexp_matches(p, '^(?i:</p)([^-_.a-zA-Z0-9<>][^<>]*)?>$') then 0 end ignore nulls)
    over (partition by page_id order by i) g
  from levels),
bodies as (
  select page_id, string_agg({_decode('p')}, '' order by i) body from grabbed
  where g = 1 and not regexp_matches(p, '^(</?[a-zA-Z][^<>]*|<[!?][^<>]*)>$') group by page_id),
articles as (
  select page_id, url, {_TITLE} title, coalesce(body, '') as content
  from pages left join bodies using (page_id))"""

CELLS = f"""{ARTICLES},
cells as (
  select url as "row", 'f' as "columnFamily", 'title' as qualifier,
         (page_id + 1)::bigint as "timestamp", 'Put' as type, title as value from articles
  union all
  select url, 'f', 'content', (page_id + 1)::bigint, 'Put', content from articles)"""

TOKEN = r"'[\p{L}\p{N}]+|(?s:.)'"


def _tokens(table: str, ids: str, text: str = "text") -> str:
    return (
        f"select {ids}, (generate_subscripts(l, 1) - 1)::int as pos, unnest(l) as term from "
        f"(select {ids}, regexp_extract_all({text}, {TOKEN}) l from {table})"
    )


DOC_TOKENS = f"tokens as materialized ({_tokens('documents', 'doc_id')})"
IS_KEYWORD = f"length(trim(term)) >= 2 and lower(term) not in ({_quoted(KEYWORD_STOP_WORDS)})"


def _terms(name: str, tokens: str, ids: str) -> str:
    return f"""
{name} as materialized (
  select {ids}, term, count(*) as freq,
         (sum(count(*)) over (partition by {ids}))::bigint as total
  from {tokens} where {IS_KEYWORD} group by {ids}, term)"""


DOC_TERMS = f"{DOC_TOKENS}, {_terms('terms', 'tokens', 'doc_id')}"
DOC_IDF = f"""{DOC_TERMS},
learned as materialized (
  select term, count(*) as df, ln((select count(*) from documents) / count(*)::double) as idf
  from terms group by term)"""


def _median(idf: str) -> str:
    return (
        f"(select idf from (select idf, row_number() over (order by idf) - 1 as r from {idf}) "
        f"where r = (select count(*) // 2 from {idf}))"
    )


LEXICON = """
lexicon as (
  select distinct term, case when length(term) <= 3 then 'x'
      when right(term, 1) in ('s', 'n') then 'n' when right(term, 1) = 'e' then 'v'
      else 'a' end as flag
  from terms)"""

FIELD_KEYWORDS = f"""{CELLS},
texts as (select "row" as url, qualifier, value as text from cells),
field_tokens as ({_tokens('texts', 'url, qualifier')}),
{_terms('field_terms', 'field_tokens', 'url, qualifier')},
field_idf as (
  select term, ln((select count(*) from texts) / count(*)::double) as idf
  from field_terms group by term),
weighed as (
  select url, qualifier, term, round(freq * idf / total, 6) as weight
  from field_terms join field_idf using (term)),
field_keywords as (
  select *, row_number() over (partition by url, qualifier order by weight desc, term)::int as rank
  from weighed qualify rank <= 10)"""


def _lists(source: str) -> str:
    return (
        "select term, 0::int as part, string_agg(url, '|' order by url) as index "
        f"from (select distinct term, url from {source}) group by term"
    )


FULL_INDEX = f"""{FIELD_KEYWORDS},
whole as (
  select term, url from field_keywords where length(term) between 2 and 4
  union all
  select term, url from field_tokens where qualifier = 'title' and length(term) > 4),
full_index as ({_lists('whole')})"""

SEARCHED = f"""{FULL_INDEX},
searched as (
  select term as keyword from (select term, count(distinct url) n from whole group by term)
  order by n desc, keyword limit {q.SEARCHED_TERMS})"""

TIMED = """
timed as (
  select p.*, e.ts from pages p join events e on p.page_id = e.event_id)"""


def _add(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


# Scans, cells, stores and files

_add("scan_articles", "select page_id, url, html from pages")
_add("cells_unpivot", f"with {CELLS} select * from cells")
_add("cells_json", f"with {CELLS} select * from cells")
_add("cells_pivot", f"with {ARTICLES} select url, title, content from articles")
_add("put_cells", f"""with {CELLS},
puts as (
  select "row", 'f' as "columnFamily", qualifier, ts::bigint as "timestamp", 'Put' as type, value from (
    select min("row") as "row", 'title' as qualifier, 1000000000000 as ts, 'put later' as value from cells
    union all select max("row"), 'content', 1000000000000, 'put later' from cells
    union all select 'put:new', 'title', 1000000000000, 'put new'
    union all select min("row"), 'content', 0, 'put too early' from cells))
select * from (select * from cells union all select * from puts)
qualify row_number() over (partition by "row", "columnFamily", qualifier order by "timestamp" desc) = 1""")
# Of the characters beside ASCII, the charset's Latin letters and its punctuation of the first row;
# documents hold no others that it has.
_add("charset_decode", r"""
select doc_id, regexp_replace(text, '[^\x00-\x7FàáèéêìíòóùúüāēěīńňōūǎǐǒǔǖǘǚǜΑ-ΡΣ-Ωα-ρσ-ωА-ЯЁа-яё¤§¨°±·×÷—‘’“”…、。]', '', 'g') as text
from documents""")
_add("upsert_latest", """
select user_id, event_type, ts, event_id, value, props from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""")
_add("keep_versions", """
select user_id, event_type, ts, event_id, value, row_number() over
  (partition by user_id, event_type order by ts desc, event_id desc)::int as version
from events qualify version <= 3""")
_add("multi_get", "select doc_id, source, text from documents "
                  "where doc_id in (select doc_id from labels)")
_add("delete_keys", "select doc_id, source, text from documents "
                    "where doc_id not in (select doc_id from labels)")
_TIMED_ARTICLES = f"""{ARTICLES}, timed_articles as (
  select a.*, strftime(e.ts, '%Y-%m-%d %H:%M:%S') as time, strftime(e.ts, '%Y%m%d') as day
  from articles a join events e on a.page_id = e.event_id)"""
_add("article_text", f"""with {_TIMED_ARTICLES}
select url, day, title || chr(10) || url || chr(10) || time || chr(10) || content as value
from timed_articles""")
_add("article_text_parse", f"with {_TIMED_ARTICLES} "
                           "select title, url, time, content from timed_articles")
_add("manifest", """
with entries as (
  select *, epoch(date_trunc('second', ts))::double as seconds from events)
select seconds as epoch, lpad(event_id::varchar, 12, '0') as url,
  event_type || '###event ' || event_id || '###' || strftime(ts, '%Y%m%d') || '/' || event_type
  || '-' || event_id || '.txt###' || printf('%.1f', seconds) as line
from entries""")
_add("index_roundtrip", f"with {FULL_INDEX} select * from full_index")
_add("idf_dictionary", f"with {DOC_IDF} select term, round(idf, 6) as idf from learned")
_add("stop_words", f"""with {DOC_IDF},
common as (select term from learned where df * 5 >= (select count(*) from documents)
           union select unnest([{_quoted(KEYWORD_STOP_WORDS)}])),
kept as (select doc_id, term, freq from terms
         where lower(term) not in (select term from common))
select doc_id, term, freq, (sum(freq) over (partition by doc_id))::bigint as total from kept""")

# Pages, links and times

_add("date_range", """
select strftime(d, '%Y-%m-%d') as day from (
  select unnest(generate_series(min(ts)::date, max(ts)::date, interval 1 day)) d from events)""")
_add("date_window", """
with windows(preset, a, b) as (values
  ('today', date '2024-01-20', date '2024-01-20'), ('last30', date '2023-12-22', date '2024-01-20'),
  ('day', date '2024-01-05', date '2024-01-05'), ('between', date '2024-01-05', date '2024-01-07'),
  ('days', date '2024-01-10', date '2024-01-13'))
select preset, count(*) as n, min(event_id) as first, max(event_id) as last
from events join windows on ts::date between a and b group by preset""")
_URLS = {
    site: template.replace("{page}", "1")
    .replace("{y}", "%Y").replace("{m}", "%m").replace("{d}", "%d")
    for site, template in fixed.ROLL_PAGE_URL.items()
}
_add("roll_urls", " union all ".join(
    f"select '{site}' as site, strftime(d, '%Y-%m-%d') as day, strftime(d, '{url}') as url "
    "from (select distinct ts::date d from events)"
    for site, url in _URLS.items()
))
_add("links", r"""
with found as (
  select page_id, url, generate_subscripts(l, 1) - 1 as pos, unnest(l) as m from (
    select page_id, url, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') l from pages)),
parts as (
  select page_id, pos::int as pos, regexp_extract(m, 'href="([^"]*)"', 1) as href,
    regexp_extract(m, '>([^<]*)<', 1) as anchor,
    regexp_extract(url, '^(https?://[^/]+)', 1) as base from found)
select page_id, pos, href, anchor,
  case when href[:4] <> 'http' then base || href else href end as link_url from parts""")
_ENTRIES = rf"""{TIMED},
entries as (
  select page_id, url, ts, strftime(ts, '%Y-%m-%d %H:%M:%S') as full_time,
    strftime(ts, '%Y-%m-%d %H:%M') || ':00' as short_time,
    regexp_extract(url, '^https?://[^/]+(/.*)$', 1) as path,
    regexp_replace(regexp_extract(html, '(?is)<title[^<>]*>(.*?)</title>', 1),
                   '[^\p{{L}}\p{{N}} ]', '', 'g') as title
  from timed),
found as (
  select 'ZXW' as site, ts::date as day, title, 'http://www.chinanews.com' || path as url,
         short_time as time from entries
  union all select 'SINA', ts::date, title, url, full_time from entries
  union all select 'RMW', ts::date, title, url, strftime(ts, '%Y-%m-%d') from entries
  union all select '163', ts::date, title, url, full_time from entries where hour(ts) < 12
  union all select 'IFENG', ts::date, title, 'http://news.ifeng.com/a/' || page_id, short_time
            from entries where not contains(url, '/en/'))"""
_add("link_props", f"with {_ENTRIES} "
     "select site, strftime(day, '%Y-%m-%d') as day, title, url, time from found")
_add("link_filters", f"""with {_ENTRIES}
select site, strftime(day, '%Y-%m-%d') as day, count(*) as n from found
where site in ('163', 'IFENG') group by site, day""")
_OUTCOMES = rf"""{ARTICLES}, {_ENTRIES.strip()},
clocks as (select page_id, regexp_extract(html, '([0-9]{{2}}:[0-9]{{2}})<', 1) as clock from pages),
outcomes as materialized (
  select 'ZXW' as site, ts::date as day, 'http://www.chinanews.com' || path as url, title, null as time,
         'no page' as reason, page_id from entries
  union all select 'SINA', ts::date, url, title, full_time, null, page_id from entries
  union all select 'RMW', ts::date, url, title, strftime(ts, '%Y-%m-%d') || ' ' || clock || ':00',
         case when clock = '' then 'no time' end, page_id from entries join clocks using (page_id)
  union all select '163', (ts + interval 12 hour)::date, url, title, full_time,
         case when hour(ts) >= 12 then 'other day' end, page_id from entries
  union all select 'IFENG', ts::date, 'http://news.ifeng.com/' || case when contains(url, '/en/') then 'photo' else 'a' end
         || '/' || page_id, title, null, case when contains(url, '/en/') then 'photo news' else 'no page' end, page_id
         from entries)"""
_add("ingest", f"""with {_OUTCOMES}
select site, strftime(day, '%Y-%m-%d') as day, o.url, o.title, time, content
from outcomes o join articles using (page_id) where reason is null""")
_add("ingest_rejects", f"""with {_OUTCOMES}
select site, strftime(day, '%Y-%m-%d') as day, url, title, reason from outcomes where reason is not null""")
_add("article_body", f"with {ARTICLES} select page_id, title, content as body from articles")
_add("site_bodies", f"""with {ARTICLES}
select page_id, site, content as body
from articles, (select unnest([{_quoted(fixed.SITES)}]) as site)""")
_add("page_rewrite", f"""
select page_id, case when contains(url, '.html')
  then url[:length(url) - 5] || '{fixed.ALL_PAGES_MARK}' else url end as url from pages""")
_add("time_norm", """
select event_id, strftime(ts, '%Y-%m-%d %H:%M:00') as time,
  epoch(date_trunc('minute', ts))::bigint as epoch,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as stamp_time, strftime(ts, '%H:%M:00') as clock
from events""")
_add("take_until_empty", """
with listed as (
  select event_type as site, strftime(ts, '%Y-%m-%d') as day, event_id as page,
    min(case when value < 1 then event_id end) over (partition by event_type, ts::date) as stop
  from events)
select site, day, page from listed where stop is null or page < stop""")
_add("seq_number", """
with numbered as (
  select event_type as site, strftime(ts, '%Y-%m-%d') as day, event_id,
    row_number() over (partition by event_type, ts::date order by event_id) - 1 as n
  from events)
select *, site || '-' || n as name from numbered""")
_add("rejects", """
with read as (
  select event_id, try_cast('2024-02-' || lpad(props->>'$.k', 2, '0') as date) as d from events)
select event_id, coalesce(strftime(d, '%Y-%m-%d'), '') as day,
  case when d is null then 'rejected' else 'kept' end as outcome from read""")

# Text and tokens

_add("unescape_text", "select doc_id, text from documents")
_add("tokens", f"with {DOC_TOKENS} select * from tokens")
_SPANS = rf"""
spans as (
  select doc_id, term, startpos, startpos + length(term) as endpos from (
    select doc_id, term, pos,
      (sum(length(term)) over (partition by doc_id order by pos) - length(term))::bigint as startpos
    from tokens)
  where length(term) > 1)"""
_add("tokens_offsets", f"with {DOC_TOKENS}, {_SPANS} select doc_id, term, startpos, endpos from spans")
_ANALYZED = f"""{DOC_TOKENS}, {_SPANS},
analyzed as materialized (
  select doc_id, lower(term) as term, startpos, endpos from spans
  where lower(term) not in ({_quoted(ANALYZER_STOP_WORDS)}))"""


def _cut(n: int) -> str:
    return f"left(w, greatest(length(w) - {n}, 0))"


def _marked(n: int) -> str:
    return f"{_cut(n)} || '+'"


def _suffix_rules(rules, outcome) -> str:
    whens = " ".join(
        f"when ends_with(w, '{s}') then {outcome(s)}" for s in porter.longest_first(rules)
    )
    return f"case {whens} else w end"


def _when_stem(s: str, pattern: str, result: str, more: str = "") -> str:
    return (f"case when regexp_matches({_cut(len(s))}, '{pattern}'){more} "
            f"then {result} else w end")


def _stems(source: str) -> str:
    """CTEs of the stemming steps over the distinct column ``term`` of ``source``."""
    stem = _cut(1)
    doubled = (f"length(w) > 2 and substr(w, -2, 1) = substr(w, -3, 1) "
               "and substr(w, -2, 1) not in ('a','e','i','o','u','y','l','s','z')")
    two, three = dict(porter.PORTER_STEP_2), dict(porter.PORTER_STEP_3)
    steps = [
        f"case when ends_with(w, 'sses') or (ends_with(w, 'ies') and length(w) > 3) then {_cut(2)} "
        f"when ends_with(w, 's') and not ends_with(w, 'ss') and length(w) > 2 then {_cut(1)} "
        "else w end",
        f"case when ends_with(w, 'eed') then {_when_stem('eed', porter.MEASURE_OVER_0, _cut(1))} "
        f"when ends_with(w, 'ed') then {_when_stem('ed', porter.HAS_VOWEL, _marked(2))} "
        f"when ends_with(w, 'ing') then {_when_stem('ing', porter.HAS_VOWEL, _marked(3))} "
        "else w end",
        f"case when not ends_with(w, '+') then w "
        f"when ends_with(w, 'at+') or ends_with(w, 'bl+') or ends_with(w, 'iz+') "
        f"then {stem} || 'e' when {doubled} then {_cut(2)} "
        f"when regexp_matches({stem}, '{porter.SHORT_SYLLABLE}') then {stem} || 'e' "
        f"else {stem} end",
        f"case when ends_with(w, 'y') and regexp_matches({stem}, '{porter.HAS_VOWEL}') "
        f"then {stem} || 'i' else w end",
        _suffix_rules(two, lambda s: _when_stem(
            s, porter.MEASURE_OVER_0, f"{_cut(len(s))} || '{two[s]}'")),
        _suffix_rules(three, lambda s: _when_stem(
            s, porter.MEASURE_OVER_0, f"{_cut(len(s))} || '{three[s]}'")),
        _suffix_rules(porter.PORTER_STEP_4, lambda s: _when_stem(
            s, porter.MEASURE_OVER_1, _cut(len(s)),
            " and (ends_with(w, 'sion') or ends_with(w, 'tion'))" if s == "ion" else "")),
        f"case when ends_with(w, 'e') and (regexp_matches({stem}, '{porter.MEASURE_OVER_1}') or "
        f"(regexp_matches({stem}, '{porter.MEASURE_IS_1}') and not "
        f"regexp_matches({stem}, '{porter.SHORT_SYLLABLE}'))) then {stem} else w end",
        f"case when ends_with(w, 'll') and regexp_matches(w, '{porter.MEASURE_OVER_1}') "
        f"then {stem} else w end",
    ]
    ctes = [f"stem0 as (select term, case when term like 'y%' then 'Y' || term[2:] else term end "
            f"as w from (select distinct term from {source}))"]
    for n, step in enumerate(steps):
        ctes.append(f"stem{n + 1} as materialized (select term, {step} as w from stem{n})")
    ctes.append(f"stems as (select term, case when length(term) < 3 then term when w like 'Y%' "
                f"then 'y' || w[2:] else w end as stem from stem{len(steps)})")
    return ",\n".join(ctes)


_CJK = f"{fixed.CJK_FIRST}-{fixed.CJK_LAST}"


def _chinese(expr: str) -> str:
    return (f"regexp_replace(translate({expr}, '{q.LETTERS}', '{q.CHINESE}'), "
            rf"'([{_CJK}]+) ([{_CJK}]+)', '\1\2', 'g')")


def _segmented(source: str, ids: str, text: str) -> str:
    """CTEs up to ``segmented(ids, term, startpos, endpos)`` over the Chinese ``text`` of ``source``.

    The cheapest path of every distinct run is found from its end, one character a step, with the costs
    of the places behind it in a list; 64 times the cost less the length puts the longer word first.
    """
    return rf"""
dictionary as materialized (
  select word, round(ln((sum(freq) over ()) / freq) * 1000000)::bigint as cost from (
    select word, count(*) as freq from (
      select unnest(regexp_extract_all(translate(text, '{q.LETTERS}', '{q.CHINESE}'), '[{_CJK}]+')) as word
      from benchmark) group by word)),
total as (
  select round(ln(sum(n)::double) * 1000000)::bigint as unlisted, max(length(word)) as longest from (
    select word, count(*) as n from (
      select unnest(regexp_extract_all(translate(text, '{q.LETTERS}', '{q.CHINESE}'), '[{_CJK}]+')) as word
      from benchmark) group by word)),
run_pieces as materialized (
  select {ids}, p, i, sum(length(p)) over (partition by {ids} order by i) - length(p) as place from (
    select {ids}, unnest(l) as p, generate_subscripts(l, 1) as i from (
      select {ids}, regexp_extract_all({text}, '[{_CJK}]+|(?:[^\P{{L}}{_CJK}]|\p{{N}})+|(?s:.)') as l from {source}))),
runs as materialized (select distinct p as run from run_pieces where regexp_matches(p, '^[{_CJK}]')),
starts as (select run, unnest(range(1, length(run) + 1)) as s from runs),
parts as (
  select run, s, unnest(range(1, least((select longest from total), length(run) - s + 1) + 1)) as l from starts),
edges as materialized (
  select run, s, list({{'l': l, 'cost': coalesce(cost, (select unlisted from total))}}) as e
  from parts left join dictionary on word = substr(run, s, l) where l = 1 or cost is not null group by run, s),
best as (
  select run, length(run) + 1 as s, [0::bigint] as costs, []::bigint[] as picks from runs
  union all
  select run, s, list_prepend((v + 63) // 64, costs), list_prepend((v + 63) // 64 * 64 - v, picks) from (
    select b.run, e.s, costs, picks,
      list_min(list_transform(e.e, lambda x: (x.cost + costs[x.l]) * 64 - x.l))::bigint as v
    from best b join edges e on e.run = b.run and e.s = b.s - 1)),
path as (
  select run, 1::bigint as s, picks[1] as l, picks from best where s = 1
  union all
  select run, s + l, picks[s + l], picks from path where s + l <= length(run)),
named as (
  select run, s, l, l > 1 or substr(run, s, 1) in (select word from dictionary) as listed from path),
spans_of_runs as materialized (
  select run, s - 1 as a, case when listed or not coalesce(not after, false) then s - 1 + l else s + l end as z
  from (select *, lead(listed) over w as after, lag(listed) over w as before from named
        window w as (partition by run order by s))
  where listed or not coalesce(after, true) or coalesce(before, true)),
segmented as materialized (
  select {ids}, substr(p, a + 1, z - a) as term, (place + a)::bigint as startpos, (place + z)::bigint as endpos
  from run_pieces join spans_of_runs on run = p
  union all
  select {ids}, p, place::bigint, (place + length(p))::bigint from run_pieces
  where not regexp_matches(p, '^[{_CJK}]'))"""


_add("segmented_tokens", f"""with recursive chinese as materialized (
  select doc_id, {_chinese('text')} as text from documents), {_segmented('chinese', 'doc_id', 'text')}
select doc_id, (row_number() over (partition by doc_id order by startpos, endpos) - 1)::int as pos, term, startpos, endpos
from segmented""")
_add("segmented_index", f"""with recursive {CELLS},
chinese as materialized (
  select "row" as url, qualifier, {_chinese('value')} as text from cells),
{_segmented('chinese', 'url, qualifier', 'text')},
{_terms('field_terms', 'segmented', 'url, qualifier')},
field_idf as (
  select term, ln((select count(*) from chinese) / count(*)::double) as idf from field_terms group by term),
weighed as (
  select url, qualifier, term, round(freq * idf / total, 6) as weight from field_terms join field_idf using (term)),
best_terms as (
  select url, term from weighed
  qualify row_number() over (partition by url, qualifier order by weight desc, term) <= 10),
whole as (
  select term, url from best_terms where length(term) between 2 and 4
  union all
  select term, url from segmented where qualifier = 'title' and length(term) > 4)
{_lists('whole')}""")
_add("analyzer", f"""with {_ANALYZED}, {_stems('analyzed')}
select doc_id, stem as term, startpos, endpos from analyzed join stems using (term)""")
_add("stemmed_terms", f"""with {_ANALYZED}, {_stems('analyzed')}
select term, stem, count(*) as n from analyzed join stems using (term) group by term, stem""")
_add("keyword_tokens", f"with {DOC_TOKENS} select * from tokens where {IS_KEYWORD}")
_add("pos_filter", f"""with {DOC_TERMS}, {LEXICON}
select doc_id, pos, term, flag from tokens join lexicon using (term)
where flag in ({_quoted(q.LEXICON_POS)})""")

_TAGGED = rf"""
sentences as materialized (
  select *, sum(case when term in ({_quoted(w for w in fixed.SENTENCE_ENDS if w != chr(10))}, chr(10)) then 1 else 0 end)
    over (partition by doc_id order by pos) as sent from tokens),
words as materialized (
  select doc_id, sent, pos, term, row_number() over (partition by doc_id, sent order by pos) as i,
    lag(term) over (partition by doc_id order by pos) as before
  from sentences where regexp_matches(term, '^[\p{{L}}\p{{N}}]')),
flagged as materialized (
  select *, case when length(before) <= 2 then 'n' when length(term) <= 3 then 'x'
      when right(term, 1) in ('s', 'n') then 'n' when right(term, 1) = 'e' then 'v' else 'a' end as flag from words),
emitted as materialized (
  select term, flag, round(ln((sum(n) over (partition by flag)) / n) * 1000000)::bigint as c
  from (select term, flag, count(*) as n from flagged group by term, flag)),
followed as (
  select coalesce(lag(flag) over (partition by doc_id order by pos), '') as prev, flag from flagged),
moves as materialized (
  select prev, flag, round(ln((sum(n) over (partition by prev)) / n) * 1000000)::bigint as c
  from (select prev, flag, count(*) as n from followed group by prev, flag)),
tables as materialized (select map(list(prev || '>' || flag), list(c)) as m, max(c) + 1000000 as unlisted from moves),
options as materialized (select term, list({{'f': flag, 'c': c}}) as o from emitted group by term),
chains as materialized (
  select doc_id, sent, list(o order by i) as os, max(i) as n from words join options using (term) group by doc_id, sent),
reached as (
  select doc_id, sent, os, n, 0::bigint as i, [{{'c': 0::bigint, 'f': ''}}] as st,
    []::struct(f varchar, p varchar)[][] as came, m, unlisted
  from chains, tables
  union all
  select doc_id, sent, os, n, i + 1, list_transform(new, lambda x: {{'c': x.b.c + x.c, 'f': x.f}}),
    list_append(came, list_transform(new, lambda x: {{'f': x.f, 'p': x.b.f}})), m, unlisted
  from (
    select *, list_transform(os[i + 1], lambda x: {{'f': x.f, 'c': x.c, 'b': list_min(list_transform(st, lambda s:
      {{'c': s.c + coalesce(m[s.f || '>' || x.f], unlisted), 'f': s.f}}))}}) as new
    from reached where i < n)),
traced as (
  select doc_id, sent, n as i, list_min(st).f as flag, came from reached where i = n
  union all
  select doc_id, sent, i - 1, list_filter(came[i], lambda x: x.f = flag)[1].p, came from traced where i > 1),
tagged as materialized (
  select w.doc_id, w.pos, w.term, t.flag from words w join traced t using (doc_id, sent, i))"""
_add("pos_tags", f"with recursive {DOC_TOKENS}, {_TAGGED} select doc_id, pos, term, flag from tagged")
_add("pos_tags_topk", f"""with recursive {DOC_IDF}, {_TAGGED},
counted as (
  select doc_id, term, flag, count(*) as freq, sum(count(*)) over (partition by doc_id)::bigint as total
  from tagged where {IS_KEYWORD} and flag in ({_quoted(q.LEXICON_POS)}) group by doc_id, term, flag),
weighed as (
  select doc_id, term, flag, round(freq * idf / total, 6) as weight from counted join learned using (term))
select *, row_number() over (partition by doc_id order by weight desc, term, flag)::int as rank
from weighed qualify rank <= 20""")

# Counts, IDF and TF-IDF

_add("word_count", f"with {DOC_TERMS} select term, sum(freq)::bigint as n from terms group by term")
_add("term_freq", f"with {DOC_TERMS} select doc_id, term, freq, total from terms")
_add("idf", f"with {DOC_IDF} select term, df, round(idf, 6) as idf from learned")
_add("idf_median", f"with {DOC_IDF} select round({_median('learned')}, 6) as median_idf")
_add("tfidf_weights", f"""with {DOC_IDF}
select doc_id, term, round(freq * idf / total, 6) as weight from terms join learned using (term)""")
_add("tfidf_default", f"""with {DOC_TERMS},
known as (select * from terms where doc_id in (select doc_id from labels)),
learned as materialized (
  select term, ln((select count(*) from documents where doc_id in (select doc_id from labels))
    / count(*)::double) as idf from known group by term)
select doc_id, term, round(freq * coalesce(idf, m) / total, 6) as weight
from terms left join learned using (term), (select {_median('learned')} as m)""")
_add("tfidf_topk", f"""with {DOC_IDF},
weighed as (
  select doc_id, term, round(freq * idf / total, 6) as weight from terms join learned using (term))
select *, row_number() over (partition by doc_id order by weight desc, term)::int as rank
from weighed qualify rank <= 20""")
_add("tfidf_topk_flag", f"""with {DOC_IDF}, {LEXICON},
flagged as (
  select doc_id, term, flag, freq, sum(freq) over (partition by doc_id)::bigint as total
  from terms join lexicon using (term) where flag in ({_quoted(q.LEXICON_POS)})),
weighed as (
  select doc_id, term, flag, round(freq * idf / total, 6) as weight
  from flagged join learned using (term))
select *, row_number() over (partition by doc_id order by weight desc, term, flag)::int as rank
from weighed qualify rank <= 20""")

# Inverted index

_add("field_cells", f"with {CELLS} select \"row\", qualifier, value from cells "
                    "where qualifier = 'title' and value is not null")
_add("field_keywords", f"with {FIELD_KEYWORDS} "
                       "select url, qualifier, term, weight, rank from field_keywords")
_add("title_tokens", f"with {FIELD_KEYWORDS} "
                     "select url, term from field_tokens where qualifier = 'title'")
_add("field_union", f"with {FIELD_KEYWORDS} select url, term from field_keywords")
_add("invert", f"with {FIELD_KEYWORDS} select distinct term, url from field_keywords")
_add("inverted_index", f"with {FIELD_KEYWORDS} {_lists('field_keywords')}")
_add("index_short", f"with {FULL_INDEX} select * from full_index where length(term) <= 4")
_add("index_long", f"with {FULL_INDEX} select * from full_index where length(term) > 4")
_add("full_index", f"with {FULL_INDEX} select * from full_index")

# Lookup

_add("lookup_point", f"""with {SEARCHED}
select keyword, part, index from searched join full_index on term = keyword""")
_add("lookup_prefix", f"with {FULL_INDEX} select * from full_index where term like 'th%'")
_add("lookup_missing", f"""with {SEARCHED}
select keyword, count(distinct url) as n from searched join whole on term = keyword
group by keyword""")
_add("search", f"""with {SEARCHED}
select distinct keyword, url, title, content
from searched join whole on term = keyword left join articles using (url)""")

ORACLE["search_ranges"] = ORACLE["search"]
_add("index_maintained", f"with {FULL_INDEX} select * from full_index")

_add("search_timed", f"""with {SEARCHED.replace(ARTICLES, ARTICLES + f", {TIMED.strip()}", 1)}
select distinct keyword, url, title, content, strftime(ts, '%Y-%m-%d %H:%M:%S') as time
from searched join whole on term = keyword left join articles using (url)
  left join (select url, ts from timed) using (url)""")

# Term graph

_PAIRS = f"""{DOC_TOKENS},
kept as (select * from tokens where {IS_KEYWORD}),
pairs as (
  select a.doc_id, a.term as src, b.term as dst, count(*) as w
  from (select *, unnest([1, 2, 3, 4]) as d from kept) a
    join kept b on a.doc_id = b.doc_id and b.pos = a.pos + a.d
  group by all),
edges as (
  select doc_id, src, dst, sum(w)::bigint as w from (
    select * from pairs union all select doc_id, dst, src, w from pairs) group by all)"""
_add("cooccurrence", f"with {_PAIRS} select doc_id, src, dst, w from pairs")
_add("term_graph", f"with {_PAIRS} select doc_id, src, dst, w from edges")
_add("node_strength", f"""with {_PAIRS}
select doc_id, src, sum(w)::bigint as strength from edges group by doc_id, src""")
_RANKS = f"""{_PAIRS},
strength as materialized (select doc_id, src, sum(w)::double as total from edges group by doc_id, src),
nodes as materialized (
  select doc_id, src as term, total, row_number() over (partition by doc_id order by src) as i,
    count(*) over (partition by doc_id) as n from strength),
flows as (
  select a.doc_id, a.i, a.n, list(b.i order by b.term) as ids, list(w / b.total order by b.term) as sh
  from edges e join nodes a on e.doc_id = a.doc_id and e.src = a.term
    join nodes b on e.doc_id = b.doc_id and e.dst = b.term
  group by a.doc_id, a.i, a.n),
graphs as materialized (
  select doc_id, n, list(ids order by i) as ids, list(sh order by i) as sh from flows group by doc_id, n),
settled as materialized (
  select doc_id, list_reduce(
    list_prepend({{'k': -1::bigint, 'st': list_transform(range(n), lambda x: 1.0::double / n)}},
      list_transform(range({fixed.RANK_ROUNDS} * n), lambda k: {{'k': k, 'st': []::double[]}})),
    lambda a, b: {{'k': b.k, 'st': a.st[:b.k % n]
      || [{1 - fixed.RANK_DAMPING}::double + {fixed.RANK_DAMPING}::double * list_sum(list_transform(
           list_zip(ids[b.k % n + 1], sh[b.k % n + 1]), lambda z: z[2] * a.st[z[1]]))]
      || a.st[b.k % n + 2:]}}).st as ranks from graphs),
ranked as materialized (
  select nodes.doc_id, term, round((ranks[i] - list_min(ranks) / 10.0) / (list_max(ranks) - list_min(ranks) / 10.0), 6)
    as weight
  from nodes join settled using (doc_id))"""
_add("textrank", f"with {_RANKS} select doc_id, term, weight from ranked")
_add("textrank_topk", f"""with {_RANKS}
select *, row_number() over (partition by doc_id order by weight desc, term)::int as rank
from ranked qualify rank <= 20""")
