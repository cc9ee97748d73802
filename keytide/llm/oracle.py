"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOW_WORDS = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"

# Base 32 takes four letters from every five hexadecimal digits.
_BASE32 = """
  list_aggregate(flatten(list_transform(range(8), lambda i: list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1, i * 5 + 1, 5))::bigint >> s) & 31) + 1, 1)))),
  'string_agg', '')"""

ORACLE: dict[str, str] = {
    "op4_warc": f"""
      with made as (select page_id, url, coalesce(html, '') as payload from pages),
      hashed as (
        select page_id, url, cast(octet_length(encode(payload)) as bigint) as payload_bytes, sha1(payload) as sha1,
          max(page_id) over (partition by payload) as largest
        from made)
      select page_id, url, case when page_id = largest then 'response' else 'revisit' end as record_type,
        case when page_id <> largest then largest end as refers_to, payload_bytes, {_BASE32} as payload_digest
      from hashed""",
    "op5_substring": f"""
      with docs as (select doc_id, {_WORDS} as w from documents),
      places as (select doc_id, w, unnest(range(1, len(w) - 48)) as place from docs where len(w) >= 50),
      windows as (select doc_id, place, sha256(array_to_string(w[place:place + 49], ' ')) as h from places),
      repeats as (select doc_id, place, min(doc_id) over (partition by h) < doc_id as later from windows),
      gone as (
        select distinct doc_id, place + unnest(range(50)) as place from repeats where later),
      words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from docs),
      judged as (select words.*, gone.place is not null as removed from words left join gone using (doc_id, place)),
      kept as (
        select doc_id, count(*) filter (where removed) as n_removed,
          string_agg(word, ' ' order by place) filter (where not removed) as text
        from judged group by doc_id)
      select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
      from docs left join kept using (doc_id)""",
    "op7_near_dups": f"""
      with recursive docs as (select doc_id, {_LOW_WORDS} as w from documents),
      sets as materialized (
        select distinct doc_id, unnest(
          case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
        from docs),
      sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
      shared as (
        select a.doc_id as a, b.doc_id as b, count(*) as common
        from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
      links as materialized (
        select a, b from shared join sizes s on s.doc_id = a join sizes t on t.doc_id = b
        where 100 * common >= 75 * (s.n + t.n - common)),
      ends as materialized (select a, b from links union all select b, a from links),
      reached(doc_id, other) as (
        select doc_id, doc_id from docs
        union
        select reached.doc_id, ends.b from reached join ends on reached.other = ends.a)
      select doc_id, coalesce(n, 0) as n_shingles, min(other) as component_id, min(other) = doc_id as kept
      from reached left join sizes using (doc_id) group by doc_id, n""",
    "op10_line_dedup": rf"""
      with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
      numbered as (select doc_id, generate_subscripts(lines, 1) - 1 as line_no, unnest(lines) as text from split),
      sets as (select doc_id, line_no, list_sort(list_distinct({_LOW_WORDS})) as tokens from numbered),
      lines as materialized (
        select *, first_value({{'d': doc_id, 'l': line_no}}) over same as first, count(*) over whole as lines
        from sets where len(tokens) > 0
        window same as (partition by tokens order by doc_id, line_no), whole as (partition by tokens)),
      classes as materialized (
        select row_number() over () as c, tokens, cast(len(tokens) as bigint) as n, first, lines
        from lines where doc_id = first.d and line_no = first.l),
      spread as materialized (select c, unnest(tokens) as token from classes),
      users as (select token, count(*) as often from spread group by token),
      ranked as (
        select c, token, row_number() over (partition by c order by often, token) as place from spread join users using (token)),
      prefix as materialized (select c, token from ranked join classes using (c) where 100 * place <= 100 * n - 75 * n + 100),
      met as (select distinct a.c as a, b.c as b from prefix a join prefix b on a.token = b.token and a.c < b.c),
      tested as (
        select x.c as a, y.c as b, x.n + y.n as total, len(list_intersect(x.tokens, y.tokens)) as common
        from met join classes x on x.c = a join classes y on y.c = b
        where 100 * least(x.n, y.n) >= 75 * greatest(x.n, y.n)),
      links as materialized (select a, b from tested where 100 * common >= 75 * (total - common)),
      ends as (select a, b from links union all select b, a from links),
      linked as (select a as c, min(first) as least, sum(lines) as others from ends join classes on c = b group by a),
      named as (
        select tokens, case when least < classes.first then least end as match, others from classes left join linked using (c))
      select doc_id, cast(line_no as integer) as line_no, first.d as class_doc, cast(first.l as integer) as class_line,
        match.d as match_doc, cast(match.l as integer) as match_line,
        doc_id <> first.d or line_no <> first.l or match is not null as removed,
        cast(lines - 1 + coalesce(others, 0) as bigint) as n_links
      from lines join named using (tokens)""",
}
