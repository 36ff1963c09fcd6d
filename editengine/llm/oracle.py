"""SQL for the corpus queries that SQL can express over whole tables.

Languages, quality and language models are trained, fingerprints need XXH64, packing and planes the
tokenizers, searches a graph: those queries are compared with brute force in tests/llm.
"""

_STRIPPED = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op2_line_store": f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as place
  from documents),
keyed as (select *, translate(trim(line, {_STRIPPED}), {_LOWER}) as key from lines),
frequent as (
  select key, max(doc_id) as last_doc from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
marked as (select k.*, f.key is not null and k.doc_id <> f.last_doc as gone from keyed k left join frequent f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op3_suffix_buckets": """
with bytes as (
  select doc_id, hex(encode(coalesce(text, ''))) as x, octet_length(encode(coalesce(text, ''))) as n from documents),
strings as (select doc_id, p, substr(x, 2 * p - 1, 100) as s from (select *, unnest(range(1, n - 48)) as p from bytes where n >= 50)),
first as (select s, min(doc_id) as first_doc from strings group by s),
gone as (select g.doc_id, g.p from strings g join first f on g.s = f.s where f.first_doc < g.doc_id),
fresh as (select *, case when p <= lag(p) over (partition by doc_id order by p) + 50 then 0 else 1 end as f from gone),
numbered as (select *, sum(f) over (partition by doc_id order by p rows unbounded preceding) as span from fresh),
spans as (select doc_id, span, min(p) as a, max(p) + 50 as b from numbered group by doc_id, span),
before as (
  select s.doc_id, s.a, s.b, substr(x, 2 * coalesce(lag(s.b) over w, 1) - 1, 2 * (s.a - coalesce(lag(s.b) over w, 1))) as kept
  from spans s join bytes d on s.doc_id = d.doc_id window w as (partition by s.doc_id order by s.a)),
summed as (select doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as rest, string_agg(kept, '' order by a) as kept from before group by doc_id)
select d.doc_id, cast(d.n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(rest, 1) - 1))) as kept_sha256
from bytes d left join summed m on d.doc_id = m.doc_id""",
}
