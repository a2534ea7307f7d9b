"""DuckDB equivalents of the queries that SQL can express."""

#: Poisson draws by inversion at MD5 hashes; thresholds as in `mixing`.
OP3 = """
with counts as (select source, count(*)::double as n from documents group by source),
shares as (select source, n, pow(n, 0.7::double) as share from counts),
rates as (select source, share / (select sum(share) from shares) * (select sum(n) from counts) * 1.0::double / n as rate from shares),
parts as (select source, greatest(ceil(rate / 16), 1)::int as parts, rate / greatest(ceil(rate / 16), 1) as mean from rates where rate > 0),
terms as (select source, mean, k, exp(-mean) * pow(mean, k) / gamma(k + 1) as p from parts, range(0, 81) as r(k)),
cdf as (select source, k, sum(p) over (partition by source order by k) as bound from terms),
bounds as (select source, list(bound order by k) as bounds from cdf group by source),
drawn as (
  select d.doc_id, d.source, coalesce(md5(d.text), 'null') as body, unnest(range(1, p.parts + 1)) as part, b.bounds
  from documents d join parts p on d.source is not distinct from p.source
  join bounds b on d.source is not distinct from b.source),
units as (
  select *, ('0x' || md5('3|' || coalesce(doc_id::varchar, 'null') || '|' || body || '|' || part)[1:13])::bigint::double
    * pow(2.0::double, -52) as u from drawn),
counted as (select *, len(list_filter(bounds, lambda p: p <= u)) as n from units),
copies as (select doc_id, source, body, part, unnest(range(1, n + 1)) as copy from counted where n > 0)
select doc_id, source, part::int as part, copy::int as copy,
  row_number() over (order by md5('3|order|' || coalesce(doc_id::varchar, 'null') || '|' || body || '|' || part || '|' || copy)) - 1
    as position
from copies
"""

OP9 = """
with hashed as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as hexed from pages),
kinds as (
  select page_id, strlen(body) as payload_bytes, hexed, max(page_id) over (partition by hexed) as last from hashed)
select page_id, payload_bytes::bigint as payload_bytes,
  list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hexed || '0', (i * 5 // 4 + 1)::int, 2))::int >> (3 - i * 5 % 4)::int) & 31) + 1)::int, 1)),
    lambda a, b: a || b) as payload_digest,
  case when last is null or page_id is not distinct from last then 'response' else 'revisit' end as record_type,
  case when last is not null and page_id is distinct from last then last end as refers_to,
  true as intact
from kinds
"""

ORACLES: dict[str, str] = {"op3_poisson_mixture": OP3, "op9_warc_roundtrip": OP9}

#: Brute force over all pairs of a query and another vector, in whole numbers.
OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as w from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, v.vec_id, list_inner_product(q.w, v.w)::bigint as score
  from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
ORACLES["op1_va_file_topk"] = OP1

#: Scores of all documents that hold a term of an item.
OP13 = """
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents where text is not null),
sized as (select r, doc_id, terms, len(terms) as n from docs where len(terms) > 0),
whole as (select count(*)::bigint as docs, sum(n)::bigint as length from sized),
held as (select r, unnest(terms) as term from sized),
counts as (select r, term, count(*)::bigint as tf from held group by all),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counts, whole group by term),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark where text is not null),
scored as (
  select a.item_id, s.r, s.doc_id,
    sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 20 * (50 + (50 * s.n * t.docs) // t.length))))::bigint as score
  from asked a join counts c using (term) join weights w using (term) join sized s using (r), whole t
  group by a.item_id, s.r, s.doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
ORACLES["op13_mask_grouped_search"] = OP13

#: All 50-byte strings as hex text, and what is left of each text.
OP11 = """
with docs as (
  select row_number() over () as r, doc_id, upper(hex(encode(coalesce(text, '')))) as h from documents),
sized as (select *, length(h) // 2 as n from docs),
places as (select r, doc_id, h, n, unnest(range(n - 49)) as s from sized where n >= 50),
strings as (select r, doc_id, s, md5_number_lower(substr(h, 2 * s + 1, 100)) as low, md5_number_upper(substr(h, 2 * s + 1, 100)) as high
  from places),
marked as (select r, doc_id, s, min(doc_id) over (partition by low, high) as least from strings),
hits as (select r, s, lag(s) over (partition by r order by s) as before from marked where least < doc_id),
runs as (select r, s, sum(case when before is null or s > before + 50 then 1 else 0 end) over (partition by r order by s) as run from hits),
spans as (select r, run, min(s) as a, max(s) + 50 as b from runs group by r, run),
cuts as (select r, a, b, coalesce(lag(b) over (partition by r order by a), 0) as since from spans),
parts as (
  select r, since as at, since, a from cuts
  union all select r, max(b), max(b), null from cuts group by r),
kept as (
  select p.r, string_agg(substr(h, 2 * p.since + 1, 2 * (coalesce(p.a, n) - p.since)), '' order by p.at) as left_over
  from parts p join sized using (r) group by p.r),
gone as (select r, count(*) as n_spans, cast(sum(b - a) as bigint) as n_removed from spans group by r)
select s.doc_id, s.n as n_bytes, coalesce(g.n_removed, 0) as n_removed, coalesce(g.n_spans, 0) as n_spans,
  sha256(unhex(coalesce(k.left_over, s.h))) as kept_sha256
from sized s left join kept k using (r) left join gone g using (r)
"""
ORACLES["op11_suffix_intervals"] = OP11
