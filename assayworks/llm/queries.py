"""Queries that apply each operator to its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.llm import decontamination, licenses, minhash_dedup, mixing, packing, pii, quality, repair, sharding, sweep, toxicity, vector_dedup, warc
from assayworks.llm.shared import reading, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), minhash_dedup.Settings(least=85))


SQL["op1_minhash_near_dedup"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select doc_id, case when len(ws) = 0 then []
    when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end as sh
  from w),
e as (select doc_id, len(sh) as n, unnest(sh) as g from s),
inter as (
  select x.doc_id as a, y.doc_id as b, min(x.n) as na, min(y.n) as nb, count(*) as c
  from e x join e y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from inter where 100 * c >= 85 * (na + nb - c)),
reach(a, b) as (
  select doc_id, doc_id from documents
  union select r.a, l.b from reach r join links l on r.b = l.a)
select s.doc_id, len(sh)::bigint as n_shingles, c.component_id, s.doc_id = c.component_id as kept
from s join (select a as doc_id, min(b) as component_id from reach group by 1) c using (doc_id)
"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query
def op3_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_archives(spark, warc.write_archives(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op3_warc_revisit"] = r"""
with p as (select page_id, encode(coalesce(html, '')) as body from pages),
d as (
  select page_id, octet_length(body)::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (('0x' || substr(sha1(body), (i // 4 * 5 + 1)::int, 5))::int >> (15 - i % 4 * 5)::int) % 32 + 1, 1)), '') as payload_digest
  from p),
w as (select payload_digest, payload_bytes, max(page_id) as last from d group by all)
select d.page_id, d.payload_bytes, d.payload_digest,
  case when d.page_id = w.last then 'response' else 'revisit' end as record_type,
  case when d.page_id <> w.last then w.last end as refers_to
from d join w using (payload_digest, payload_bytes)
"""


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), packing.WEIGHED)


@_query
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


SQL["op6_benchmark_decontamination"] = r"""
with lowered as (
  select 'd' as side, doc_id as id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
  union all
  select 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark),
w as (select side, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from lowered),
b as (
  select distinct id as item_id, n, array_to_string(ws[i:i + n - 1], ' ') as win
  from (select id, ws, n, unnest(range(1, len(ws) - n + 2)) as i
        from (select id, ws, least(len(ws), 10) as n from w where side = 'b' and len(ws) > 0))),
d as (
  select id as doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as win
  from (select id, ws, n, unnest(range(1, len(ws) - n + 2)) as i
        from w, (select distinct n from b) where side = 'd' and len(ws) >= n)),
hits as (select d.doc_id, d.i, d.n, b.item_id from d join b using (n, win)),
places as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by 1),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
  from (select distinct doc_id, item_id::varchar as item_id from hits) group by 1)
select w.id as doc_id, len(w.ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join places on places.doc_id = w.id left join items on items.doc_id = w.id
where w.side = 'd'
"""


@_query
def op5_pii_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


_SHARDS = [f"shard-{k:02d}" for k in range(24)]


@_query
def op8_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", _SHARDS, 4093).select("doc_id", "slot", "shard")


def _sharding_sql() -> str:
    """The same in SQL: a recursive query fills the table, a claim a step."""
    names = ", ".join(f"({k}, '{s}')" for k, s in enumerate(_SHARDS))
    return rf"""
with recursive shards(k, name) as (values {names}),
claims as (
  select k, name, ('0x' || substr(md5('offset:' || name), 1, 16))::ubigint % 4093 as a0,
    ('0x' || substr(md5('stride:' || name), 1, 16))::ubigint % 4092 + 1 as stride
  from shards),
walk as (
  select k, name, j, ((a0 + j::ubigint * stride) % 4093)::bigint as slot
  from claims, (select unnest(range(0, 4093)) as j)),
orders as (select list(slots order by k) as o from (select k, list(slot order by j) as slots from walk group by k)),
filled(turn, ptr, taken, slot) as (
  select 0, list_transform(range(0, {len(_SHARDS)}), lambda x: 0), list_transform(range(0, 4093), lambda x: false), -1::bigint from orders
  union all
  select turn + 1,
    ptr[1:k - 1] || [p] || ptr[k + 1:],
    taken[1:s] || [true] || taken[s + 2:], s
  from (
    select turn, ptr, taken, k, p, (o[k][p])::bigint as s
    from (
      select turn, ptr, taken, turn % {len(_SHARDS)} + 1 as k, o,
        ptr[turn % {len(_SHARDS)} + 1] + list_position(
          list_transform(o[turn % {len(_SHARDS)} + 1][ptr[turn % {len(_SHARDS)} + 1] + 1:], lambda x: taken[x + 1]), false) as p
      from filled, orders where turn < 4093)))
select d.doc_id, f.slot, s.name as shard
from (select doc_id, (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint % 4093) as slot from documents) d
join (select turn - 1 as turn, slot from filled where turn > 0) f using (slot)
join shards s on s.k = f.turn % {len(_SHARDS)}
"""


SQL["op8_permutation_sharding"] = _sharding_sql()


@_query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_join(F.transform("matches", lambda m: F.concat_ws(":", m.license, m["at"].cast("string"))), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_licenses"), names.alias("licenses"))


def _license_sql() -> str:
    """Every window's exact shares, without the bands."""
    quoted = {k: v.replace("'", "''") for k, v in sorted(licenses.TEMPLATES.items())}
    rows = ", ".join(f"('{k}', '{v}')" for k, v in quoted.items())
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with t(name, text) as (values {rows}),
tw as (select name, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from t),
tg as (select distinct name, array_to_string(ws[i:i + 4], ' ') as g from (select name, ws, unnest(range(1, len(ws) - 3)) as i from tw)),
tn as (select name, count(*) as n, (16 * power(2, greatest(0, ceil(log2(count(*) / 64)))))::int as step from tg group by 1),
ts as (select name, step, g from tg join tn using (name)),
dw as (select doc_id, regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
ds as (select doc_id, i - 1 as i, array_to_string(ws[i:i + 4], ' ') as g from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from dw)),
inside as (
  select doc_id, name, w * step as a0, g
  from (select doc_id, name, step, g, unnest(range(i // step - 4, i // step + 1)) as w from ds join ts using (g))
  where w >= 0),
share as (select doc_id, name, a0, count(distinct g) / any_value(n) as share from inside join tn using (name) group by 1, 2, 3),
best as (select doc_id, name, arg_max(a0, (share, -a0)) as a1 from share where share >= 0.8 group by 1, 2)
select d.doc_id, count(name)::bigint as n_licenses, coalesce(string_agg(name || ':' || a1, ',' order by name), '') as licenses
from documents d left join best using (doc_id) group by 1
"""


SQL["op10_license_scan"] = _license_sql()


@_query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


SQL["op9_embedding_near_dedup"] = r"""
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings),
ok as (
  select vec_id, label, e from v
  where label is not null and e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and list_dot_product(e, e) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from ok x join ok y on x.label = y.label and x.vec_id <> y.vec_id
  where list_cosine_similarity(x.e, y.e) >= 0.93),
reach(a, b) as (
  select vec_id, vec_id from v
  union select r.a, l.b from reach r join links l on r.b = l.a)
select v.vec_id, coalesce(n, 0)::bigint as n_links, c.component_id, v.vec_id = c.component_id as kept
from v join (select a as vec_id, min(b) as component_id from reach group by 1) c using (vec_id)
left join (select a as vec_id, count(*) as n from links group by 1) d using (vec_id)
"""


@_query
def op7_toxicity_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    # documents carry no URL: their source stands for the host, its part in one language for the path
    return quality.scored(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), carry=("doc_id", "source", "lang"))


@_query
def op11_peak_concurrency(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = sweep.open_sales(*(table(spark, sf_dir, t) for t in ("sales", "sale_lines", "clients")))
    found = sweep.sweep(spans, total=sweep.ALL).withColumnsRenamed({"key": "nation_id", "open_amount": "open_cents"})
    return reading(found, *spans._reads)


SQL["op11_peak_concurrency"] = r"""
with ends as (
  select sale_id, max(epoch_us(shipped_at)) // 60000000 * 60 + 604800 as stop from sale_lines
  where sale_id is not null and shipped_at is not null group by 1),
homes as (select client_id, min(nation_id) as nation from clients where client_id is not null group by 1),
spans as (
  select coalesce(nation, -1) as nation, epoch_us(sold_at) // 60000000 * 60 as start, stop, coalesce(floor(100 * total + 0.5), 0)::bigint as cents
  from sales left join ends using (sale_id) left join homes using (client_id) where sold_at is not null),
open as (select * from spans where stop is null or stop > start),
moves as (
  select nation, start as t, 1 as n, cents as c from open union all select nation, stop, -1, -cents from open where stop is not null),
net as (
  select nation, t, sum(n) as n, sum(c) as c
  from (select * from moves union all select -2, t, n, c from moves) group by 1, 2 having sum(n) <> 0 or sum(c) <> 0),
run as (
  select nation, t, lead(t) over w as next_t, sum(n) over w as n_open, sum(c) over w as c_open
  from net window w as (partition by nation order by t))
select nation::int as nation_id, t::bigint as from_s, next_t::bigint as to_s, n_open::bigint as n_open, c_open::bigint as open_cents,
  (max(n_open) over (partition by nation order by t))::bigint as high_open, n_open = max(n_open) over (partition by nation) as is_peak
from run
"""


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


SQL["op12_conversation_repair"] = r"""
with recursive crc as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k:
    case when c % 2 = 1 then xor(3988292384, c // 2) else c // 2 end)) as t),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
      lambda x: ascii(x)::bigint)), lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256))) % 20 as kind
  from conversations, crc),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from (select *, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy from given)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
facts as (
  select *, left(role, 1) as c, rtrim(text, E' 	

') as t, row_number() over (partition by conv_id, role, text order by i) > 1 as later,
    lag(left(role, 1)) over (partition by conv_id order by i) as before
  from placed),
turns as (
  select *, t = '' as blank, t = '' or later as forced, (t <> '' and not later and right(t, 1) not in ('.', '!', '?'))::int as cut from facts),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
    count(*) filter (later and not blank) as duplicate, sum(cut) as truncated,
    count(*) filter (before is not null and before || c not in ('su', 'ua', 'au')) as illegal, max(i) as last
  from turns group by 1),
puts(q, more, line, q2) as (
  values (0, '', '', 0), (0, 'I', chr(10) || 'user:', 2), (0, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3),
    (1, '', '', 1), (1, 'I', chr(10) || 'user:', 2), (1, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 3),
    (2, '', '', 2), (2, 'I', chr(10) || 'assistant:', 3), (3, '', '', 3), (3, 'I', chr(10) || 'user:', 2)),
moves(letter, c, q, q1, cost, named) as (
  values ('K', 's', 0, 1, 0, null), ('K', 'u', 0, 2, 0, null), ('K', 'u', 1, 2, 0, null), ('K', 'u', 3, 2, 0, null), ('K', 'a', 2, 3, 0, null),
    ('R', null, 0, 2, 2, 'user'), ('R', null, 1, 2, 2, 'user'), ('R', null, 3, 2, 2, 'user'), ('R', null, 2, 3, 2, 'assistant'),
    ('D', null, 0, 0, 3, null), ('D', null, 1, 1, 3, null), ('D', null, 2, 2, 3, null), ('D', null, 3, 3, 3, null)),
best as (
  select conv_id, 0::bigint as i, q2 as q, {'cost': 2 * length(more), 'audit': more, 'lines': line} as way
  from (select distinct conv_id from conversations), puts where puts.q = 0
  union all
  select b.conv_id, t.i, p.q2, min({'cost': b.way.cost + m.cost + 2 * length(p.more) + case when m.letter <> 'D' then t.cut else 0 end,
    'audit': b.way.audit || m.letter || p.more,
    'lines': b.way.lines || case when m.letter = 'D' then '' else chr(10) || coalesce(m.named, t.role) || ':' || t.text end || p.line})
  from best b join turns t on t.conv_id is not distinct from b.conv_id and t.i = b.i + 1
  join moves m on m.q = b.q and (m.c is null or m.c = t.c) and (m.letter = 'D' or not t.forced) join puts p on p.q = m.q1
  group by b.conv_id, t.i, p.q2),
ended as (
  select b.conv_id, min(b.way) as way from best b left join counts c on c.conv_id is not distinct from b.conv_id
  where b.i = coalesce(c.last, 0) and b.q in (0, 3) group by 1)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, way.cost::bigint as cost, way.audit as audit,
  sha256(substr(way.lines, 2)) as repaired_sha256
from ended e left join counts c on c.conv_id is not distinct from e.conv_id
"""


@_query
def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


SQL["op13_source_mixing"] = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, text, '')), 1, 13))::bigint / 4503599627370496.0::double as draw
  from documents),
s as (
  select source, sum(size)::bigint as size, row_number() over (order by source nulls last) as k from d group by 1),
w as (select *, [5.0, 2.0, 1.0][((k - 1) % 3 + 1)::int]::double as weight, 2.0::double * size as most from s),
l as (
  select *, coalesce(sum(most) over before, 0) as limits, coalesce(sum(weight) over before, 0) as weights
  from w window before as (order by most / weight, k rows between unbounded preceding and 1 preceding)),
level as (
  select max((1.5::double * (select sum(size) from s) - limits) / ((select sum(weight) from w) - weights)) as level from l),
goal as (select source, size as source_size, least(most, weight * level) as target from w, level),
r as (
  select doc_id, d.size, source_size, target, case when source_size = 0 then 0 else target / source_size end as rate, draw
  from d join goal on goal.source is not distinct from d.source)
select doc_id, size::bigint as size, source_size, target, (floor(rate) + (draw < rate - floor(rate))::int)::int as copies,
  (size * (floor(rate) + (draw < rate - floor(rate))::int))::bigint as taken
from r
"""
