"""DuckDB SQL for the queries whose results SQL can state, from the definitions.

Token ids, decoded secrets and robust estimates are beyond SQL; those queries are tested against
brute-force versions instead.
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIX = rf"""
with sized as (
  select doc_id, source, cast(len({WORDS}) as bigint) as size from documents),
totals as (
  select source, cast(sum(size) as bigint) as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 as place
  from sized group by source),
capped as (
  select source, source_size, source_size * cast(2.0 as double) as cap,
         cast([3.0, 1.0, 2.0][place + 1] as double) as weight
  from totals),
levels as (
  select *, (sum(source_size) over () * cast(1.5 as double)
             - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                       rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by cap / weight, source nulls last
                                rows between current row and unbounded following) as level
  from capped),
targets as (
  select source, source_size, least(cap, max(level) over () * weight) as target,
         cast(('0x' || substr(md5('0/' || coalesce(source, '') || '/'
              || case when source is null then 'none' else 'some' end), 1, 5)) as bigint)
         / cast(1048576 as double) as off_set
  from levels),
ranked as (
  select *, row_number() over (partition by source order by size,
            md5('0/' || coalesce(cast(doc_id as varchar), '')), doc_id) as place
  from sized),
drawn as (
  select r.doc_id, r.source, r.size, t.source_size, t.target, t.off_set, r.place,
         case when t.source_size > 0 then t.target / t.source_size else 0 end as rate
  from ranked r join targets t on r.source is not distinct from t.source)
select doc_id, source, size, source_size, target,
       cast(floor(place * rate + off_set) - floor((place - 1) * rate + off_set) as bigint)
         as copies,
       cast(floor(place * rate + off_set) - floor((place - 1) * rate + off_set) as bigint) * size
         as taken
from drawn"""

REPEATS = rf"""
with worded as (select doc_id, {WORDS} as w from documents),
windows as (
  select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from worded where len(w) >= 13)),
firsts as (select gram, min(doc_id) as first from windows group by gram),
hits as (
  select distinct doc_id, unnest(range(i, i + 13)) as i
  from windows join firsts using (gram) where first < doc_id),
gone as (select doc_id, list(i) as places, count(*) as n from hits group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(array_to_string(
         case when n is null then w
              else list_filter(w, lambda x, i: not list_contains(places, i)) end, ' '), ''))
         as kept_sha256
from worded d left join gone g on d.doc_id = g.doc_id"""

NEAR = rf"""
with recursive worded as (select doc_id, {WORDS} as w from documents),
grams as (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ')
                               else array_to_string(list_slice(w, i, i + 4), ' ') end as gram
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i
        from worded where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from grams a join grams b on a.gram = b.gram and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select s.a, s.b, s.n = x.n and s.n = y.n as same
  from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
  where s.n >= 0.8 * (x.n + y.n - s.n)),
reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
groups as (select a, min(b) as low from reach group by a),
counts as (
  select a, count(*) as n, count(*) filter (same) as copies, min(b) filter (same) as low
  from links group by a)
select doc_id, least(doc_id, c.low) as class_id, cast(coalesce(copies, 0) as bigint) as n_copies,
       cast(coalesce(n, 0) as bigint) as n_links, least(doc_id, g.low) as group_id
from documents d left join counts c on c.a = d.doc_id left join groups g on g.a = d.doc_id"""

COVER = """
with recursive able as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from able a join able b
  on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.9),
reach(a, b) as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
found as (
  select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links,
         least(e.vec_id, (select min(b) from reach r where r.a = e.vec_id)) as component_id
  from embeddings e)
select *, vec_id = component_id as kept from found"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FOUR = " || ".join(
    f"substr('{_LETTERS}', cast((g >> {shift}) & 31 as integer) + 1, 1)" for shift in (15, 10, 5, 0)
)

WARC = f"""
with raw as (
  select page_id, encode(coalesce(html, '')) as payload from pages),
digests as (
  select page_id, octet_length(payload) as n, sha1(payload) as hex from raw),
firsts as (select hex, min(page_id) as first from digests group by hex)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string(list_transform(range(8), lambda i: list_transform(
         [cast(('0x' || substr(d.hex, cast(5 * i + 1 as integer), 5)) as bigint)],
         lambda g: {_FOUR})[1]), '') as payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from digests d join firsts f on d.hex = f.hex"""

#: crc32 of UTF-8 text ``x``, by a table ``codes`` (column ``t``) that a rule builds.
CRC_CODES = """
codes as (
  select list(c order by i) as t
  from (select i, list_reduce(list_prepend(cast(i as bigint), cast(range(8) as bigint[])),
          lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from (select unnest(range(256)) as i)))"""


def crc32(x: str) -> str:
    bytes_of = (
        f"list_transform(range(0, octet_length(encode({x}))), lambda i: "
        f"cast('0x' || substr(hex(encode({x})), cast(2 * i + 1 as integer), 2) as bigint))"
    )
    step = "lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as integer) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_of}), {step}), 4294967295)"


_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

IMPORTANCE = rf"""
with {CRC_CODES.strip()},
texts as (
  select row_number() over () as row_id, doc_id,
         regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w
  from documents
  union all
  select null, null, regexp_extract_all({_LOWERED}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')
  from benchmark),
places as (select row_id, w, unnest(range(1, len(w) + 1)) as i from texts),
grams as (
  select row_id, array_to_string(list_slice(w, i, i + n - 1), ' ') as gram
  from places, (select unnest([1, 2, 3]) as n) where i + n - 1 <= len(w)),
found as (select gram, row_id, count(*) as n from grams group by all),
buckets as (
  select gram, {crc32('gram')} % 10000 as bucket
  from (select distinct gram from found), codes),
counted as (
  select bucket, coalesce(sum(n) filter (row_id is not null), 0) as s,
         coalesce(sum(n) filter (row_id is null), 0) as t
  from found join buckets using (gram) group by bucket),
gains as (
  select bucket, floor(1000 * ln(((cast(t as double) + 1) * (sum(s) over () + 10000))
                                 / ((cast(s as double) + 1) * (sum(t) over () + 10000)))) as gain
  from counted),
weights as (
  select row_id, sum(n) as n_features, sum(n * gain) as weight
  from found join buckets using (gram) join gains using (bucket)
  where row_id is not null group by row_id),
scored as (
  select doc_id, len(w) as n_words, cast(coalesce(n_features, 0) as bigint) as n_features,
         cast(coalesce(weight, 0) as bigint) as weight,
         cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((cast('0x' || substr(
           sha256('42:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5)
           / cast(4294967296 as double)))) as bigint) as score
  from texts left join weights using (row_id) where row_id is not null),
ranked as (
  select *, case when n_words >= 20 then row_number() over (
           partition by n_words >= 20 order by score desc, doc_id nulls last, n_features) end as r,
         count(*) filter (n_words >= 20) over () as able
  from scored)
select doc_id, n_features, weight, score,
       case when r <= (5 * able) // 100 then r end as rank
from ranked"""

SPELLING = rf"""
with recursive {CRC_CODES.strip()},
runs as (
  select doc_id, run, count(*) as n
  from (select doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run
        from documents)
  where length(run) >= 7 group by all),
hashed as (
  select run, n, {crc32("coalesce(cast(doc_id as varchar), '') || ':' || run")} as h
  from runs, codes),
words as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run))
                                   || substr(run, h % length(run) + 2) else run end as word,
         cast(sum(n) as bigint) as n
  from hashed group by 1),
kept as (select word, n from words where length(word) >= 7 and n >= 2),
dropped as (
  select word, i, substr(word, 1, i) || substr(word, i + 2) as rest
  from (select word, unnest(range(length(word))) as i from kept)),
near as (
  select a.word, b.word as other
  from dropped a join dropped b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select d.word, k.word from dropped d join kept k on d.rest = k.word
  union select k.word, d.word from dropped d join kept k on d.rest = k.word),
ranked as (
  select near.word, other, o.n as other_n, count(*) over (partition by near.word) as n_near,
         row_number() over (partition by near.word order by o.n desc, other) as place
  from near join kept o on o.word = other),
formed as (
  select k.word, k.n, cast(coalesce(n_near, 0) as bigint) as n_near,
         case when other_n >= 10 * k.n then other end as form,
         case when other_n >= 10 * k.n then other_n end as form_n
  from kept k left join ranked r on r.word = k.word and place = 1),
steps(word, root, last) as (
  select word, word, form from formed
  union all
  select s.word, s.last, f.form from steps s join formed f on f.word = s.last),
roots as (select word, root from steps where last is null)
select word, form, root, n, n_near, form_n from formed join roots using (word)"""

SUFFIXES = """
with raw as (
  select row_number() over () as row_id, doc_id, hex(encode(coalesce(text, ''))) as h
  from documents),
places as (
  select row_id, i, hash(substr(h, cast(2 * i + 1 as integer), 400)) as code
  from (select row_id, h, unnest(range(length(h) // 2 - 199)) as i from raw)),
again as (select code from places group by code having count(*) > 1),
starts as (
  select row_id, i, i - lag(i) over (partition by row_id order by i) as gap
  from places join again using (code)),
numbered as (
  select row_id, i, sum(case when gap <= 200 then 0 else 1 end)
           over (partition by row_id order by i) as span
  from starts),
spans as (
  select row_id, span, min(i) as low, max(i) + 200 as high from numbered group by all),
gaps as (
  select row_id, low, high - low as n,
         coalesce(lag(high) over (partition by row_id order by low), 0) as from_byte
  from spans),
cut as (
  select s.row_id, count(*) as n_spans, sum(n) as n_removed, max(low + n) as tail,
         string_agg(substr(h, cast(2 * from_byte + 1 as integer), cast(2 * (low - from_byte) as integer)), ''
                    order by low) as kept
  from gaps s join raw using (row_id) group by s.row_id)
select doc_id, cast(length(h) // 2 as bigint) as n_bytes,
       cast(coalesce(n_removed, 0) as bigint) as n_removed,
       cast(coalesce(n_spans, 0) as bigint) as n_spans,
       sha256(unhex(case when c.row_id is null then h
                         else kept || substr(h, cast(2 * tail + 1 as integer)) end)) as kept_sha256
from raw r left join cut c using (row_id)"""

ORACLE_SQL = {
    "op2_mix": MIX,
    "op4_repeats": REPEATS,
    "op5_near_duplicates": NEAR,
    "op9_cover_tree": COVER,
    "op10_warc": WARC,
    "op11_importance": IMPORTANCE,
    "op12_spelling": SPELLING,
    "op13_suffixes": SUFFIXES,
}
