"""The operators applied to the test tables, each with the DuckDB SQL it is held against (none: see the reason)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from scribemill.functions import arrays as A
from scribemill.functions import metrics as M
from scribemill.functions import names as N
from scribemill.functions import speech as S
from scribemill.functions import text as T
from scribemill.operators import documents as D
from scribemill.operators import models, quality, sequence, splits, stats
from scribemill.operators.seen import SeenTexts
from scribemill.operators.tables import shared_folder, stored
from scribemill.plans import views as V
from scribemill.plans.views import LINES, PAIRS, PROBS, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Register a function (spark, folder) under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


FUSED = """runs as (select *, sum(case when text = p then 0 else 1 end) over (partition by file_id order by idx) as run from (select *, lag(text) over (partition by file_id order by idx) as p from subs)),
fused as (select file_id, cast(row_number() over (partition by file_id order by run) - 1 as int) as idx, start, "end", text from (select file_id, run, arg_min(start, idx) as start, arg_max("end", idx) as "end", first(text) as text from runs group by all) where "end" > start)"""
FILLED = """filled as (select *, "end" - start as duration, text = '<|silence|>' as is_silence from (
  select file_id, idx * 2 as o, b as start, start as "end", '<|silence|>' as text from (select *, coalesce(lag("end") over (partition by file_id order by idx), 0) as b from fused) where b <> start
  union all select file_id, idx * 2 + 1, start, "end", text from fused))"""


@query(f"with {LINES}, {FUSED} select * from fused")
def fuse_runs(spark, d):
    return sequence.fuse(V.subs(spark, d))


@query(f"""with {LINES}, {FUSED}, {FILLED} select file_id, cast(row_number() over (partition by file_id order by o) - 1 as int) as idx, start, "end", duration, text, is_silence from filled""")
def silence_fill(spark, d):
    return sequence.fill_silence(sequence.fuse(V.subs(spark, d), renumbered=False))


@query(f"""with {LINES}, s as (select *, coalesce(lag("end") over (partition by file_id order by idx), start) as b from (select *, start + 100 as start2 from subs)),
u as (select file_id, idx * 2 as o, b as start, start as "end", '<|silence|>' as text from s where b <> start union all select file_id, idx * 2 + 1, start, "end", text from s)
select file_id, cast(row_number() over (partition by file_id order by o) - 1 as int) as idx, start, "end", "end" - start as duration, text, text = '<|silence|>' as is_silence from u""")
def silence_fill_no_leadin(spark, d):
    return sequence.fill_silence(V.subs(spark, d).select("file_id", "idx", "start", "end", "text"), lead_in=False)


@query(f"""with {LINES}, {FUSED}, {FILLED} select file_id, count(*) as n_subs, cast(sum(duration) as bigint) as subs_duration,
cast(sum(case when is_silence then 0 else len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) end) as bigint) as n_words, avg(duration) as mean_duration,
0::bigint as n_duplicate, 0::bigint as duplicate_duration, 0::bigint as n_live, 0::bigint as live_duration, cast(count_if(is_silence) as bigint) as n_silence, cast(sum(case when is_silence then duration else 0 end) as bigint) as silence_duration from filled group by file_id""")
def sub_stats_per_file(spark, d):
    return stats.subtitle_stats(silence_fill(spark, d))


@query(f"""with {LINES}, m as (select *, "end" - start as d, contains(text, 'x') as duplicate, idx % 7 = 0 as live, idx % 3 = 0 or text = '' as silence from subs),
k as (select *, case when duplicate then 'd' when live then 'l' when silence then 's' else 'w' end as k, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) as w from m)
select file_id, count(*) as n_subs, cast(sum(d) as bigint) as subs_duration, cast(sum(case when k = 'w' then w else 0 end) as bigint) as n_words, avg(d) as mean_duration, cast(count_if(k = 'd') as bigint) as n_duplicate, cast(coalesce(sum(d) filter (k = 'd'), 0) as bigint) as duplicate_duration,
cast(count_if(k = 'l') as bigint) as n_live, cast(coalesce(sum(d) filter (k = 'l'), 0) as bigint) as live_duration, cast(count_if(k = 's') as bigint) as n_silence, cast(coalesce(sum(d) filter (k = 's'), 0) as bigint) as silence_duration from k group by file_id""")
def sub_stats_marked(spark, d):
    """Subtitles that are duplicates, live and silent at once count as the first of these."""
    rows = V.subs(spark, d).withColumns({"duration": F.col("end") - F.col("start"), "duplicate": F.contains("text", F.lit("x")), "live": F.col("idx") % 7 == 0, "is_silence": (F.col("idx") % 3 == 0) | (F.col("text") == "")})
    return stats.subtitle_stats(rows)


@query(f"""with {LINES}, {FUSED}, {FILLED}, f as (select file_id, sum(duration) as s, count_if(is_silence) as n, sum(case when is_silence then duration else 0 end) as q, sum(case when is_silence then 0 else len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) end) as w, count(*) as c from filled group by file_id)
select count(*) as n_files, cast(sum(c) as bigint) as n_subs, cast(sum(s) as bigint) as subs_duration, cast(sum(w) as bigint) as n_words, 0::bigint as n_duplicate, 0::bigint as duplicate_duration, 0::bigint as n_live, 0::bigint as live_duration, cast(sum(n) as bigint) as n_silence, cast(sum(q) as bigint) as silence_duration, cast(sum(s) - sum(q) as bigint) as net_duration from f""")
def corpus_totals(spark, d):
    return stats.corpus_stats(sub_stats_per_file(spark, d))


@query(f"""with {LINES}, r as (select file_id, idx * 10 + k as idx, array_to_string(string_split(text, ' ')[1:k], ' ') as text from (select *, unnest(range(1, 2 + idx % 4)) as k from lines)),
a as (select *, row_number() over w - 1 as pos, count(*) over (partition by file_id) as n, coalesce(cast(starts_with(text, lag(text) over w) as int), 0) as c from r window w as (partition by file_id order by idx)),
b as (select *, case when pos >= 3 then greatest(c, coalesce(lead(c) over w, 0)) else c end as m, list(c) over (partition by file_id order by idx rows between unbounded preceding and unbounded following) as cs from a window w as (partition by file_id order by idx)),
e as (select *, case when pos < 3 then cs[1] + cs[2] + cs[3] else coalesce(sum(m) over (partition by file_id order by idx rows between 3 preceding and 1 preceding), 0) end as p,
 case when pos = 0 then cs[4] when pos < 3 then greatest(cs[4], cs[5]) else m end as o,
 case when pos < 3 then coalesce(list_sum(cs[5:4 + pos]), 0) else coalesce(sum(c) over (partition by file_id order by idx rows between 1 following and 3 following), 0) end as f from b)
select file_id, cast(idx as int) as idx, text, n > 6 and not (p = 3 and o = 0 and f = 0) and p + o + f >= 3 as live from e""")
def live_mark(spark, d):
    return sequence.mark_live(V.rollup_subs(spark, d))


MARKS = """l as (select *, lead(seen) over w as nx, sum(case when seen then 0 else 1 end) over w as run, row_number() over w - 1 as pos, count(*) over (partition by file_id) as n from s window w as (partition by file_id order by idx)),
g as (select *, seen and count(*) over (partition by file_id, run, seen) >= 4 as long from l),
h as (select *, coalesce(lead(long) over (partition by file_id order by idx), false) as nxt, bool_or(long and pos = 0) over (partition by file_id) as wraps from g)
select file_id, idx, text, nxt or (long and pos >= n - 4) or (wraps and pos = n - 1) as duplicate from h"""


@query(f"with {LINES}, s as (select *, row_number() over (partition by text order by file_id, idx) > 1 as seen from lines), {MARKS}")
def dup_mark_global(spark, d):
    return sequence.mark_duplicates(V.doc_lines(spark, d).select("file_id", "idx", "text"))


@query(f"with {LINES}, s as (select *, row_number() over (partition by text order by file_id, idx) > 1 as seen from lines), {MARKS}")
def dup_mark_runs(spark, d):
    """The same marks from two runs, the lower half of the files and then the upper one, with the texts kept between them."""
    rows = V.doc_lines(spark, d).select("file_id", "idx", "text")
    half = table(spark, d, "documents").agg(F.floor((F.min("doc_id") + F.max("doc_id")) / 2)).first()[0] or 0
    seen = SeenTexts(spark, f"{shared_folder(spark)}/seen-{uuid.uuid4().hex}", "bigint", buckets=8)
    first, second = rows.where(F.col("file_id") <= half), rows.where(F.col("file_id") > half)
    marked = stored(sequence.mark_duplicates(first, seen=seen, run="1"), "run")
    seen.add(first, "1")
    return marked.unionByName(sequence.mark_duplicates(second, seen=seen, run="2"))


@query(f"with {LINES}, s as (select *, row_number() over (partition by file_id, text order by idx) > 1 as seen from lines), {MARKS}")
def dup_mark_file(spark, d):
    return sequence.mark_duplicates(V.doc_lines(spark, d).select("file_id", "idx", "text"), scope="file")


@query(f"""with {LINES}, s as (select *, row_number() over (partition by text order by file_id, idx) > 1 as seen from lines),
l as (select *, sum(case when seen then 0 else 1 end) over (partition by file_id order by idx) as run from s)
select file_id, idx, text, seen and count(*) over (partition by file_id, run, seen) >= 4 as duplicate from l""")
def dup_mark_exact(spark, d):
    return sequence.mark_duplicates(V.doc_lines(spark, d).select("file_id", "idx", "text"), offset=False)


def _marked(spark, d):
    """Texts move once, by file: which ones were met before is found from rows that digests stand for them in."""
    digests = sequence.fuse(V.subs(spark, d, digests=True), renumbered=False)
    digests = sequence.fill_silence(digests, silence=sequence.digest(F.lit(sequence.SILENCE)))
    return sequence.mark_duplicates(silence_fill(spark, d), digests=digests.select("file_id", "idx", F.col("text").alias("digest")))


MARKED = f"""{FUSED}, {FILLED}, fl as (select file_id, cast(row_number() over (partition by file_id order by o) - 1 as int) as idx, start, "end", text from filled),
s as (select *, row_number() over (partition by text order by file_id, idx) > 1 as seen from fl), {MARKS[: MARKS.rindex("select file_id")].rstrip()},
m as (select file_id, idx, start, "end", text, nxt or (long and pos >= n - 4) or (wraps and pos = n - 1) as marked, n from h)"""
#: rows of each file one after the other, and one behind the last; a step takes a row, and is done with a chunk or not
PACKED = """o as (select file_id, idx - 1 as i, start, "end" as e, text, marked from m where idx > 0 and idx < n - 1 union all select file_id, max(n) - 2, null, null, null, null from m group by file_id having max(n) > 2),
pk as (select least, most, file_id, -1::bigint as i, 0::bigint as total, []::struct(a bigint, b bigint, t varchar)[] as pieces, []::bigint[] as ids, 0::bigint as cs, 0::bigint as ce, null::struct(s bigint, e bigint, d bigint, pieces struct(a bigint, b bigint, t varchar)[], ids bigint[]) as done from (select distinct file_id from o), ranges
union all
select least, most, file_id, oi, case kind when 'add' then total + d when 'flush' then d when 'fill' then rest else 0 end,
  case kind when 'add' then list_append(pieces, {'a': total, 'b': total + d, 't': t}) when 'flush' then [{'a': 0::bigint, 'b': d, 't': t}] when 'fill' then [{'a': 0::bigint, 'b': rest, 't': t}] else [] end,
  case kind when 'add' then list_append(ids, id) when 'flush' then [id] when 'fill' then [id] else [] end,
  case kind when 'add' then case when len(pieces) = 0 then s else cs end when 'flush' then s when 'fill' then oe - rest else 0 end, case when kind in ('add', 'flush', 'fill') then oe else 0 end,
  case when kind = 'flush' or kind in ('end', 'mark') and total >= least then {'s': cs, 'e': ce, 'd': total, 'pieces': pieces, 'ids': ids}
    when kind = 'fill' then {'s': case when len(pieces) = 0 then s else cs end, 'e': s + most - total, 'd': most, 'pieces': pieces, 'ids': list_append(ids, id)} end
from (select *, (d - (most - total)) - greatest(0, (d - (most - total) + most - 1) // most - 1) * most as rest from (
  select p.*, o.i as oi, o.start as s, o.e as oe, o.e - o.start as d, o.text as t, case when o.text = '<|silence|>' then -o.i else o.i end as id,
    case when o.text is null then 'end' when o.marked then 'mark' when o.e - o.start + p.total <= p.most then 'add' when o.text = '<|silence|>' then 'fill' else 'flush' end as kind from pk p join o on o.file_id = p.file_id and o.i = p.i + 1))),
ch as (select least, most, file_id, i, done, list_filter(done.pieces, lambda x: x.t <> '<|silence|>') as said from pk where done is not null)
select least, most, file_id, cast(row_number() over (partition by least, most, file_id order by i) - 1 as int) as chunk, done.s as start, done.e as "end", done.d as duration, array_to_string(list_transform(said, lambda x: x.t), ' ') as text,
  array_to_string(list_transform(said, lambda x: '<' || (x.a // 20 * 20 // 1000) || '.' || lpad((x.a // 20 * 2 % 100)::varchar, 2, '0') || '>' || replace(x.t, chr(10), ' ') || '<' || (x.b // 20 * 20 // 1000) || '.' || lpad((x.b // 20 * 2 % 100)::varchar, 2, '0') || '>'), '') as text_timestamps, array_to_string(done.ids, ',') as sub_ids
from ch where array_to_string(list_transform(said, lambda x: x.t), ' ') <> ''"""


def _plain_ids(chunks):
    return chunks.withColumn("sub_ids", F.array_join(F.col("sub_ids").cast("array<string>"), ","))


@query(f"with recursive {LINES}, {MARKED}, ranges(least, most) as (values (10000, 30000)), {PACKED}".replace("select least, most, file_id, cast(row_number()", "select file_id, cast(row_number()"))
def chunk_pack_30s(spark, d):
    return _plain_ids(sequence.pack_chunks(_marked(spark, d)))


@query(f"with recursive {LINES}, {MARKED}, ranges(least, most) as (values (1, 5000), (1, 30000)), {PACKED}")
def chunk_pack_many(spark, d):
    return _plain_ids(sequence.pack_many(_marked(spark, d), [(1, 5000), (1, 30_000)]))


@query()  # patterns that DuckDB's expressions lack; tested against a state machine written by itself
def chunk_pack_exclude(spark, d):
    return sequence.pack_chunks(silence_fill(spark, d), flush_marked=False, exclude=("|",), remove=(r"\w+ing\b", "  +"))


@query(f"""with recursive {LINES}, o as (select *, row_number() over (partition by file_id order by idx) as k from subs),
b as (select file_id, k, idx, start, "end", 0 as bucket, start as anchor from o where k = 1 union all
 select o.file_id, o.k, o.idx, o.start, o."end", case when o."end" - b.anchor >= 30000 then b.bucket + 1 else b.bucket end, case when o."end" - b.anchor >= 30000 then o.start else b.anchor end from b join o on o.file_id = b.file_id and o.k = b.k + 1)
select file_id, idx, start, "end", bucket, "end" - anchor as since from b""")
def bucket_30s(spark, d):
    return sequence.bucket_spans(V.subs(spark, d).select("file_id", "idx", "start", "end"))


@query(f"""with {LINES}, b as (select *, cast(start // 30000 as int) as bucket from subs)
select file_id, idx, start - min(start) over w as start_relative, "end" - min(start) over w as end_relative, max("end") over w - min(start) over w as duration_bucket,
 string_agg(text, ' ' order by idx) over (partition by file_id, bucket order by idx rows between unbounded preceding and unbounded following) as text_bucket from b window w as (partition by file_id, bucket)""".replace("string_agg(text, ' ' order by idx) over", "string_agg(text, ' ') over"))
def bucket_relative_times(spark, d):
    rows = V.subs(spark, d).withColumn("bucket", F.floor(F.col("start") / 30_000).cast("int"))
    return sequence.bucket_texts(rows).select("file_id", "idx", "start_relative", "end_relative", "duration_bucket", "text_bucket")


@query("""with o as (select o_orderkey, cast(trunc(o_totalprice) as bigint) as dur, o_custkey % 50 as k from orders), s as (select k, list({'o': o_orderkey, 'd': dur} order by o_orderkey) as x from o group by k),
f as (select k, list_reduce(list_transform(x, lambda r: {'s': 1::bigint, 't': 0::bigint, 'd': r.d, 'out': [{'o': r.o, 'shard': 1}]}), lambda a, r: {'s': case when a.t + r.d > 10000000 then a.s + 1 else a.s end, 't': case when a.t + r.d > 10000000 then 0 else a.t + r.d end, 'd': r.d, 'out': list_append(a.out, {'o': r.out[1].o, 'shard': a.s::int})}, {'s': 1::bigint, 't': 0::bigint, 'd': 0::bigint, 'out': [{'o': -1::bigint, 'shard': 0}]}) as r from s),
u as (select k, unnest(r.out) as m from f) select k, m.o as o_orderkey, m.shard as shard from u where m.o >= 0""")
def shard_by_duration(spark, d):
    rows = table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("k"), "o_orderkey", F.col("o_totalprice").cast("long").alias("dur"))
    return sequence.shard_by_duration(rows, "k", "o_orderkey", "dur", 10_000_000).select("k", "o_orderkey", "shard")


@query("""with g as (select source, count(*) as n, md5(source) as h from documents group by source), o as (select list({'s': source, 'n': n} order by h) as x, sum(n) as t from g),
f as (select t, list_reduce(list_transform(x, lambda r: {'a': 0::double, 'n': r.n, 'out': [{'s': r.s, 'n': r.n, 'split': ''}]}), lambda a, r: {'a': case when a.a + r.n < 0.2 * t then a.a + r.n else a.a end, 'n': r.n, 'out': list_append(a.out, {'s': r.out[1].s, 'n': r.n, 'split': case when a.a + r.n < 0.1 * t then 'validation' when a.a + r.n < 0.2 * t then 'test' else 'train' end})}, {'a': 0::double, 'n': 0::bigint, 'out': [{'s': '', 'n': 0::bigint, 'split': ''}]}) as r from o)
select m.s as source, m.n as n, m.split as split from (select unnest(r.out) as m from f) where m.split <> ''""")
def greedy_group_split(spark, d):
    groups = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n")).withColumn("h", F.md5("source"))
    return splits.greedy_group_split(groups, "h", validation=0.1, test=0.2).drop("h")


@query("""select conv_id, turn, case when turn % 3 <> 2 and lag(turn) over w = turn - 1 then lag(text) over w end as previous_text from conversations window w as (partition by conv_id order by turn)""")
def prev_text(spark, d):
    rows = table(spark, d, "conversations").withColumns({"start": F.col("turn") * 10, "end": F.col("turn") * 10 + F.when(F.col("turn") % 3 == 1, 9).otherwise(10)})
    return sequence.previous_text(rows, "conv_id", "turn").select("conv_id", "turn", "previous_text")


@query("""with k as (select source, lang, min(doc_id) as doc_id from documents group by source, lang) select * from k where doc_id < (select max(doc_id) from k)""")
def keep_first_drop_last(spark, d):
    return sequence.first_rows(table(spark, d, "documents"), ["source", "lang"], "doc_id").select("source", "lang", "doc_id")


@query("""with b as (select source as file_id, n_chars as p0, doc_id as bucket, lang as language, quality from documents left join labels using (doc_id)),
w as (select *, lag(bucket) over (partition by file_id order by bucket) = bucket - 1 and lag(language) over (partition by file_id order by bucket) = 'en' as ok from b)
select file_id, bucket, language from w where (language = 'en' and coalesce(quality, 0) > 0.5) or coalesce(ok, false)""")
def language_fallback(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rows = rows.select(F.col("source").alias("file_id"), F.col("doc_id").alias("bucket"), F.col("lang").alias("language"), F.coalesce("quality", F.lit(0)).cast("double").alias("p"))
    return sequence.language_fallback(rows, "en").drop("p")


# Text functions


def _sql_replace(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, '{a}', '{b}')"
    return x


@query(f"with {LINES} select file_id, idx, {_sql_replace('text', T.CORRECTIONS + T.ABBREVIATIONS + T.SYMBOLS)} as expanded from lines")
def abbrev_expand(spark, d):
    return V.doc_lines(spark, d).select("file_id", "idx", T.expand_abbreviations(F.col("text")).alias("expanded"))


@query(f"with {LINES} select file_id, idx, translate(text, '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~', '') as bare from lines")
def punct_delete(spark, d):
    return V.doc_lines(spark, d).select("file_id", "idx", T.delete_punctuation(F.col("text")).alias("bare"))


@query(r"select doc_id, replace(replace(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'), '- -', ' '), '– –', ' ') as cleaned from documents")
def clean_subtitle(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_subtitle(F.col("text")).alias("cleaned"))


@query(r"select doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '')) as n_words from documents".replace("len(", "cast(len(").replace("<> ''))", "<> '')) as int)"))
def word_count(spark, d):
    return table(spark, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


@query(r"select page_id, regexp_replace('<' || (page_id % 30) || '.' || lpad((page_id % 100)::varchar, 2, '0') || '>' || url, '<(\d{1,2}\.\d{2})>', '<|\1|>', 'g') as t from pages")
def timestamp_token_rewrite(spark, d):
    marked = F.concat(F.lit("<"), (F.col("page_id") % 30).cast("string"), F.lit("."), F.lpad((F.col("page_id") % 100).cast("string"), 2, "0"), F.lit(">"), F.col("url"))
    return table(spark, d, "pages").select("page_id", T.timestamp_tokens(marked).alias("t"))


@query(r"select page_id, regexp_replace(html, '<[^>]*?>', '', 'g') as bare from pages")
def tag_strip(spark, d):
    return table(spark, d, "pages").select("page_id", T.without_tags(F.col("html")).alias("bare"))


@query()  # lookaround, NFKC and number words are not in DuckDB; tested against plain Python
def clean_text(spark, d):
    return V.dealt_out(table(spark, d, "pages").select("page_id", "html"), "page_id").select("page_id", T.clean_text(F.col("html"), cues=True).alias("cleaned"))


@query()  # as above
def normalize_text(spark, d):
    return V.doc_lines(spark, d, dealt=True).select("file_id", "idx", T.normalize_text(F.col("text")).alias("plain"), T.normalize_text_svt(F.col("text")).alias("svt"))


@query(r"select doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{N}\p{M}_\s]', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) as plain from documents")
def eval_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalize_for_scores(F.col("text")).alias("plain"))


@query(f"""with {LINES} select file_id, idx, '<' || (start // 20 * 2 // 100) || '.' || lpad(cast(start // 20 * 2 % 100 as varchar), 2, '0') || '>' || replace(text, chr(10), ' ') || '<' || ("end" // 20 * 2 // 100) || '.' || lpad(cast("end" // 20 * 2 % 100 as varchar), 2, '0') || '>' as t from subs""")
def timestamped_text(spark, d):
    return V.subs(spark, d).select("file_id", "idx", F.concat(T.seconds_token(F.col("start")), F.replace("text", F.lit("\n"), F.lit(" ")), T.seconds_token(F.col("end"))).alias("t"))


# Numbers, arrays and maps


@query(f"""with {LINES} select file_id, idx, start // 20 * 20 as floored, cast(trunc("end" / 1000.0::double * 16000) as bigint) as frames, start // 3600000 as h, start // 60000 % 60 as m, start // 1000 % 60 as s, start % 1000 * 1000 as us from subs""")
def ms_time_fields(spark, d):
    rows = V.subs(spark, d).select("file_id", "idx", A.floor20(F.col("start")).alias("floored"), A.frames(F.col("end")).alias("frames"), A.clock(F.col("start")).alias("c"))
    return rows.select("file_id", "idx", "floored", "frames", "c.*")


@query(f"with {PROBS}, r as (select doc_id, list_sort(list_transform(p, lambda x: {{'n': -x.p, 'l': x.l}})) as r from probs) select doc_id, list_transform(r, lambda x: x.l)[1] as best, array_to_string(list_sort(list_distinct(list_append(list_transform(r[1:3], lambda x: x.l), 'sv'))), ',') as top from r")
def top_languages(spark, d):
    rows = V.language_probs(spark, d)
    return rows.select("doc_id", A.likeliest(F.col("probs")).alias("best"), F.array_join(F.array_sort(F.map_keys(A.top_languages(F.col("probs"), 3))), ",").alias("top"))


@query("""with e as (select vec_id, list_transform(embedding, lambda x: x::double) as x from embeddings), z as (select vec_id, list_transform(x, lambda v: exp(v - list_max(x))) as z from e)
select vec_id, round(z[1] / list_sum(z), 9) as p, round(z[1] / list_sum(z[1:8]), 9) as masked from z""")
def softmax(spark, d):
    x = F.transform("embedding", lambda v: v.cast("double"))
    first = F.transform("embedding", lambda v, i: i < 8)
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding"), F.round(F.get(A.softmax(x), F.lit(0)), 9).alias("p"))
    # the masked softmax scales by the maximum of what it keeps, which cancels
    return rows.select("vec_id", "p", F.round(F.get(A.softmax(x, first), F.lit(0)), 9).alias("masked"))


@query("select vec_id, cast(len(embedding[3:greatest(vec_id % 40, 2)]) as int) as n, coalesce(round(list_sum(list_transform(embedding[3:greatest(vec_id % 40, 2)], lambda v: v::double)), 6), 0) as total from embeddings")
def audio_slice(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", A.audio_slice(F.col("embedding"), F.lit(2), F.col("vec_id") % 40).alias("x"))
    return rows.select("vec_id", F.size("x").alias("n"), F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("total"))


@query("select vec_id, 100 as n, round(list_sum(list_transform(embedding, lambda v: v::double)), 6) as total from embeddings")
def pad_batch(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", A.padded(F.col("embedding"), F.lit(100)).alias("x"))
    return rows.select("vec_id", F.size("x").alias("n"), F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double")), 6).alias("total"))


@query(f"""with v as (select vec_id, list_transform(embedding, lambda x: abs(x::double)) as m from embeddings), s as (select vec_id, list_transform(m, lambda x: greatest(x / list_max(m), 1e-10)) as a from v),
l as (select vec_id, ln(list_sum(a) / len(a)) - list_sum(list_transform(a, lambda x: ln(x))) / len(a) as level, {A.SNR_RATIOS}::double[] as r from s), p as (select *, list_max(list_filter(range(1, 122), lambda i: r[i] < level)) as at_ from l)
select vec_id, round(case when at_ is null then -20.0::double when at_ = 121 then 100.0::double else at_ - 21 + (level - r[at_]) / (r[at_ + 1] - r[at_]) end, 4) as snr from p""")
def wada_snr(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.round(A.snr_db(F.col("embedding")), 4).alias("snr"))


@query(f"with {LINES}, t as (select file_id, idx, list_prepend('<s>', w[greatest(len(w) - 5, 1):]) as p from (select *, list_filter(string_split(text, ' '), lambda x: x <> '') as w from lines)) select file_id, idx, cast(len(p) as int) as n, array_to_string(p, ' ') as prompt from t".replace("greatest(len(w) - 5, 1):", "greatest(len(w) - 5, 1):len(w)"))
def prompt_truncate(spark, d):
    p = A.prompt(F.filter(F.split("text", " "), lambda x: x != ""), F.lit("<s>"), 7)
    return V.doc_lines(spark, d).select("file_id", "idx", F.size(p).alias("n"), F.array_join(p, " ").alias("prompt"))


@query(f"with {PROBS} select doc_id, case when doc_id % 2 = 0 then 'a,b' else 'b' end as models, case when doc_id % 3 = 0 then 'b' else 'a,b' end as appended from probs")
def map_and_list_upsert(spark, d):
    rows = V.language_probs(spark, d)
    old = F.when(F.col("doc_id") % 2 == 0, F.create_map(F.lit("a"), F.col("probs")))
    entry = lambda m: F.struct(F.lit(m).alias("model"), F.lit("t").alias("text"))
    entries = F.when(F.col("doc_id") % 3 == 0, F.array(entry("b"))).otherwise(F.array(entry("a")))
    out = A.list_upsert(entries, entry("b"))
    return rows.select("doc_id", F.array_join(F.array_sort(F.map_keys(A.map_upsert(old, F.lit("b"), F.col("probs")))), ",").alias("models"), F.array_join(F.transform(out, lambda e: e["model"]), ",").alias("appended"))


# Scores


@query()  # DuckDB's levenshtein counts bytes, and a line's distinct words do not fit into one; tested against plain Python
def wer_pairs(spark, d):
    rows = V.pairs(spark, d).where("ref <> ''")
    return rows.select("pair_id", M.wer(F.col("ref"), F.col("hyp_a")).alias("wer_a"), M.wer(F.col("ref"), F.col("hyp_b")).alias("wer_b"))


@query(f"""with {LINES}, {PAIRS} select pair_id, case when length(ref) = 0 and length(hyp_b) = 0 then 0 else levenshtein(left(ref, 10), left(hyp_b, 10)) / greatest(length(left(ref, 10)), length(left(hyp_b, 10)))::double end as head,
case when length(ref) = 0 and length(hyp_b) = 0 then 0 else levenshtein(right(ref, 10), right(hyp_b, 10)) / greatest(length(right(ref, 10)), length(right(hyp_b, 10)))::double end as tail, levenshtein(ref, hyp_a) / nullif(length(ref), 0)::double as cer from pairs""")
def cer_head_tail(spark, d):
    a, b = F.col("ref"), F.col("hyp_b")
    return V.pairs(spark, d).select("pair_id", M.edge_cer(a, b).alias("head"), M.edge_cer(a, b, tail=True).alias("tail"), M.cer(a, F.col("hyp_a")).alias("cer"))


@query()  # smoothing multiplies logarithms; tested against plain Python
def bleu_scores(spark, d):
    a, b = F.col("ref"), F.col("hyp_b")
    return V.pairs(spark, d).select("pair_id", *(F.round(x, 6).alias(n) for x, n in ((M.bleu(a, b), "bleu"), (M.bleu(a, b, M.RECALL_WEIGHTS), "bleu_long"), (M.rouge(a, F.col("hyp_a")), "rouge"))))


@query()  # no longest common subsequence in DuckDB; tested against plain Python
def fuzzy_first_last(spark, d):
    first, last = (f(F.col("ref"), F.col("hyp_a")) for f in (M.first_ratio, M.last_ratio))
    return V.pairs(spark, d).select("pair_id", F.round(first, 6).alias("first"), F.round(last, 6).alias("last"))


@query()  # as wer_pairs
def macro_wer(spark, d):
    rows = V.pairs(spark, d).where("ref <> ''").withColumn("wer", M.wer(F.col("ref"), F.col("hyp_b")))
    return rows.groupBy("source").agg(F.round(F.avg("wer"), 9).alias("wer"), F.count("*").alias("n"))


@query()  # no shortest edit script in DuckDB; tested against a table of longest common subsequences
def ndiff_html(spark, d):
    return V.pairs(spark, d).select("pair_id", T.difference_html(F.col("ref"), F.col("hyp_b")).alias("diff"))


@query()  # normalisation and smoothing as above; tested against plain Python
def stages_of_texts(spark, d):
    rows = quality.with_metrics(V.pairs(spark, d), "ref", "hyp_a", "hyp_b")
    return rows.select("pair_id", *(F.round(c, 6).alias(c) for c in SCORES), *(c.alias(k) for k, c in quality.general_stages().items()))


@query()  # as above
def chunk_scores(spark, d):
    rows = V.pairs(spark, d).select("pair_id", T.normalize_text(F.col("ref")).alias("a"), T.normalize_text(F.col("hyp_b")).alias("b"))
    return rows.select("pair_id", quality.chunk_scores(F.col("a"), F.col("b"), F.lit("wav2vec2")).alias("s")).select("pair_id", "s.*")


# Quality stages. Scores are thousandths made from md5, so that both engines have the same numbers.

SCORES = ["w_bleu", "v_bleu", "w_rouge", "v_rouge", "w_head", "w_tail", "v_head", "v_tail", "w_wer", "v_wer", "w_first", "w_last", "v_first", "v_last"]
SCORED = "sc as (select doc_id, source, n_chars, (('0x' || substr(md5(doc_id || 'run'), 1, 4))::int % 2) = 1 as as_run, (('0x' || substr(md5(doc_id || 'silence'), 1, 4))::int % 10) = 0 as is_silence, " + ", ".join(
    f"(('0x' || substr(md5(doc_id || '{x}'), 1, 4))::int % 1001) / {10.0 if x.endswith(('first', 'last')) else 1000.0}::double as {x}" for x in SCORES
) + " from documents)"


def scored(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    number = lambda x: F.conv(F.substring(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(x))), 1, 4), 16, 10).cast("int")
    scores = {x: number(x) % 1001 / (10.0 if x.endswith(("first", "last")) else 1000.0) for x in SCORES}
    return docs.withColumns({"as_run": number("run") % 2 == 1, "is_silence": number("silence") % 10 == 0, **scores})


def _stages(name: str, stages, sql: dict[str, str]) -> None:
    def run(spark, d):
        return scored(spark, d).select("doc_id", *(c.alias(k) for k, c in stages().items()))

    run.__name__ = name
    query(f"with {SCORED} select doc_id, " + ", ".join(f"{v} as {k}" for k, v in sql.items()) + " from sc")(run)


_TAIL = {"stage2_whisper": "w_bleu > 0.8 and w_wer < 0.2", "stage2_whisper_timestamps": "w_bleu > 0.8 and w_wer < 0.2 and w_first >= 80 and w_last >= 80", "stage1_wav2vec": "w_first >= 80 and w_last >= 80 and v_first >= 80 and v_last >= 80 and w_wer < 0.2 and v_wer < 0.2"}
_stages("stage_filters_scorer", quality.scorer_stages, {"stage1_whisper": "v_bleu > 0.4 or w_bleu > 0.4", **_TAIL})
_stages("stage_filters_live", lambda: quality.scorer_stages(live_aware=True), {"stage1_whisper": "greatest(v_bleu, w_bleu) > case when as_run then 0.4 else 0.11 end", **_TAIL})
for _name, (_s, _b, _r, _h, _t, _tb, _wh, _wt, _vh, _vt) in quality.THRESHOLDS.items():
    _stages(
        f"filter_general_{_name}",
        lambda n=_name: quality.general_stages(n),
        {
            "stage1": f"w_bleu >= {_s} or is_silence",
            "stage2": f"(w_head <= {_h} and w_tail <= {_t} and w_bleu >= {_b} and w_rouge >= {_r}) or is_silence",
            "stage_wav2vec2": f"(greatest(w_head, v_head) <= {_h} and greatest(w_tail, v_tail) <= {_t} and least(w_bleu, v_bleu) >= {_b} and least(w_rouge, v_rouge) >= {_r}) or (v_bleu >= 0.85 and v_rouge >= 0.85 and w_head <= {_wh} and w_tail <= {_wt})",
            "stage2_whisper_timestamps": f"(w_head <= {_wh} and w_tail <= {_wt} and v_head <= {_vh} and v_tail <= {_vt} and w_bleu >= {_tb}) or is_silence",
        },
    )
_stages(
    "filter_svt",
    quality.svt_stages,
    {
        "stage1": "w_bleu >= case when as_run then 0.4 else 0.15 end or is_silence",
        "stage2": "(least(w_bleu, w_rouge) >= case when as_run then 0.9 else 0.7 end and greatest(w_head, w_tail) <= 0.2) or is_silence",
        "stage2_svt": "case when as_run then w_bleu >= 0.3 and greatest(w_head, w_tail) <= 0.3 else w_bleu >= 0.2 and greatest(w_head, w_tail) <= 0.4 end",
        "stage_wav2vec2": "greatest(w_head, w_tail, v_head, v_tail) <= 0.2 and case when as_run then w_bleu >= 0.9 and w_rouge > 0.9 else w_bleu >= 0.8 and w_rouge > 0.8 end",
        "stage2_whisper_timestamps": "greatest(w_head, w_tail) <= 0.2 and greatest(v_head, v_tail) <= 0.4 and w_bleu >= case when as_run then 0.8 else 0.6 end",
    },
)
ORACLES["filter_svt"] = ORACLES["filter_svt"].replace("<= 0.4 end as stage2_svt", "<= 0.4 end or is_silence as stage2_svt")


@query(f"with {SCORED}, x as (select *, bool_and(w_bleu > 0.02) over (partition by source, doc_id // 20) as ok from sc) select doc_id, source from x where ok")
def file_atomic_scores(spark, d):
    rows = scored(spark, d).withColumn("file_id", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 20)))
    return quality.whole_files(rows, F.col("w_bleu") > 0.02).select("doc_id", "source")


@query("""with o as (select o_orderkey, o_custkey % 7 = 0 as short, md5('42:' || o_orderkey) as h from orders), r as (select *, row_number() over (partition by short order by h, o_orderkey) as k, count(*) over (partition by short) as n, count(*) over () as t from o)
select o_orderkey, short from r where not short or k <= round_even(n * 0.45, 0)""")
def subsample_short_exact(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 7 == 0).alias("short"))
    return quality.share_of_short(rows, F.col("short"), 0.45, "o_orderkey")


@query(f"""with {SCORED}, f as (select sc.*, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) as n from sc join (select doc_id as d, text from documents) on d = doc_id where n_chars between 500 and 4000)
select doc_id from f where n + 4 <= 448 and ((w_head <= 0.2 and w_tail <= 0.2 and w_bleu >= 0.8 and w_rouge >= 0.8) or is_silence)""")
def filter_dataset(spark, d):
    """Labels are a number for each word; of documents with up to 4000 characters some have too many."""
    words = lambda c: F.transform(T.split_words(c), lambda w: (F.crc32(w) % 50_000).cast("int"))
    texts = table(spark, d, "documents").select("doc_id", "text", F.col("text").alias("text_timestamps"))
    rows = scored(spark, d).join(S.with_labels(texts, words, [0, 1], 2, 3).drop("labels", "labels_timestamps", "text", "text_timestamps"), "doc_id")
    rows = rows.withColumns({"input_length": F.col("n_chars"), "duration": F.lit(1.0)})
    return quality.filter_dataset(rows, "default", "stage2", length=(500, 4000), key="doc_id").select("doc_id")


# Statistics


@query(f"with {SCORED}, l as (unpivot (select doc_id, source, n_chars, w_bleu >= 0.4 as stage1, w_bleu >= 0.8 as stage2 from sc) on stage1, stage2 into name stage value value) select stage, value, count(*) as n, cast(sum(n_chars) as bigint) as duration, count(distinct source) as n_files from l group by stage, value")
def stage_true_false_xtab(spark, d):
    rows = scored(spark, d).withColumns({"stage1": F.col("w_bleu") >= 0.4, "stage2": F.col("w_bleu") >= 0.8})
    return stats.stage_table(rows, ["stage1", "stage2"], "n_chars", "source")


@query(f"with {SCORED} select source, count(*) as n, cast(count_if(w_bleu >= 0.4) as bigint) as n_stage1, cast(count_if(not w_bleu >= 0.4) as bigint) as n_not_stage1 from sc group by source")
def program_stage_counts(spark, d):
    return stats.group_stage_counts(scored(spark, d).withColumn("stage1", F.col("w_bleu") >= 0.4), "source", ["stage1"])


SHARDS = "sh as (select source, count(*) as n, cast(count_if(n_chars % 10 = 0) as bigint) as n_silence, count(nullif(lang, 'en')) as n_previous_text, cast(sum(n_chars) as bigint) as n_words, cast(sum(n_chars * 2) as bigint) as n_tokens, sum(n_chars) / 3600000::double as duration_hours, sum(case when n_chars % 10 = 0 then n_chars else 0 end) / 3600000::double as duration_hours_silence from documents group by source)"


@query(f"with {SHARDS} select * from sh")
def shard_stats(spark, d):
    rows = table(spark, d, "documents").select("source", F.expr("n_chars % 10 = 0").alias("is_silence"), F.expr("nullif(lang, 'en')").alias("previous_text"), F.col("n_chars").alias("n_words"), (F.col("n_chars") * 2).alias("n_tokens"), F.col("n_chars").alias("duration"))
    return stats.shard_stats(rows, "source")


@query(f"with {SHARDS}, r as (select source, sum(n)::bigint as n, sum(n_silence)::bigint as n_silence, sum(n_words)::bigint as n_words, grouping(source)::int as is_total from sh group by rollup (source)) select source, n, n_silence, n_words, is_total from r")
def stats_rollup(spark, d):
    return stats.rolled_up(shard_stats(spark, d), "source").select("source", "n", "n_silence", "n_words", F.col("is_total").cast("int").alias("is_total"))


@query("""with g as (select source, cast(sum(n_chars) as bigint) as n from documents group by source), s as (select source, n / sum(n) over () as share, n / sum(n) over () * case when source = 'src0' then 2.5 else 1 end as x from g), w as (select source, share, x / sum(x) over () as w from s)
select source, round_even(share, 4) as share, round_even(w, 4) as weight, round_even(w / min(w) over (), 4) as to_least, round_even(w / max(w) over (), 4) as to_greatest from w""")
def sampling_weights(spark, d):
    rows = table(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("n"))
    return stats.sampling_weights(rows, "source", "n", {"src0": 2.5})


@query(f"""with {LINES}, s as (select file_id, idx, "end" - start as duration from subs), c as (select file_id, idx // 5 as k, list(idx) as ids, sum(duration) as dur, min(idx) as lo from s group by all),
n as (select distinct file_id, unnest(ids) as idx from c where dur > 20000 and lo % 2 = 0), h as (select file_id, count(*) as n_lang, sum(duration) as lang_duration from s join n using (file_id, idx) where idx > 0 group by file_id)
select file_id, count(*) as n_subs, cast(sum(duration) as bigint) as duration, coalesce(any_value(n_lang), 0) as n_lang, cast(coalesce(any_value(lang_duration), 0) as bigint) as lang_duration, coalesce(any_value(lang_duration), 0) / nullif(sum(duration), 0)::double as share from s left join h using (file_id) group by file_id""")
def language_sub_totals(spark, d):
    rows = V.subs(spark, d).select("file_id", "idx", (F.col("end") - F.col("start")).alias("duration"))
    chunks = rows.groupBy("file_id", F.floor(F.col("idx") / 5).alias("k")).agg(F.collect_list("idx").alias("sub_ids"), F.sum("duration").alias("duration"), F.min("idx").alias("lo"))
    return stats.language_totals(chunks.withColumn("language", F.when(F.col("lo") % 2 == 0, "sv")), rows)


# Joins, sets and splits


@query("select doc_id, source from documents where doc_id in (select doc_id from labels where quality = 1)")
def passed_lang_semi(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi").select("doc_id", "source")


@query("select doc_id, source from documents where doc_id not in (select doc_id from labels)")
def unprocessed_anti(spark, d):
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("select d.doc_id, p.page_id, p.url from documents d join pages p on d.doc_id = p.page_id")
def srt_wav_pair(spark, d):
    docs, pages = table(spark, d, "documents").select("doc_id"), table(spark, d, "pages").select("page_id", "url")
    return docs.join(pages, F.col("doc_id") == F.col("page_id"))


@query("""with e as (select *, cast(epoch_ms(ts) - (select epoch_ms(min(ts)) from events) as bigint) as ms from events), c as (select file_id, start, start + 600000 as "end" from (select n_nationkey as file_id, n_nationkey * 1000000::bigint as start from nation))
select file_id, count(*) as n, round(sum(value), 4) as total from c join e on ms >= start and ms < "end" group by file_id""")
def interval_slice_join(spark, d):
    events = table(spark, d, "events")
    first = events.agg(F.min(F.unix_millis(F.col("ts").cast("timestamp"))).alias("t0"))
    events = events.crossJoin(F.broadcast(first)).withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")) - F.col("t0"))
    spans = table(spark, d, "nation").select(F.col("n_nationkey").alias("file_id"), (F.col("n_nationkey") * 1_000_000).cast("long").alias("start"))
    hit = sequence.interval_points(spans.withColumn("end", F.col("start") + 600_000), events, "ms", 600_000)
    return hit.groupBy("file_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""with f as (select page_id // 4 as base, ['wav', 'mp3', 'txt', 'webm'][page_id % 4 + 1] as ext, page_id % 3 <> 0 as listed from pages), r as (select *, list_position(['webm', 'wav', 'm4a', 'mp3', 'mp4', 'mkv', 'flac'], ext) as k from f)
select cast(base as varchar) as base, base || '.' || arg_min(ext, k) filter (k > 0 and listed) as audio_path from r group by base""")
def extension_priority(spark, d):
    from scribemill.sources.readers import audio_of

    ext = F.element_at(F.array(*map(F.lit, ["wav", "mp3", "txt", "webm"])), (F.col("page_id") % 4 + 1).cast("int"))
    pages = table(spark, d, "pages").select("page_id", F.floor(F.col("page_id") / 4).cast("string").alias("base"), ext.alias("ext"))
    listing = pages.where("page_id % 3 <> 0")
    return audio_of(pages.select("base").distinct(), listing.select(F.concat_ws(".", "base", "ext").alias("path")))


@query("select doc_id as id, source, null as url from documents union all by name select page_id as id, url, null as source from pages")
def concat_by_name(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source")
    return docs.unionByName(table(spark, d, "pages").select(F.col("page_id").alias("id"), "url"), allowMissingColumns=True)


@query("select source, lang from documents except all select source, lang from documents where doc_id % 3 = 0")
def except_files(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("source", "lang").exceptAll(docs.where("doc_id % 3 = 0").select("source", "lang"))


@query("""with r as (select o_orderkey, row_number() over (order by md5('42:' || o_orderkey), o_orderkey) as k, count(*) over () as n from orders)
select o_orderkey, case when k <= round_even(n * 0.8, 0) then 'train' when k <= round_even(n * 0.8, 0) + round_even(n * 0.1, 0) then 'test' else 'validation' end as split from r""")
def ratio_split_hashed(spark, d):
    return splits.ratio_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")


# Documents as rows

CHUNK_SQL = f"""{LINES}, ch as (select file_id, source, lang, idx, idx as number, text as raw, idx * 1000::bigint as start, cast(idx * 1000 + 600 + length(text) % 400 as bigint) as "end", case when idx % 6 > 0 then text else '' end as text, '' as text_whisper,
  idx % 4 as kind, {", ".join(f"case when idx % 4 in (1, 2) then (idx * 3 + {k}) % 11 / 10::double end as {x}_whisper, case when idx % 4 = 2 then (idx * 7 + {k}) % 11 / 10::double else 0 end as {x}_wav2vec" for k, x in enumerate(("bleu", "wer", "first", "last")))},
  {", ".join(f"idx % 3 > 0 and idx % {k} = 0 as {f}" for k, f in enumerate(("stage1_whisper", "stage2_whisper", "stage2_whisper_timestamps", "stage1_wav2vec"), 2))}, false as silence from lines where idx % 4 > 0)"""


@query(f"""with {CHUNK_SQL} select file_id, number, '[' || idx || ', ' || (idx + 1) || ']' as sub_ids, source, start, "end", text, text_whisper, 'W ' || raw as whisper_transcription, case when kind > 1 then 'v ' || raw end as wav2vec_transcription, * exclude (file_id, number, source, start, "end", text, text_whisper, lang, idx, raw, kind) from ch""")
def chunk_rows(spark, d):
    return D.chunk_rows(V.documents(spark, d))


@query(f"""with {CHUNK_SQL} select file_id, number, case when file_id % 3 = 0 then 'Unknown Channel' when file_id % 3 = 1 then 'cmore_AsRun' else source end as channel, case when file_id % 2 = 0 then 'id' || file_id else 'Unknown ID' end as id, 'Unknown Title' as program_title, coalesce(lang, 'Unknown Video File') as video_file,
case when file_id % 7 > 0 then 'c.srt' else 'Unknown Caption File' end as caption_file, coalesce(source, 'Unknown Source') as source, case when file_id % 5 = 0 then file_id % 2 = 0 when file_id % 3 = 1 then true else coalesce(file_id % 3 = 2 and contains(upper(source), 'ASRUN'), false) end as is_asrun, "end" - start as duration_ms, '2020' as production_year, null::varchar as program_classification, start as start_time, "end" as end_time, text, text_whisper,
case when kind < 3 then 'W ' || raw else 'v ' || raw end as transcription_whisper, case kind when 2 then 'v ' || raw when 3 then 'W ' || raw else '' end as transcription_wav2vec2, * exclude (file_id, number, source, start, "end", text, text_whisper, lang, idx, raw, kind) from ch""")
def stat_rows(spark, d):
    return D.stat_rows(V.documents(spark, d))


@query(f"with {LINES} select file_id, cast(idx as int) as idx, idx * 1000::bigint as start, text from lines")
def sub_rows(spark, d):
    return D.sub_rows(V.documents(spark, d))


@query(f"""with {CHUNK_SQL}, c as (select *, trim(regexp_replace(text, '\\s+', ' ', 'g')) as t, coalesce(case when kind > 1 then 'v ' || raw end, '') as v from ch where idx % 5 > 0),
p as (select *, t = '' and v = '' as is_silence from c), s as (select *, case when is_silence then '<|nospeech|>' || t else t end as marked from p),
q as (select *, lag("end") over w as e, lag(marked) over w as before from s window w as (partition by file_id order by idx))
select file_id, number, marked as text, case when is_silence then '<|nospeech|>' else '' end as text_timestamps, cast(len(list_filter(string_split(t, ' '), lambda x: x <> '')) as int) as n_words, is_silence, case when start = e and before <> '<|nospeech|>' then before end as previous_text from q""")
def prepared_rows(spark, d):
    """Chunk rows as videos: those without subtitle ids go, and the text before comes from the chunk that ends at the start."""
    rows = D.chunk_rows(V.documents(spark, d, dealt=True)).withColumns({"audio_path": F.col("file_id"), "audio": F.array(F.lit(0.0)), "wav2vec_transcription": F.coalesce("wav2vec_transcription", F.lit(""))})
    rows = rows.withColumn("sub_ids", F.when(F.col("number") % 5 > 0, F.col("sub_ids")).otherwise("[]"))
    out = D.prepared(rows, "youtube", clean=lambda x: T.strip(T.collapse(x)), metrics=False)
    return out.select("file_id", "number", "text", "text_timestamps", "n_words", "is_silence", "previous_text")


@query()  # cleaning and scores as above; tested against its parts
def prepared_scored(spark, d):
    """The whole projection: cleaned texts, silences, the text before, normalised texts, scores, and the stages."""
    rows = D.chunk_rows(V.documents(spark, d)).withColumns({"audio_path": F.col("file_id"), "audio": F.array(F.lit(0.0)), "wav2vec_transcription": F.coalesce("wav2vec_transcription", F.lit(""))})
    out = D.prepared(rows, "youtube").withColumns(quality.general_stages("youtube"))
    return out.select("file_id", "number", "text", "text_timestamps", "previous_text", "n_words", "is_silence", "text_normalized", *(F.round(c, 6).alias(c) for c in SCORES), *quality.general_stages("youtube"))


@query("""select doc_id as file_id, k % 4 > 0 as is_transcribed, k % 4 >= 2 as is_transcribed_same_model, k % 2 = 0 as is_langdetected from (select doc_id, doc_id % len(string_split(text, chr(10))) as k from documents)""")
def transcription_state(spark, d):
    """Of documents that begin at different chunks: with no, one or two transcriptions, with and without a language."""
    at = (F.col("file_id") % F.size("chunks") + 1).cast("int")
    state = D.transcription_state(F.slice("chunks", at, 1), D.WAV2VEC)
    return V.documents(spark, d).select("file_id", *(x.alias(k) for k, x in state.items()))


@query(f"""with {LINES}, m as (select file_id, "end" - start as d, case idx % 4 when 0 then '<duplicate>' when 1 then '<live_sub>' when 2 then '<live_sub><duplicate>' else '' end || text as text from subs)
select file_id, count(*) as subs_count, cast(sum(d) as bigint) as subs_duration, cast(count_if(contains(text, '<duplicate>')) as bigint) as duplicates_count, cast(coalesce(sum(d) filter (contains(text, '<duplicate>')), 0) as bigint) as subs_duration_duplicate,
cast(count_if(starts_with(text, '<live_sub>') and not contains(text, '<duplicate>')) as bigint) as livesubs_count, cast(coalesce(sum(d) filter (starts_with(text, '<live_sub>') and not contains(text, '<duplicate>')), 0) as bigint) as subs_duration_live from m group by file_id""")
def marked_srt_stats(spark, d):
    tag = F.element_at(F.array(*map(F.lit, ("<duplicate>", "<live_sub>", "<live_sub><duplicate>", ""))), F.col("idx") % 4 + 1)
    return D.marked_stats(V.subs(spark, d).withColumn("text", F.concat(tag, "text")))


@query("""select doc_id, source as location, lang as speaker_id, (doc_id % 4)::varchar as version, 'p' || doc_id as program_id, 's' || (doc_id % 9) as split, make_date(2000 + doc_id % 20, 1 + doc_id % 12, 1 + doc_id % 28)::varchar as day, lpad((doc_id % 24)::varchar, 2, '0') || ':30:05' as time, 'a_' || doc_id as recording, source || '/' || lang as area, source || '_' || doc_id as program from documents""")
def names_decode(spark, d):
    n, text = F.col("doc_id"), F.col("doc_id").cast("string")
    dialect, cast = N.dialect_parts(F.concat_ws("_", "source", "lang", (n % 4).cast("string"))), N.broadcast_parts(F.concat(F.lit("p"), text, F.lit("-s"), (n % 9).cast("string")))
    digits = (n % 24 * 10_000 + 3005).cast("int")
    recording = N.recording_name(F.concat(F.lit("a_"), text, F.when(n % 2 == 0, ".gloss").otherwise("_gloss")))
    more = {
        "day": N.broadcast_date(2000 + n % 20, 1 + n % 12, 1 + n % 28).cast("string"),
        "time": N.clock_time(digits),
        "recording": recording,
        "area": N.recording_area(F.concat_ws("/", F.lit("x/y"), "source", "lang")),
        "program": N.program_of_chunk(F.concat(F.col("source"), F.lit("-"), text, F.lit("-17.wav"))),
    }
    return table(spark, d, "documents").select("doc_id", *(c.alias(k) for k, c in (dialect | cast | more).items()))


@query("select start_bucket, end_bucket, page_id, url from (select page_id, url, page_id * 10 as start_bucket, page_id * 10 + length(url) * 100 as end_bucket from pages) where end_bucket - start_bucket >= 2000")
def long_buckets(spark, d):
    return D.long_buckets(table(spark, d, "pages").select("page_id", "url", (F.col("page_id") * 10).alias("start_bucket"), (F.col("page_id") * 10 + F.length("url") * 100).alias("end_bucket")))


@query("""with d as (select lang as folder, count(*) as n_docs, cast(sum(n_chars) as bigint) as n_chars, min(doc_id) as first from documents group by lang)
select p.page_id, d.* from (select page_id, split_part(url, '/', 4) as folder from pages) p join d using (folder)""")
def folder_metadata(spark, d):
    """Files with what is known of the folder that they stand in: of all documents of its language."""
    about = table(spark, d, "documents").groupBy(F.col("lang").alias("folder")).agg(F.count("*").alias("n_docs"), F.sum("n_chars").cast("long").alias("n_chars"), F.min("doc_id").alias("first"))
    files = table(spark, d, "pages").select("page_id", F.concat(F.lit("/data/"), F.get(F.split("url", "/"), F.lit(3)), F.lit("/file.srt")).alias("path"))
    return D.with_metadata(files, about).drop("path")


@query(f"with {LINES} select file_id, idx, round_even((start // 20 + 1) * 0.02::double, 2) as first, round_even((start // 20 + 7) * 0.02::double, 2) as last, round_even(\"end\" / 20.0, 0) * 20 / 1000::double as nearest from subs")
def word_offsets(spark, d):
    offsets = F.transform(F.array(*map(F.lit, (1, 3, 7))), lambda w: F.struct(F.lit("w").alias("word"), (F.floor(F.col("start") / 20) + w).alias("start_offset"), F.lit(0).alias("end_offset")))
    times = A.word_times(offsets, 0.02)
    return V.subs(spark, d).select("file_id", "idx", *(F.element_at(times, i)["start_time"].alias(n) for i, n in ((1, "first"), (-1, "last"))), A.nearest20_seconds(F.col("end")).cast("double").alias("nearest"))


@query(f"""with {SCORED}, l as (unpivot (select doc_id, source, n_chars, as_run, w_bleu >= 0.4 as stage1, w_bleu >= 0.8 as stage2 from sc) on stage1, stage2 into name stage value value)
select stage, value, count(*) as n, sum(n_chars) / 3600000::double as hours, count(distinct source) as n_files, cast(count_if(as_run) as bigint) as n_asrun, cast(count_if(not as_run) as bigint) as n_not_asrun from l group by stage, value""")
def stage_as_run_xtab(spark, d):
    rows = scored(spark, d).withColumns({"stage1": F.col("w_bleu") >= 0.4, "stage2": F.col("w_bleu") >= 0.8, "is_asrun": F.col("as_run")})
    return stats.stage_as_run_table(rows, ["stage1", "stage2"], "n_chars", "source")


@query("""with f as (select n_chars, case when doc_id % 3 = 0 then case doc_id % 4 when 0 then 'riksdagen_web' when 1 then 'riksdagen_old' end when doc_id % 3 = 1 then case doc_id % 4 when 0 then 'svt1' when 1 then 'svt2' end else 'smdb' end as folder from documents)
select folder, count(*) as n, sum(n_chars)::bigint as n_words, grouping(folder)::int as is_total from f where folder is not null group by rollup (folder)""")
def folder_rollup(spark, d):
    n = F.col("doc_id")
    dataset = F.when(n % 3 == 0, "rixvox").when(n % 3 == 1, "svt").otherwise("smdb")
    name = F.when(n % 3 == 0, F.when(n % 4 == 0, "a_riksdagen_web_1").when(n % 4 == 1, "riksdagen_old")).when(n % 4 == 0, "svt1_x").when(n % 4 == 1, "svt2_x")
    shards = table(spark, d, "documents").select(dataset.alias("dataset"), F.coalesce(name, F.lit("other")).alias("file"), F.col("n_chars").alias("n_words"), F.lit(1).cast("long").alias("n"))
    rest = {c: F.lit(0) for c in ("n_silence", "n_previous_text", "n_tokens", "duration_hours", "duration_hours_silence")}
    return stats.folder_stats(shards.withColumns(rest)).select("folder", "n", "n_words", F.col("is_total").cast("int").alias("is_total"))


@query(f"with {PROBS} select doc_id, array_to_string(list_filter(['sv', 'haw', 'no'], lambda x: doc_id % 2 = 0 or x <> 'no'), ',') as langs, case when doc_id % 3 = 0 then 50273 when doc_id % 3 = 1 then 50259 else 0 end as number, 'x/wav2vec2-b' as model from probs")
def token_tables(spark, d):
    n = F.col("doc_id")
    tokens = F.concat(F.array(*map(F.lit, ("<|sv|>", "<|transcribe|>", "<|haw|>"))), F.when(n % 2 == 0, F.array(F.lit("<|no|>"))).otherwise(F.array().cast("array<string>")))
    code = F.when(n % 3 == 0, "sv").when(n % 3 == 1, "en").otherwise("zz")
    models_ = F.array(F.lit("openai/whisper"), F.lit("x/wav2vec2-a"), F.lit("x/wav2vec2-b"))
    return table(spark, d, "documents").select("doc_id", F.array_join(A.token_languages(tokens), ",").alias("langs"), F.coalesce(A.language_id(code).cast("int"), F.lit(0)).alias("number"), A.model_of_kind(models_, "wav2vec2").alias("model"))


# Reports and parsing


@query(r"select page_id, split_part(split_part(url, '://', 2), '/', 1) as host, string_split(url, '/')[4] as lang, cast(regexp_extract(url, '/(\d+)', 1) as int) as number from pages")
def path_parts(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", r"://([^/]+)", 1).alias("host"), F.get(F.split("url", "/"), F.lit(3)).alias("lang"), F.regexp_extract("url", r"/(\d+)", 1).cast("int").alias("number"))


@query("""with n as (select doc_id, source || '_x_' || (2000 + doc_id % 20) || '-' || (1 + doc_id % 12) || '-' || (1 + doc_id % 28) || '_' || lpad((doc_id % 24)::varchar, 2, '0') || '0000xx_' || lpad((doc_id % 23)::varchar, 2, '0') || '3000' as p from documents)
select doc_id, split_part(p, '_', 1) as channel, 'x' as subchannel, (2000 + doc_id % 20)::int as year, (1 + doc_id % 12)::int as month, (1 + doc_id % 28)::int as day, (doc_id % 24 * 10000)::int as from_time, (doc_id % 23 * 10000 + 3000)::int as to_time from n""")
def program_id_decode(spark, d):
    from scribemill.sources.readers import program_parts

    n = F.col("doc_id")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    name = F.concat_ws("_", "source", F.lit("x"), F.lit("z"), F.concat_ws("-", 2000 + n % 20, 1 + n % 12, 1 + n % 28), F.concat(two(n % 24), F.lit("0000xx")), F.concat(two(n % 23), F.lit("3000")))
    return table(spark, d, "documents").select("doc_id", *(c.alias(k) for k, c in program_parts(name).items()))


#: the columns of pivots: what other sources and languages there are is counted as such
SOURCES, TONGUES = [f"src{k}" for k in range(20)], ["en", "de", "es", "fr"]


@query("select lang, cast(n_chars // 1000 as bigint) as bin, " + ", ".join(f"cast(count_if(source = '{x}') as bigint) as {x}" for x in SOURCES) + ", cast(count(*) - count_if(source in (" + ", ".join(f"'{x}'" for x in SOURCES) + ")) as bigint) as other from documents group by all")
def hist_pivot(spark, d):
    known = F.when(F.col("source").isin(SOURCES), F.col("source")).otherwise("other")
    rows = table(spark, d, "documents").select("lang", F.floor(F.col("n_chars") / 1000).alias("bin"), known.alias("source")).groupBy("lang", "bin")
    return rows.pivot("source", [*SOURCES, "other"]).count().na.fill(0)


@query("""with r as (select source, coalesce(case when lang in ('en', 'de', 'es', 'fr') then lang end, 'other') as lang, n_chars, doc_id from documents), n as (select *, row_number() over (partition by lang order by doc_id) - 1 as index from r)
select cast(index as bigint) as index, """ + ", ".join(f"max(n_chars) filter (lang = '{x}')::varchar as n_chars_{x}, max(source) filter (lang = '{x}') as source_{x}" for x in [*TONGUES, "other"]) + " from n group by index")
def melt_pivot(spark, d):
    tongue = F.coalesce(F.when(F.col("lang").isin(TONGUES), F.col("lang")), F.lit("other"))
    rows = sequence.row_numbers(table(spark, d, "documents").withColumn("lang", tongue), "lang", "doc_id")
    long = rows.select("index", "lang", F.col("n_chars").cast("string").alias("n_chars"), "source").unpivot(["index", "lang"], ["n_chars", "source"], "variable", "value")
    names = [f"{v}_{x}" for x in [*TONGUES, "other"] for v in ("n_chars", "source")]
    return long.withColumn("key", F.concat_ws("_", "variable", "lang")).groupBy("index").pivot("key", names).agg(F.first("value"))


# Speech: vectors stand for logits (8 frames of 8 labels) and for samples


VOCABULARY = ["_", "|", "a", "b", "c", "d", "e", "f"]


def _logits(spark, d):
    frames = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, 8))
    return table(spark, d, "embeddings").select("vec_id", frames.alias("logits"))


@query("""with f as (select vec_id, list_transform(range(8), lambda i: ['_', '|', 'a', 'b', 'c', 'd', 'e', 'f'][list_position(embedding[i * 8 + 1:i * 8 + 8], list_max(embedding[i * 8 + 1:i * 8 + 8]))]) as c from embeddings),
k as (select vec_id, c, list_filter(range(1, 9), lambda i: (i = 1 or c[i] <> c[i - 1]) and c[i] <> '_') as s, list_filter(range(1, 9), lambda i: c[i] not in ('_', '|')) as z from f),
w as (select *, list_filter(string_split(array_to_string(list_transform(s, lambda i: c[i]), ''), '|'), lambda x: x <> '') as words from k)
select vec_id, array_to_string(words, ' ') as text, cast(len(words) as int) as n_words, case when len(z) > 0 then round_even(list_min(z) * 0.02::double - 0.02, 2) end as start_time, case when len(z) > 0 then round_even(list_max(z) * 0.02::double, 2) end as end_time from w""")
def ctc_words_of_vectors(spark, d):
    times = A.word_times(F.col("words"), 0.02)
    rows = _logits(spark, d).select("vec_id", S.ctc_words(F.col("logits"), VOCABULARY).alias("words"))
    edge = lambda at, f: F.try_element_at(times, F.lit(at))[f]
    return rows.select("vec_id", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("text"), F.size("words").alias("n_words"), edge(1, "start_time").alias("start_time"), edge(-1, "end_time").alias("end_time"))


@query()  # a search; tested against the sum over all alignments
def ctc_search_of_vectors(spark, d):
    rows = _logits(spark, d).select("vec_id", S.ctc_search(F.col("logits"), width=8).alias("x"))
    return rows.select("vec_id", F.array_join(F.transform("x.labels", lambda k: F.get(F.array(*map(F.lit, VOCABULARY)), k)), "").alias("text"), F.round("x.log_prob", 6).alias("log_prob"))


@query()  # no Fourier transform in DuckDB; tested against a plain one
def mel_of_vectors(spark, d):
    made = S.mel_features(F.col("embedding"), length=80, n_fft=16, hop=8, bands=4)
    rows = table(spark, d, "embeddings").select("vec_id", made.alias("x"))
    flat = F.flatten("x.features")
    return rows.select("vec_id", F.col("x.input_length").alias("input_length"), F.aggregate("x.attention_mask", F.lit(0), lambda a, b: a + b).alias("n_frames"), F.round(F.array_max(flat).cast("double"), 4).alias("loudest"), F.round(F.array_min(flat).cast("double"), 4).alias("faintest"))


@query()  # byte-pair merges; tested against a plain merge loop
def token_labels(spark, d):
    """Token ids of all turns, as they are and with one merge in ten left out at random, by conversation and turn."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = V.dealt_out(table(spark, d, "conversations").select("conv_id", "turn", "text"), "conv_id").select("conv_id", "turn", "text", F.concat(F.lit("<0.00>"), F.col("text"), F.lit("<1.20>")).alias("text_timestamps"))
    rows = S.with_labels(rows, lambda c: S.token_ids(c, path), [50_256, 50_256], 50_256, 50_256)
    loose = S.token_ids(F.col("text"), path, 0.1, F.xxhash64("conv_id", "turn"))
    return rows.select("conv_id", "turn", "labels_length", "labels_timestamps_length", F.size(loose).alias("n_loose"), F.sha2(F.array_join("labels", " "), 256).alias("labels"))


@query()  # a Python model
def model_hook_stub(spark, d):
    rows = V.doc_lines(spark, d).select("file_id", "idx", "text")
    return models.with_model(rows, "text", "language", "string", lambda: lambda texts: ["sv" if len(t) % 2 else "no" for t in texts])


@query("select time_bucket(interval '1 hour', ts) as start, event_type, count(*) as n from events group by all")
def event_windows(spark, d):
    from scribemill.streaming.files import event_counts

    return event_counts(table(spark, d, "events"))
