"""Registered queries of the training-text operators, and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.llm import byte_bpe, collocations, conversations, cotraining, html_text, language, lm_score, merkle, mixing, pii, shingle_join, toxicity, vector_dedup
from meshroad.llm.common import remainder, table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels", "doc_id", "quality").filter("quality = 1")
    return lm_score.score(table(spark, sf_dir, "documents", "doc_id", "text"), good)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"), keep=["page_id", "url"])
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_neighbour_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", remainder("doc_id", 3) == 1)
    model = language.train(docs.filter(~F.col("held_out")))
    return language.identify(docs, model, keep=["doc_id", "held_out"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", remainder("doc_id", 4) == 2)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train(docs.filter(~F.col("held_out")), labels.filter(remainder("doc_id", 4) != 2))
    return toxicity.score(docs, model, keep=["doc_id", "held_out"])


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = byte_bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), decoded=True, keep=["doc_id"])
    return back.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    model = cotraining.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return cotraining.score(docs, model, keep=["doc_id"])


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damage(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents", "text", "lang"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"]))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_lm_score": op2_lm_score,
    "op3_html": op3_html,
    "op4_merkle": op4_merkle,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality": op8_quality,
    "op9_ngram_join": op9_ngram_join,
    "op10_vector_dedup": op10_vector_dedup,
    "op11_conversations": op11_conversations,
    "op12_collocations": op12_collocations,
    "op13_pii": op13_pii,
}

ORACLE = {
    "op1_mixing": r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, '')) as k
  from documents),
s as (
  select source, sum(size)::bigint as source_size, 3 * sum(size)::bigint as lim,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight
  from d group by source),
l as (
  select *, (sum(source_size) over () - coalesce(sum(lim) over w, 0))::double / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as level
  from s window w as (order by lim / weight, source nulls last rows between unbounded preceding and 1 preceding)),
f as (
  select *, lim <= level * weight as is_full,
         min(case when not (lim <= level * weight) then struct_pack(a := lim / weight, b := level) end) over () as free from l),
t as (
  select source, source_size, weight, case when is_full then lim::double else free.b * weight end as target from f),
o as (
  select d.*, t.source_size, t.target,
         sum(d.size) over (partition by d.source order by d.k, d.size, d.doc_id rows unbounded preceding) as upto
  from d join t on d.source is not distinct from t.source),
e as (
  select o.doc_id, o.size, (o.source_size * g.pass + o.upto)::double / o.target as finish, g.pass, o.source, o.k
  from o, (select unnest([0, 1, 2]) as pass) g where o.target > 0),
r as (
  select *, sum(size) over (order by finish, coalesce(source, chr(1114111)), pass, k, size rows unbounded preceding) as used from e),
x as (
  select doc_id, k, size, count(*) as copies from r where used <= (select sum(size) from d) group by doc_id, k, size)
select o.doc_id, o.size, o.source_size, o.target, coalesce(x.copies, 0)::integer as copies, (o.size * coalesce(x.copies, 0))::bigint as taken
from o left join x on o.doc_id = x.doc_id
""",
    "op11_conversations": r"""
with recursive rows0 as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key
  from conversations),
keyed as (
  select *, (xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))), 4294967295::bigint)) % 20 as kind
  from rows0),
damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, u.copy
  from keyed, (select unnest([1, 2]) as copy) u where kind <> 0 and (u.copy = 1 or kind = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as pos,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') as cut, substr(role, 1, 1) as initial
  from damaged),
marked as (
  select *, case when cut = '' then 'b' when nth > 1 then 'd' when right(cut, 1) not in ('.', '!', '?') then 't' else '' end as fault,
         lag(initial) over (partition by conv_id order by pos) as before
  from (select *, row_number() over (partition by conv_id, role, text order by pos) as nth from placed)),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'b') as blank,
         count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
         count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal, max(pos) as m
  from marked group by conv_id),
-- Least cost and edits by state: 0 nothing yet, 1 after a system row, 2 after a user row, 3 complete.
steps as (
  select conv_id, 0::bigint as pos, {'c': 0::bigint, 'e': '', 'r': ''} as s0, {'c': 1000000000::bigint, 'e': '', 'r': ''} as s1,
         {'c': 1000000000::bigint, 'e': '', 'r': ''} as s2, {'c': 1000000000::bigint, 'e': '', 'r': ''} as s3
  from counts
  union all
  select conv_id, pos, list_min([{'c': p0.c + 2, 'e': p0.e || 'D', 'r': p0.r}]),
         list_min([{'c': p1.c + 2, 'e': p1.e || 'D', 'r': p1.r}, {'c': p0.c + x + gone + case initial when 's' then 0 else 1000000000 end, 'e': p0.e || 'K', 'r': p0.r || line}]),
         list_min([{'c': p2.c + 2, 'e': p2.e || 'D', 'r': p2.r},
                   {'c': p0.c + x + gone + nu, 'e': p0.e || 'K', 'r': p0.r || line}, {'c': p1.c + x + gone + nu, 'e': p1.e || 'K', 'r': p1.r || line}, {'c': p3.c + x + gone + nu, 'e': p3.e || 'K', 'r': p3.r || line},
                   {'c': p0.c + x + gone + 1, 'e': p0.e || 'R', 'r': p0.r || chr(10) || 'user:' || text}, {'c': p1.c + x + gone + 1, 'e': p1.e || 'R', 'r': p1.r || chr(10) || 'user:' || text},
                   {'c': p3.c + x + gone + 1, 'e': p3.e || 'R', 'r': p3.r || chr(10) || 'user:' || text}]),
         list_min([{'c': p3.c + 2, 'e': p3.e || 'D', 'r': p3.r}, {'c': p2.c + x + gone + na, 'e': p2.e || 'K', 'r': p2.r || line},
                   {'c': p2.c + x + gone + 1, 'e': p2.e || 'R', 'r': p2.r || chr(10) || 'assistant:' || text}])
  from (
    select s.conv_id, m.pos, m.text, m.initial, chr(10) || m.role || ':' || m.text as line, case m.fault when 't' then 5 else 0 end as x,
           case when m.fault in ('b', 'd') then 1000000000 else 0 end as gone, case m.initial when 'u' then 0 else 1000000000 end as nu,
           case m.initial when 'a' then 0 else 1000000000 end as na, s0 as p0, s1 as p1,
           list_min([s2, {'c': s0.c + 5, 'e': s0.e || 'I', 'r': s0.r || chr(10) || 'user:'}, {'c': s1.c + 5, 'e': s1.e || 'I', 'r': s1.r || chr(10) || 'user:'},
                     {'c': s3.c + 5, 'e': s3.e || 'I', 'r': s3.r || chr(10) || 'user:'}]) as p2,
           list_min([s3, {'c': s2.c + 5, 'e': s2.e || 'I', 'r': s2.r || chr(10) || 'assistant:'},
                     {'c': s0.c + 10, 'e': s0.e || 'II', 'r': s0.r || chr(10) || 'user:' || chr(10) || 'assistant:'},
                     {'c': s1.c + 10, 'e': s1.e || 'II', 'r': s1.r || chr(10) || 'user:' || chr(10) || 'assistant:'}]) as p3
    from steps s join marked m on m.conv_id is not distinct from s.conv_id and m.pos = s.pos + 1)),
ends as (
  select conv_id, list_min([s0, s3, {'c': s2.c + 5, 'e': s2.e || 'I', 'r': s2.r || chr(10) || 'assistant:'},
                            {'c': s1.c + 10, 'e': s1.e || 'II', 'r': s1.r || chr(10) || 'user:' || chr(10) || 'assistant:'}]) as best
  from steps join counts using (conv_id) where pos = m)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost, coalesce(best.e, '') as audit,
       sha256(coalesce(substr(best.r, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts using (conv_id) left join ends using (conv_id)
""",
    "op12_collocations": r"""
with d as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
g as (
  select lang, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(ws[i:i + n - 1], ' '))) as phrase
  from w, (select unnest([1, 2, 3, 4, 5]) as n) s where len(ws) >= n),
f as (select lang, n, phrase, count(*) as f from g group by lang, n, phrase),
t as (select lang, sum(f)::hugeint as n from f where n = 1 group by lang),
c as (select lang, n as words, phrase, string_split(phrase, ' ') as ws, f as a from f where n > 1 and f >= 100),
h as (
  select lang, array_to_string(ws[i:j], ' ') as phrase, max(a) as held
  from c, (select unnest(range(1, 6)) as i) x, (select unnest(range(1, 6)) as j) y where i < j and j <= words and j - i + 1 < words group by 1, 2),
k as (
  select c.lang, c.phrase, c.a, u.k, array_to_string(ws[1:u.k], ' ') as front, array_to_string(ws[u.k + 1:words], ' ') as rest
  from c left join h using (lang, phrase), (select unnest(range(1, 5)) as k) u where u.k < words and (held is null or 100 * held < 100 * a)),
s as (
  select k.lang, k.phrase, k.a, k.k, x.f as l, y.f as r, t.n, (1000::hugeint * a * t.n) // (x.f::hugeint * y.f) as score
  from k join f x on x.lang = k.lang and x.phrase = front join f y on y.lang = k.lang and y.phrase = rest join t on t.lang = k.lang),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as best from s),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b where best = 1)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score from o where rank <= 2000
""",
}
