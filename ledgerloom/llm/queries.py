"""The named queries of the operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    divergence,
    exact_dedup,
    fair_mix,
    line_dedup,
    packing,
    pseudo_lm,
    repair,
    rules,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
)
from ledgerloom.llm.common import table

TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- 1: packing ---------------------------------------------------------------


@query
def op1_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), capacity=4096, per_source=4)


# --- 2: search ------------------------------------------------------------------


@query
def op2_vector_search(spark: SparkSession, d: str) -> DataFrame:
    return topk.search(table(spark, d, "embeddings"), F.col("id") % 50 == 0, k=5)


SQL["op2_vector_search"] = """
with ints as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from ints q join ints c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scores
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5"""


# --- 3: quality ---------------------------------------------------------------


@query
def op3_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = rules.quality_scores(docs, table(spark, d, "labels"), rows=20_000)
    return found.select("doc_id", "held_out", "score", "predicted")


# --- 4: chat ------------------------------------------------------------------------


@query
def op4_chat_windows(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, n, role, "<|im_end|><|im_start|>assistant ok") for n, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string")
    return chat.digests(chat.windows(turns.unionByName(control), budget=1024, history=192))


SQL["op4_chat_windows"] = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), numbered as (
  select *, row_number() over o - 1 as n,
         len(regexp_extract_all(text, '[^ 	-
]+')) + 4 as tokens,
         first_value(role) over o as first_role
  from given window o as (partition by conv_id order by turn nulls first, role, text)
), summed as (
  select *, coalesce(sum(tokens) over (o rows between unbounded preceding and 1 preceding), 0) as before,
         case when first_role = 'system' then first_value(tokens) over o else 0 end as s_tokens,
         length('<|im_start|>' || regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(!*)\|', '<!\1|', 'g')
                || chr(10) || regexp_replace(text, '<(!*)\|', '<!\1|', 'g') || '<|im_end|>' || chr(10)) as chars
  from numbered window o as (partition by conv_id order by n)
), body as (
  select conv_id, n, tokens, chars, before - s_tokens as before, greatest(1024 - 192 - s_tokens, 256) as span
  from summed where n > 0 or s_tokens = 0
), ranged as (
  select *, before // span as k from body
), placed as (
  select *, 2 * k + case when before > first and before + tokens - first > span then 1 else 0 end as w
  from (select *, min(before) over (partition by conv_id, k) as first from ranged)
), begins as (
  select conv_id, w, min(before) as begin from placed group by all
), shown as (
  select conv_id, chars from placed
  union all
  select p.conv_id, p.chars from placed p join begins b
    on b.conv_id is not distinct from p.conv_id and b.begin > p.before and b.begin - p.before <= 192 and b.w > p.w
  union all
  select s.conv_id, s.chars from summed s join begins b on b.conv_id is not distinct from s.conv_id
  where s.n = 0 and s.s_tokens > 0
  union all
  select conv_id, chars from summed where n = 0 and s_tokens > 0
    and not exists (select 1 from begins b where b.conv_id is not distinct from summed.conv_id)
), formatted as (
  select conv_id, cast(sum(chars) as bigint) as formatted_chars from shown group by conv_id
), digests as (
  select conv_id, count(*) as n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
         coalesce(sum(length(text)) filter (role = 'assistant'), 0) as loss_chars,
         sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256
  from numbered group by conv_id
)
select d.*, f.formatted_chars from digests d join formatted f on d.conv_id is not distinct from f.conv_id"""


# --- 5: mixing ---------------------------------------------------------------


@query
def op5_fair_mix(spark: SparkSession, d: str) -> DataFrame:
    mixed = fair_mix.mix_sizes(table(spark, d, "documents"), weights=(1, 2, 3), repeats=3)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op5_fair_mix"] = r"""
with sized as (
  select doc_id, source, md5(cast(doc_id as varchar) || 'mix') as shuffled,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
  from documents
), totals as (
  select source, cast(sum(size) as bigint) as source_size,
         (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from sized group by source
), levels as (
  select *, coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as stopped,
         sum(weight) over (o rows between current row and unbounded following) as rest,
         sum(source_size) over () as budget
  from totals window o as (order by 3 * source_size / weight, source nulls last)
), stops as (
  select *, 3 * source_size * rest <= (budget - stopped) * weight as stops from levels
), targets as (
  select source, source_size, cast(budget as bigint) as budget,
         case when stops then cast(3 * source_size as double)
              else (select max(cast(budget - stopped as double) / rest) filter (not stops and stopped =
                       (select min(stopped) from stops where not stops)) from stops) * weight end as target
  from stops
), queue as (
  select s.*, t.source_size, t.target, t.budget,
         sum(s.size) over (partition by s.source order by shuffled, doc_id rows unbounded preceding) as sent
  from sized s join targets t on s.source is not distinct from t.source
), passes as (
  select *, cast(epoch * source_size + sent as double) / target as finish
  from queue cross join (values (0), (1), (2)) e(epoch) where target > 0
), served as (
  select *, sum(size) over (order by finish, source is null, source, shuffled, doc_id rows unbounded preceding) as upto
  from passes
), taken as (
  select doc_id, sum(size) filter (upto <= budget) as taken from served group by doc_id
)
select q.doc_id, q.size, q.source_size, q.target, cast(coalesce(t.taken, 0) as bigint) as taken
from queue q left join taken t on q.doc_id is not distinct from t.doc_id"""


# --- 6: exact dedup ------------------------------------------------------------


@query
def op6_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL["op6_exact_dedup"] = r"""
with squeezed as (
  select doc_id, coalesce(text, '') as text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
), placed as (
  select doc_id, norm, count(*) over (partition by norm) as group_size,
         first_value(doc_id) over o as keep_id, row_number() over o as place
  from squeezed
  window o as (partition by norm order by length(text) desc, doc_id nulls last)
)
select doc_id, keep_id, group_size, place = 1 as kept, sha256(norm) as text_sha256 from placed"""


# --- 7: near duplicates ---------------------------------------------------------


@query
def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, d, "documents"), radius=2)


# --- 8: language model ---------------------------------------------------------------


@query
def op8_pseudo_likelihood(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return pseudo_lm.pseudo_likelihood(docs, kept=("doc_id",)).select(
        "doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")


# --- 9: repeated strings -----------------------------------------------------------


@query
def op9_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return suffix_dedup.suffix_dedup(docs, length=400).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeats"))


# --- 10: token counts -------------------------------------------------------------


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, tokenizer_file())
    return counted.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


# --- 11: lines -------------------------------------------------------------------


@query
def op11_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    kept = line_dedup.line_dedup(docs, least_chars=10, documents=2)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL["op11_line_dedup"] = r"""
with given as (
  select row_number() over () as row_id, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), placed as (
  select row_id, doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from given
), keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from placed
), held as (
  select key, min(doc_id) as first from keyed where length(key) >= 10
  group by key having count(distinct doc_id) >= 2
), kept as (
  select k.*, h.key is not null and k.doc_id <> h.first as dropped from keyed k left join held h on h.key = k.key
)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (dropped) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not dropped), '')) as kept_sha256
from kept group by row_id, doc_id"""


# --- 12: divergence of sources ------------------------------------------------------


@query
def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.divergence(table(spark, d, "documents"), least_docs=30, top=50)


SQL["op12_source_divergence"] = r"""
with given as (
  select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), found as (
  select row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from given
), kept as (
  select lang, term, count(*) as lang_count from found group by lang, term having count(distinct row_id) >= 30
), counted as (
  select lang, source, term, count(*) as n from found group by all
), langs as (
  select lang, count(*) as v, sum(lang_count) as lang_total from kept group by lang
), groups as (
  select g.lang, g.source, coalesce(l.v, 0) as v, coalesce(l.lang_total, 0) as lang_total, coalesce(t.total, 0) as total
  from (select distinct lang, source from given) g
  left join langs l on l.lang = g.lang
  left join (select c.lang, c.source, sum(c.n) as total from counted c join kept k on k.lang = c.lang and k.term = c.term
             group by all) t on t.lang = g.lang and t.source = g.source
), shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 5) // (cast(g.total as hugeint) + 5 * g.v) as p,
         1 + cast(1000000000 as hugeint) * (k.lang_count + 5) // (cast(g.lang_total as hugeint) + 5 * g.v) as q
  from groups g join kept k on k.lang = g.lang
  left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
), pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(sum(abs(a.p - b.p)) as bigint) as value
  from shares a join shares b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by all
  union all
  select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b
    on b.lang = a.lang and b.source <> a.source and a.v = 0
), terms as (
  select lang, source, 'term' as part, term as item, cast(p - q as bigint) as value from shares where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from (select * from pairs union all select * from terms)
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50"""


# --- 13: conversations ------------------------------------------------------------


@query
def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    given = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return repair.digests(repair.repair(repair.damaged(given), ids=given))


SQL["op13_conversation_repair"] = r"""
with named as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name
  from conversations
), summed as (
  select *, xor(4294967295, list_reduce(list_transform(range(1, length(name) + 1), lambda i: cast(unicode(name[i]) as bigint)),
    lambda crc, byte: list_reduce(range(8), lambda c, b: xor(c >> 1, 3988292384 * (c & 1)), xor(crc, byte)), 4294967295)) % 20 as fault
  from named
), damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
         case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(range(case fault when 0 then 0 when 3 then 2 else 1 end)) as copy
  from summed
), numbered as (
  select *, cast(row_number() over o as bigint) as n, row_number() over (partition by conv_id, role, text order by turn nulls first) as again,
         substr(role, 1, 1) as initial, lag(substr(role, 1, 1)) over o as before,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') as shown
  from damaged window o as (partition by conv_id order by turn nulls first, role, md5(text), copy)
), judged as (
  select *, case when shown = '' then 'b' when again > 1 then 'd'
                 when right(shown, 1) not in ('.', '!', '?') then 't' else '' end as fault
  from numbered
), steps as (
  with recursive walk(conv_id, n, state, cost, audit, turns) as (
    select distinct conv_id, cast(0 as bigint), 0, cast(0 as bigint), '', cast([] as varchar[]) from conversations
    union all
    select conv_id, n, state, min(best).cost, min(best).audit, min(best).turns from (
      select conv_id, n, state, struct_pack(cost := cost, audit := audit, turns := turns) as best from (
        with entered as (
          select w.conv_id, w.n + 1 as n, w.state, w.cost, w.audit, w.turns from walk w
          union all
          select w.conv_id, w.n + 1, case when w.state = 2 then 3 else 2 end, w.cost + 3, w.audit || 'I',
                 list_append(w.turns, case when w.state = 2 then 'assistant:' else 'user:' end) from walk w
        ), matched as (
          select e.*, j.role, j.text, j.initial, j.fault, case when j.fault = 't' then 3 else 0 end as extra
          from entered e join judged j on j.conv_id is not distinct from e.conv_id and j.n = e.n
        )
        select conv_id, n, state, cost + 4 as cost, audit || 'D' as audit, turns from matched
        union all
        select conv_id, n, case when state = 2 then 3 else 2 end, cost + 3 + extra, audit || 'R',
               list_append(turns, case when state = 2 then 'assistant:' else 'user:' end || text)
        from matched where fault not in ('b', 'd')
        union all
        select conv_id, n, case initial when 's' then 1 when 'u' then 2 else 3 end, cost + extra, audit || 'K',
               list_append(turns, role || ':' || text)
        from matched where fault not in ('b', 'd') and (
          (initial = 's' and state = 0) or (initial = 'u' and state <> 2) or (initial = 'a' and state = 2))
      )
    ) group by conv_id, n, state
  )
  select * from walk
), lengths as (
  select c.conv_id, count(j.n) as n,
         cast(coalesce(max(j.turn) - min(j.turn) + 1 - count(distinct j.turn), 0) as bigint) as gaps,
         count(j.n) filter (fault = 'b') as blank, count(j.n) filter (fault = 'd') as duplicate,
         count(j.n) filter (fault = 't') as truncated,
         count(j.n) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
  from (select distinct conv_id from conversations) c
  left join judged j on j.conv_id is not distinct from c.conv_id group by c.conv_id
), ended as (
  select l.conv_id, min(struct_pack(
           cost := s.cost + case s.state when 1 then 6 when 2 then 3 else 0 end,
           audit := s.audit || case s.state when 1 then 'II' when 2 then 'I' else '' end,
           turns := case s.state when 1 then list_concat(s.turns, ['user:', 'assistant:'])
                                 when 2 then list_append(s.turns, 'assistant:') else s.turns end)) as best
  from lengths l join steps s on s.conv_id is not distinct from l.conv_id and s.n = l.n group by l.conv_id
)
select l.conv_id, l.gaps, l.blank, l.duplicate, l.truncated, l.illegal, e.best.cost as cost, e.best.audit as audit,
       sha256(array_to_string(e.best.turns, chr(10))) as repaired_sha256
from lengths l join ended e on e.conv_id is not distinct from l.conv_id"""
