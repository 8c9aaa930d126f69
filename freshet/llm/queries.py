"""One query per operator over the driver tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import (
    collocations,
    jaccard_join,
    language_id,
    neighbours,
    packing,
    periodic_runs,
    perspectives,
    quality_classifier,
    quality_rules,
    sentencepieces,
    sharding,
    vector_dedup,
    wrapper,
)
from freshet.llm.shared import table

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SHARDS = [f"shard-{k:03d}" for k in range(256)]


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op2_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.search(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = quality_classifier.fit(docs, table(spark, sf, "labels"))
    return quality_classifier.score(docs, model).select(
        "doc_id",
        language_id.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.place(table(spark, sf, "documents").select("doc_id"), F.col("doc_id"), SHARDS)


def op5_chat_perspectives(spark: SparkSession, sf: str) -> DataFrame:
    return perspectives.rotated(table(spark, sf, "conversations"))


OP5_SQL = """
with t as (
  select conv_id, turn, role as said_by, coalesce(text, '') as text from conversations
), speakers as (
  select distinct conv_id, said_by as speaker from t where said_by is not null and said_by <> 'system'
), v as (
  select t.*, s.speaker, coalesce(said_by, 'unknown') as name,
    case when said_by = speaker then 'assistant' when said_by = 'system' then 'system' else 'user' end as role
  from t join speakers s on t.conv_id is not distinct from s.conv_id
), h as (
  select *, case when role = 'user' then '<|user name=' || name || '|>' else '<|' || role || '|>' end || chr(10) as head from v
), g as (
  select *, head || text || '<|end|>' || chr(10) as segment, length(head || text || '<|end|>' || chr(10)) as n from h
), p as (
  select *, row_number() over w - 1 as place, sum(n) over w - n as begins from g
  window w as (partition by conv_id, speaker order by turn nulls last, said_by nulls last, text
    rows between unbounded preceding and current row)
)
select conv_id, speaker, place::bigint as place, turn::bigint as turn, role, name, segment, begins::bigint as start,
  n::bigint as n_chars, case when role = 'assistant' then (begins + length(head))::bigint end as mask_start,
  case when role = 'assistant' then (begins + n)::bigint end as mask_end
from p
"""


def op6_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return wrapper.main_text(table(spark, sf, "pages"))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


OP8_SQL = """
with recursive d as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct rid, array_to_string(list_slice(w, i, i + 4), ' ') as g
  from (select rid, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from d where len(w) > 0)
), sizes as materialized (
  select rid, count(*) as n from shingles group by rid
), shared as materialized (
  select x.rid as a, y.rid as b, count(*) as k
  from shingles x join shingles y on x.g = y.g and x.rid < y.rid group by x.rid, y.rid
), links as materialized (
  select a, b from shared join sizes p on p.rid = a join sizes q on q.rid = b where 100 * k >= 75 * (p.n + q.n - k)
), ways as materialized (
  select a, b from links union select b, a from links
), reach(rid, seen) as (
  select rid, rid from sizes union select reach.rid, ways.b from reach join ways on ways.a = reach.seen
), least as (
  select reach.rid, min(d.doc_id) as component_id from reach join d on d.rid = reach.seen group by reach.rid
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(l.component_id, d.doc_id)::bigint as component_id
from d left join sizes s on s.rid = d.rid left join least l on l.rid = d.rid
"""


def op9_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(PIECE_MODEL)
    encoded = sentencepieces.encode(table(spark, sf, "documents").select("doc_id", "text"), path).drop("text")
    return sentencepieces.decode(encoded, path).select(
        "doc_id",
        F.size("encoded.ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("encoded.ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP10_SQL = """
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents
), windows as (
  select rid, i, array_to_string(list_slice(w, i, i + 4), ' ') as g
  from (select rid, w, unnest(generate_series(1, len(w) - 4)) as i from d)
), twice as (
  select rid, i from windows qualify count(*) over (partition by rid, g) > 1
), covered as (
  select rid, sum(least(5, coalesce(next_i - i, 5))) as n
  from (select rid, i, lead(i) over (partition by rid order by i) as next_i from twice) group by rid
), based as (
  select d.rid, doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) as n_lines,
    len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
    length(regexp_replace(t, '[^|]', '', 'g')) as n_bars
  from d left join covered c on c.rid = d.rid
), judged as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    case when n_words < 200 then 0 when n_words < 600 then 1 else 2 end as stratum
  from based
), vals as (
  select rid, doc_id, base_failed, stratum, 'symbols' as rule, 1000 * n_symbols // greatest(word_chars, 1) as v from judged
  union all select rid, doc_id, base_failed, stratum, 'bars', 1000 * n_bars // greatest(n_words, 1) from judged
  union all select rid, doc_id, base_failed, stratum, 'dup_lines', 1000 * n_dup_lines // greatest(n_lines, 1) from judged
  union all select rid, doc_id, base_failed, stratum, 'repeats', 1000 * n_repeat_words // greatest(n_words, 1) from judged
), marked as (
  select doc_id, min(quality) as q from labels where doc_id is not null and quality is not null group by doc_id
), tried as (
  select stratum, rule, cutoff, count(*) filter (q = 1) as n, count(*) filter (q = 1 and v > cutoff) as k,
    count(*) filter (q <> 1 and v > cutoff) as hits
  from vals join marked using (doc_id), unnest(generate_series(50, 950, 50)) as c(cutoff)
  where not base_failed group by stratum, rule, cutoff
), tails as (
  select *, (select sum(exp(n * ln(0.99::double) + i * ln(0.01::double / 0.99)
      + lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)))
    from unnest(generate_series(0, k)) as s(i)) as tail
  from tried where k <= 0.01 * n and n > 0
), used as (
  select stratum, rule, max({'gain': hits - k, 'cutoff': cutoff}).cutoff as cutoff
  from tails where tail <= 0.05 / (4 * 3 * 19) and hits > k group by stratum, rule
), over as (
  select distinct rid from vals join used using (stratum, rule) where v > cutoff
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and rid not in (select rid from over) as kept
from judged
"""


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


OP11_SQL = """
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents
), worded as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces
), grams as (
  select lang, m, w[i : i + m - 1] as g
  from (select lang, w, m, unnest(generate_series(1, len(w) - m + 1)) as i from worded, (values (1), (2), (3), (4)) as sizes(m) where len(w) >= m)
), f as materialized (
  select lang, m, g, count(*)::hugeint as f from grams group by lang, m, g
), totals as (
  select lang, sum(f) as n from f where m = 1 group by lang
), asked as materialized (
  select * from f where m >= 2 and f >= 30
), parts as (
  select lang, f, g[i : i + k - 1] as part
  from asked, (values (2), (3)) as sizes(k), unnest(generate_series(1, m - k + 1)) as places(i) where m > k
), gone as (
  select distinct a.lang, a.g from asked a join parts p on p.lang = a.lang and p.part = a.g where 100 * p.f >= 80 * a.f
), cuts as (
  select a.lang, a.g, a.f as a, k, g[1 : k] as x, g[k + 1 : m] as y
  from asked a anti join gone using (lang, g), unnest(generate_series(1, m - 1)) as c(k)
), scored as (
  select c.lang, c.g, a, k, p.f as l, q.f as r, 2000000 * a // (p.f + q.f) as score
  from cuts c join f p on p.lang = c.lang and p.g = c.x join f q on q.lang = c.lang and q.g = c.y
), best as (
  select * from scored qualify row_number() over (partition by lang, g order by score, k) = 1
), ranked as (
  select *, array_to_string(g, ' ') as phrase from best
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a::bigint as a, l::bigint as l,
  r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
"""


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Texts whose hash ends in 0 go on periodically from one of their words on."""
    words = F.expr("array(regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0))")
    g = F.floor(F.crc32(F.col("doc_id").cast("string")) / 10).cast("long")

    def tail(w):
        n = F.size(w)
        a = F.try_mod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))
        return F.array_join(F.transform(places, lambda i: F.get(w, F.when(i < a, i).otherwise(a + F.try_mod(i - a, p)).cast("int"))), " ")

    made = F.get(F.transform(words, lambda w: F.when(F.size(w) > 0, tail(w))), F.lit(0))
    changed = (F.crc32(F.col("doc_id").cast("string")) % 10 == 0) & F.col("text").isNotNull()
    return docs.withColumn("text", F.when(changed, F.coalesce(made, F.col("text"))).otherwise(F.col("text")))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf, "documents").select("doc_id", "text"))
    found = periodic_runs.with_runs(docs, ["doc_id"])
    # The longest run; of equally long ones the first, then the one of the shorter period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_vector_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return vector_dedup.near_groups(table(spark, sf, "embeddings"))


OP13_SQL = """
with recursive usable as materialized (
  select vec_id, label, embedding::double[] as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.v) = len(b.v)
    and list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.98
), reach(vec_id, seen) as (
  select vec_id, vec_id from embeddings union select reach.vec_id, links.b from reach join links on links.a = reach.seen
), least as (
  select vec_id, min(seen) as component_id from reach group by vec_id
), counts as (
  select a, count(*) as n from links group by a
)
select e.vec_id, coalesce(n, 0)::bigint as n_links, component_id::bigint as component_id, e.vec_id = component_id as kept
from embeddings e join least using (vec_id) left join counts on a = e.vec_id
"""

_ALL = (
    op1_best_fit_packing, op2_nearest_neighbours, op3_quality_classifier, op4_sharding, op5_chat_perspectives,
    op6_html_extraction, op7_language_id, op8_jaccard_join, op9_sentencepiece, op10_quality_rules,
    op11_collocations, op12_periodic_runs, op13_vector_dedup,
)
QUERIES = {f.__name__: f for f in _ALL}
SQL = {"op5_chat_perspectives": OP5_SQL, "op8_jaccard_join": OP8_SQL, "op10_quality_rules": OP10_SQL, "op11_collocations": OP11_SQL, "op13_vector_dedup": OP13_SQL}
