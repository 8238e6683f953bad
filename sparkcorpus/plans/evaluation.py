"""Evaluation queries: prompts, spans, scores, bits per byte, pass rates, rollouts.

Model outputs (losses, predictions, rewards) are columns derived from the tables by formulas both engines evaluate."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.functions import chat
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.functions.text import byte_ids
from sparkcorpus.operators import conversations as conv
from sparkcorpus.operators import ordering, prompts, rendering, rollouts, scoring
from sparkcorpus.operators.tokenization import byte_ranks, encode_bytes, encode_segment_bytes, token_bytes_table, vocab_table
from sparkcorpus.plans.chats import EDGES, MATH_ANSWER, MATH_COLUMNS, MATH_KEY, PARTS_SQL, RESPONSE, math_rows
from sparkcorpus.plans.packing import chat_sql, rendered_chats, weighted
from sparkcorpus.plans.registry import query, table

SHOTS, SEED, BOS = 3, 1234, chat.special_id("bos")


def items(spark, sf_dir):
    """Benchmark texts as evaluation items of all three kinds."""
    words = F.split("text", " ")
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("idx"), F.col("text").alias("query"), F.slice(words, 1, 4).alias("choices"),
        (F.col("item_id") % 4).cast("int").alias("gold"),
        F.array(F.concat(words[0], F.lit(" one")), F.concat(words[1], F.lit(" two"))).alias("context_options"),
        F.concat(F.lit("  "), F.col("text"), F.lit("\n")).alias("context"), words[0].alias("word"),
    )


ITEMS_SQL = f"""
items as (
  select item_id as idx, text, string_split(text, ' ') as words, (item_id % 4)::int as gold, (select count(*) from benchmark) as n,
         regexp_replace('  ' || text || chr(10), '{EDGES}', '', 'g') as context from benchmark),
draws as (
  select idx, j, ('0x' || md5('{SEED}|' || idx || '|' || j)[1:8])::bigint % (n - 1) as h from items, range(400) t(j)),
firsts as (select idx, h + (h >= idx)::int as shot_idx, min(j) as j from draws group by 1, 2),
shots as (
  select idx, shot_no::int as shot_no, shot_idx from (
    select idx, shot_idx, row_number() over (partition by idx order by j) - 1 as shot_no from firsts) where shot_no < {SHOTS}),
heads as (
  select s.idx, string_agg(p.text || ' ' || p.words[p.gold + 1] || chr(10) || chr(10), '' order by shot_no) as mc,
         string_agg(p.words[p.gold % 2 + 1] || case p.gold % 2 when 0 then ' one' else ' two' end || '; ' || p.text || chr(10) || chr(10), '' order by shot_no) as schema_head,
         string_agg(p.context || ' ' || p.words[1] || chr(10) || chr(10), '' order by shot_no) as lm
  from shots s join items p on p.idx = s.shot_idx group by 1),
mc as (select idx, o::int as option, mc || text || ' ' || words[o + 1] as prompt from items join heads using (idx), range(4) t(o)),
schema_prompts as (
  select idx, o::int as option, schema_head || words[o + 1] || case o when 0 then ' one' else ' two' end || '; ' || text as prompt
  from items join heads using (idx), range(2) t(o)),
lm as (
  select idx, o::int as option, case o when 0 then regexp_replace(lm || context || ' ', '{EDGES}', '', 'g') else lm || context || ' ' || words[1] end as prompt
  from items join heads using (idx), range(2) t(o))"""


def shots_of(spark, sf_dir):
    return prompts.sample_fewshot(items(spark, sf_dir), "idx", SHOTS, SEED)


def with_shots(spark, sf_dir, fields, **columns):
    pool = items(spark, sf_dir).withColumns(columns) if columns else items(spark, sf_dir)
    return prompts.attach_shots(pool, "idx", prompts.sample_fewshot(pool, "idx", SHOTS, SEED), fields)


def mc_prompts(spark, sf_dir):
    return prompts.render_mc_prompts(with_shots(spark, sf_dir, ["query", "choices", "gold"]), " ")


def schema_prompts(spark, sf_dir):
    df = with_shots(spark, sf_dir, ["context_options", "continuation", "gold"], continuation=F.col("query"), gold=F.col("gold") % 2)
    return prompts.render_schema_prompts(df, "; ")


def lm_prompts(spark, sf_dir):
    return prompts.render_lm_prompts(with_shots(spark, sf_dir, ["context", "continuation"], continuation=F.col("word")), " ")


def prompt_rows(df):
    return df.select("idx", F.posexplode("prompts").alias("option", "prompt")).select("idx", "option", F.md5("prompt").alias("digest"))


@query(f"with {ITEMS_SQL} select idx, shot_no, shot_idx from shots")
def sample_fewshot(spark, sf_dir):
    return shots_of(spark, sf_dir)


@query(f"with {ITEMS_SQL} select idx, option, md5(prompt) as digest from mc")
def render_mc_prompts(spark, sf_dir):
    return prompt_rows(mc_prompts(spark, sf_dir))


@query(f"with {ITEMS_SQL} select idx, option, md5(prompt) as digest from schema_prompts")
def render_schema_prompts(spark, sf_dir):
    return prompt_rows(schema_prompts(spark, sf_dir))


@query(f"with {ITEMS_SQL} select idx, option, md5(prompt) as digest from lm")
def render_lm_prompts(spark, sf_dir):
    return prompt_rows(lm_prompts(spark, sf_dir))


def shared_sql(name: str) -> str:
    """Shared prefix and suffix in bytes of all prompts of an item."""
    def same(cut: str) -> str:
        return f"len(list_filter(range(1, shortest + 1), lambda k: len(list_distinct(list_transform(hs, lambda h: {cut}))) = 1))"

    return f"""
{name}_shared as (
  select idx, {same('h[1:2 * k]')} as prefix, {same('h[len(h) - 2 * k + 1:]')} as suffix
  from (select idx, list(hex(encode(prompt))) as hs, min(strlen(prompt)) as shortest from {name} group by 1))"""


@query(f"with {ITEMS_SQL}, {shared_sql('mc')} select idx, (prefix + 1)::int as prefix, suffix::int as suffix from mc_shared")
def common_length(spark, sf_dir):
    seqs = prompts.encode_prompts(mc_prompts(spark, sf_dir), BOS)
    return seqs.select("idx", prompts.common_length(F.col("seqs")).alias("prefix"), prompts.common_length(F.col("seqs"), "right").alias("suffix"))


SPANS_SQL = f"""
{shared_sql('mc')}, {shared_sql('schema_prompts')},
spans as (
  select 'multiple_choice' as kind, idx, option, prefix + 1 as start, strlen(prompt) + 1 as stop, null as fault from mc join mc_shared using (idx)
  union all
  select 'schema', idx, option, strlen(prompt) + 1 - suffix, strlen(prompt) + 1, null from schema_prompts join schema_prompts_shared using (idx)
  union all
  select 'language_modeling', idx, 0, strlen(a.prompt) + 1, strlen(b.prompt) + 1,
         case when not starts_with(b.prompt, a.prompt) or strlen(a.prompt) = strlen(b.prompt) then 'not_a_prefix' end
  from (select idx, prompt from lm where option = 0) a join (select idx, prompt from lm where option = 1) b using (idx))"""


def all_spans(spark, sf_dir):
    union = None
    for kind, rows in (("multiple_choice", mc_prompts), ("schema", schema_prompts), ("language_modeling", lm_prompts)):
        part = prompts.answer_spans(prompts.encode_prompts(rows(spark, sf_dir), BOS), kind)
        part = part.select("idx", F.lit(kind).alias("kind"), "spans", "fault")
        union = part if union is None else union.unionByName(part)
    return union


@query(f"with {ITEMS_SQL}, {SPANS_SQL} select kind, idx, option, start::int as start, stop::int as stop, fault from spans")
def answer_spans(spark, sf_dir):
    rows = all_spans(spark, sf_dir).select("kind", "idx", "fault", F.posexplode("spans").alias("option", "s"))
    return rows.select("kind", "idx", "option", F.col("s.start").alias("start"), F.col("s.end").alias("stop"), "fault")


@query(f"""
with {ITEMS_SQL}, {SPANS_SQL},
cut as (select *, greatest(stop - 700, 0) as crop from spans)
select kind, idx, option, least(stop, 700)::int as n_tokens, (start - crop)::int as start, (stop - crop)::int as stop,
       coalesce(fault, case when start - crop < 0 then 'span_cut_off' end) as fault from cut""")
def crop_spans(spark, sf_dir):
    rows = prompts.crop_spans(all_spans(spark, sf_dir), 700)
    return rows.select("kind", "idx", "option", F.size("ids").alias("n_tokens"), "start", F.col("end").alias("stop"), "fault")


# --- scores -------------------------------------------------------------------------------------------------------

BYTES_SQL = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::int)"


@query(f"""
select idx, i::int as pos, ids[i + 2] as target, case when i < len(ids) - 1 then ((ids[i + 1] * 7 + i * 13) % 101) / 10.0::double end as loss
from (select idx, ids, unnest(range(len(ids))) as i from (select item_id as idx, {BYTES_SQL} as ids from benchmark))""")
def align_losses(spark, sf_dir):
    rows = items(spark, sf_dir).select("idx", byte_ids(F.col("query")).alias("ids"))
    losses = F.transform("ids", lambda t, i: ((t * 7 + i * 13) % 101) / F.lit(10.0))
    aligned = scoring.align_losses(rows.withColumn("losses", losses), "ids", "losses")
    return aligned.select("idx", F.posexplode("aligned").alias("pos", "a")).select("idx", "pos", "a.target", "a.loss")


LOSS = "((item_id * 31 + option * 17 + pos * 7) % 101) / 8.0"


@query(f"""
with losses as (
  select item_id, option, pos, ({LOSS})::double as loss, length(text) as n from benchmark, range(4) t(option), lateral (select unnest(range(length(text))) as pos)),
means as (
  select item_id, option, avg(loss) as mean_loss from losses
  where pos >= 5 + item_id % 3 + option - 1 and pos < least(n, 25 + 2 * option + item_id % 3) - 1 group by 1, 2)
select item_id, min_by(option, (mean_loss, option))::int as predicted, round(min(mean_loss), 6) as best_loss, (item_id % 4)::int as gold,
       min_by(option, (mean_loss, option)) = item_id % 4 as correct from means group by 1""")
def score_options(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("option"))
    losses = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda pos: ((F.col("item_id") * 31 + F.col("option") * 17 + pos * 7) % 101) / 8.0)
    start = F.lit(5) + F.col("item_id") % 3 + F.col("option")
    options = bench.select(
        "item_id", "option", losses.alias("losses"), start.alias("start"),
        F.least(F.col("n"), F.lit(25) + 2 * F.col("option") + F.col("item_id") % 3).alias("end"), (F.col("item_id") % 4).cast("int").alias("gold"),
    )
    return scoring.score_options(options, ["item_id"]).withColumn("best_loss", F.round("best_loss", 6))


@query(f"""
with tokens as (
  select item_id, unnest(ids[2:]) as target_id, unnest(range(len(ids) - 1)) as pos from (select item_id, {BYTES_SQL} as ids from benchmark))
select item_id, bool_and(case when (item_id * pos) % 50 = 7 then -1 else target_id end = target_id) as correct, count(*) as span_tokens
from tokens where pos >= 3 + item_id % 5 - 1 and pos < 40 + item_id % 7 - 1 group by 1""")
def score_exact_span(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark")
    ids = bench.select("item_id", byte_ids(F.col("text")).alias("ids"))
    tokens = ids.select("item_id", F.posexplode(F.slice("ids", F.lit(2), F.size("ids") - 1)).alias("pos", "target_id"))
    tokens = tokens.withColumn("pred_id", F.when((F.col("item_id") * F.col("pos")) % 50 == 7, -1).otherwise(F.col("target_id")))
    spans = bench.select("item_id", (3 + F.col("item_id") % 5).alias("start"), (40 + F.col("item_id") % 7).alias("end"))
    return scoring.score_exact_span(tokens, spans, ["item_id"])


def labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").drop("text").join(table(spark, sf_dir, "labels"), "doc_id")


@query("select lang, count(*) as items, round(avg(quality), 6) as accuracy from documents join labels using (doc_id) group by 1")
def task_accuracy(spark, sf_dir):
    return scoring.task_accuracy(labelled(spark, sf_dir), ["lang"], "quality").withColumn("accuracy", F.round("accuracy", 6))


CENTERED_SQL = """
scores as (
  select source as label, avg(quality) as accuracy, (ascii(source[-1:]) % 4) * 0.125 as random_baseline
  from documents join labels using (doc_id) group by 1),
centered as (select *, (accuracy - random_baseline) / (1.0 - random_baseline) as centered from scores)"""


def source_scores(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumnRenamed("source", "label")
    accuracies = scoring.task_accuracy(rows, ["label"], "quality")
    baselines = table(spark, sf_dir, "documents").select(
        F.col("source").alias("label"), (F.ascii(F.substring("source", -1, 1)) % 4 * 0.125).alias("random_baseline")
    ).distinct()
    return scoring.centered_scores(accuracies, baselines)


@query(f"with {CENTERED_SQL} select label, round(accuracy, 6) as accuracy, round(random_baseline, 6)::double as random_baseline, round(centered, 6) as centered from centered")
def centered_scores(spark, sf_dir):
    return source_scores(spark, sf_dir).select("label", *[F.round(c, 6).alias(c) for c in ("accuracy", "random_baseline", "centered")])


@query(f"with {CENTERED_SQL} select round(avg(centered), 6) as core, count(*) as tasks from centered")
def core_score(spark, sf_dir):
    return scoring.core_score(source_scores(spark, sf_dir)).withColumn("core", F.round("core", 6))


@query("""
with required as (select * from (values ('en', 0.25, true), ('fr', 0.25, true), ('de', 0.0, false), ('es', 0.0, false)) t(label, baseline, categorical)),
scores as (
  select doc_id % 5 as grp, lang as label, avg(quality) as accuracy from documents join labels using (doc_id)
  where not (doc_id % 5 = 2 and lang = 'es') and not (doc_id % 5 = 3 and lang = 'fr') group by 1, 2),
centered as (select grp, label, categorical, (accuracy - baseline) / (1.0 - baseline) as c from scores join required using (label))
select grp, count(distinct label) as tasks, case when count(distinct label) = 4 then round(avg(c), 6) end as composite,
       case when count(distinct label) filter (categorical) = 2 then round(avg(c) filter (categorical), 6) end as composite_cat from centered group by 1""")
def composite_score(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("grp", F.col("doc_id") % 5).withColumnRenamed("lang", "label")
    rows = rows.filter("not (grp = 2 and label = 'es') and not (grp = 3 and label = 'fr')")
    scores = scoring.task_accuracy(rows, ["grp", "label"], "quality")
    required = spark.createDataFrame(
        [("en", 0.25, True), ("fr", 0.25, True), ("de", 0.0, False), ("es", 0.0, False)], "label string, random_baseline double, categorical boolean"
    )
    out = scoring.composite_score(scores, required, ["grp"])
    return out.withColumn("composite", F.round("composite", 6)).withColumn("composite_cat", F.round("composite_cat", 6))


@query("""
with ranked as (
  select vec_id, label, i - 1 as letter, row_number() over (partition by vec_id order by score desc, i) as r from (
    select vec_id, label, unnest(embedding[1:10]) as score, unnest(range(1, 11)) as i from embeddings))
select vec_id, letter::int as chosen, letter = label as correct from ranked where r = 1""")
def choose_letter(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").withColumn("allowed", F.array(*[F.lit(i) for i in range(10)]))
    return scoring.choose_letter(rows, "embedding", "allowed").select("vec_id", "chosen", (F.col("chosen") == F.col("label")).alias("correct"))


GRADED_SQL = f"""
answers as (select {MATH_KEY}, {MATH_ANSWER} as answer, {RESPONSE} as response from lineitem),
graded as (
  select {MATH_KEY}, replace(nullif(regexp_extract(answer, '#### (\\-?[0-9\\.\\,]+)', 1), ''), ',', '') as ref_answer,
         replace(nullif(regexp_extract(response, '#### (\\-?[0-9\\.\\,]+)', 1), ''), ',', '') as pred_answer,
         replace(regexp_extract_all(response, '-?[0-9][0-9,]*(?:\\.[0-9]+)?')[-1], ',', '') as last_number from answers)"""


@query(f"with {GRADED_SQL} select {MATH_KEY}, ref_answer, pred_answer, ref_answer is not distinct from pred_answer as correct, pred_answer is null as unparsed from graded")
def grade_math(spark, sf_dir):
    return scoring.grade("math", math_rows(spark, sf_dir), "answer", "response").select(*MATH_COLUMNS, "ref_answer", "pred_answer", "correct", "unparsed")


FORMAT_ONLY = "coalesce(pred_answer is null and ref_answer is not null and try_cast(last_number as double) = try_cast(ref_answer as double), false)"


@query(f"with {GRADED_SQL} select {MATH_KEY}, pred_answer, last_number, {FORMAT_ONLY} as format_only_failure from graded")
def format_diagnostics(spark, sf_dir):
    return scoring.format_diagnostics(math_rows(spark, sf_dir), "answer", "response").select(
        *MATH_COLUMNS, "pred_answer", "last_number", "format_only_failure"
    )


@query(f"""
with {GRADED_SQL}
select l_linenumber, count(*) as responses, count(*) filter (ref_answer is not distinct from pred_answer) as correct,
       count(*) filter (pred_answer is null) as unparsed, count(last_number) as with_number, count(*) filter ({FORMAT_ONLY}) as format_only
from graded group by 1""")
def diagnostics_summary(spark, sf_dir):
    return scoring.diagnostics_summary(scoring.format_diagnostics(math_rows(spark, sf_dir), "answer", "response"), ["l_linenumber"])


@query("""
with rows as (select l_orderkey, l_linenumber, l_partkey, substr('ABCDE', (l_partkey % 5 + 1)::int, 1) as response, substr('ABCD', (l_suppkey % 4 + 1)::int, 1) as gold from lineitem)
select l_orderkey, l_linenumber, l_partkey, response, case when response = 'E' then 'not_a_letter' end as fault,
       case when response <> 'E' then response = gold end as correct from rows""")
def grade_choice(spark, sf_dir):
    letter = lambda text, c, n: F.substring(F.lit(text), (F.col(c) % n + 1).cast("int"), F.lit(1))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", letter("ABCDE", "l_partkey", 5).alias("response"), letter("ABCD", "l_suppkey", 4).alias("gold"),
        F.array(*[F.lit(l) for l in "ABCD"]).alias("letters"),
    )
    return scoring.grade("choice", rows, "response", "gold", "letters").drop("gold", "letters")


# Per-token losses in sixteenths, so that sums are exact in any order.
TOKEN_LOSS = "((doc_id * 31 + pos * 7 + byte) % 97) / 16.0"
TOKEN_TARGET = "case when pos % 11 = 0 then -1 when pos % 13 = 0 then 256 when pos % 101 = 0 then 999 else byte end"
TOKEN_LOSSES_SQL = f"""
tokens as (
  select lang, source, doc_id, unnest(ids) as byte, unnest(range(len(ids))) as pos from (select lang, source, doc_id, {BYTES_SQL} as ids from documents)),
losses as (
  select lang, source, {TOKEN_TARGET} as target_id, case when (pos + doc_id) % 1009 = 5 then 'nan'::double else ({TOKEN_LOSS})::double end as bad_loss,
         ({TOKEN_LOSS})::double as loss from tokens)"""


def token_losses(spark, sf_dir):
    docs = encode_bytes(table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "text"))
    tokens = docs.select("lang", "source", "doc_id", F.posexplode("ids").alias("pos", "byte"))
    return tokens.select(
        "lang", "source", F.expr(TOKEN_TARGET).alias("target_id"), F.expr(f"double({TOKEN_LOSS})").alias("loss"),
        F.expr(f"case when (pos + doc_id) % 1009 = 5 then double('NaN') else double({TOKEN_LOSS}) end").alias("bad_loss"),
    )


def byte_lengths(spark):
    return token_bytes_table(vocab_table(byte_ranks(spark)))


@query(f"""
with {TOKEN_LOSSES_SQL}
select lang, sum(loss) filter (target_id between 0 and 255) as nats, count(*) filter (target_id between 0 and 255) as n_bytes,
       round(sum(loss) filter (target_id between 0 and 255) / (ln(2) * count(*) filter (target_id between 0 and 255)), 6) as bpb,
       count(*) filter (target_id = 999) as unknown_targets, 0::bigint as bad_losses from losses group by 1""")
def bits_per_byte(spark, sf_dir):
    return scoring.bits_per_byte(token_losses(spark, sf_dir), byte_lengths(spark), ["lang"]).withColumn("bpb", F.round("bpb", 6))


@query(f"""
with {TOKEN_LOSSES_SQL}
select source, count(*) filter (isnan(bad_loss) and target_id <= 256) as bad_losses,
       round(avg(bad_loss) filter (not isnan(bad_loss) and target_id <= 256), 6) as mean_loss, count(*) filter (target_id > 256) as unknown_targets,
       count(*) filter (not isnan(bad_loss) and target_id <= 256) as targets, sum(bad_loss) filter (not isnan(bad_loss) and target_id < 256) as nats,
       count(*) filter (not isnan(bad_loss) and target_id < 256) as n_bytes,
       round(sum(bad_loss) filter (not isnan(bad_loss) and target_id < 256) / (ln(2) * count(*) filter (not isnan(bad_loss) and target_id < 256)), 6) as bpb
from losses where target_id >= 0 group by 1""")
def loss_summary(spark, sf_dir):
    losses = token_losses(spark, sf_dir).drop("loss").withColumnRenamed("bad_loss", "loss")
    out = scoring.loss_summary(losses, byte_lengths(spark), ["source"])
    return out.withColumn("mean_loss", F.round("mean_loss", 6)).withColumn("bpb", F.round("bpb", 6))


@query(f"""
with {TOKEN_LOSSES_SQL}
select source, case when target_id > 256 then 'unknown_target' else 'loss_not_finite' end as reason, count(*) as n
from losses where target_id > 256 or (target_id >= 0 and isnan(bad_loss)) group by 1, 2""")
def error_losses(spark, sf_dir):
    losses = token_losses(spark, sf_dir).drop("loss").withColumnRenamed("bad_loss", "loss")
    return scoring.error_losses(losses, byte_lengths(spark)).groupBy("source", "reason").agg(F.count("*").alias("n"))


@query("""
with sums as (select l_suppkey, sum(l_extendedprice) as a, sum(floor(l_extendedprice)) as b from lineitem group by 1)
select l_suppkey, round(a, 2) as left_value, round(b, 2) as right_value,
       abs(a - b) <= greatest(2e-5 * greatest(abs(a), abs(b)), 2e-5) as agrees from sums""")
def reconcile_metrics(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    a = rows.groupBy("l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    b = rows.groupBy("l_suppkey").agg(F.sum(F.floor("l_extendedprice").cast("double")).alias("v"))
    out = scoring.reconcile_metrics(a, b, ["l_suppkey"], "v")
    return out.withColumn("left_value", F.round("left_value", 2)).withColumn("right_value", F.round("right_value", 2))


# --- samples and rollouts -----------------------------------------------------------------------------------------


def samples(spark, sf_dir):
    """Events as samples: the prompt is the user, samples are numbered from 1 in event order."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    placed = ordering.with_position(events, ["event_id"], width_bucket(F.col("event_id"), 4096), "sample_no", ["user_id"])
    return placed.withColumn("sample_no", F.col("sample_no") + 1).withColumn("correct", F.expr("event_type = 'purchase' and value > 50"))


SAMPLES_SQL = """
samples as (
  select *, row_number() over (partition by user_id order by event_id) as sample_no, event_type = 'purchase' and value > 50 as correct from events)"""


@query(f"""
with {SAMPLES_SQL}, per as (select user_id, bool_or(correct) as passed, user_id % 4 as grp from samples group by user_id)
select grp, count(*) as problems, round(avg(passed::int), 6) as pass_rate from per group by 1""")
def any_pass_rate(spark, sf_dir):
    rows = samples(spark, sf_dir).withColumn("grp", F.col("user_id") % 4)
    return rollouts.any_pass_rate(rows, "user_id", ["grp"]).withColumn("pass_rate", F.round("pass_rate", 6))


@query(f"""
with {SAMPLES_SQL}, firsts as (select user_id, min(sample_no) filter (correct) as first_ok from samples group by 1)
select k::int as k, count(*) as problems, round(avg(coalesce(first_ok <= k, false)::int), 6) as pass_rate from firsts, range(1, 17) t(k) group by 1""")
def pass_at_k(spark, sf_dir):
    curve = rollouts.pass_at_k(samples(spark, sf_dir), "user_id", "sample_no", 16)
    return curve.withColumn("pass_rate", F.round("pass_rate", 6))


@query("""
with rows as (select event_id, case when user_id % 7 <> 3 then user_id end as user_id, value from events)
select event_id, user_id, round(avg(value) over (partition by user_id), 9) as mean_reward,
       round(value - avg(value) over (partition by user_id), 9) as advantage from rows""")
def advantages(spark, sf_dir):
    prompt = F.when(F.col("user_id") % 7 != 3, F.col("user_id")).alias("user_id")
    rows = table(spark, sf_dir, "events").select("event_id", prompt, F.col("value").alias("reward"))
    return rollouts.advantages(rows, ["user_id"]).select(
        "event_id", "user_id", F.round("mean_reward", 9).alias("mean_reward"), F.round("advantage", 9).alias("advantage")
    )


@query(f"""
with {chat_sql(10_000_000)},
tokens as (
  select conv_id, unnest(range(length(mask))) as i, unnest(regexp_extract_all(codes, '....')) as code, unnest(string_split(mask, '')) as flag from chats),
lengths as (select conv_id, length(mask) as n, max(length(mask)) over (partition by conv_id // 8) as longest from chats),
sums as (
  select conv_id, (sum(('0x' || code)::int * (i + 1)) filter (i < longest - 1))::bigint as inputs_sum,
         (sum(case when flag = '1' then ('0x' || code)::int else -1 end * i) filter (i > 0))::bigint as targets_sum
  from tokens join lengths using (conv_id) group by 1)
select conv_id, longest - 1 as n_inputs,
       (inputs_sum + 256 * ((longest - 1) * longest - least(n, longest - 1) * (least(n, longest - 1) + 1)) // 2)::bigint as inputs_sum,
       (targets_sum - (longest * (longest - 1) - n * (n - 1)) // 2)::bigint as targets_sum from sums join lengths using (conv_id)""")
def rollout_targets(spark, sf_dir):
    rows = rendered_chats(spark, sf_dir, 10_000_000).withColumn("batch", F.floor(F.col("conv_id") / 8))
    out = rollouts.rollout_targets(rows, ["batch"], "ids", "mask", BOS)
    return out.select(
        "conv_id", F.size("inputs").cast("long").alias("n_inputs"), weighted(F.col("inputs")).alias("inputs_sum"),
        weighted(F.col("targets")).alias("targets_sum"),
    )


@query("""
with tokens as (
  select user_id % 10 as step, (event_id % 4)::int as pass_no, event_id % 7 - 1 as target_id, -value / 100 as logp, (event_id % 5 - 2)::double as advantage from events)
select step, pass_no, round(sum(case when target_id >= 0 then logp * advantage else 0 end), 6) as weighted, count(*) filter (target_id >= 0) as valid_tokens,
       round(sum(case when target_id >= 0 then logp * advantage else 0 end) / (greatest(count(*) filter (target_id >= 0), 1) * 4 * 16), 12) as objective
from tokens group by 1, 2""")
def policy_objective(spark, sf_dir):
    tokens = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("step"), (F.col("event_id") % 4).cast("int").alias("pass_no"), (F.col("event_id") % 7 - 1).alias("target_id"),
        (-F.col("value") / 100).alias("logp"), (F.col("event_id") % 5 - 2).cast("double").alias("advantage"),
    )
    out = rollouts.policy_objective(tokens, "step", "pass_no", passes=4, examples=16)
    return out.withColumn("weighted", F.round("weighted", 6)).withColumn("objective", F.round("objective", 12))


@query("""
with per as (
  select event_id % 20 as step, user_id, avg(value) as r, sum(length(props))::bigint as length, count(*) as n from events group by 1, 2)
select step, round(avg(r), 6) as mean_reward, round(sum(length) / sum(n), 6) as mean_length, sum(n)::bigint as samples from per group by 1""")
def rollout_report(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        (F.col("event_id") % 20).alias("step"), "user_id", F.col("value").alias("reward"), F.length("props").alias("n_tokens")
    )
    out = rollouts.rollout_report(rows, "step", "user_id", "reward", "n_tokens")
    return out.withColumn("mean_reward", F.round("mean_reward", 6)).withColumn("mean_length", F.round("mean_length", 6))


CUT_BLOCK = 512


@query(f"""
with {chat_sql(10_000_000)},
ids as (select conv_id, list_transform(regexp_extract_all(codes, '....'), lambda h: ('0x' || h)::int) as ids from chats),
cut as (select conv_id, ids, list_position(ids, 260) as e from ids),
turns as (select conv_id, p, length(codes) // 4 as n, 1 + coalesce(sum(length(codes) // 4) over (partition by conv_id order by p rows between unbounded preceding and 1 preceding), 0) as start from pieces),
blocks as (select conv_id, start + o as start, least({CUT_BLOCK}, n - o) as n from (select *, unnest(range(0, n, {CUT_BLOCK})) as o from turns))
select conv_id, start::bigint as start, case when e > 0 then least(n, e - 1 - start) else n end::bigint as kept,
       md5(array_to_string(ids[start + 1:start + case when e > 0 then least(n, e - 1 - start) else n end], ',')) as digest,
       case when e > 0 then 'assistant_end' else 'max_new_tokens' end as stop_reason
from blocks join cut using (conv_id) where e is null or e = 0 or start < e - 1""")
def truncate_completions(spark, sf_dir):
    """Rendered chats, block by block, cut where the first answer ends."""
    placed = rendering.place_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    out = rendering.truncate_blocks(rendering.token_blocks(placed, block=CUT_BLOCK))
    return out.select(F.col("conv").alias("conv_id"), "start", F.size("kept").cast("long").alias("kept"), F.md5(F.array_join("kept", ",")).alias("digest"), "stop_reason")


@query(f"""
with {PARTS_SQL},
sized as (
  select *, strlen(text) + case type when 'text' then 0 else 2 end as n, 4 + strlen('How much is part ' || l_partkey || '?') as base from parts),
placed as (
  select *, base + sum(n) over k - n as start, base + sum(n) over (partition by rid) + 1 as n_tokens,
         base + coalesce(sum(n) filter (type = 'python_output') over (partition by rid), 0) as forced_tokens
  from sized window k as (partition by rid order by k rows unbounded preceding))
select {MATH_KEY}, forced_tokens::int as forced_tokens, n_tokens::int as n_tokens, case type when 'python' then 'python' else 'output' end as kind,
       start::int as start, (start + n - 1)::int as stop, text as span, case type when 'python' then strlen(text) else 0 end::int as sampled
from placed where type <> 'text'""")
def extract_tool_spans(spark, sf_dir):
    built = conv.adapt("math", math_rows(spark, sf_dir))
    segments = encode_segment_bytes(built.select(*MATH_COLUMNS, chat.render_segments(F.col("messages")).alias("segments")))
    r = chat.rendered(F.col("segments"), 2**30, F.col("encoded")).alias("r")
    rows = segments.select(*MATH_COLUMNS, r).select(*MATH_COLUMNS, "r.ids", "r.mask")
    out = rollouts.extract_tool_spans(rows, MATH_COLUMNS, "ids", "mask")
    text = F.array_join(F.transform("span_ids", lambda i: F.char(i)), "")
    return out.select(*MATH_COLUMNS, "forced_tokens", "n_tokens", "kind", "start", F.col("end").alias("stop"), text.alias("span"), "sampled")


RETURN_CODE = "cast(event_id % 3 as int)"
STDERR = """case event_type
 when 'error' then concat('Traceback (most recent call last):', chr(10), '  File x', chr(10), 'MemoryError', chr(10))
 when 'click' then concat(chr(10), ' ', chr(9))
 when 'view' then concat('warning', chr(13), chr(10), 'ValueError: ', cast(user_id as varchar(20)), chr(10), chr(10))
 else '' end"""
TIMED_OUT = "(event_id % 17 = 0)"


@query(f"""
with rows as (select event_id, {RETURN_CODE} as code, {STDERR} as stderr, {TIMED_OUT} as timed_out from events),
trimmed as (select *, regexp_replace(stderr, '{EDGES}', '', 'g') as t from rows)
select event_id, not timed_out and code = 0 as success,
       case when timed_out then 'Execution timed out (process killed)' when code = 0 then null when t = '' then 'Execution failed'
            else regexp_split_to_array(t, '\\r\\n|\\n|\\r')[-1] end as error,
       timed_out as timeout, not timed_out and contains(stderr, 'MemoryError') as memory_exceeded from trimmed""")
def classify_outcomes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.expr(RETURN_CODE).alias("returncode"), F.lit("").alias("stdout"), F.expr(STDERR).alias("stderr"), F.expr(TIMED_OUT).alias("timed_out")
    )
    return rollouts.classify_outcomes(rows).select("event_id", "success", "error", "timeout", "memory_exceeded")


@query(f"""
with scores as (select vec_id, unnest(embedding)::double as s, unnest(range(64)) as i from embeddings),
ranked as (select *, row_number() over (partition by vec_id order by s desc, i) as r, max(s) over (partition by vec_id) as best from scores),
kept as (select *, exp((s - best) / 0.7) as w from ranked where r <= 5),
shares as (select vec_id, i, r, w / sum(w) over (partition by vec_id) as p from kept),
running as (
  select *, sum(p) over (partition by vec_id order by r rows unbounded preceding) as c, ('0x' || md5('7|' || vec_id)[1:8])::bigint / 4294967296.0 as u from shares)
select vec_id, r::int as rank, i::int as idx, round(p, 6) as p, (first_value(i) over (partition by vec_id order by (u < c) desc, r))::int as picked from running""")
def topk_softmax(spark, sf_dir):
    key = F.concat(F.lit("7|"), F.col("vec_id").cast("string"))
    out = rollouts.topk_softmax(table(spark, sf_dir, "embeddings"), "embedding", 5, 0.7, key)
    return out.select("vec_id", F.posexplode("top").alias("r", "t"), "picked").select(
        "vec_id", (F.col("r") + 1).alias("rank"), "t.idx", F.round("t.p", 6).alias("p"), "picked"
    )
