"""Conversation queries: assembly, validation, rendering, adapters, mixtures, requests, logs, tool calls.

Texts that the tables lack (math answers with tool tags, code tasks, server logs) are built from table columns by SQL
expressions that both engines evaluate."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.functions import chat, text as tx
from sparkcorpus.operators import conversations as conv
from sparkcorpus.operators import ordering, rendering, tokenization as tok
from sparkcorpus.plans.packing import chat_sql, rendered_chats
from sparkcorpus.plans.registry import query, table
from sparkcorpus.plans.tokens import MARK, PRETOKEN_PATTERN, SPACE
from sparkcorpus.session import fresh_path
from sparkcorpus.sources import reports

MAX_TOKENS = 2048
PART_TURNS, BLOCK = 4, 512


def chats(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return conv.validate_conversations(conv.assemble_conversations(turns, "conv_id", "turn", "role", "text"))


def digest_of(messages):
    return F.md5(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|"))


@query(f"""
with placed as (select *, (row_number() over (partition by conv_id order by turn) - 1) // {PART_TURNS} as part from conversations)
select conv_id, part, count(*) as n_messages, md5(string_agg(role || ':' || text, '|' order by turn)) as digest
from placed group by 1, 2""")
def assemble_conversations(spark, sf_dir):
    """Conversations as records of a bounded number of turns."""
    turns = table(spark, sf_dir, "conversations")
    parts = conv.assemble_parts(turns, "conv_id", "turn", "role", "text", PART_TURNS)
    return parts.select("conv_id", "part", F.size("messages").cast("long").alias("n_messages"), digest_of(F.col("messages")).alias("digest"))


def with_empty_answers(spark, sf_dir):
    """The turns, with nothing in the answers of every tenth conversation."""
    empty = (F.col("role") == "assistant") & (F.col("conv_id") % 10 == 4)
    return table(spark, sf_dir, "conversations").withColumn("text", F.when(~empty, F.col("text")))


NUMBERED = """
numbered as (
  select conv_id, turn, role, text, row_number() over c - 1 as p, first_value(role) over c = 'system' as has_system,
         count(*) over (partition by conv_id) as n, nth_value(role, 2) over c as second_role
  from conversations window c as (partition by conv_id order by turn rows between unbounded preceding and unbounded following)),
checks as (
  select conv_id, max(n) as n_turns, bool_or(has_system) as has_system, max(second_role) as second_role,
         bool_or(role = 'assistant' and (text is null or conv_id % 10 = 4)) as no_answer,
         bool_and(case when has_system and p = 0 then true
                       else role = case when (p - has_system::int) % 2 = 0 then 'user' else 'assistant' end end) as alternates
  from numbered group by 1)"""


@query(f"""
with {NUMBERED}
select conv_id, case when n_turns - has_system::int < 2 then 'too_short' when not alternates then 'bad_alternation' when no_answer then 'content_not_text' end as chat_reason,
       case when has_system and coalesce(second_role, '') <> 'user' then 'system_without_user' when not alternates then 'bad_alternation' when no_answer then 'no_content' end as render_reason
from checks""")
def validate_conversations(spark, sf_dir):
    built = conv.assemble_conversations(with_empty_answers(spark, sf_dir), "conv_id", "turn", "role", "text")
    return conv.validate_conversations(built).select("conv_id", "chat_reason", "render_reason")


@query(f"""
with {NUMBERED}
select conv_id, n_turns, has_system,
       case when n_turns - has_system::int < 2 then 'too_short' when not alternates then 'bad_alternation' when no_answer then 'content_not_text' end as chat_reason,
       case when has_system and coalesce(second_role, '') <> 'user' then 'system_without_user' when not alternates then 'bad_alternation' when no_answer then 'no_content' end as render_reason
from checks""")
def validate_turns(spark, sf_dir):
    return conv.validate_turns(with_empty_answers(spark, sf_dir), "conv_id", "turn", "role", "text")


@query(f"with {chat_sql(MAX_TOKENS)} select conv_id, p, role, md5(text) as digest from body where conv_id in (select conv_id from renderable)")
def merge_system(spark, sf_dir):
    merged = chats(spark, sf_dir).filter("render_reason is null").select("conv_id", chat.merge_system(F.col("messages")).alias("messages"))
    return merged.select("conv_id", F.posexplode("messages").alias("p", "m")).select(
        "conv_id", F.col("p").cast("long").alias("p"), "m.role", F.md5("m.content").alias("digest")
    )


@query(f"""
with {chat_sql(MAX_TOKENS)},
valid as (select * from body where conv_id in (select conv_id from renderable))
select conv_id, 0::bigint as seg_no, 'bos' as special, null as digest, 0 as supervised from renderable
union all select conv_id, 3 * p + 1, case role when 'user' then 'user_start' else 'assistant_start' end, null, 0 from valid
union all select conv_id, 3 * p + 2, null, md5(text), case role when 'user' then 0 else 1 end from valid
union all select conv_id, 3 * p + 3, case role when 'user' then 'user_end' else 'assistant_end' end, null, case role when 'user' then 0 else 1 end from valid""")
def render_segments(spark, sf_dir):
    good = chats(spark, sf_dir).filter("render_reason is null")
    segments = good.select("conv_id", F.posexplode(chat.render_segments(F.col("messages"))).alias("seg_no", "s"))
    return segments.select(
        "conv_id", F.col("seg_no").cast("long").alias("seg_no"), "s.special", F.md5("s.text").alias("digest"), "s.supervised"
    )


DECODED = "array_to_string(list_transform(regexp_extract_all(codes, '....'), lambda h: ('0x' || h)::int), ',')"


@query(f"""
with {chat_sql(MAX_TOKENS)}
select conv_id, length(mask) as n_tokens, length(replace(mask, '0', '')) as supervised, md5({DECODED}) as digest, md5(mask) as mask_digest from chats""")
def render_ids(spark, sf_dir):
    r = rendered_chats(spark, sf_dir, MAX_TOKENS)
    return r.select(
        "conv_id", F.size("ids").cast("long").alias("n_tokens"), F.size(F.filter("mask", lambda m: m == 1)).cast("long").alias("supervised"),
        F.md5(F.array_join("ids", ",")).alias("digest"), F.md5(F.array_join("mask", "")).alias("mask_digest"),
    )


@query(f"""
with {chat_sql(MAX_TOKENS).replace("from pieces group by 1", "from pieces where (conv_id, p) not in (select conv_id, max(p) from body group by 1) group by 1")},
answered as (select conv_id from body where (conv_id, p) in (select conv_id, max(p) from body group by 1) and role = 'assistant')
select conv_id, length(codes) // 4 + 1 as n_tokens, md5({DECODED} || ',259') as digest from chats where conv_id in (select conv_id from answered)""")
def render_prompt(spark, sf_dir):
    placed = rendering.place_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", last=False)
    ids = rendering.completion_prompts(placed, MAX_TOKENS)
    return ids.select(F.col("conv").alias("conv_id"), F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("digest"))


@query(f"""
with pieces as (
  select conv_id, turn, case role when 'user' then '0101' else '0103' end || regexp_replace(hex(encode(text)), '(..)', '00\\1', 'g')
         || case role when 'user' then '0102' else '0104' end as codes from conversations where role in ('user', 'assistant')),
placed as (select *, 1 + coalesce(sum(length(codes) // 4) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as start from pieces),
blocks as (
  select conv_id, (start + o)::bigint as start, codes[o * 4 + 1:(o + {BLOCK}) * 4] as codes
  from (select *, unnest(range(0, length(codes) // 4, {BLOCK})) as o from placed)
  union all select conv_id, 0, '0100' from placed group by 1
  union all select conv_id, (max(start + length(codes) // 4))::bigint, '0103' from placed group by 1)
select conv_id, start, length(codes) // 4 as n_tokens, md5({DECODED}) as digest from blocks""")
def render_serving_prompt(spark, sf_dir):
    """Prompts of any length, block by block."""
    placed = rendering.place_turns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", strict=False)
    blocks = rendering.serving_prompts(placed, block=BLOCK)
    return blocks.select(F.col("conv").alias("conv_id"), "start", F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("digest"))


TRAINED_MERGES = 128


@query(rf"""
with recursive {chat_sql(MAX_TOKENS)},
marked as (select conv_id, p, role, regexp_replace(text, '([{SPACE}])([\t\x0b\x0c \x{{85}}\p{{Z}}])([^{SPACE}])', '\1{MARK}\2\3', 'g') as text from body where conv_id in (select conv_id from renderable)),
cut as (
  select conv_id, p, role, list_filter(list_transform(regexp_extract_all(text, {PRETOKEN_PATTERN}), lambda w: replace(w, '{MARK}', '')), lambda w: w <> '') as words from marked),
placed_words as (select conv_id, p, role, unnest(words) as word, unnest(range(len(words))) as i from cut),
words as (
  select word, array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: chr(('0x' || h)::int)), '') as w, count(*) as n
  from placed_words group by 1),
run as (
  select 255 as rank, word, w, n from words
  union all
  select rank + 1, word, replace(w, best, chr(rank + 1)), n from run, (
    select pair as best from (
      select w[i:i + 1] as pair, sum(n) as total from (select w, n, unnest(range(1, length(w))) as i from run) group by 1)
    order by total desc, greatest(pair[1], pair[2]), pair limit 1)
  where rank < {255 + TRAINED_MERGES}),
encoded as (
  select conv_id, p, role, list_transform(string_split(string_agg(w, '' order by i), ''), lambda c: unicode(c)) as ids
  from placed_words join run using (word) where rank = {255 + TRAINED_MERGES} and conv_id in (select conv_id from renderable) group by 1, 2, 3),
turns as (
  select conv_id, p, case role when 'user' then [{256 + TRAINED_MERGES + 1}] || ids || [{256 + TRAINED_MERGES + 2}] else [{256 + TRAINED_MERGES + 3}] || ids || [{256 + TRAINED_MERGES + 4}] end as ids,
         case role when 'user' then list_transform(range(len(ids) + 2), lambda x: 0) else [0] || list_transform(range(len(ids) + 1), lambda x: 1) end as mask from encoded),
whole as (select conv_id, ([{256 + TRAINED_MERGES}] || flatten(list(ids order by p)))[1:{MAX_TOKENS}] as ids, ([0] || flatten(list(mask order by p)))[1:{MAX_TOKENS}] as mask from turns group by 1)
select conv_id, len(ids) as n_tokens, list_sum(mask)::bigint as supervised, md5(array_to_string(ids, ',')) as digest from whole""")
def render_trained_ids(spark, sf_dir):
    """Chats in a vocabulary trained on their own texts: ids and supervision of the first tokens of each."""
    turns = table(spark, sf_dir, "conversations")
    args = (turns, "conv_id", "turn", "role", "text")
    texts = rendering.body_turns(*args)
    ranks = tok.train_bpe(tok.pretoken_counts(texts), 256 + TRAINED_MERGES + len(chat.SPECIAL_TOKENS))
    r = rendering.render_heads(rendering.place_turns(*args, ranks=ranks), MAX_TOKENS, 256 + TRAINED_MERGES)
    supervised = F.size(F.filter("mask", lambda m: m == 1)).cast("long").alias("supervised")
    return r.select(F.col("conv").alias("conv_id"), F.size("ids").cast("long").alias("n_tokens"), supervised, F.md5(F.array_join("ids", ",")).alias("digest"))


# --- math answers -------------------------------------------------------------------------------------------------

A, B = "cast(l_quantity as int)", "(l_partkey % 97 + 1)"
PRODUCT = f"({A} * {B})"
SHOWN = f"({PRODUCT} + case when l_linenumber = 7 then 1 else 0 end)"
S = f"cast({SHOWN} as varchar(20))"
AB = f"cast({A} as varchar(20)), '*', cast({B} as varchar(20))"
COUNT_CALL = "concat(chr(39), 'strawberry', chr(39), '.count(', chr(39), 'r', chr(39), ')')"
MATH_ANSWER = f"""case l_linenumber % 5
 when 0 then concat('She buys ', {AB}, ': <<', {AB}, '=', {S}, '>>', {S}, ' in all.', chr(10), '#### ', {S})
 when 1 then concat('First <<', {AB}, '=', {S}, '>><<', {S}, '-1=', cast({SHOWN} - 1 as varchar(20)), '>> then.', chr(10), '#### 1,', {S}, '.50')
 when 2 then concat('No sign <<', {S}, '+1>> here, so <<', {AB}, '=c=', {S}, '>>')
 when 3 then concat('<<', {COUNT_CALL}, '=3>> letters', chr(10), '#### -', {S}, ' then #### 7')
 else concat('Plain total $', {S}, ' without marker.') end"""
RESPONSE = f"""case l_suppkey % 4
 when 0 then concat('I think so.', chr(10), '#### ', {S})
 when 1 then concat('The answer is ', {S}, ' dollars.')
 when 2 then concat('#### ', cast({SHOWN} + 1 as varchar(20)))
 else 'no idea' end"""
MATH_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
MATH_COLUMNS = MATH_KEY.split(", ")


def math_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *MATH_COLUMNS, F.expr(MATH_ANSWER).alias("answer"), F.expr(RESPONSE).alias("response"),
        F.concat(F.lit("How much is part "), F.col("l_partkey").cast("string"), F.lit("?")).alias("question"),
    )


PARTS_SQL = f"""
math as (select row_number() over () as rid, {MATH_KEY}, {MATH_ANSWER} as answer from lineitem),
pieces as (
  select rid, {MATH_KEY}, unnest(pieces) as piece, unnest(range(len(pieces))) as i, len(pieces) as n
  from (select *, regexp_extract_all(answer, '<<[^>]+>>|(?:[^<]|<[^<])+') as pieces from math)),
typed as (
  select rid, {MATH_KEY}, i, n, piece, piece like '<<%>>' as is_tag, piece[3:-3] as inner_text from pieces),
parts as (
  select rid, {MATH_KEY}, i * 2 as k, 'text' as type, piece as text from typed where not is_tag
  union all select rid, {MATH_KEY}, i * 2, 'python', case when contains(inner_text, '=') then regexp_replace(inner_text, '=[^=]*$', '') else inner_text end from typed where is_tag
  union all select rid, {MATH_KEY}, i * 2 + 1, 'python_output', case when contains(inner_text, '=') then regexp_extract(inner_text, '=([^=]*)$', 1) else '' end from typed where is_tag
  union all select rid, {MATH_KEY}, n * 2, 'text', '' from typed where is_tag and i = n - 1)"""


@query(f"""
with {PARTS_SQL}
select {MATH_KEY}, string_agg(type || '[' || text || ']', '' order by k) as parts from parts group by rid, {MATH_KEY}""")
def parse_tool_parts(spark, sf_dir):
    parts = tx.tool_parts(F.col("answer"))
    shown = F.array_join(F.transform(parts, lambda p: F.concat(p["type"], F.lit("["), p["text"], F.lit("]"))), "")
    return math_rows(spark, sf_dir).select(*MATH_COLUMNS, shown.alias("parts"))


@query(f"""
select {MATH_KEY}, replace(nullif(regexp_extract({MATH_ANSWER}, '#### (\\-?[0-9\\.\\,]+)', 1), ''), ',', '') as answer from lineitem""")
def extract_answer(spark, sf_dir):
    return math_rows(spark, sf_dir).select(*MATH_COLUMNS, tx.extract_answer(F.col("answer")).alias("answer"))


# --- choices ------------------------------------------------------------------------------------------------------

CHOICES_SQL = """
grouped as (
  select item_id // 4 as g, min_by(text, item_id) as question, list(text order by item_id) as choices, list(('L' || item_id % 4) order by item_id) as labels
  from benchmark group by 1),
items as (select *, (g % 4)::int as gold, case when g % 7 = 0 then 'Z' else 'L' || g % 4 end as answer_key from grouped)"""
PROMPT_SQL = """'Multiple Choice question: ' || question || chr(10)
  || list_aggregate(list_transform(range(len(choices)), lambda i: '- ' || choices[i + 1] || '=' || letters[i + 1] || chr(10)), 'string_agg', '')
  || chr(10) || 'Respond only with the letter of the correct answer.'"""


def choice_items(spark, sf_dir):
    """Four neighbouring benchmark texts as one question."""
    rows = F.array_sort(F.collect_list(F.struct("item_id", "text")))
    grouped = table(spark, sf_dir, "benchmark").groupBy(F.floor(F.col("item_id") / 4).alias("g")).agg(rows.alias("r"))
    label = lambda i: F.concat(F.lit("L"), (i % 4).cast("string"))
    return grouped.select(
        "g", F.col("r")[0]["text"].alias("question"), F.transform("r", lambda x: x["text"]).alias("texts"),
        F.transform("r", lambda x: label(x["item_id"])).alias("labels"), (F.col("g") % 4).cast("int").alias("gold"),
        F.when(F.col("g") % 7 == 0, "Z").otherwise(label(F.col("g"))).alias("answer_key"),
    )


@query(f"with {CHOICES_SQL} select g, md5({PROMPT_SQL}) as digest from (select *, ['A', 'B', 'C', 'D'] as letters from items)")
def render_choices(spark, sf_dir):
    letters = F.array(*[F.lit(l) for l in "ABCD"])
    prompt = tx.choices_prompt(F.col("question"), letters, F.col("texts"))
    return choice_items(spark, sf_dir).select("g", F.md5(prompt).alias("digest"))


@query(f"""
with {CHOICES_SQL}
select g, md5({PROMPT_SQL}) as digest, letters[gold + 1] as answer, 'S' || g % 3 as subject, null::varchar as fault
from (select *, ['A', 'B', 'C', 'D'] as letters from items)""")
def adapt_indexed_choice(spark, sf_dir):
    rows = choice_items(spark, sf_dir).select(
        "g", "question", F.col("texts").alias("choices"), F.col("gold").alias("answer"), F.concat(F.lit("S"), (F.col("g") % 3).cast("string")).alias("subject")
    )
    out = conv.adapt("indexed_choice", rows)
    return out.select("g", F.md5(F.col("messages")[0]["content"]).alias("digest"), F.col("messages")[1]["content"].alias("answer"), "subject", "fault")


@query(f"""
with {CHOICES_SQL}
select g, md5({PROMPT_SQL}) as digest, answer_key as answer, array_to_string(letters, ',') as letters,
       case when not list_contains(letters, answer_key) then 'key_not_a_label' end as fault from (select *, labels as letters from items)""")
def adapt_labelled_choice(spark, sf_dir):
    rows = choice_items(spark, sf_dir).select(
        "g", "question", F.struct(F.col("texts").alias("text"), F.col("labels").alias("label")).alias("choices"), F.col("answer_key").alias("answerKey")
    )
    out = conv.adapt("labelled_choice", rows)
    return out.select(
        "g", F.md5(F.col("messages")[0]["content"]).alias("digest"), F.col("messages")[1]["content"].alias("answer"),
        F.array_join("letters", ",").alias("letters"), "fault",
    )


# --- code tasks ---------------------------------------------------------------------------------------------------

ID = "cast(doc_id as varchar(20))"
CODE_PROMPT = f"""concat('import math', chr(10), '# helper', chr(10), '  from typing import List', chr(10), chr(10),
 case when doc_id % 3 = 0 then '' else concat('X = 1', chr(10), 'import os', chr(10)) end, 'def f', {ID}, '(x):', chr(10), '    return x')"""
CODE_SOLUTION = f"concat('    return x + ', {ID}, chr(10))"
CODE_TEST = f"concat('def check(f):', chr(10), '    assert f(0) == ', {ID})"
CODE_COMPLETION = f"""case doc_id % 4
 when 0 then concat(text, chr(10), '```python', chr(10), 'def f', {ID}, '(x): return x', chr(10), '```', chr(10), text)
 when 1 then concat('```', chr(10), '  a = 1', chr(10), chr(10), '```', chr(10), '```', chr(10), 'b = 2', chr(10), '```')
 when 2 then concat(chr(10), ' ', text, chr(9), chr(10))
 else concat('```python x = 1```', text) end"""
EDGES = r"^[\t-\r\x1c-\x1f \x{85}\p{Z}]+|[\t-\r\x1c-\x1f \x{85}\p{Z}]+$"
FENCE = r"(?s)```(?:python)?\s*\n(.*?)\n```"
BLOCK_SQL = f"case when regexp_matches(completion, '{FENCE}') then regexp_extract(completion, '{FENCE}', 1) else completion end"
PROGRAM_SQL = f"regexp_replace({BLOCK_SQL}, '{EDGES}', '', 'g')"
IMPORTS_SQL = """case when doc_id % 3 = 0 then 'import math' || chr(10) || 'from typing import List' else 'import math' || chr(10) || 'from typing import List' end"""


def code_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(CODE_PROMPT).alias("prompt"), F.expr(CODE_SOLUTION).alias("canonical_solution"),
        F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("entry_point"), F.expr(CODE_TEST).alias("test"),
        F.expr(CODE_COMPLETION).alias("completion"),
    )


@query(f"select doc_id, md5({CODE_PROMPT}) as prompt_digest, md5({CODE_PROMPT} || chr(10) || {CODE_SOLUTION}) as answer_digest, 'f' || doc_id as entry_point from documents")
def adapt_code_task(spark, sf_dir):
    out = conv.adapt("code", code_rows(spark, sf_dir))
    return out.select(
        "doc_id", F.md5(F.col("messages")[0]["content"]).alias("prompt_digest"), F.md5(F.col("messages")[1]["content"]).alias("answer_digest"), "entry_point"
    )


@query(f"select doc_id, {IMPORTS_SQL} as imports from documents")
def extract_imports(spark, sf_dir):
    return code_rows(spark, sf_dir).select("doc_id", tx.leading_imports(F.col("prompt")).alias("imports"))


@query(f"select doc_id, md5({PROGRAM_SQL}) as digest from (select doc_id, {CODE_COMPLETION} as completion from documents)")
def extract_program(spark, sf_dir):
    return code_rows(spark, sf_dir).select("doc_id", F.md5(tx.code_block(F.col("completion"))).alias("digest"))


@query(f"""
select doc_id, md5({IMPORTS_SQL} || chr(10) || chr(10) || {PROGRAM_SQL} || chr(10) || chr(10) || {CODE_TEST} || chr(10) || 'check(f' || doc_id || ')') as digest
from (select doc_id, {CODE_COMPLETION} as completion from documents)""")
def assemble_programs(spark, sf_dir):
    return conv.assemble_programs(code_rows(spark, sf_dir)).select("doc_id", F.md5("program").alias("digest"))


# --- mixtures -----------------------------------------------------------------------------------------------------

MIX_SQL = """
union_rows as (
  select 'docs' as task, 0 as copy, doc_id as key from documents
  union all select 'bench', c, item_id from benchmark, (select unnest([0, 1, 2]) as c)
  union all select 'good', c, doc_id from labels, (select unnest([0, 1]) as c) where quality = 1),
mixed as (select *, row_number() over (order by md5('42|' || task || '|' || copy || '|' || key), task, copy, key) - 1 as pos from union_rows)"""


def mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"))
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("key"))
    good = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").alias("key"))
    return conv.mix_datasets([("docs", docs, 1), ("bench", bench, 3), ("good", good, 2)], "key")


@query(f"with {MIX_SQL} select task, copy, key, pos from mixed")
def mix_datasets(spark, sf_dir):
    return mixture(spark, sf_dir).select("task", "copy", "key", "pos")


@query(f"""
with {MIX_SQL}, val as (select * from mixed where pos < 400)
select task, copy, count(*) as n_rows, round(count(*) / (select count(*) from val), 6) as share from val group by 1, 2""")
def mixture_report(spark, sf_dir):
    validation = ordering.slice_rows(mixture(spark, sf_dir), "pos", 0, 400)
    return conv.mixture_report(validation).withColumn("share", F.round("share", 6))


@query("""
select 0 as stage, 'bench' as task, item_id as key, item_id as pos from benchmark
union all select 1, 'docs', doc_id, doc_id + (select count(*) from benchmark) from documents""")
def sequence_datasets(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("key"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"))
    return conv.sequence_datasets([("bench", bench), ("docs", docs)], "key").select("stage", "task", "key", "pos")


# --- requests and logs --------------------------------------------------------------------------------------------

REQUEST_TEXT = """case when (conv_id + turn) % 37 = 0 then '' when conv_id % 11 = 0 then repeat(text, 12) else text end"""
REQUEST_FIELDS = {
    "temperature": "case when conv_id % 5 = 0 then null else cast(conv_id % 25 as double) / 10 end",
    "top_k": "cast(conv_id % 215 as int)",
    "max_tokens": "cast(conv_id * 53 % 4300 as int)",
}


def requests(spark, sf_dir):
    """Requests as the records in which they arrive."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.expr(REQUEST_TEXT))
    built = conv.assemble_conversations(turns, "conv_id", "turn", "role", "text")
    return built.select(F.col("conv_id").alias("request_id"), "messages", *[F.expr(e).alias(n) for n, e in REQUEST_FIELDS.items()])


REQUESTS_SQL = f"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn) - 1 as i, role, {REQUEST_TEXT} as text from conversations),
faults as (
  select conv_id, count(*) as n, sum(length(text)) as total,
         min_by(case when text = '' then 'empty_message:' || i else 'long_message:' || i end, i) filter (text = '' or length(text) > 8000) as message_fault,
         min_by('bad_role:' || i, i) filter (role not in ('user', 'assistant')) as role_fault from turns group by 1)
select conv_id as request_id,
       coalesce(case when n > 500 then 'too_many_messages' end, message_fault, case when total > 32000 then 'too_long' end, role_fault,
                case when not ({REQUEST_FIELDS['temperature']} between 0.0 and 2.0) then 'bad_temperature' end,
                case when not ({REQUEST_FIELDS['top_k']} between 0 and 200) then 'bad_top_k' end,
                case when not ({REQUEST_FIELDS['max_tokens']} between 1 and 4096) then 'bad_max_tokens' end) as reason from faults"""


@query(REQUESTS_SQL)
def validate_requests(spark, sf_dir):
    """Requests of any number of messages, judged on their turns."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.expr(REQUEST_TEXT))
    asked = turns.select("conv_id").distinct().select(F.col("conv_id").alias("request_id"), *[F.expr(e).alias(n) for n, e in REQUEST_FIELDS.items()])
    return rendering.validate_request_turns(turns, asked, "conv_id", "turn", "role", "text")


LOG_SQL = """
answered as (select conv_id, case when max_by(role, turn) = 'assistant' then max(turn) end as last_turn from conversations group by 1),
turns as (
  select c.conv_id, c.role, c.text, coalesce(turn = last_turn, false) as is_answer, last_turn is null as unanswered, row_number() over (partition by c.conv_id order by turn) - 1 as turn_no
  from conversations c join answered using (conv_id)),
files as (select conv_id, conv_id % 8 as file, row_number() over (partition by conv_id % 8 order by conv_id) - 1 as request_no from answered)"""


@query(f"""
with {LOG_SQL}
select 'file' || file as file, request_no, turn_no, role, case when is_answer then (conv_id % 3)::int end as worker, md5(text || chr(10) || 'ERROR:   disk full' || chr(10) || 'INFO:    retry') as digest,
       '2024-03-05 10:20:' || lpad((conv_id % 60)::varchar, 2, '0') || '.125' as logged_at, unanswered as interleaved
from turns join files using (conv_id)""")
def parse_chat_log(spark, sf_dir):
    built = conv.assemble_conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    pasted = "\nERROR:   disk full\nINFO:    retry"  # lines of a message that look like the server's own
    stamp = F.concat(F.lit("2024-03-05 10:20:"), F.lpad((F.col("conv_id") % 60).cast("string"), 2, "0"), F.lit(",125"))
    head = F.concat(stamp, F.lit(" - __main__ - \u001b[32m\u001b[1mINFO\u001b[0m - "))
    rule = lambda c: F.concat(head, F.lit(c * 20), F.lit("\n"))
    answered = F.element_at("messages", -1)["role"] == "assistant"
    asked = F.transform(
        F.slice("messages", F.lit(1), F.size("messages") - answered.cast("int")),
        lambda m: F.concat(head, F.lit("["), F.upper(m["role"]), F.lit("]: "), m["content"], F.lit(pasted + "\n")),
    )
    last = F.element_at("messages", -1)["content"]
    answer = F.concat(head, F.lit("[ASSISTANT] (GPU "), (F.col("conv_id") % 3).cast("string"), F.lit("): "), last, F.lit(pasted + "\n"))
    answer = F.when(answered, answer).otherwise("")
    access = F.lit('INFO:     127.0.0.1:52734 - "POST /chat/completions HTTP/1.1" 200 OK\n')
    # the text sink ends each block with the line end that belongs to its last line
    block = F.concat(rule("="), F.array_join(asked, ""), rule("-"), access, answer, head, F.lit("=" * 20))
    path = fresh_path(spark, "chatlog")
    rows = built.select(F.concat(F.lit("file"), (F.col("conv_id") % 8).cast("string")).alias("file"), "conv_id", block.alias("value"))
    rows.repartition("file").sortWithinPartitions("file", "conv_id").select("file", "value").write.partitionBy("file").text(path)
    turns = conv.parse_chat_log(reports.read_logs(spark, path))
    return turns.select(
        F.regexp_extract("path", "file=(file[0-9]+)/", 1).alias("file"), "request_no", "turn_no", "role", "worker", F.md5("text").alias("digest"),
        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("logged_at"), "interleaved",
    )


@query(f"""
with math as (select {MATH_KEY}, l_linenumber % 5 as kind, {S} as s, concat({AB}) as ab, {SHOWN} as shown, {PRODUCT} as product from lineitem)
select {MATH_KEY}, ab as expr, s as recorded, product::varchar as value, case when product = shown then 'match' else 'mismatch' end as status from math where kind in (0, 1)
union all select {MATH_KEY}, s || '-1', (shown - 1)::varchar, (shown - 1)::varchar, 'match' from math where kind = 1
union all select {MATH_KEY}, s || '+1', '', (shown + 1)::varchar, 'no_result' from math where kind = 2
union all select {MATH_KEY}, ab || '=c', s, null, 'not_allowed' from math where kind = 2
union all select {MATH_KEY}, {COUNT_CALL}, '3', '3', 'match' from math where kind = 3""")
def audit_tool_calls(spark, sf_dir):
    built = conv.adapt("math", math_rows(spark, sf_dir))
    return conv.audit_tool_calls(built, "messages", MATH_COLUMNS).drop("part_no")
