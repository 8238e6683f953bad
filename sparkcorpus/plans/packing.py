"""Packing queries. Tokens are bytes with a document start, so SQL can follow every placement."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sparkcorpus.functions.arrays import mask_padding, mask_targets as masked, shift_inputs, shift_targets as shifted
from sparkcorpus.functions.chat import rendered, render_segments, special_id
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.functions.text import byte_ids
from sparkcorpus.operators import conversations as conv
from sparkcorpus.operators import packing
from sparkcorpus.operators.tokenization import encode_bytes, with_specials
from sparkcorpus.plans.registry import query, table
from sparkcorpus.session import fresh_path

CAPACITY, DOCS_PER_GROUP, BUFFER = 2049, packing.DOCS_PER_GROUP, 1000
CHAT_TOKENS, CHAT_CAPACITY, CHAT_BUFFER = 10_000_000, 4097, 100


def lengths(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length("text") + 1).alias("n_tokens"))
    return packing.pack_groups(docs, "doc_id", DOCS_PER_GROUP)


DOC_GROUPS = f"""
groups as (
  select doc_id // {DOCS_PER_GROUP} as grp, list((strlen(text) + 1)::bigint order by doc_id) as lens, list(doc_id order by doc_id) as docs
  from documents group by 1)"""


def best_fit_sql(groups: str, capacity: int, buffer: int, crop: bool) -> str:
    """Best-fit placements in SQL. A waiting document is coded as length * 1e6 + (999999 - arrival), so the largest
    code is the longest document and, among equals, the earliest."""
    fallback = "list_max(list_filter(w, lambda e: e < (list_min(w) // 1000000 + 1) * 1000000))" if crop else "null"
    return f"""
with recursive {groups},
run as (
  select grp, []::bigint[] as waiting, 0::bigint as arrived, 0::bigint as row_next, {capacity}::bigint as room_next, 0::bigint as slot_next,
         null::bigint as row_no, null::bigint as slot, null::bigint as doc, null::bigint as off, null::bigint as take, null::bigint as n_tokens,
         false as finished
  from groups
  union all
  select grp, list_filter(w, lambda e: e <> coalesce(chosen, -1)), now_arrived,
         case when chosen is null or room = used then row_cur + 1 else row_cur end,
         case when chosen is null or room = used then {capacity} else room - used end,
         case when chosen is null or room = used then 0 else slot_cur + 1 end,
         row_cur, slot_cur, docs[(999999 - chosen % 1000000) + 1], {capacity} - room, used, chosen // 1000000, len(w) = 0
  from (
    select *, least(chosen // 1000000, room) as used from (
      select *, coalesce(list_max(list_filter(w, lambda e: e < (room + 1) * 1000000)), {fallback}) as chosen from (
        select r.grp, g.docs, r.row_next as row_cur, r.room_next as room, r.slot_next as slot_cur,
               least(len(g.lens), r.arrived + {buffer} - len(r.waiting)) as now_arrived,
               list_concat(r.waiting, list_transform(range(r.arrived, least(len(g.lens), r.arrived + {buffer} - len(r.waiting))),
                                                     lambda i: g.lens[i + 1] * 1000000 + 999999 - i)) as w
        from run r join groups g on g.grp = r.grp where not r.finished))
  )
),
placements as (
  select grp as pack_group, row_no, slot::int as slot, doc, off::int as "offset", take::int as take, n_tokens::int as n_tokens
  from run where doc is not null and not finished)"""


PLACED = ["pack_group", "row_no", "slot", "doc", "offset", "take", "n_tokens"]


@query(best_fit_sql(DOC_GROUPS, CAPACITY, BUFFER, True) + f"""
select *, sum(take) over (partition by pack_group, row_no) = {CAPACITY} as complete from placements""")
def pack_bestfit_crop(spark, sf_dir):
    return packing.pack_bestfit_crop(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY, BUFFER)


FITTING_GROUPS = DOC_GROUPS.replace("from documents", f"from documents where strlen(text) + 1 <= {CAPACITY}")


@query(best_fit_sql(FITTING_GROUPS, CAPACITY, BUFFER, False) + " select * from placements")
def pack_bestfit_pad(spark, sf_dir):
    placed = packing.pack_bestfit_pad(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY, BUFFER)
    return placed.select(*PLACED)


@query(f"select doc_id, (strlen(text) + 1)::int as n_tokens from documents where strlen(text) + 1 > {CAPACITY}")
def oversize_documents(spark, sf_dir):
    return packing.oversize(lengths(spark, sf_dir), "n_tokens", CAPACITY).select("doc_id", "n_tokens")


def greedy_sql(crop: bool) -> str:
    opens = "false" if crop else f"g.lens[r.i + 1] > r.room and r.room < {CAPACITY}"
    return f"""
with recursive {DOC_GROUPS},
run as (
  select grp, 0::bigint as i, 0::bigint as row_next, {CAPACITY}::bigint as room, 0::bigint as slot_next,
         null::bigint as row_no, null::bigint as slot, null::bigint as doc, null::bigint as off, null::bigint as take, null::bigint as n_tokens from groups
  union all
  select grp, i + 1, case when room - used = 0 then row_cur + 1 else row_cur end, case when room - used = 0 then {CAPACITY} else room - used end,
         case when room - used = 0 then 0 else slot_cur + 1 end, row_cur, slot_cur, doc, {CAPACITY} - room, used, n
  from (
    select *, least(n, room) as used from (
      select r.grp, r.i, g.docs[r.i + 1] as doc, g.lens[r.i + 1] as n,
             case when {opens} then r.row_next + 1 else r.row_next end as row_cur,
             case when {opens} then {CAPACITY} else r.room end as room,
             case when {opens} then 0 else r.slot_next end as slot_cur
      from run r join groups g on g.grp = r.grp where r.i < len(g.lens))))
select grp as pack_group, row_no, slot::int as slot, doc, off::int as "offset", take::int as take, n_tokens::int as n_tokens
from run where doc is not null"""


@query(greedy_sql(True))
def pack_greedy_crop(spark, sf_dir):
    return packing.pack_greedy(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY, crop=True).select(*PLACED)


@query(greedy_sql(False))
def pack_greedy_pad(spark, sf_dir):
    return packing.pack_greedy(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY, crop=False).select(*PLACED)


FFD_SQL = f"""
with recursive groups as (
  select doc_id // {DOCS_PER_GROUP} as grp, list((strlen(text) + 1)::bigint order by strlen(text) desc, doc_id) as lens,
         list(doc_id order by strlen(text) desc, doc_id) as docs from documents group by 1),
run as (
  select grp, 0::bigint as i, list_transform(lens, lambda x: {CAPACITY}::bigint) as free, null::bigint as row_no, null::bigint as doc,
         null::bigint as take, null::bigint as n_tokens from groups
  union all
  select grp, i + 1, list_transform(free, lambda f, k: case when k = chosen then f - used else f end), chosen - 1, doc, used, n
  from (
    select *, list_position(list_transform(free, lambda f: f >= used), true)::bigint as chosen from (
      select r.grp, r.i, r.free, g.docs[r.i + 1] as doc, g.lens[r.i + 1] as n, least(g.lens[r.i + 1], {CAPACITY}) as used
      from run r join groups g on g.grp = r.grp where r.i < len(g.lens))))
select grp as pack_group, row_no, doc, take::int as take, n_tokens::int as n_tokens from run where doc is not null"""


@query(FFD_SQL)
def pack_ffd(spark, sf_dir):
    placed = packing.pack_ffd(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY)
    return placed.select("pack_group", "row_no", "doc", "take", "n_tokens")


REPORT_COLUMNS = f"""
select policy, n_rows, tokens, placed, cropped, tail, floor, round(placed / (n_rows * {CAPACITY}) * 100, 6) as util_pct,
       round(cropped / tokens * 100, 6) as crop_pct, round((n_rows * {CAPACITY} - placed) / (n_rows * {CAPACITY}) * 100, 6) as pad_pct,
       round(floor / tokens * 100, 6) as floor_pct"""


@query(best_fit_sql(DOC_GROUPS, CAPACITY, BUFFER, True) + f""",
rows as (
  select *, sum(take) over (partition by pack_group, row_no) = {CAPACITY} as complete from placements),
sums as (
  select 'bestfit_crop' as policy, count(distinct (pack_group, row_no)) filter (complete) as n_rows, sum(n_tokens)::bigint as tokens,
         (sum(take) filter (complete))::bigint as placed, sum(n_tokens - take)::bigint as cropped,
         coalesce(sum(take) filter (not complete), 0)::bigint as tail, sum(greatest(n_tokens - {CAPACITY}, 0))::bigint as floor from rows)
{REPORT_COLUMNS} from sums""")
def packing_report(spark, sf_dir):
    placed = packing.pack_bestfit_crop(lengths(spark, sf_dir), "doc_id", "doc_id", "n_tokens", CAPACITY, BUFFER)
    report = packing.packing_report(placed.withColumn("policy", F.lit("bestfit_crop")), CAPACITY, by=["policy"])
    return report.select(
        "policy", "n_rows", "tokens", "placed", "cropped", "tail", "floor",
        *[F.round(c, 6).alias(c) for c in ("util_pct", "crop_pct", "pad_pct", "floor_pct")],
    )


def waste_sql(policy: str, placements: str, full_rows_only: bool) -> str:
    complete = f"sum(take) over (partition by pack_group, row_no) = {CAPACITY}" if full_rows_only else "true"
    return f"""
select '{policy}' as policy, count(distinct (pack_group, row_no)) filter (complete) as n_rows, sum(n_tokens) as tokens, sum(take) filter (complete) as placed,
       sum(n_tokens - take) as cropped, sum(greatest(n_tokens - {CAPACITY}, 0)) as floor
from (select *, {complete} as complete from ({placements}))"""


@query("with sums as (" + " union all ".join([
    waste_sql("greedy_crop", greedy_sql(True), True), waste_sql("greedy_pad", greedy_sql(False), False), waste_sql("first_fit_decreasing", FFD_SQL, False),
    waste_sql("bestfit_crop", best_fit_sql(DOC_GROUPS, CAPACITY, BUFFER, True) + " select * from placements", True),
]) + f""")
select policy, n_rows, round(placed / (n_rows * {CAPACITY}) * 100, 4) as util_pct, round(cropped / tokens * 100, 4) as crop_pct,
       round((n_rows * {CAPACITY} - placed) / (n_rows * {CAPACITY}) * 100, 4) as pad_pct, round(floor / tokens * 100, 4) as floor_pct from sums""")
def packing_policies(spark, sf_dir):
    """The waste of every policy side by side, as percentages of tokens and of row space."""
    df, args = lengths(spark, sf_dir), ("doc_id", "doc_id", "n_tokens", CAPACITY)
    runs = {
        "greedy_crop": packing.pack_greedy(df, *args, crop=True), "greedy_pad": packing.pack_greedy(df, *args, crop=False),
        "first_fit_decreasing": packing.pack_ffd(df, *args), "bestfit_crop": packing.pack_bestfit_crop(df, *args, BUFFER),
    }
    union = None
    for name, placed in runs.items():
        part = placed.withColumn("policy", F.lit(name))
        union = part if union is None else union.unionByName(part)
    report = packing.packing_report(union, CAPACITY, by=["policy"])
    return report.select("policy", "n_rows", *[F.round(c, 4).alias(c) for c in ("util_pct", "crop_pct", "pad_pct", "floor_pct")])


def concat_placements(spark, sf_dir, capacity: int = CAPACITY):
    return packing.pack_concat(lengths(spark, sf_dir), "doc_id", ["doc_id"], width_bucket(F.col("doc_id"), 128), "n_tokens", capacity)


STREAM_SQL = f"""
stream as (
  select doc_id, n, (sum(n) over (order by doc_id rows unbounded preceding) - n)::bigint as begin from (
    select doc_id, (strlen(text) + 1)::bigint as n from documents)),
pieces as (
  select doc_id as doc, n, begin, unnest(range(begin // {CAPACITY}, (begin + n - 1) // {CAPACITY} + 1)) as row_no from stream),
placements as (
  select row_no, doc, n as n_tokens, (greatest(begin, row_no * {CAPACITY}) - row_no * {CAPACITY})::int as "offset",
         (greatest(begin, row_no * {CAPACITY}) - begin)::int as start,
         (least(begin + n, (row_no + 1) * {CAPACITY}) - greatest(begin, row_no * {CAPACITY}))::int as take from pieces)"""


@query(f"with {STREAM_SQL} select * from placements")
def pack_concat(spark, sf_dir):
    return concat_placements(spark, sf_dir)


# All tokens of the corpus in order: place in the row, row and id.
TOKENS_SQL = f"""
with tokens as (
  select doc_id, unnest(ids) as id, unnest(range(len(ids))) as i from (
    select doc_id, list_prepend(256, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::int)) as ids from documents)),
begins as (
  select doc_id, (sum(strlen(text) + 1) over (order by doc_id rows unbounded preceding) - (strlen(text) + 1))::bigint as begin from documents),
placed as (
  select (begin + i) // {CAPACITY} as row_no, (begin + i) % {CAPACITY} as place, id from tokens join begins using (doc_id)),
rows as (select row_no, count(*) as n from placed group by 1)"""


def concat_rows(spark, sf_dir):
    docs = encode_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    tokens = docs.select(F.col("doc_id").alias("doc"), with_specials(F.col("ids"), special_id("bos")).alias("ids"))
    return packing.fill_rows(concat_placements(spark, sf_dir), tokens, ["row_no"], CAPACITY, start="start")


def weighted(ids):
    """Sum of id * (index + 1): depends on order. Null for null ids and where an id is null."""
    return F.arrow_udf(lambda rows: _weighted(rows), "long")(ids)


def _weighted(rows: pa.Array) -> pa.Array:
    ends = rows.offsets.to_numpy()
    ids = rows.values.slice(ends[0], ends[-1] - ends[0])
    ends = ends - ends[0]
    place = np.arange(len(ids)) - np.repeat(ends[:-1], np.diff(ends)) + 1
    through = lambda numbers: np.concatenate([[0], np.cumsum(numbers)])
    sums = np.diff(through(ids.fill_null(0).to_numpy().astype(np.int64) * place)[ends])
    nulls = np.diff(through(ids.is_null().to_numpy(zero_copy_only=False))[ends]) > 0
    return pa.array(sums, mask=nulls | rows.is_null().to_numpy(zero_copy_only=False))


@query(TOKENS_SQL + """
select row_no, max(n) as n_tokens, (sum(id * (place + 1)) filter (place < n - 1))::bigint as inputs_sum,
       (sum(id * place) filter (place > 0))::bigint as targets_sum
from placed join rows using (row_no) group by 1""")
def shift_targets(spark, sf_dir):
    rows = concat_rows(spark, sf_dir)
    return rows.select(
        "row_no", F.size("row").cast("long").alias("n_tokens"),
        weighted(shift_inputs(F.col("row"))).alias("inputs_sum"), weighted(shifted(F.col("row"))).alias("targets_sum"),
    )


@query(TOKENS_SQL + """
select row_no // 4 as batch_no, count(distinct row_no) as n_rows,
       md5(string_agg(id, ',' order by row_no, place)) as digest from placed group by 1""")
def assemble_batches(spark, sf_dir):
    batches = packing.assemble_batches(concat_rows(spark, sf_dir), "row_no", 4, "row")
    return batches.select("batch_no", "n_rows", F.md5(F.array_join(F.flatten("rows"), ",")).alias("digest"))


@query(f"""
with {STREAM_SQL},
used as (select row_no // 8 as batch_no, count(*) as docs from placements where start = 0 group by 1),
done as (select batch_no, (sum(docs) over (order by batch_no rows unbounded preceding))::bigint as consumed from used)
select batch_no, consumed::bigint as consumed, round(consumed / (select count(*) from documents), 6) as progress,
       (consumed // (select count(*) from documents) + 1)::bigint as epoch from done""")
def packing_progress(spark, sf_dir):
    first_pieces = concat_placements(spark, sf_dir).filter("start = 0")
    size = table(spark, sf_dir, "documents").count()
    return packing.packing_progress(first_pieces, "row_no", 8, size).withColumn("progress", F.round("progress", 6))


@query("""
select doc_id, max(strlen(text)) over (partition by doc_id // 8) as padded, strlen(text) as n_tokens,
       (max(strlen(text)) over (partition by doc_id // 8) - strlen(text)) as pads from documents""")
def pad_group(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.floor(F.col("doc_id") / 8).alias("batch"), byte_ids(F.col("text")).alias("ids"), F.octet_length("text").cast("long").alias("n_tokens")
    )
    padded = packing.pad_group(docs, ["batch"], "ids", special_id("bos"))
    return padded.select(
        "doc_id", F.size("ids").cast("long").alias("padded"), "n_tokens",
        F.size(F.filter("ids", lambda i: i == special_id("bos"))).cast("long").alias("pads"),
    )


# --- chats as masked rows -----------------------------------------------------------------------------------------


def chat_sql(max_tokens: int) -> str:
    """Rendered chats as hex codes (four digits per token) and a mask of 0 and 1."""
    code = "regexp_replace(hex(encode(text)), '(..)', '00\\1', 'g')"
    return f"""
numbered as (
  select conv_id, turn, role, text, row_number() over c - 1 as p, first_value(role) over c = 'system' as has_system,
         first_value(text) over c as system_text
  from conversations window c as (partition by conv_id order by turn rows between unbounded preceding and unbounded following)),
body as (
  select conv_id, p - has_system::int as p, role,
         case when has_system and p = 1 then system_text || chr(10) || chr(10) || text else text end as text
  from numbered where not (has_system and p = 0)),
renderable as (
  select conv_id from body group by 1 having bool_and(role = case when p % 2 = 0 then 'user' else 'assistant' end)),
pieces as (
  select conv_id, p,
         case when role = 'user' then '0101' || {code} || '0102' else '0103' || {code} || '0104' end as codes,
         case when role = 'user' then repeat('0', strlen(text) + 2) else '0' || repeat('1', strlen(text) + 1) end as mask
  from body where conv_id in (select conv_id from renderable)),
chats as (
  select conv_id, ('0100' || string_agg(codes, '' order by p))[1:{4 * max_tokens}] as codes,
         ('0' || string_agg(mask, '' order by p))[1:{max_tokens}] as mask from pieces group by 1)"""


def rendered_chats(spark, sf_dir, max_tokens: int = CHAT_TOKENS):
    turns = table(spark, sf_dir, "conversations")
    chats = conv.renderable_heads(turns, "conv_id", "turn", "role", "text", max_tokens, F.octet_length("text"))
    r = rendered(render_segments(F.col("messages")), max_tokens)
    return chats.select("conv_id", r.alias("r")).select("conv_id", "r.*")


def grouped_chats(spark, sf_dir):
    chats = rendered_chats(spark, sf_dir).withColumn("n_tokens", F.size("ids"))
    return packing.pack_groups(chats, "conv_id", DOCS_PER_GROUP)


def written_chats(spark, sf_dir):
    """Rendered chats as a table, for queries that read them more than once."""
    path = fresh_path(spark, "chats")
    grouped_chats(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def chat_placements(grouped):
    chats = packing.supervised_only(grouped, "mask").filter(F.col("n_tokens") <= CHAT_CAPACITY)
    return chats, packing.pack_bestfit_pad(chats, "conv_id", "conv_id", "n_tokens", CHAT_CAPACITY, CHAT_BUFFER)


def chat_errors(grouped):
    """Every rendered chat that is longer than a row, supervised or not: training stops at any of them."""
    long = packing.oversize(grouped, "n_tokens", CHAT_CAPACITY)
    supervised = F.exists("mask", lambda m: m == 1).alias("supervised")
    return long.select(F.col("pack_group").cast("long").alias("pack_group"), F.col("conv_id").alias("doc"), "n_tokens", supervised)


CHAT_GROUPS = f"""
{chat_sql(CHAT_TOKENS)},
groups as (
  select conv_id // {DOCS_PER_GROUP} as grp, list(length(mask)::bigint order by conv_id) as lens, list(conv_id order by conv_id) as docs
  from chats where mask like '%1%' and length(mask) <= {CHAT_CAPACITY} group by 1)"""


@query(best_fit_sql(CHAT_GROUPS, CHAT_CAPACITY, CHAT_BUFFER, False) + " select * from placements")
def pack_chats(spark, sf_dir):
    """Chats without a supervised token are left out, chats longer than a row are error rows of `oversize_chats`; the
    others are packed with padding."""
    return chat_placements(grouped_chats(spark, sf_dir))[1].select(*PLACED)


@query(f"""
with {chat_sql(CHAT_TOKENS)}
select conv_id // {DOCS_PER_GROUP} as pack_group, conv_id as doc, length(mask)::int as n_tokens, mask like '%1%' as supervised
from chats where length(mask) > {CHAT_CAPACITY}""")
def oversize_chats(spark, sf_dir):
    """The error rows of `pack_chats`, `mask_targets` and `supervision_audit`, by the same key."""
    return chat_errors(grouped_chats(spark, sf_dir))


@query(f"""
with {chat_sql(CHAT_TOKENS)}
select conv_id // {DOCS_PER_GROUP} as pack_group, count(*) as chats, sum(length(mask))::bigint as tokens,
       count(*) filter (length(mask) > {CHAT_CAPACITY}) as errors from chats where mask like '%1%' group by 1""")
def chat_packing_account(spark, sf_dir):
    """Packed chats and error rows together: all supervised chats, which SQL counts without regard to their length."""
    grouped = written_chats(spark, sf_dir)
    packed = chat_placements(grouped)[1].select("pack_group", F.col("take").alias("n_tokens"), F.lit(0).alias("error"))
    errors = chat_errors(grouped).filter("supervised").select("pack_group", "n_tokens", F.lit(1).alias("error"))
    return packed.unionByName(errors).groupBy("pack_group").agg(
        F.count("*").alias("chats"), F.sum("n_tokens").cast("long").alias("tokens"), F.sum("error").cast("long").alias("errors")
    )


def chat_rows(spark, sf_dir):
    chats, placed = chat_placements(written_chats(spark, sf_dir))
    tokens = chats.select(F.col("conv_id").alias("doc"), "ids", "mask")
    return packing.fill_rows(placed, tokens, ["pack_group", "row_no"], CHAT_CAPACITY, mask="mask", pad_id=special_id("bos"))


CHAT_TOKENS_SQL = best_fit_sql(CHAT_GROUPS, CHAT_CAPACITY, CHAT_BUFFER, False) + """,
tokens as (
  select pack_group, row_no, "offset" + i as place, ('0x' || code)::int as id, flag = '1' as supervised
  from (select p.*, unnest(range(take)) as i, unnest(regexp_extract_all(codes, '....')) as code, unnest(string_split(mask, '')) as flag
        from placements p join chats c on c.conv_id = p.doc))"""


@query(CHAT_TOKENS_SQL + f"""
select pack_group, row_no, count(*)::int as content_len, (sum(id * (place + 1)) filter (place < {CHAT_CAPACITY - 1}))::bigint
         + 256 * ({CHAT_CAPACITY - 1} * {CHAT_CAPACITY} - least(count(*), {CHAT_CAPACITY - 1}) * (least(count(*), {CHAT_CAPACITY - 1}) + 1)) // 2 as inputs_sum,
       (sum(case when supervised then id else -1 end * place) filter (place > 0))::bigint
         - ({CHAT_CAPACITY} * {CHAT_CAPACITY - 1} - count(*) * (count(*) - 1)) // 2 as targets_sum,
       count(*) filter (supervised and place > 0) as supervised
from tokens group by 1, 2""")
def mask_targets(spark, sf_dir):
    rows = chat_rows(spark, sf_dir)
    targets = mask_padding(masked(shifted(F.col("row")), F.col("mask_row")), F.col("content_len"))
    return rows.select("pack_group", "row_no", "content_len", shift_inputs(F.col("row")).alias("inputs"), targets.alias("targets")).select(
        "pack_group", "row_no", "content_len", weighted(F.col("inputs")).alias("inputs_sum"),
        weighted(F.col("targets")).alias("targets_sum"),
        F.size(F.filter("targets", lambda t: t != -1)).cast("long").alias("supervised"),
    )


@query(CHAT_TOKENS_SQL + """
select pack_group * 1000000 + row_no // 2 as batch, count(distinct row_no) as n_rows, count(*) filter (supervised and place > 0) as supervised,
       count(*) filter (supervised and place > 0) = 0 as fully_masked from tokens group by 1""")
def supervision_audit(spark, sf_dir):
    rows = chat_rows(spark, sf_dir).withColumn("targets", masked(shifted(F.col("row")), F.col("mask_row")))
    batch = F.col("pack_group") * 1_000_000 + F.floor(F.col("row_no") / 2)
    return packing.supervision_audit(rows.withColumn("batch", batch), "targets", "batch")
