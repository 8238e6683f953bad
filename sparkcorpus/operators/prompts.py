"""Few-shot prompts and answer spans. All options of an item stay in its row, so only the shot lookup joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.functions.arrays import common_prefix_length, left_crop
from sparkcorpus.functions.text import byte_ids, strip
from sparkcorpus.operators.tokenization import with_specials

BLANK_LINE = "\n\n"


def fewshot_draws(idx: Column, n_items: int, k: int, seed: int, draws: int) -> Column:
    """First k distinct positions of a seeded sequence of draws from all items but the own one."""
    def draw(j: Column) -> Column:
        text = F.concat_ws("|", F.lit(str(seed)), idx.cast("string"), j.cast("string"))
        h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % (n_items - 1)
        return F.when(h >= idx, h + 1).otherwise(h)

    return F.slice(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), draw)), 1, k)


def sample_fewshot(items: DataFrame, idx: str, k: int, seed: int = 1234) -> DataFrame:
    """(idx, shot_no, shot_idx): k other items per item, never the item itself. `idx` must be 0..n-1. Where the draws
    leave fewer than k distinct items, the number of draws doubles; it is the same for all items and results do not
    change for items that had enough."""
    n_items = items.count()
    if n_items - 1 < k:
        raise ValueError(f"{k} shots need more than {n_items} items")
    draws = k + 8
    while True:
        drawn = items.select(F.col(idx).alias("idx"), fewshot_draws(F.col(idx).cast("long"), n_items, k, seed, draws).alias("shots"))
        if drawn.filter(F.size("shots") < k).isEmpty():
            return drawn.select("idx", F.posexplode("shots").alias("shot_no", "shot_idx"))
        draws *= 2


def attach_shots(items: DataFrame, idx: str, shots: DataFrame, fields: list[str]) -> DataFrame:
    """Items with their ordered `shots ARRAY<STRUCT<shot_no, fields>>`, found by an equi-join on position."""
    pool = items.select(F.col(idx).alias("shot_idx"), *fields)
    per_item = (
        shots.join(pool, "shot_idx").groupBy("idx")
        .agg(F.array_sort(F.collect_list(F.struct("shot_no", *fields))).alias("shots"))
    )
    return items.join(per_item.withColumnRenamed("idx", idx), idx, "left").withColumn(
        "shots", F.coalesce("shots", F.array().cast(per_item.schema["shots"].dataType))
    )


def _shots(render) -> Column:
    return F.array_join(F.transform("shots", lambda s: F.concat(render(s), F.lit(BLANK_LINE))), "")


def render_mc_prompts(items: DataFrame, delimiter: str) -> DataFrame:
    """One prompt per choice: shots as query + delimiter + right choice, blank line, then the item."""
    d = F.lit(delimiter)
    head = _shots(lambda s: F.concat(s["query"], d, F.get(s["choices"], s["gold"])))
    return items.withColumn("prompts", F.transform("choices", lambda c: F.concat(head, F.col("query"), d, c)))


def render_schema_prompts(items: DataFrame, delimiter: str) -> DataFrame:
    """One prompt per context option, all with the same continuation."""
    d = F.lit(delimiter)
    head = _shots(lambda s: F.concat(F.get(s["context_options"], s["gold"]), d, s["continuation"]))
    return items.withColumn("prompts", F.transform("context_options", lambda c: F.concat(head, c, d, F.col("continuation"))))


def render_lm_prompts(items: DataFrame, delimiter: str) -> DataFrame:
    """Two prompts: without the continuation (stripped) and with it."""
    d = F.lit(delimiter)
    head = _shots(lambda s: F.concat(strip(s["context"]), d, s["continuation"]))
    open_end = F.concat(head, strip(F.col("context")), d)
    return items.withColumn("prompts", F.array(strip(open_end), F.concat(open_end, F.col("continuation"))))


def encode_prompts(df: DataFrame, bos: int, encode=byte_ids) -> DataFrame:
    """`seqs`: ids of every prompt, with the document start in front."""
    return df.withColumn("seqs", F.transform("prompts", lambda p: with_specials(encode(p), bos)))


def common_length(seqs: Column, direction: str = "left") -> Column:
    """Length of the prefix (left) or suffix (right) that all sequences share."""
    turned = seqs if direction == "left" else F.transform(seqs, F.reverse)
    return F.array_min(F.transform(turned, lambda s: common_prefix_length(s, turned[0])))


def answer_spans(df: DataFrame, task_type: str) -> DataFrame:
    """(start, end) of the answer in every sequence. LM items keep only the prompt with continuation; `fault` says
    when the prompt without it is no strict prefix."""
    seqs = F.col("seqs")
    span = lambda ids, start: F.struct(ids.alias("ids"), start.cast("int").alias("start"), F.size(ids).alias("end"))
    if task_type == "multiple_choice":
        shared = common_length(seqs, "left")
        return df.withColumn("spans", F.transform(seqs, lambda s: span(s, shared))).withColumn("fault", F.lit(None).cast("string"))
    if task_type == "schema":
        shared = common_length(seqs, "right")
        return df.withColumn("spans", F.transform(seqs, lambda s: span(s, F.size(s) - shared))).withColumn("fault", F.lit(None).cast("string"))
    short, full = seqs[0], seqs[1]
    prefix = (F.size(short) < F.size(full)) & (common_prefix_length(short, full) == F.size(short))
    return df.withColumn("spans", F.array(span(full, F.size(short)))).withColumn("fault", F.when(~prefix, "not_a_prefix"))


def crop_spans(df: DataFrame, max_tokens: int) -> DataFrame:
    """One row per option: ids cut from the left to max_tokens, span moved along; a span that starts before the cut is
    an error row."""
    rows = df.select(*[c for c in df.columns if c != "spans"], F.posexplode("spans").alias("option", "span"))
    cut = F.greatest(F.size("span.ids") - max_tokens, F.lit(0))
    start, end = F.col("span.start") - cut, F.col("span.end") - cut
    fault = F.coalesce(F.col("fault"), F.when((start < 0) | (end < 0), "span_cut_off"))
    return rows.select(
        *[c for c in rows.columns if c not in ("span", "fault")],
        left_crop(F.col("span.ids"), max_tokens).alias("ids"), start.alias("start"), end.alias("end"), fault.alias("fault"),
    )
