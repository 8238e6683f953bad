"""Rendering of conversations turn by turn: every turn knows where its tokens begin, so a conversation is never one
record. Turns of one conversation may lie in many tasks; what is cut or hashed is a turn, or a block of a long one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.functions.chat import (
    MAX_MESSAGE_CHARS, MAX_MESSAGES, MAX_TOKENS_RANGE, MAX_TOTAL_CHARS, TEMPERATURE_RANGE, TOP_K_RANGE, special_id,
)
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators.conversations import TURNS_PER_BUCKET, _turn_reasons
from sparkcorpus.operators.ordering import prefix_sums, with_position
from sparkcorpus.operators.tokenization import encode_corpus

BLOCK_TOKENS = 65_536


def _bucket(turn: str) -> Column:
    return width_bucket(F.col(turn), TURNS_PER_BUCKET)


def body_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, strict: bool = True, last: bool = True) -> DataFrame:
    """`conv`, `turn`, `role`, `text` of the turns that are rendered.

    strict: only conversations that can be rendered, a leading system turn put before the first user turn; without
    `last`, those that end with an assistant turn, and that turn is left out. Otherwise user and assistant turns as they
    are."""
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    if not strict:
        return rows.filter(F.col("role").isin("user", "assistant"))
    placed = with_position(rows, ["turn"], _bucket("turn"), "_pos", ["conv"])
    good = _turn_reasons(placed, "conv", "role", "text").filter("render_reason is null").select("conv", "has_system")
    if not last:
        ends = placed.groupBy("conv").agg(F.max("_pos").alias("_last"), F.max_by("role", "_pos").alias("_last_role"))
        good = good.join(ends.filter("_last_role = 'assistant'").drop("_last_role"), "conv")
    heads = placed.filter("_pos = 0").select("conv", F.when(F.col("role") == "system", F.col("text")).alias("_system"))
    rows = placed.join(good.join(heads, "conv"), "conv").filter("not has_system or _pos > 0")
    if not last:
        rows = rows.filter("_pos < _last")
    merged = F.concat("_system", F.lit("\n\n"), "text")
    return rows.select("conv", "turn", "role", F.when(F.col("has_system") & (F.col("_pos") == 1), merged).otherwise(F.col("text")).alias("text"))


def place_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, strict: bool = True, last: bool = True, ranks: DataFrame | None = None) -> DataFrame:
    """The turns of `body_turns` where their tokens stand: `conv`, `turn`, `p` (position), `role`, `content` and `start`,
    the number of tokens before the turn, document start included. The content is the text's ids in the vocabulary
    `ranks`, or a string with a character for each byte."""
    rows = body_turns(turns, conv, turn, role, text, strict, last).withColumn("text", F.coalesce("text", F.lit("")))
    if ranks is None:
        rows = rows.withColumn("content", F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"))
        size = F.length("content")
    else:
        rows = encode_corpus(rows, ranks, "text", "content")
        size = F.size("content")
    measures = {"_before": (size + 2).cast("long"), "p": F.lit(1).cast("long")}
    placed = prefix_sums(rows.drop("text"), ["turn"], _bucket("turn"), measures, ["conv"])
    return placed.select("conv", "turn", "p", "role", "content", (F.col("_before") + 1).alias("start"))


def token_blocks(placed: DataFrame, ranks_size: int = 256, block: int = BLOCK_TOKENS, most: int | None = None) -> DataFrame:
    """Placed turns to `conv`, `p`, `start`, `ids`, `mask`: the tokens of each turn, cut into blocks of bounded size, and
    which of them are supervised. `most` drops all tokens beyond so many of a conversation."""
    strings = dict(placed.dtypes)["content"] == "string"
    size = F.length("content") if strings else F.size("content")
    total = size + 2
    rows = placed if most is None else placed.filter(F.col("start") < most)
    end = total if most is None else F.least(total.cast("long"), F.lit(most) - F.col("start"))
    rows = rows.withColumn("_n", end.cast("int")).withColumn("_at", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(block))))
    first, stop = F.col("_at"), F.least(F.col("_at") + block, F.col("_n"))
    low, high = F.greatest(first - 1, F.lit(0)), F.least(stop - 1, size)  # of the content, behind the start marker
    count = F.greatest(high - low, F.lit(0))
    if strings:
        part = F.substr("content", low + 1, count)
        inner = F.when(count == 0, F.array().cast("array<int>")).otherwise(F.transform(F.split(part, ""), lambda c: F.ascii(c)))
    else:
        inner = F.slice("content", low + 1, count)
    assistant = F.col("role") == "assistant"
    marker = lambda kind: F.when(assistant, special_id(f"assistant_{kind}", ranks_size)).otherwise(special_id(f"user_{kind}", ranks_size))
    none = F.array().cast("array<int>")
    ids = F.concat(F.when(first == 0, F.array(marker("start"))).otherwise(none), inner, F.when(stop == total, F.array(marker("end"))).otherwise(none))
    flag = assistant.cast("int")
    mask = F.concat(F.when(first == 0, F.array(F.lit(0))).otherwise(none), F.array_repeat(flag, F.greatest(stop - F.greatest(first, F.lit(1)), F.lit(0))))
    return rows.select("conv", "p", (F.col("start") + first).alias("start"), ids.alias("ids"), mask.alias("mask"))


def render_heads(placed: DataFrame, most: int, ranks_size: int = 256) -> DataFrame:
    """`conv`, `ids`, `mask`: the first `most` tokens of each conversation, so a record is bounded. Tokens meet in order
    of their start; what lies beyond was dropped before."""
    blocks = token_blocks(placed, ranks_size, most=most)
    whole = blocks.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("start", "ids", "mask"))).alias("b"))
    of = lambda field: F.flatten(F.transform("b", lambda x: x[field]))
    bos = special_id("bos", ranks_size)
    return whole.select("conv", F.concat(F.array(F.lit(bos)), of("ids")).alias("ids"), F.concat(F.array(F.lit(0)), of("mask")).alias("mask"))


def completion_prompts(placed: DataFrame, most: int, ranks_size: int = 256) -> DataFrame:
    """`conv`, `ids`: prompts cut to `most` tokens, then the marker that makes the assistant answer. Place the turns
    without their last one."""
    heads = render_heads(placed, most, ranks_size)
    return heads.select("conv", F.concat("ids", F.array(F.lit(special_id("assistant_start", ranks_size)))).alias("ids"))


def serving_prompts(placed: DataFrame, ranks_size: int = 256, block: int = BLOCK_TOKENS) -> DataFrame:
    """`conv`, `start`, `ids`: uncut prompts in blocks, document start and the assistant's marker included."""
    ends = placed.groupBy("conv").agg(F.max(F.col("start") + (F.length("content") if dict(placed.dtypes)["content"] == "string" else F.size("content")) + 2).alias("end"))
    one = lambda name: F.array(F.lit(special_id(name, ranks_size)))
    marks = F.array(F.struct(F.lit(0).cast("long").alias("start"), one("bos").alias("ids")), F.struct(F.col("end").alias("start"), one("assistant_start").alias("ids")))
    marks = ends.select("conv", F.explode(marks).alias("m")).select("conv", "m.start", "m.ids")
    return token_blocks(placed, ranks_size, block).select("conv", "start", "ids").union(marks)


def truncate_blocks(blocks: DataFrame, ranks_size: int = 256) -> DataFrame:
    """Blocks of a token sequence (`conv`, `start`, `ids`) cut at its first assistant end or document start, which is
    excluded: `kept` ids and why the sequence stops, `stop_reason`. The first end of a sequence is a minimum over its blocks."""
    ends = {"assistant_end": special_id("assistant_end", ranks_size), "bos": special_id("bos", ranks_size)}
    found = [F.struct((F.col("start") + p - 1).alias("at"), F.lit(name).alias("why")) for name, e in ends.items() for p in [F.array_position("ids", F.lit(e))]]
    first = F.least(*[F.when(F.array_position("ids", F.lit(e)) > 0, s) for e, s in zip(ends.values(), found)])
    stops = blocks.groupBy("conv").agg(F.min(first).alias("stop"))
    rows = blocks.join(stops, "conv").filter("stop is null or start < stop.at")
    left = (F.col("stop.at") - F.col("start")).cast("int")
    kept = F.when(left < F.size("ids"), F.slice("ids", F.lit(1), left)).otherwise(F.col("ids"))
    return rows.select("conv", "start", kept.alias("kept"), F.coalesce("stop.why", F.lit("max_new_tokens")).alias("stop_reason"))


def validate_request_turns(turns: DataFrame, requests: DataFrame, request_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The rules of `validate_requests` on turn rows, one aggregate per request: `request_id`, `reason`. `requests` has
    `temperature`, `top_k` and `max_tokens`; a request without turns has no messages."""
    rows = turns.select(F.col(request_id).alias("request_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.length(text).alias("chars"))
    placed = with_position(rows, ["turn"], _bucket("turn"), "i", ["request_id"])
    chars, at = F.coalesce("chars", F.lit(0)), F.col("i").cast("string")
    fault = F.when(chars == 0, F.concat(F.lit("empty_message:"), at)).when(chars > MAX_MESSAGE_CHARS, F.concat(F.lit("long_message:"), at))
    bad_role = F.when(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False)), F.concat(F.lit("bad_role:"), at))
    stats = placed.groupBy("request_id").agg(
        F.count("*").alias("n"), F.sum(chars).alias("total"),
        F.min_by(fault, F.when(fault.isNotNull(), F.col("i"))).alias("message_fault"), F.min_by(bad_role, F.when(bad_role.isNotNull(), F.col("i"))).alias("role_fault"),
    )
    joined = requests.select("request_id", "temperature", "top_k", "max_tokens").join(stats, "request_id", "left")
    reason = F.coalesce(
        F.when(F.col("n").isNull(), "no_messages"),
        F.when(F.col("n") > MAX_MESSAGES, "too_many_messages"),
        F.col("message_fault"),
        F.when(F.col("total") > MAX_TOTAL_CHARS, "too_long"),
        F.col("role_fault"),
        F.when(~F.col("temperature").between(*TEMPERATURE_RANGE), "bad_temperature"),
        F.when(~F.col("top_k").between(*TOP_K_RANGE), "bad_top_k"),
        F.when(~F.col("max_tokens").between(*MAX_TOKENS_RANGE), "bad_max_tokens"),
    )
    return joined.select("request_id", reason.alias("reason"))
