"""Chat expressions over `messages ARRAY<STRUCT<role, content, parts>>`. Each conversation is one row; no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The special tokens, in id order after the ordinary vocabulary.
SPECIAL_TOKENS = [
    "<|bos|>",
    "<|user_start|>",
    "<|user_end|>",
    "<|assistant_start|>",
    "<|assistant_end|>",
    "<|python_start|>",
    "<|python_end|>",
    "<|output_start|>",
    "<|output_end|>",
]

MESSAGE_TYPE = "struct<role:string,content:string,parts:array<struct<type:string,text:string>>>"

# Limits of a chat request.
MAX_MESSAGES = 500
MAX_MESSAGE_CHARS = 8000
MAX_TOTAL_CHARS = 32000
TEMPERATURE_RANGE = (0.0, 2.0)
TOP_K_RANGE = (0, 200)
MAX_TOKENS_RANGE = (1, 4096)


def special_id(name: str, ordinary_size: int = 256) -> int:
    return ordinary_size + SPECIAL_TOKENS.index(f"<|{name}|>")


def merge_system(messages: Column) -> Column:
    """A leading system message is put before the first user message, with one blank line in between."""
    first, second = messages[0], F.try_element_at(messages, F.lit(2))
    merged = F.struct(
        second["role"].alias("role"),
        F.concat(first["content"], F.lit("\n\n"), second["content"]).alias("content"),
        second["parts"].alias("parts"),
    )
    tail = F.slice(messages, F.lit(3), F.greatest(F.size(messages) - 2, F.lit(0)))
    return F.when(
        (F.size(messages) >= 2) & (first["role"] == "system"), F.concat(F.array(merged), tail)
    ).otherwise(messages)


def _alternates(messages: Column) -> Column:
    roles = F.transform(
        messages, lambda m, i: m["role"] == F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    )
    return F.forall(roles, lambda ok: F.coalesce(ok, F.lit(False)))


def chat_fault(messages: Column) -> Column:
    """Why a chat is unfit for supervised tuning; null when it is fit."""
    is_system = F.try_element_at(messages, F.lit(1))["role"] == "system"
    body = F.when(is_system, F.slice(messages, F.lit(2), F.size(messages))).otherwise(messages)
    return (
        F.when(F.size(messages) < 1, "empty")
        .when(F.size(body) < 2, "too_short")
        .when(~_alternates(body), "bad_alternation")
        .when(F.exists(body, lambda m: m["content"].isNull()), "content_not_text")
    )


def render_fault(messages: Column) -> Column:
    """Why a chat cannot be rendered; null when it can."""
    is_system = F.try_element_at(messages, F.lit(1))["role"] == "system"
    second_user = F.coalesce(F.try_element_at(messages, F.lit(2))["role"] == "user", F.lit(False))
    return (
        F.when(F.size(messages) < 1, "empty")
        .when(is_system & ~second_user, "system_without_user")
        .when(~_alternates(merge_system(messages)), "bad_alternation")
        .when(
            F.exists(merge_system(messages), lambda m: (m["role"] == "user") & m["content"].isNull()),
            "user_content_not_text",
        )
        .when(
            F.exists(messages, lambda m: (m["role"] == "assistant") & m["content"].isNull() & m["parts"].isNull()),
            "no_content",
        )
        .when(
            F.exists(
                messages,
                lambda m: F.coalesce(
                    F.exists(m["parts"], lambda p: ~p["type"].isin("text", "python", "python_output")), F.lit(False)
                ),
            ),
            "unknown_part",
        )
    )


def _segment(special: str | None, text: Column | None, supervised: int) -> Column:
    return F.struct(
        F.lit(special).cast("string").alias("special"),
        (F.lit(None).cast("string") if text is None else text).alias("text"),
        F.lit(supervised).alias("supervised"),
    )


def _part_segments(part: Column) -> Column:
    return (
        F.when(
            part["type"] == "python",
            F.array(_segment("python_start", None, 1), _segment(None, part["text"], 1), _segment("python_end", None, 1)),
        )
        .when(
            part["type"] == "python_output",
            F.array(_segment("output_start", None, 0), _segment(None, part["text"], 0), _segment("output_end", None, 0)),
        )
        .otherwise(F.array(_segment(None, part["text"], 1)))
    )


def _message_segments(message: Column) -> Column:
    answer = F.when(
        message["parts"].isNotNull(), F.flatten(F.transform(message["parts"], _part_segments))
    ).otherwise(F.array(_segment(None, message["content"], 1)))
    return F.when(
        message["role"] == "user",
        F.array(_segment("user_start", None, 0), _segment(None, message["content"], 0), _segment("user_end", None, 0)),
    ).otherwise(
        F.concat(F.array(_segment("assistant_start", None, 0)), answer, F.array(_segment("assistant_end", None, 1)))
    )


def render_segments(messages: Column, merge: bool = True) -> Column:
    """Chat to ordered segments `ARRAY<STRUCT<special, text, supervised>>`; a segment is a special token or text."""
    body = merge_system(messages) if merge else F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    return F.concat(F.array(_segment("bos", None, 0)), F.flatten(F.transform(body, _message_segments)))


def segment_ids(segments: Column, encoded: Column, ordinary_size: int = 256) -> Column:
    """Token ids of each segment. `encoded ARRAY<ARRAY<INT>>` holds the ids of each segment's text."""
    names = F.array(*[F.lit(name[2:-2]) for name in SPECIAL_TOKENS])

    def ids(segment: Column, text_ids: Column) -> Column:
        special = (F.array_position(names, segment["special"]) - 1 + ordinary_size).cast("int")
        return F.when(segment["special"].isNotNull(), F.array(special)).otherwise(text_ids)

    return F.zip_with(segments, encoded, ids)


# One character per special token, right behind the 256 byte characters.
_SPECIAL_CHARACTERS = "".join(chr(256 + i) for i in range(len(SPECIAL_TOKENS)))


def _byte_string(segments: Column) -> Column:
    """All tokens of a chat as one string, a character per token. Long texts stay strings until they are cut."""
    names = F.array(*[F.lit(name[2:-2]) for name in SPECIAL_TOKENS])

    def characters(segment: Column) -> Column:
        special = F.substring(F.lit(_SPECIAL_CHARACTERS), F.array_position(names, segment["special"]).cast("int"), F.lit(1))
        return F.when(segment["special"].isNotNull(), special).otherwise(F.decode(F.encode(segment["text"], "UTF-8"), "ISO-8859-1"))

    return F.array_join(F.transform(segments, characters), "")


def _ids_of(byte_string: Column) -> Column:
    return F.when(byte_string == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(byte_string, ""), lambda c: F.ascii(c))
    )


def rendered(segments: Column, max_tokens: int, encoded: Column | None = None, ordinary_size: int = 256) -> Column:
    """STRUCT<ids, mask>, cut to max_tokens; byte tokens unless the ids of the texts are given."""
    if encoded is None:
        flags = F.transform(
            segments,
            lambda s: F.repeat(s["supervised"].cast("string"), F.when(s["special"].isNotNull(), 1).otherwise(F.octet_length(s["text"]))),
        )
        ids = _ids_of(F.substring(_byte_string(segments), 1, max_tokens))
        cut = F.substring(F.array_join(flags, ""), 1, max_tokens)
        return F.struct(ids.alias("ids"), F.transform(F.split(cut, ""), lambda f: f.cast("int")).alias("mask"))
    size = lambda s, ids: F.when(s["special"].isNotNull(), 1).otherwise(F.size(ids))
    mask = F.zip_with(segments, encoded, lambda s, ids: F.array_repeat(s["supervised"], size(s, ids)))
    return F.struct(
        F.slice(F.flatten(segment_ids(segments, encoded, ordinary_size)), 1, max_tokens).alias("ids"),
        F.slice(F.flatten(mask), 1, max_tokens).alias("mask"),
    )


def completion_messages(messages: Column) -> Column:
    """All messages but the last one, which is the assistant's and will be completed."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def prompt_ids(messages: Column, max_tokens: int, strict: bool = True) -> Column:
    """Prompt in byte tokens that makes the assistant answer. strict: drop the last (assistant) message, cut, then
    append assistant_start, so the result may be one longer than max_tokens. Otherwise render all turns uncut."""
    start = F.array(F.lit(special_id("assistant_start")))
    if strict:
        return F.concat(rendered(render_segments(completion_messages(messages)), max_tokens)["ids"], start)
    return F.concat(_ids_of(_byte_string(render_segments(messages, merge=False))), start)


def request_fault(messages: Column, temperature: Column, top_k: Column, max_tokens: Column) -> Column:
    """First broken rule of a chat request, in checking order; null when the request is fine. The length rules run
    message by message, so an early over-long message wins over a later empty one."""
    faults = F.transform(
        messages,
        lambda m, i: F.when(F.coalesce(F.length(m["content"]), F.lit(0)) == 0, F.concat(F.lit("empty_message:"), i.cast("string")))
        .when(F.length(m["content"]) > MAX_MESSAGE_CHARS, F.concat(F.lit("long_message:"), i.cast("string"))),
    )
    first_message_fault = F.try_element_at(F.filter(faults, lambda f: f.isNotNull()), F.lit(1))
    total = F.aggregate(messages, F.lit(0), lambda acc, m: acc + F.coalesce(F.length(m["content"]), F.lit(0)))
    role_faults = F.transform(
        messages,
        lambda m, i: F.when(~F.coalesce(m["role"].isin("user", "assistant"), F.lit(False)), F.concat(F.lit("bad_role:"), i.cast("string"))),
    )
    first_role_fault = F.try_element_at(F.filter(role_faults, lambda f: f.isNotNull()), F.lit(1))
    return F.coalesce(
        F.when(F.size(messages) == 0, "no_messages"),
        F.when(F.size(messages) > MAX_MESSAGES, "too_many_messages"),
        first_message_fault,
        F.when(total > MAX_TOTAL_CHARS, "too_long"),
        first_role_fault,
        F.when(~temperature.between(*TEMPERATURE_RANGE), "bad_temperature"),
        F.when(~top_k.between(*TOP_K_RANGE), "bad_top_k"),
        F.when(~max_tokens.between(*MAX_TOKENS_RANGE), "bad_max_tokens"),
    )
