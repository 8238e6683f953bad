"""Conversations: assembly, validation, adapters, mixtures, request and server logs, tool-call audit."""

from __future__ import annotations

import ast
import operator
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from sparkcorpus.functions.chat import chat_fault, render_fault, request_fault
from sparkcorpus.functions.keys import hex_bucket, key_digits, shuffle_key, width_bucket
from sparkcorpus.functions.text import (
    choices_prompt, code_block, leading_imports, tool_parts, without_colours,
)
from sparkcorpus.operators.ordering import prefix_sums, with_position

NO_PARTS = "array<struct<type:string,text:string>>"
TURNS_PER_BUCKET = 4096


def message(role, content: Column | None = None, parts: Column | None = None) -> Column:
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"),
        (F.lit(None).cast("string") if content is None else content).alias("content"),
        (F.lit(None).cast(NO_PARTS) if parts is None else parts).alias("parts"),
    )


def place_turns(turns: DataFrame, conv: str, turn: str, text_tokens: Column) -> DataFrame:
    """Adds the position of each turn in its conversation (`_pos`) and the tokens before it (`_before`): its text and
    two markers per turn."""
    measures = {"_before": (text_tokens + 2).cast("long"), "_pos": F.lit(1).cast("long")}
    return prefix_sums(turns, [turn], width_bucket(F.col(turn), TURNS_PER_BUCKET), measures, [conv])


def head_turns(placed: DataFrame, max_tokens: int) -> DataFrame:
    """Placed turns that can still contribute to the first max_tokens tokens of their conversation, and always the first
    two, because a system turn needs the user turn behind it. So at most max_tokens/2 + 2 turns of a conversation
    stay, however long it is."""
    return placed.filter((F.col("_before") < max_tokens + 2) | (F.col("_pos") < 2))


def assemble_conversations(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turn rows to one record per conversation. For truncated rendering cut the turns with `head_turns` first."""
    rows = F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")))
    return turns.groupBy(conv).agg(
        F.transform(F.array_sort(rows), lambda t: message(t["role"], t["text"])).alias("messages")
    )


def assemble_parts(turns: DataFrame, conv: str, turn: str, role: str, text: str, turns_per_part: int = 512) -> DataFrame:
    """Turn rows to records of a bounded number of turns: `part` counts the records of a conversation. What needs whole
    conversations works on turns (`operators.rendering`, `validate_turns`)."""
    placed = with_position(turns.select(conv, turn, role, text), [turn], width_bucket(F.col(turn), TURNS_PER_BUCKET), "_pos", [conv])
    rows = F.collect_list(F.struct(F.col("_pos").alias("pos"), F.col(role).alias("role"), F.col(text).alias("text")))
    parts = placed.groupBy(conv, F.floor(F.col("_pos") / turns_per_part).alias("part")).agg(F.array_sort(rows).alias("rows"))
    return parts.select(conv, "part", F.transform("rows", lambda t: message(t["role"], t["text"])).alias("messages"))


def validate_conversations(df: DataFrame, messages: str = "messages") -> DataFrame:
    """Adds `chat_reason` (unfit for tuning) and `render_reason` (cannot be rendered); null means fit."""
    return df.withColumn("chat_reason", chat_fault(F.col(messages))).withColumn("render_reason", render_fault(F.col(messages)))


def split_valid(df: DataFrame, reason: str = "chat_reason") -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows."""
    return df.filter(F.col(reason).isNull()).drop(reason), df.filter(F.col(reason).isNotNull())


def validate_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rules of `validate_conversations` on turn rows: one aggregate per conversation, nothing collected, so a
    conversation may have any number of turns."""
    placed = with_position(turns, [turn], width_bucket(F.col(turn), TURNS_PER_BUCKET), "_pos", [conv])
    return _turn_reasons(placed, conv, role, text)


def _turn_reasons(placed: DataFrame, conv: str, role: str, text: str) -> DataFrame:
    at = F.col("_pos")
    expected = lambda p: F.when(p % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    wrong = lambda p: F.when(F.col(role).eqNullSafe(expected(p)), 0).otherwise(1)
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    stats = placed.groupBy(conv).agg(
        F.count("*").alias("n_turns"),
        flag((at == 0) & (F.col(role) == "system")).alias("has_system"),
        flag((at == 1) & (F.col(role) == "user")).alias("second_user"),
        F.sum(wrong(at)).alias("wrong_plain"),
        F.sum(F.when(at > 0, wrong(at - 1)).otherwise(0)).alias("wrong_after_system"),
        flag(F.col(text).isNull() & (F.col(role) != "system")).alias("missing_text"),
        flag(F.col(text).isNull() & (F.col(role) == "user")).alias("missing_user_text"),
        flag(F.col(text).isNull() & (F.col(role) == "assistant")).alias("missing_answer"),
    )
    has_system = F.col("has_system") == 1
    wrong_roles = F.when(has_system, F.col("wrong_after_system")).otherwise(F.col("wrong_plain")) > 0
    chat_reason = (
        F.when(F.col("n_turns") - F.col("has_system") < 2, "too_short").when(wrong_roles, "bad_alternation")
        .when(F.col("missing_text") == 1, "content_not_text")
    )
    render_reason = (
        F.when(has_system & (F.col("second_user") == 0), "system_without_user").when(wrong_roles, "bad_alternation")
        .when(F.col("missing_user_text") == 1, "user_content_not_text").when(F.col("missing_answer") == 1, "no_content")
    )
    return stats.select(
        conv, "n_turns", has_system.alias("has_system"), chat_reason.alias("chat_reason"), render_reason.alias("render_reason")
    )


def renderable_heads(turns: DataFrame, conv: str, turn: str, role: str, text: str, max_tokens: int, text_tokens: Column) -> DataFrame:
    """Conversations ready for truncated rendering: judged on all their turns, assembled from their first ones."""
    placed = place_turns(turns, conv, turn, text_tokens)
    good = _turn_reasons(placed, conv, role, text).filter("render_reason is null").select(conv)
    heads = assemble_conversations(head_turns(placed, max_tokens), conv, turn, role, text)
    return heads.join(good, conv, "left_semi")


# --- dataset adapters ---------------------------------------------------------------------------------------------

INDEXED_LETTERS = ("A", "B", "C", "D")


def adapt_indexed_choice(df: DataFrame) -> DataFrame:
    """question, choices, answer index, subject -> messages, letters, subject. `fault` marks rows without exactly
    four choices or with an index outside them."""
    letters = F.array(*[F.lit(l) for l in INDEXED_LETTERS])
    answer = F.try_element_at(letters, (F.col("answer") + 1).cast("int"))
    return df.withColumn("letters", letters).withColumn(
        "messages",
        F.array(message("user", choices_prompt(F.col("question"), letters, F.col("choices"))), message("assistant", answer)),
    ).withColumn(
        "fault",
        F.when(F.size("choices") != 4, "choice_count").when(~F.col("answer").between(0, 3), "answer_index"),
    )


def adapt_labelled_choice(df: DataFrame) -> DataFrame:
    """question, choices{text,label}, answerKey -> messages, letters. The key must be one of the labels."""
    letters, texts = F.col("choices.label"), F.col("choices.text")
    return df.withColumn("letters", letters).withColumn(
        "messages",
        F.array(message("user", choices_prompt(F.col("question"), letters, texts)), message("assistant", F.col("answerKey"))),
    ).withColumn("fault", F.when(~F.array_contains(letters, F.col("answerKey")), "key_not_a_label"))


def adapt_math(df: DataFrame) -> DataFrame:
    """question, answer with tool tags -> messages whose answer is a list of typed parts."""
    return df.withColumn(
        "messages", F.array(message("user", F.col("question")), message("assistant", parts=tool_parts(F.col("answer"))))
    )


def adapt_code_task(df: DataFrame) -> DataFrame:
    """prompt, canonical_solution, entry_point, test -> messages; the answer is the whole program."""
    solution = F.concat(F.col("prompt"), F.lit("\n"), F.col("canonical_solution"))
    return df.withColumn("messages", F.array(message("user", F.col("prompt")), message("assistant", solution)))


def assemble_programs(df: DataFrame, completion: str = "completion") -> DataFrame:
    """Text of the test program: imports of the prompt, code of the completion, tests, call of the check."""
    return df.withColumn(
        "program",
        F.concat(
            leading_imports(F.col("prompt")), F.lit("\n\n"), code_block(F.col(completion)), F.lit("\n\n"),
            F.col("test"), F.lit("\ncheck("), F.col("entry_point"), F.lit(")"),
        ),
    )


_ADAPTERS = {
    "indexed_choice": adapt_indexed_choice,
    "labelled_choice": adapt_labelled_choice,
    "math": adapt_math,
    "code": adapt_code_task,
}


def register_adapter(name: str, adapter) -> None:
    """Make a DataFrame -> DataFrame adapter available by name."""
    _ADAPTERS[name] = adapter


def adapt(name: str, df: DataFrame) -> DataFrame:
    return _ADAPTERS[name](df)


# --- mixtures -----------------------------------------------------------------------------------------------------


def mix_datasets(parts: Sequence[tuple[str, DataFrame, int]], key: str, seed: int = 42, per_bucket: int = 65_536) -> DataFrame:
    """Union in which each dataset appears `copies` times, in one deterministic shuffled order over (task, copy, key).
    Adds task, copy and the position `pos`."""
    union = None
    for task, df, copies in parts:
        part = df.withColumn("task", F.lit(task)).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        union = part if union is None else union.unionByName(part)
    keyed = union.withColumn("_key", shuffle_key(seed, "task", "copy", key))
    digits = key_digits(sum(df.count() * copies for _, df, copies in parts), per_bucket)
    return with_position(keyed, ["_key", "task", "copy", key], hex_bucket(F.col("_key"), digits)).drop("_key")


def sequence_datasets(parts: Sequence[tuple[str, DataFrame]], local: str) -> DataFrame:
    """Curriculum: datasets one after the other; `pos` is the running offset of the stage plus the local index."""
    union, offset = None, F.lit(0).cast("long")
    for stage, (task, df) in enumerate(parts):
        part = df.withColumn("stage", F.lit(stage)).withColumn("task", F.lit(task)).withColumn("pos", F.col(local) + offset)
        union = part if union is None else union.unionByName(part)
        offset = offset + df.agg(F.count("*")).scalar()
    return union


def mixture_report(mixed: DataFrame) -> DataFrame:
    counts = mixed.groupBy("task", "copy").agg(F.count("*").alias("n_rows"))
    return counts.withColumn("share", F.col("n_rows") / mixed.agg(F.count("*")).scalar())


# --- serving records ----------------------------------------------------------------------------------------------


def validate_requests(df: DataFrame) -> DataFrame:
    """Adds `reason`: the first broken rule, null when the request may be served. Works on streams too."""
    return df.withColumn(
        "reason", request_fault(F.col("messages"), F.col("temperature"), F.col("top_k"), F.col("max_tokens"))
    )


ACCESS_LINE = r'^(INFO|WARNING|ERROR):\s+\S+ - "[A-Z]+ \S+ HTTP/[0-9.]+" \d{3}( .*)?$'
LOG_HEAD = r"(?s)^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) - (\S+) - (\w+) - (.*)$"


def parse_chat_log(lines: DataFrame, lines_per_bucket: int = 65_536) -> DataFrame:
    """Server log lines (path, line_no, line) to turns: request_no, turn_no, role, worker, text, logged_at and
    `interleaved`. Lines without a log head continue the message before them; access-log lines are skipped. Requests
    carry no id, so a request block that does not hold exactly one answer is flagged as interleaved."""
    line = without_colours(F.col("line"))
    is_head = F.rlike(line, F.lit(LOG_HEAD))
    body = F.regexp_extract(line, LOG_HEAD, 4)
    parsed = lines.select(
        "path", "line_no", F.when(is_head, body).otherwise(line).alias("body"), is_head.alias("head"),
        F.when(is_head, F.to_timestamp(F.regexp_extract(line, LOG_HEAD, 1), "yyyy-MM-dd HH:mm:ss,SSS")).alias("logged_at"),
    ).filter(~F.rlike("body", F.lit(ACCESS_LINE)) | F.col("head"))
    head, rule = F.col("head").cast("long"), (F.col("head") & (F.col("body") == "=" * 20)).cast("long")
    placed = prefix_sums(
        parsed, ["line_no"], width_bucket(F.col("line_no"), lines_per_bucket), {"heads": head, "rules": rule}, ["path"]
    )
    placed = placed.withColumn("message_no", F.col("heads") + head).filter("message_no > 0")
    request = r"(?s)^\[([A-Z]+)\]: (.*)$"
    answer = r"(?s)^\[ASSISTANT\] \(GPU (\d+)\): (.*)$"
    # Lines behind rule lines and other log records belong to no turn and are left out before anything is collected.
    turn_heads = placed.filter(F.col("head") & (F.rlike("body", F.lit(request)) | F.rlike("body", F.lit(answer))))
    lines_of_turns = placed.join(turn_heads.select("path", "message_no"), ["path", "message_no"], "left_semi")
    messages = lines_of_turns.groupBy("path", "message_no").agg(
        F.min("rules").alias("rules"),
        F.max("logged_at").alias("logged_at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "body"))), lambda r: r["body"]), "\n").alias("text"),
    )
    is_answer = F.rlike("text", F.lit(answer))
    turns = messages.select(
        "path",
        F.floor((F.col("rules") - 1) / 2).alias("request_no"),
        "message_no",
        F.when(is_answer, "assistant").otherwise(F.lower(F.regexp_extract("text", request, 1))).alias("role"),
        F.when(is_answer, F.regexp_extract("text", answer, 1).try_cast("int")).alias("worker"),
        F.when(is_answer, F.regexp_extract("text", answer, 2)).otherwise(F.regexp_extract("text", request, 2)).alias("text"),
        "logged_at",
    )
    blocks = turns.groupBy("path", "request_no").agg(
        (F.count("worker") != 1).alias("interleaved"), F.min("message_no").alias("_first")
    )
    return turns.join(blocks, ["path", "request_no"]).select(
        "path", "request_no",
        # the rule line between request and answer is a message of its own
        (F.col("message_no") - F.col("_first") - F.col("worker").isNotNull().cast("int")).alias("turn_no"), "role", "worker", "text",
        "logged_at", "interleaved",
    )


# --- tool calls ---------------------------------------------------------------------------------------------------

# What a tool expression may contain.
ARITHMETIC_CHARACTERS = "0123456789*+-/.() "
STRING_CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'\"()._ "
BANNED_SUBSTRINGS = [
    "__", "import", "exec", "eval", "compile", "open", "file", "input", "raw_input", "globals", "locals", "vars", "dir",
    "getattr", "setattr", "delattr", "hasattr",
]

_OPERATORS = {
    ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
    ast.FloorDiv: operator.floordiv, ast.USub: operator.neg, ast.UAdd: operator.pos,
}


def _value(node: ast.AST):
    match node:
        case ast.Expression(body=body):
            return _value(body)
        case ast.Constant(value=int() | float() | str() as value):
            return value
        case ast.BinOp(left=left, op=op, right=right) if type(op) in _OPERATORS:
            return _OPERATORS[type(op)](_value(left), _value(right))
        case ast.UnaryOp(op=op, operand=operand) if type(op) in _OPERATORS:
            return _OPERATORS[type(op)](_value(operand))
        case ast.Call(func=ast.Attribute(value=text, attr="count"), args=[part], keywords=[]):
            return str.count(_value(text), _value(part))
    raise ValueError("not a tool expression")


def _evaluate(expr: str) -> str | None:
    """Value of an allowed expression as text, else null. The syntax tree is walked; nothing is executed."""
    expr = expr.replace(",", "")
    arithmetic = not set(expr) - set(ARITHMETIC_CHARACTERS) and "**" not in expr
    counting = (
        not set(expr) - set(STRING_CHARACTERS)
        and ".count(" in expr
        and not any(banned in expr.lower() for banned in BANNED_SUBSTRINGS)
    )
    if not (arithmetic or counting):
        return None
    try:
        return str(_value(ast.parse(expr.strip(), mode="eval")))
    except (SyntaxError, ValueError, TypeError, ArithmeticError, RecursionError, MemoryError):
        return None


@F.pandas_udf(StringType())
def tool_value(exprs: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(exprs, use_na_sentinel=True)
    results = [_evaluate(e) for e in distinct]
    return pd.Series([results[c] if c >= 0 else None for c in codes], dtype=object)


def audit_tool_calls(df: DataFrame, messages: str, keep: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """One row per tool call of the last message: expression, recorded result, recomputed value and status
    (match, mismatch, not_allowed, no_result)."""
    parts = F.try_element_at(F.col(messages), F.lit(-1))["parts"]
    calls = df.select(*keep, parts.alias("parts"), F.posexplode(parts).alias("part_no", "part")).filter("part.type = 'python'")
    calls = calls.select(
        *keep, "part_no", F.col("part.text").alias("expr"),
        F.try_element_at("parts", F.col("part_no") + 2)["text"].alias("recorded"),
    ).withColumn("value", tool_value("expr"))
    number = lambda c: F.replace(F.col(c), F.lit(","), F.lit("")).try_cast("double")
    close = F.abs(number("value") - number("recorded")) <= tolerance * F.greatest(F.abs(number("value")), F.lit(1.0))
    status = (
        F.when(F.coalesce(F.col("recorded"), F.lit("")) == "", "no_result")
        .when(F.col("value").isNull(), "not_allowed")
        .when(F.coalesce(close, F.col("value") == F.col("recorded")), "match")
        .otherwise("mismatch")
    )
    return calls.withColumn("status", status)
