"""Text expressions: pre-token pattern, byte ids, UTF-8 prefixes, answers, choices, code blocks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The pre-token pattern. (?U) makes \s and the classes follow Unicode in the JVM.
SPLIT_PATTERN = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""
JVM_SPLIT_PATTERN = "(?U)" + SPLIT_PATTERN

# Fixed value: the marker of a final numeric answer.
ANSWER_PATTERN = r"#### (\-?[0-9\.\,]+)"


# A tool tag, or the text up to the next tag or the end of a `>>`. Unlike that of a split, the pattern is compiled once.
PIECE_PATTERN = r"(?s).(?:(?<!>>)(?!<<[^>]+>>).)*"


def once(value: Column, body) -> Column:
    """body(value) in which the value, which may cost much, is worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pretokens(text: Column) -> Column:
    """Lossless split into pre-tokens: their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(JVM_SPLIT_PATTERN), F.lit(0))


def byte_ids(text: Column) -> Column:
    """One id per UTF-8 byte. Each byte becomes one Latin-1 character, whose code point is the byte."""
    latin = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.when(F.octet_length(text) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(latin, ""), lambda c: F.ascii(c))
    )


def ids_to_latin(ids: Column) -> Column:
    """Inverse helper of `byte_ids`: ids below 256 to a Latin-1 string."""
    return F.array_join(F.transform(ids, lambda i: F.char(i)), "")


def utf8_prefix(text: Column, budget: Column) -> Column:
    """Longest prefix of whole characters within `budget` bytes. A character has at most 4 bytes, so one of the
    four byte prefixes of length budget, budget-1, budget-2, budget-3 is valid."""
    raw = F.encode(text, "UTF-8")
    tries = [
        F.try_validate_utf8(F.substring(raw, F.lit(1), F.greatest(budget - cut, F.lit(0)).cast("int")).cast("string"))
        for cut in range(4)
    ]
    return F.when(F.octet_length(text) <= budget, text).otherwise(F.coalesce(*tries))


def extract_answer(text: Column) -> Column:
    """Number after the first answer marker without thousands commas; null when there is no marker."""
    found = F.regexp_extract(text, ANSWER_PATTERN, 1)
    return F.when(found == "", F.lit(None)).otherwise(F.replace(found, F.lit(","), F.lit("")))


def last_number(text: Column) -> Column:
    """Last number anywhere in the text, commas removed; null when there is none."""
    found = F.regexp_extract_all(text, F.lit(r"(-?[0-9][0-9,]*(?:\.[0-9]+)?)"), F.lit(1))
    return F.replace(F.try_element_at(found, F.lit(-1)), F.lit(","), F.lit(""))


def tool_parts(answer: Column) -> Column:
    """Math answer to typed parts. <<expr=result>> gives a python part and a python_output part; the rest is text.
    A text part always closes the list, because graders read the last part."""
    pieces = F.regexp_extract_all(answer, F.lit(PIECE_PATTERN), F.lit(0))

    def typed(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    def convert(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(3), F.length(piece) - 4)
        has_equals = F.contains(inner, F.lit("="))
        last = F.substring_index(inner, "=", -1)
        expr = F.when(has_equals, F.substring(inner, F.lit(1), F.length(inner) - F.length(last) - 1)).otherwise(inner)
        result = F.when(has_equals, last).otherwise(F.lit(""))
        return F.when(
            F.rlike(piece, F.lit(r"(?s)^<<[^>]+>>$")), F.array(typed("python", expr), typed("python_output", result))
        ).otherwise(F.array(typed("text", piece)))

    closed = lambda parts: F.when(
        (F.size(parts) == 0) | (F.try_element_at(parts, F.lit(-1))["type"] != "text"),
        F.concat(parts, F.array(typed("text", F.lit("")))),
    ).otherwise(parts)
    return once(F.flatten(F.transform(pieces, convert)), closed)


def choices_prompt(question: Column, letters: Column, choices: Column) -> Column:
    """Multiple-choice prompt; the letter follows '=' directly, so it is the same token as the answer."""
    lines = F.zip_with(choices, letters, lambda c, l: F.concat(F.lit("- "), c, F.lit("="), l, F.lit("\n")))
    return F.concat(
        F.lit("Multiple Choice question: "), question, F.lit("\n"), F.array_join(lines, ""),
        F.lit("\nRespond only with the letter of the correct answer."),
    )


_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(text: Column) -> Column:
    """Trim all Unicode white space at both ends, not only blanks."""
    return F.regexp_replace(text, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def leading_imports(prompt: Column) -> Column:
    """Import lines at the top of a code prompt, up to the first line that is neither import, comment nor blank."""
    lines = F.transform(F.split(prompt, "\n"), strip)
    is_import = lambda s: F.startswith(s, F.lit("import ")) | F.startswith(s, F.lit("from "))
    stops = F.transform(lines, lambda s: ~is_import(s) & (s != "") & ~F.startswith(s, F.lit("#")))
    first_stop = F.array_position(stops, True)
    head = F.when(first_stop > 0, F.slice(lines, F.lit(1), (first_stop - 1).cast("int"))).otherwise(lines)
    return F.array_join(F.filter(head, is_import), "\n")


def code_block(completion: Column) -> Column:
    """Content of the first fenced block, else the whole text; stripped."""
    fence = r"(?s)```(?:python)?\s*\n(.*?)\n```"
    return strip(F.when(F.rlike(completion, F.lit(fence)), F.regexp_extract(completion, fence, 1)).otherwise(completion))


def without_colours(line: Column) -> Column:
    """Drop terminal colour sequences."""
    return F.regexp_replace(line, "\u001b\\[[0-9;]*m", "")
