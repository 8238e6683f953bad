"""Quality rules: how much of a text repeats itself.

Words get numbers within their text, a rolling hash gives every n-gram of several lengths a 64-bit value, and sorting
those values finds the n-grams that occur twice or more. What counts is the share of the text's characters that lie
inside such n-grams, or inside lines seen before. Each text is judged alone: no shuffle, and the columns that pass
through never enter Python.

Nulls count as empty texts, which fail the base rule (fewer than `MIN_WORDS` words). A very long text is one row and
takes a few arrays of 8 bytes a word. Ties do not arise, an empty table gives an empty one, repeated rows get the same verdict each, and other columns are left alone: the result is one struct column.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import as_bytes

MIN_WORDS = 10
BASE_LENGTH = 5
MAX_REPEAT_PERCENT = 20
#: Largest share of characters inside duplicated n-grams, by n, and inside repeated lines. Fixed values, as published for
#: the MassiveText corpus (Rae et al. 2021, "Scaling Language Models", table A1).
MAX_NGRAM_SHARE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_LINE_SHARE = 0.20

_SPACES = b" \t\n\x0b\x0c\r"
_LATER_BYTES = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)

FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "dup_line_chars bigint, dup_ngram_chars array<bigint>, base_failed boolean, kept boolean"
)


def _spread(ids: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value for each word number."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _inside_repeats(hashes: np.ndarray, length: int, n_words: int) -> np.ndarray | None:
    """Which words lie inside an n-gram that occurs twice or more; None if there is no such n-gram."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return None
    marks = np.zeros(len(hashes), bool)
    marks[order[1:][same]] = True
    marks[order[:-1][same]] = True
    steps = np.zeros(n_words + 1, np.int32)
    starts = np.flatnonzero(marks)
    steps[starts] += 1
    steps[starts + length] -= 1
    return np.cumsum(steps[:-1]) > 0


def code_points(text: bytes) -> int:
    return len(text.translate(None, _LATER_BYTES))


def measure(text: bytes) -> tuple:
    """The values of `FIELDS` for one text."""
    words = text.split()
    n = len(words)
    word_chars = len(text.translate(None, _SPACES + _LATER_BYTES))
    n_symbols = len(text) - len(text.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    n_dup_lines = dup_line_chars = 0
    for line in text.split(b"\n"):
        if not line.strip():
            continue
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += len(line.translate(None, _SPACES + _LATER_BYTES))
        else:
            seen.add(line)

    ngram_chars = [0] * len(MAX_NGRAM_SHARE)
    n_repeat_words = 0
    if n > BASE_LENGTH:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
        spread = _spread(ids)
        hashes = spread
        lengths = None
        for length in range(2, min(max(MAX_NGRAM_SHARE), n) + 1):
            hashes = hashes[:-1] * _BASE + spread[length - 1 :]
            if length not in MAX_NGRAM_SHARE:
                continue
            inside = _inside_repeats(hashes, length, n)
            if inside is None:  # then no longer n-gram repeats either
                break
            if lengths is None:
                lengths = np.fromiter(map(code_points, numbers), np.int64, len(numbers))[ids]
            if length == BASE_LENGTH:
                n_repeat_words = int(inside.sum())
            ngram_chars[length - min(MAX_NGRAM_SHARE)] = int(lengths[inside].sum())

    failed = n < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n
    kept = (
        not failed
        and dup_line_chars <= MAX_LINE_SHARE * word_chars
        and all(c <= share * word_chars for c, share in zip(ngram_chars, MAX_NGRAM_SHARE.values(), strict=True))
    )
    return n, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, ngram_chars, failed, kept


def _measured(texts: pa.Array) -> pa.Array:
    found = list(zip(*map(measure, as_bytes(texts)), strict=True)) or [[]] * 9
    kinds = [pa.int64()] * 6 + [pa.list_(pa.int64())] + [pa.bool_()] * 2
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names=names)


def repetition(text: str | Column) -> Column:
    """Struct of `FIELDS` for a text column."""
    return F.arrow_udf(_measured, f"struct<{FIELDS}>")(text)


def reject_repetitive(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes all rules, with their columns as they are."""
    return docs.filter(repetition(text)["kept"])
