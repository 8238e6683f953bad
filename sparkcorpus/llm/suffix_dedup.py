"""Removal of byte strings that occur twice, by prefix-free parsing.

A document is parsed at triggers: a rolling hash is taken of every `length - span + 1` bytes, and each run of `span`
consecutive window starts picks its smallest hash. Where a window (a string of `length` bytes) has its trigger depends
on its own bytes alone, so equal windows are parsed alike wherever they stand. The window starts that share a trigger
are consecutive; the string from the first of them to the end of the last is a phrase. A document's phrases overlap so
that every window lies in exactly one of them, and no phrase is a prefix of another at its trigger: so two windows are
equal if and only if they are equal suffixes, cut to `length`, of phrases with equal triggers, at equal distance from it.

Parse and dictionary. The parse is one slim row per phrase of the corpus; the dictionary counts its distinct phrases. A
phrase that occurs twice is repeated as a whole, every window of it. A trigger string that occurs once proves that none
of its windows is repeated.

Suffix array. Between the two, where a repeated passage begins or ends inside a phrase, the dictionary's suffixes are
put in order, and a suffix is repeated if a neighbour in that order shares its first `length` bytes. The order goes by
steps that each leave less to sort. Phrases with the same trigger line up at it and are cut into blocks of `BLOCK`
window starts. All windows of a block share a core of `length - BLOCK + 1` bytes; blocks are classed by core, so that
within a class suffixes differ only in the few bytes around it. These suffixes are sorted by (core, distance, bytes
around the core) in ranges, where each is compared with its neighbours; a range's first and last suffix meet those of
the next ranges in a table of two rows a range. Ties are broken by place, so a passage at the edge of which very many
documents differ is spread over ranges, too. As no window reaches beyond its phrase, the order of the parse's own
suffixes (of the phrases that follow) cannot change which windows are equal, and is not built.

What moves: the parse, twice (counted by trigger, joined with the repeated triggers); blocks around the ends of repeats;
the texts of documents that lose something, once, to meet their spans, and of those that hold a block. Other texts stay
where they are: bitmaps of places pick rows out.

Nulls and texts shorter than a window have no windows and stay as they are. Long texts are parsed in pieces of `PIECE`
window starts. Repeated rows are repeats of each other: all lose what they share. Other columns pass through. An empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import as_bytes, at_places, drop, located, map_batches, save, whole_row

LENGTH, SPAN, BLOCK = 400, 320, 16
#: A phrase's window starts and the place of its trigger are packed into one long.
_MOST_SPAN = 1 << 10
PIECE = 1 << 20
#: Texts whose phrases are held at a time.
ROWS = 512
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@cache
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value for each byte, and the powers of an odd base and of its inverse modulo 2**64."""
    base = _ODD[which]
    values = np.random.default_rng(which).integers(0, 2**64, 256, np.uint64)
    ups, downs = np.empty(size + 1, np.uint64), np.empty(size + 1, np.uint64)
    for powers, factor in ((ups, base), (downs, pow(base, -1, 2**64))):
        powers[0] = 1
        powers[1:] = np.uint64(factor)
        np.multiply.accumulate(powers, out=powers)
    return values, ups, downs


def rolling(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each string of `width` bytes."""
    values, ups, downs = _powers(which, 1 << max(12, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * ups[: len(data)], out=sums[1:])
    found = (sums[width:] - sums[:-width]) * downs[: len(data) - width + 1]
    found ^= found >> np.uint64(32)
    found *= np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(29)
    return found


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def parse(text: bytes, length: int = LENGTH, span: int = SPAN) -> list[tuple[int, int, int, int, int]]:
    """The phrases of a text: first and last window start, place and hash of the trigger string, digest of the phrase."""
    phrases = []
    width = length - span + 1
    digest = xxhash.xxh3_64_intdigest
    for piece in range(0, len(text) - length + 1, PIECE):
        data = text[piece : piece + PIECE + length - 1]
        grams = rolling(np.frombuffer(data, np.uint8), width)
        places = np.arange(len(grams), dtype=np.uint64)
        lowest = _sliding_min((grams & np.uint64(0xFFFFFFFF00000000)) | places, span)
        triggers = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(triggers)) + 1])
        last = np.concatenate([first[1:], [len(triggers)]]) - 1
        hashes = grams[triggers[first]].view(np.int64).tolist()
        for a, b, at, gram in zip(first.tolist(), last.tolist(), triggers[first].tolist(), hashes, strict=True):
            found = digest(data[a : b + length])
            phrases.append((piece + a, piece + b, piece + at, gram, found - (1 << 64) if found >> 63 else found))
    return phrases


_PHRASE = "_file bigint, _place bigint, at bigint, gram bigint, phrase bigint"
_BLOCK = "_file bigint, _place bigint, first bigint, last bigint, start bigint, n bigint, core binary, whole binary, left binary, right binary"
_SUFFIX = "core binary, off int, around binary, _file bigint, _place bigint, start bigint, n bigint"
_FOUND = "suffix binary, n bigint, rows bigint, edge boolean, _file bigint, _place bigint, start bigint"


def _batch(rows: list[tuple] | list[list], schema: str, by_column: bool = False) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    columns = rows if by_column else list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _parsed(batch: pa.RecordBatch, length: int, span: int):
    columns: list[list] = [[], [], [], [], []]
    for file, place, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), strict=True):
        if len(text) >= length:
            found = parse(text, length, span)
            at = [(a << 20) + (b - a << 10) + t - a for a, b, t, _, _ in found]
            for column, values in zip(columns, ([file] * len(at), [place] * len(at), at, [p[3] for p in found], [p[4] for p in found]), strict=True):
                column += values
    yield _batch(columns, _PHRASE, by_column=True)


def _unpacked(at: str = "at") -> list[Column]:
    """First and last window start and the trigger's place of a packed phrase."""
    first = F.shiftright(at, 20)
    return [first.alias("first"), (first + F.shiftright(at, 10).bitwiseAND(_MOST_SPAN - 1)).alias("last"), (first + F.col(at).bitwiseAND(_MOST_SPAN - 1)).alias("trigger")]


def _blocks(batch: pa.RecordBatch, length: int):
    """The blocks of some phrases of each text: window starts, digests of core and whole, and the bytes around the core."""
    rows = []
    digest = xxhash.xxh3_128_digest
    for file, place, text, phrases in zip(*(batch.column(i).to_pylist() for i in (0, 1)), as_bytes(batch.column(2)), batch.column(3).to_pylist(), strict=True):
        for p in phrases:
            trigger = p["trigger"]
            for number in range((p["first"] - trigger) // BLOCK, (p["last"] - trigger) // BLOCK + 1):
                start = trigger + number * BLOCK
                a, b = max(p["first"], start), min(p["last"], start + BLOCK - 1)
                core = digest(text[start + BLOCK - 1 : start + length], number % (1 << 64))
                rows.append((file, place, a, b, start, p["n"], core, digest(text[a : b + length]), text[a : start + BLOCK - 1], text[start + length : b + length]))
    yield _batch(rows, _BLOCK)


def _suffixes(batch: pa.RecordBatch):
    """The suffixes at all window starts of each block, as their bytes around the core."""
    rows = []
    for r in batch.to_pylist():
        for s in range(r["first"], r["last"] + 1):
            off = s - r["start"]
            rows.append((r["core"], off, r["left"][s - r["first"] :] + r["right"][:off], r["_file"], r["_place"], s, r["n"]))
    yield _batch(rows, _SUFFIX)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes of one range to those that a neighbour equals and whose phrase occurs once. The range's first and
    last runs of equal suffixes come as `edge` rows, with their size, for the ranges beside it."""
    run: list[tuple] = []  # the first rows of the open run
    size, suffix, first = 0, None, True

    def closed(last: bool) -> list[tuple]:
        rows = [(suffix, n, size, False, *where) for n, *where in run if size > 1 and n == 1]
        if first or last:
            n, *where = run[0]
            rows.append((suffix, n, size, True, *where))
        return rows

    for batch in batches:
        found = []
        keys = [c + bytes([o]) + a for c, o, a in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
        places = zip(*(batch.column(i).to_pylist() for i in (6, 3, 4, 5)), strict=True)
        for key, row in zip(keys, places, strict=True):
            if key != suffix:
                if suffix is not None:
                    found += closed(False)
                    first = False
                run, size, suffix = [], 0, key
            size += 1
            if size < 3:
                run.append(row)
            elif row[0] == 1:  # the run is known to be longer than one: no need to hold it
                found.append((suffix, 1, size, False, *row[1:]))
        if found:
            yield _batch(found, _FOUND)
    if suffix is not None:
        yield _batch(closed(True), _FOUND)


def _cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left without the spans, the number of bytes removed, and of maximal runs removed."""
    kept, at, runs, end = [], 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            runs += 1
            kept.append(text[at:a])
        end = max(end, b)
        at = end
    kept.append(text[at:])
    left = b"".join(kept)
    return left, len(text) - len(left), runs


def _kept(as_text: bool):
    kind, name = (pa.string(), "string") if as_text else (pa.binary(), "binary")

    def of(texts: pa.Array, spans: pa.Array) -> pa.Array:
        found = []
        for text, cuts in zip(as_bytes(texts), spans.to_pylist(), strict=True):
            left, *counts = _cut(text, [(s["first"], s["end"]) for s in cuts])
            found.append(dict(zip(("kept", "n_removed", "n_spans"), (left.decode("utf-8", "ignore") if as_text else left, *counts), strict=True)))
        return pa.array(found, pa.struct([("kept", kind), ("n_removed", pa.int64()), ("n_spans", pa.int64())]))

    # Not to be repeated in filters on what it gives: each place in a plan takes a Python worker of its own in every task.
    return F.arrow_udf(of, f"kept {name}, n_removed bigint, n_spans bigint").asNondeterministic()


def repeated_phrases(texts: DataFrame, length: int = LENGTH, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Texts (`_file`, `_place`, `text`) to the occurrences of phrases that occur twice (`_file`, `_place`, `first`,
    `last`), and to the open phrases of the dictionary: those whose trigger another phrase has too, where one of them
    occurs once, with the number `n` of their occurrences and the place of one."""
    parsed = save(map_batches(texts.select("_file", "_place", "text"), _PHRASE, lambda b: _parsed(b, length, span), ROWS), "parse")
    triggers = save(parsed.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram"), "triggers")
    repeated = save(parsed.join(triggers, "gram", "left_semi"), "repeated-parse")
    drop(parsed, triggers)
    counts = repeated.groupBy("gram", "phrase").agg(F.count("*").alias("n"), F.min(F.struct("_file", "_place", "at")).alias("one"))
    dictionary = save(counts, "dictionary")
    rarest = dictionary.groupBy("gram").agg(F.min("n").alias("least")).filter("least = 1").select("gram")
    opened = dictionary.join(save(rarest, "open-triggers"), "gram", "left_semi").select("one.*", "n")
    opened = save(opened.select("_file", "_place", *_unpacked(), "n"), "open-phrases")
    twice = dictionary.filter("n > 1").select("gram", "phrase")
    wholes = save(repeated.join(twice, ["gram", "phrase"], "left_semi").select("_file", "_place", *_unpacked()).drop("trigger"), "repeated-phrases")
    drop(repeated, dictionary)
    return wholes, opened


def repeated_suffixes(texts: DataFrame, opened: DataFrame, length: int = LENGTH) -> DataFrame:
    """Window starts of open phrases that are repeated although their phrase is not: runs from `first` to `last`."""
    wanted = opened.groupBy("_file", "_place").agg(F.collect_list(F.struct("first", "last", "trigger", "n")).alias("phrases"))
    holders = at_places(texts.select("_file", "_place", "text"), opened).join(wanted, ["_file", "_place"])
    blocks = save(map_batches(holders.select("_file", "_place", "text", "phrases"), _BLOCK, lambda b: _blocks(b, length), ROWS), "blocks")

    one = F.min_by(F.struct("_file", "_place", "first", "last", "start", "left", "right"), F.struct("_file", "_place", "first")).alias("one")
    wholes = save(blocks.groupBy("core", "whole").agg(F.sum("n").alias("n"), one), "block-dictionary")
    twice = save(wholes.filter("n > 1").select("core", "whole"), "repeated-blocks")
    in_blocks = save(blocks.filter("n = 1").join(twice, ["core", "whole"], "left_semi").select("_file", "_place", "first", "last"), "found-in-blocks")
    cores = wholes.groupBy("core").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 and least = 1")
    opened_blocks = wholes.join(save(cores.select("core"), "open-cores"), "core", "left_semi").select("core", "n", "one.*")

    order = ["core", "off", "around", "_file", "_place", "start"]
    suffixes = save(map_batches(opened_blocks, _SUFFIX, _suffixes, ROWS), "suffixes")
    found = save(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, _FOUND), "neighbours")
    edges = found.filter("edge").groupBy("suffix").agg(F.sum("rows").alias("total")).filter("total > 1").select("suffix")
    at_edges = found.filter("edge and rows = 1 and n = 1").join(edges, "suffix", "left_semi")
    alone = found.filter("not edge").union(at_edges).select("_file", "_place", "start", F.col("start").alias("last"))
    result = save(in_blocks.union(alone), "window-starts")
    drop(blocks, wholes, suffixes, found, in_blocks)
    return result


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = LENGTH, span: int = SPAN, keep: list[str] | None = None, in_place: bool = False, as_text: bool = False
) -> DataFrame:
    """Every row (or the columns to keep) as struct `row`, with `n_bytes`, `n_removed`, `n_spans`, and `kept`, the bytes left of a text from
    which some were removed (else null); `as_text`: the text left, without characters cut in half. `in_place` says that `docs` is a table
    just read, whose rows need no copy."""
    if not 1 < span < length or span > _MOST_SPAN:
        raise ValueError(f"span must lie between 1 and length, and be {_MOST_SPAN} at most")
    names = docs.columns if keep is None else keep
    whole = whole_row(docs, [*names, *([] if text in names else [text])])
    rows = located(docs, [whole], in_place)
    texts = rows.select(F.col("row").getField(text).alias("text"), "_file", "_place")
    wholes, opened = repeated_phrases(texts, length, span)
    starts = repeated_suffixes(texts, opened, length)
    spans = wholes.union(starts).groupBy("_file", "_place").agg(F.collect_set(F.struct("first", (F.col("last") + length).alias("end"))).alias("spans"))
    spans = save(spans, "spans")
    drop(wholes, opened, starts)

    size = F.coalesce(F.octet_length(F.col("row").getField(text)), F.lit(0)).cast("long").alias("n_bytes")
    shown = F.struct(*[F.col("row").getField(c).alias(c) for c in names]).alias("row")
    touched = at_places(rows, spans).join(spans, ["_file", "_place"])
    cut = _kept(as_text)(F.col("row").getField(text), "spans").alias("cut")
    found = touched.select("row", cut).select(shown, size, "cut.n_removed", "cut.n_spans", F.col("cut.kept").alias("kept"))
    zero = F.lit(0).cast("long")
    same = at_places(rows, spans, wanted=False).select(shown, size, zero.alias("n_removed"), zero.alias("n_spans"), F.lit(None).cast("string" if as_text else "binary").alias("kept"))
    return found.union(same)
