"""Packing documents into rows of fixed capacity.

Packing is sequential inside a stream, so the corpus is cut into streams of a fixed number of documents
(`pack_group`); their number grows with the corpus and no stream exceeds a task. Only document lengths enter
Python; tokens are joined to the placements afterwards."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.functions.arrays import pad_right, supervised_count
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators.ordering import join_values, prefix_sums

PLACEMENT_SCHEMA = "pack_group long, row_no long, slot int, doc long, offset int, take int, n_tokens int, complete boolean"
DOCS_PER_GROUP = 65_536


def pack_groups(df: DataFrame, pos: str, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """Streams of consecutive documents, at most docs_per_group each (positions are unique)."""
    return df.withColumn("pack_group", width_bucket(F.col(pos), docs_per_group))


def _best_fit(lengths: Sequence[int], capacity: int, buffer_size: int, crop: bool) -> Iterator[tuple[int, int, int]]:
    """(row, doc index, take) in placement order. The buffer is kept sorted by (length, newest first), so the best
    fit and the shortest document are found by bisection; the earliest arrival wins ties."""
    waiting: list[tuple[int, int]] = []
    arrived, row, room = 0, 0, capacity
    newest = float("inf")
    while True:
        while len(waiting) < buffer_size and arrived < len(lengths):
            insort(waiting, (lengths[arrived], -arrived))
            arrived += 1
        if not waiting:
            return
        fit = bisect_right(waiting, (room, newest)) - 1
        if fit >= 0:
            length, doc = waiting.pop(fit)
            yield row, -doc, length
            room -= length
        elif crop:
            length, doc = waiting.pop(bisect_right(waiting, (waiting[0][0], newest)) - 1)
            yield row, -doc, room
            room = 0
        else:
            room = 0
        if room == 0:
            row, room = row + 1, capacity


def _greedy(lengths: Sequence[int], capacity: int, crop: bool) -> Iterator[tuple[int, int, int]]:
    """Documents in order. Without crop a document that does not fit opens a new row; over-long ones are cut."""
    row, room = 0, capacity
    for doc, length in enumerate(lengths):
        if not crop and length > room and room < capacity:
            row, room = row + 1, capacity
        take = min(length, room)
        yield row, doc, take
        room -= take
        if room == 0:
            row, room = row + 1, capacity


def _first_fit_decreasing(lengths: Sequence[int], capacity: int) -> Iterator[tuple[int, int, int]]:
    """Longest first, each into the first open row with room; over-long documents are cut to one row."""
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)  # a tournament: each node knows the largest room of the rows below it
    for doc in order:
        take = min(lengths[doc], capacity)
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < take:
                at += 1
        yield at - leaves, doc, take
        room[at] -= take
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])


def _placements(df: DataFrame, doc: str, order: str, n_tokens: str, place, drop_open_row: bool, capacity: int) -> DataFrame:
    """Run a placement policy per pack_group on (doc, length) only."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("o", kind="stable")
        docs, lengths = pdf["doc"].to_numpy(), pdf["n"].to_numpy()
        placed = pd.DataFrame(list(place(lengths.tolist())), columns=["row_no", "doc", "take"])
        placed["n_tokens"] = lengths[placed["doc"].to_numpy(dtype="int64")]
        placed["doc"] = docs[placed["doc"].to_numpy(dtype="int64")]
        by_row = placed.groupby("row_no", sort=False)["take"]
        placed["slot"] = by_row.cumcount()
        placed["offset"] = by_row.cumsum() - placed["take"]
        placed["complete"] = (by_row.transform("sum") == capacity) if drop_open_row else True
        placed["pack_group"] = pdf["pack_group"].iloc[0]
        return placed[["pack_group", "row_no", "slot", "doc", "offset", "take", "n_tokens", "complete"]]

    slim = df.select(
        F.col("pack_group").cast("long").alias("pack_group"),
        F.col(doc).cast("long").alias("doc"),
        F.col(order).alias("o"),
        F.col(n_tokens).cast("int").alias("n"),
    )
    return slim.groupBy("pack_group").applyInPandas(pack, PLACEMENT_SCHEMA)


def pack_bestfit_crop(df: DataFrame, doc: str, order: str, n_tokens: str, capacity: int, buffer_size: int = 1000) -> DataFrame:
    """Best-fit with cropping: every complete row is full. When nothing fits, the shortest waiting document is cut to
    the room left. The open row at the end of a stream has complete = false."""
    return _placements(df, doc, order, n_tokens, lambda ls: _best_fit(ls, capacity, buffer_size, True), True, capacity)


def pack_bestfit_pad(df: DataFrame, doc: str, order: str, n_tokens: str, capacity: int, buffer_size: int = 100) -> DataFrame:
    """Best-fit without cropping: rows are padded. Documents above the capacity can never be placed, see `oversize`."""
    fitting = df.filter(F.col(n_tokens) <= capacity)
    return _placements(fitting, doc, order, n_tokens, lambda ls: _best_fit(ls, capacity, buffer_size, False), False, capacity)


def oversize(df: DataFrame, n_tokens: str, capacity: int) -> DataFrame:
    return df.filter(F.col(n_tokens) > capacity)


def supervised_only(df: DataFrame, mask: str) -> DataFrame:
    """Examples with at least one supervised token."""
    return df.filter(F.exists(mask, lambda m: m == 1))


def pack_greedy(df: DataFrame, doc: str, order: str, n_tokens: str, capacity: int, crop: bool) -> DataFrame:
    return _placements(df, doc, order, n_tokens, lambda ls: _greedy(ls, capacity, crop), crop, capacity)


def pack_ffd(df: DataFrame, doc: str, order: str, n_tokens: str, capacity: int) -> DataFrame:
    return _placements(df, doc, order, n_tokens, lambda ls: _first_fit_decreasing(ls, capacity), False, capacity)


def pack_concat(df: DataFrame, doc: str, order: Sequence[str], bucket: Column, n_tokens: str, capacity: int) -> DataFrame:
    """One token stream cut into rows; a row may start inside a document. `start` is the offset inside the document,
    `offset` the place in the row. Only lengths move; there is no sequential step."""
    slim = df.select(F.col(doc).alias("doc"), *[c for c in order if c != doc], F.col(n_tokens).cast("long").alias("n_tokens"), bucket.alias("_b"))
    keys = ["doc" if c == doc else c for c in order]
    placed = prefix_sums(slim, keys, F.col("_b"), {"begin": F.col("n_tokens")}).filter(F.col("n_tokens") > 0)
    end = F.col("begin") + F.col("n_tokens")
    rows = F.sequence(F.floor(F.col("begin") / capacity), F.floor((end - 1) / capacity))
    pieces = placed.select("doc", "n_tokens", "begin", end.alias("end"), F.explode(rows).alias("row_no"))
    first = F.greatest(F.col("begin"), F.col("row_no") * capacity)
    last = F.least(F.col("end"), (F.col("row_no") + 1) * capacity)
    return pieces.select(
        "row_no", "doc", "n_tokens",
        (first - F.col("row_no") * capacity).cast("int").alias("offset"),
        (first - F.col("begin")).cast("int").alias("start"),
        (last - first).cast("int").alias("take"),
    )


def fill_rows(
    placements: DataFrame, tokens: DataFrame, by: Sequence[str], capacity: int, ids: str = "ids",
    mask: str | None = None, pad_id: int | None = None, start: str | None = None,
) -> DataFrame:
    """Join tokens to placements and rebuild the rows: `row`, `content_len` and, for masked data, `mask_row`. `start`
    names the offset inside the document. A document meets all its placements in one row and is cut there, so a long
    document is never copied per piece, and a row never holds more than `capacity` tokens."""
    begin = F.lit(0) if start is None else F.col(start)
    where = placements.groupBy("doc").agg(F.collect_list(F.struct(*by, "offset", begin.alias("begin"), "take")).alias("places"))
    both = where.join(tokens.select("doc", ids, *([mask] if mask else [])), "doc")

    def piece(p: Column) -> Column:
        cut = [F.slice(ids, p["begin"] + 1, p["take"]).alias("ids")]
        if mask is not None:
            cut.append(F.slice(mask, p["begin"] + 1, p["take"]).alias("mask"))
        return F.struct(*[p[k].alias(k) for k in by], F.struct(p["offset"].alias("offset"), *cut).alias("piece"))

    pieces = both.select(F.explode(F.transform("places", piece)).alias("p")).select("p.*")
    rows = pieces.groupBy(*by).agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    row = F.flatten(F.transform("pieces", lambda p: p["ids"]))
    out = [*by, (row if pad_id is None else pad_right(row, F.lit(capacity), pad_id)).alias("row"), F.size(row).alias("content_len")]
    if mask is not None:
        flags = F.flatten(F.transform("pieces", lambda p: p["mask"]))
        out.append((flags if pad_id is None else pad_right(flags, F.lit(capacity), 0)).alias("mask_row"))
    return rows.select(*out)


def packing_report(placements: DataFrame, capacity: int, by: Sequence[str] = (), row_keys: Sequence[str] = ("pack_group", "row_no")) -> DataFrame:
    """Utilisation, cropped and padded share, and the floor: tokens beyond the capacity of single documents."""
    per_row = placements.filter("complete").groupBy(*by, *row_keys).agg(F.sum("take").cast("long").alias("used"))
    rows = per_row.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum("used").alias("placed"))
    docs = placements.groupBy(*by).agg(
        F.sum("n_tokens").cast("long").alias("tokens"),
        F.sum(F.col("n_tokens") - F.col("take")).cast("long").alias("cropped"),
        F.sum(F.when(F.col("complete"), 0).otherwise(F.col("take"))).cast("long").alias("tail"),
        F.sum(F.greatest(F.col("n_tokens") - capacity, F.lit(0))).cast("long").alias("floor"),
    )
    both = docs.join(rows, list(by), "left") if by else docs.withColumn("_one", F.lit(1)).join(rows.withColumn("_one", F.lit(1)), "_one").drop("_one")
    space = F.col("n_rows") * capacity
    return both.select(
        *by, "n_rows", "tokens", "placed", "cropped", "tail", "floor",
        (F.col("placed") / space * 100).alias("util_pct"),
        (F.col("cropped") / F.col("tokens") * 100).alias("crop_pct"),
        ((space - F.col("placed")) / space * 100).alias("pad_pct"),
        (F.col("floor") / F.col("tokens") * 100).alias("floor_pct"),
    )


def supervision_audit(rows: DataFrame, targets: str, batch: str) -> DataFrame:
    """Supervised targets per batch; a batch without any is an error."""
    per_row = rows.select(batch, supervised_count(F.col(targets)).alias("n"))
    return per_row.groupBy(batch).agg(
        F.count("*").alias("n_rows"), F.sum("n").cast("long").alias("supervised"), (F.sum("n") == 0).alias("fully_masked")
    )


def packing_progress(placements: DataFrame, row: str, batch_rows: int, dataset_size: int) -> DataFrame:
    """Documents consumed up to the end of each batch, as a share of the dataset, and the epoch."""
    batch = F.floor(F.col(row) / batch_rows).cast("long")
    used = placements.groupBy(batch.alias("batch_no")).agg(F.count("*").alias("docs"))
    done = prefix_sums(used, ["batch_no"], width_bucket(F.col("batch_no"), 4096), {"earlier": F.col("docs")})
    consumed = F.col("earlier") + F.col("docs")
    return done.select(
        "batch_no", consumed.alias("consumed"), (consumed / dataset_size).alias("progress"),
        (F.floor(consumed / dataset_size) + 1).cast("long").alias("epoch"),
    )


def assemble_batches(rows: DataFrame, row_no: str, batch_rows: int, value: str) -> DataFrame:
    """B rows per batch, in row order."""
    batch = F.floor(F.col(row_no) / batch_rows).cast("long")
    return rows.groupBy(batch.alias("batch_no")).agg(
        F.count("*").alias("n_rows"),
        F.transform(F.array_sort(F.collect_list(F.struct(row_no, value))), lambda r: r[value]).alias("rows"),
    )


def pad_group(df: DataFrame, by: Sequence[str], ids: str, pad_id: int, *also: tuple[str, object]) -> DataFrame:
    """Right-pad to the longest sequence of the group; `also` pads further columns to the same length with their own
    value. Only the group maxima are joined back."""
    longest = df.groupBy(*by).agg(F.max(F.size(ids)).alias("_longest"))
    padded = {name: pad_right(F.col(name), F.col("_longest"), value) for name, value in ((ids, pad_id), *also)}
    return join_values(df, longest, by).withColumns(padded).drop("_longest")
