"""SimHash near-duplicates by exact tiled comparison.

A text's fingerprint has a bit where more than half of its shingles' hashes have one. Two fingerprints link if they
differ in `radius` bits or fewer. Fingerprints are cut into radius + 1 parts, of which linked ones share at least one,
so only fingerprints with an equal part meet. Those that share a part are sorted by population count and compared tile
by tile: numpy's exclusive-or and bit counts decide every pair, and tile pairs whose population counts differ by more
than the radius are skipped, for no pair in them can link.

Only distinct fingerprints are compared. A part value that very many of them share is dealt into tiles of at most
about `tile` fingerprints, and each pair of tiles is a row of its own, so no task holds such a group. A tile pair gives
a spanning forest of its links, not all its pairs; components of the whole come from contraction in Spark.

Nulls and texts without words have fingerprint zero, which links like any other. Rows that repeat or tie share a
component; `keep_one` keeps the row of the smallest id (null last), then of the smallest text hash, then one of the
equal rows. Other columns pass through. Empty tables give empty results.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import as_bytes, at_places, drop, located, map_batches, save, whole_row
from sparkcorpus.llm.components import components

WORDS, RADIUS, SEED, TILE = 3, 3, 42, 2048
_ROWS = 256
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The fingerprint of one text as an unsigned number."""
    found = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    width = min(words, len(found))
    spans = zip(starts, ends[width - 1 :])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), np.uint64, len(found) - width + 1)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(text: str | Column, words: int = WORDS) -> Column:
    """Fingerprints as signed longs."""

    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, words) for t in as_bytes(texts)], np.uint64).view(np.int64))

    return F.arrow_udf(of, "bigint")(text)


def _forest(rows: np.ndarray, columns: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the matrix of links connects: each node with the first row of its component."""
    far = len(rows)
    of_row = np.arange(far)
    while True:
        of_column = np.where(near, of_row[:, None], far).min(0)
        lower = np.minimum(of_row, np.where(near, of_column[None, :], far).min(1))
        if (lower == of_row).all():
            break
        of_row = lower
    linked = of_column < far
    a = np.concatenate([rows, columns[linked]])
    b = rows[np.concatenate([of_row, of_column[linked]])]
    return a[a != b], b[a != b]


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges of the links inside one tile, or between two. Tiles are unsigned fingerprints."""
    left = left[np.argsort(np.bitwise_count(left), kind="stable")]
    within = right is None
    right = left if within else right[np.argsort(np.bitwise_count(right), kind="stable")]
    counts = np.bitwise_count(right).astype(np.int16)
    found = []
    for i in range(0, len(left), _ROWS):
        rows = left[i : i + _ROWS]
        low, high = int(np.bitwise_count(rows[0])), int(np.bitwise_count(rows[-1]))
        start = i if within else np.searchsorted(counts, low - radius, "left")
        columns = right[start : np.searchsorted(counts, high + radius, "right")]
        if not len(columns):
            continue
        near = np.bitwise_count(rows[:, None] ^ columns[None, :]) <= radius
        if near.sum() > (len(rows) if within else 0):
            found.append(_forest(rows, columns, near))
    if not found:
        return left[:0], left[:0]
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _edges_of(batch: pa.RecordBatch, radius: int):
    """Batches of arrays `left` (and `right`) to edges."""
    sides = [
        (c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False).view(np.uint64)) for c in batch.columns
    ]
    found = []
    for i in range(batch.num_rows):
        tiles = [values[offsets[i] : offsets[i + 1]] for offsets, values in sides]
        a, b = tile_links(tiles[0], tiles[1] if len(tiles) > 1 else None, radius)
        if len(a):
            found.append((a, b))
    if found:
        a, b = (np.unique(np.stack([np.concatenate(x) for x in zip(*found)]), axis=1)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints `fp` to (node, root) for all that link to another one."""
    spark = distinct.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = radius + 1
    width = 64 // parts
    cuts = [(i * width, width if i < radius else 64 - radius * width) for i in range(parts)]
    value = lambda at, bits: F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1))
    keys = F.array(*[F.struct(F.lit(i).alias("part"), value(*cut).alias("value")) for i, cut in enumerate(cuts)])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.part", "k.value")
    crowded = save(keyed.groupBy("part", "value").agg(F.count("*").alias("n")).filter(F.col("n") > tile).drop("n"), "crowded")

    alone = keyed.join(crowded, ["part", "value"], "left_anti").repartition(tasks, "part", "value")
    groups = alone.groupBy("part", "value").agg(F.collect_list("fp").alias("left")).filter(F.size("left") > 1).select("left")
    edges = map_batches(groups, "a bigint, b bigint", lambda batch: _edges_of(batch, radius))
    if not crowded.isEmpty():
        at = ["part", "value", "ones"]
        many = keyed.join(crowded, ["part", "value"]).withColumn("ones", F.bit_count("fp"))
        shares = save(many.groupBy(*at).agg(F.ceil(F.count("*") / tile).alias("shares")), "shares")
        dealt = many.join(shares, at).withColumn("share", F.pmod(F.xxhash64("fp"), F.col("shares")))
        tiles = save(dealt.groupBy(*at, "share").agg(F.collect_list("fp").alias("fps")), "tiles")
        a, b = tiles.drop("fps").alias("a"), tiles.drop("fps").alias("b")
        near = (F.col("b.ones") <= F.col("a.ones") + radius) & (F.struct("a.ones", "a.share") <= F.struct("b.ones", "b.share"))
        pairs = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value")) & near)
        pairs = pairs.select(F.struct("a.*").alias("a"), F.struct("b.*").alias("b"))
        tiles = tiles.select(F.struct(*at, "share").alias("tile"), "fps")
        pairs = pairs.join(tiles.select(F.col("tile").alias("a"), F.col("fps").alias("left")), "a")
        pairs = pairs.join(tiles.select(F.col("tile").alias("b"), F.col("fps").alias("right")), "b")
        # a tile paired with itself links each fingerprint to itself too; the components drop such edges
        pairs = pairs.repartition(tasks, "a", "b").select("left", "right")
        edges = edges.union(map_batches(pairs, "a bigint, b bigint", lambda batch: _edges_of(batch, radius)))
    return components(edges)


def with_groups(docs: DataFrame, doc_id: str, fp: str, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Distinct fingerprints of `docs` as `fp` with `component_id`, the smallest id of their component (null if all
    its ids are null), and `root`."""
    lowest = save(docs.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("low")), "fingerprints")
    roots = link_fingerprints(lowest.select("fp"), radius, tile)
    rooted = lowest.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("low").alias("component_id"))
    return save(rooted.join(least, F.col("root") == F.col("_root")).select("fp", "root", "component_id"), "groups")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per document: its id, `fingerprint` (16 hex digits) and `component_id`."""
    slim = save(docs.select(F.col(doc_id), fingerprints(text, words).alias("_fp")), "document-fingerprints")
    groups = with_groups(slim, doc_id, "_fp", radius, tile)
    shown = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return slim.join(groups, F.col("_fp") == F.col("fp")).select(doc_id, shown, "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS, tile: int = TILE, in_place: bool = False
) -> DataFrame:
    """One row of each component, with its columns as they are. `in_place` says that `docs` is a table just read, whose
    rows need no copy; they are not shuffled either."""
    rows = located(docs, [whole_row(docs)], in_place)
    content = F.col("row").getField(text)
    slim = save(rows.select(fingerprints(content, words).alias("_fp"), F.col("row").getField(doc_id).alias("_id"), F.xxhash64(content).alias("_h"), "_file", "_place"), "document-fingerprints")
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_h", "_file", "_place")
    first = save(slim.groupBy("_fp").agg(F.min(place).alias("first")), "first-rows")
    roots = link_fingerprints(first.select(F.col("_fp").alias("fp")), radius, tile)
    rooted = first.join(roots, F.col("_fp") == F.col("node"), "left").select(F.coalesce("root", "_fp").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first._file", "first._place")
    found = at_places(rows, kept).select("row.*")
    drop(slim, first)
    return found
