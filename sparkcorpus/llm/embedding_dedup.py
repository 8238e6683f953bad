"""Embedding near-duplicates by lattice hashing.

In each of `tables` hash tables a vector, scaled to length one, is projected by a random matrix onto eight coordinates
and decoded to the nearest point of the E8 lattice. The table holds it in that point's cell and in the `probes`
neighbouring cells (of the 240 around it) that lie nearest to its projection. Two vectors meet if they share a cell of
some table; their cosine in double precision then decides. With the default width a pair of cosine 0.9 meets with
probability 0.97, a pair of 0.95 with more than 0.999; a link is missed with the rest, none is invented.

Equal vectors collapse to one with a weight before anything else moves. Cells that hold one vector are dropped before
vectors travel. A cell of more than `tile` vectors is dealt into shares, and each pair of shares is a group of its own,
so no task holds a crowded cell and no pair of vectors is ever a row: a group is compared by matrix products and gives,
per vector, the weight of its links and one edge of a spanning forest. A pair that meets in several cells is counted in
the one of lowest number: the cells of both are worked out again, by arithmetic that does not depend on the order or
size of batches. Components come from contraction in Spark.

Null, zero and non-finite vectors, and vectors with a null component, link with nothing, nor do vectors of different
lengths. Rows with equal vectors link whatever their ids; a repeated row is a row. Null ids count as no id for
`component_id`, which is null if a component has no id, and are never `kept`. Other columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import map_batches, save
from sparkcorpus.llm.components import components

COSINE, TABLES, PROBES, WIDTH, TILE, SEED = 0.9, 4, 4, 1.25, 1024, 11
_ROWS, _SLICE = 4096, 1 << 16
_MIX = 0x9E3779B97F4A7C15


@cache
def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8, one a column."""
    eye = np.eye(8)
    whole = [a * eye[i] + b * eye[j] for i in range(8) for j in range(i) for a in (1, -1) for b in (1, -1)]
    half = [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(whole + half).T


@cache
def _projection(size: int, tables: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, size, tables])
    return rng.normal(size=(size, tables * 8)) / width, 2 * rng.random(tables * 8)


def _even_points(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where rounding gives an odd sum, the worst coordinate goes the other way."""
    near = np.rint(x)
    rest = x - near
    worst = np.abs(rest).argmax(1)
    rows = np.arange(len(x))
    near[rows, worst] += np.where(near.sum(1) % 2 != 0, np.where(rest[rows, worst] >= 0, 1.0, -1.0), 0.0)
    return near


def nearest_points(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the nearer of those with whole and with half coordinates."""
    whole, half = _even_points(x), _even_points(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """Numbers of the cells of unit vectors: own cell and probed ones, for each table. Sums run over one coordinate
    after the other, so a vector has the same cells in any batch."""
    matrix, offset = _projection(unit.shape[1], tables, width, seed)
    x = np.tile(offset, (len(unit), 1))
    for i in range(unit.shape[1]):
        x += unit[:, i : i + 1] * matrix[i]
    x = x.reshape(-1, 8)
    points = nearest_points(x)
    rest = x - points
    ahead = np.zeros((len(x), 240))
    for i in range(8):
        ahead += rest[:, i : i + 1] * _shortest()[i]
    order = np.argsort(-ahead, axis=1, kind="stable")[:, :probes]
    around = np.concatenate([points[:, None], points[:, None] + _shortest().T[order]], axis=1)
    numbers = np.full(around.shape[:2], unit.shape[1], np.uint64)
    numbers += np.tile(np.arange(tables, dtype=np.uint64) << np.uint64(32), len(unit))[:, None]
    for i in range(8):
        numbers = (numbers ^ np.rint(2 * around[..., i]).astype(np.int64).view(np.uint64)) * np.uint64(_MIX)
        numbers ^= numbers >> np.uint64(29)
    return numbers.view(np.int64).reshape(len(unit), tables * (1 + probes))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and unit vectors of each length in a column of lists without nulls."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        vectors = values[lists.offsets.to_numpy()[rows][:, None] + np.arange(size)]
        vectors /= np.abs(vectors).max(1)[:, None]  # squares of the largest and smallest doubles stay in range
        total = np.zeros(len(rows))
        for i in range(size):
            total += vectors[:, i] ** 2
        yield rows, vectors / np.sqrt(total)[:, None]


def _entries(batch: pa.RecordBatch, config: tuple) -> Iterator[pa.RecordBatch]:
    nodes = batch.column(0).to_numpy()
    for rows, unit in _matrices(batch.column(1)):
        found = cells(unit, *config)
        node = np.repeat(nodes[rows], found.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(node)], names=["cell", "node"])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The lowest row that each of n rows reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def compare(cell: int, unit: np.ndarray, weight: np.ndarray, left: np.ndarray, cosine: float, config: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a cell's group: the weight of the links that are counted in this cell, and the lowest row linked to
    it. `left` marks the rows of the first share; without a second one, rows are compared among themselves."""
    within = bool(left.all())
    first = np.flatnonzero(left)
    second = first if within else np.flatnonzero(~left)
    links, a, b, codes = np.zeros(len(unit), np.int64), [], [], None
    for at in range(0, len(first), 256):
        rows = first[at : at + 256]
        i, j = np.nonzero(unit[rows] @ unit[second].T >= cosine - 1e-9)
        i, j = rows[i], second[j]
        i, j = (i[i < j], j[i < j]) if within else (i, j)
        for k in range(0, len(i), _SLICE):
            x, y = i[k : k + _SLICE], j[k : k + _SLICE]
            exact = np.einsum("nd,nd->n", unit[x], unit[y]) >= cosine
            x, y = x[exact], y[exact]
            if not len(x):
                continue
            codes = cells(unit, *config) if codes is None else codes
            step, lowest = 1 + config[1], np.full(len(x), np.iinfo(np.int64).max)
            for t in range(0, codes.shape[1], step):
                for u in range(t, t + step):
                    for v in range(t, t + step):
                        same = codes[x, u] == codes[y, v]
                        lowest[same] = np.minimum(lowest[same], codes[x[same], u])
            counted = lowest == cell
            np.add.at(links, x[counted], weight[y[counted]])
            np.add.at(links, y[counted], weight[x[counted]])
            tree = _forest(x, y, len(unit))
            moved = np.flatnonzero(tree != np.arange(len(unit)))
            a.append(moved)
            b.append(tree[moved])
    root = _forest(np.concatenate(a), np.concatenate(b), len(unit)) if a else np.arange(len(unit))
    return links, root


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by (cell, low, high)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            keys = np.stack([part.column(i).to_numpy() for i in range(3)])
            new = np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1
            if held and tuple(held[-1].column(i)[-1].as_py() for i in range(3)) != tuple(keys[:, 0].tolist()):
                new = np.concatenate([[0], new])
            if len(new):
                done = held + ([part.slice(0, int(new[-1]))] if new[-1] else [])
                if done:
                    yield pa.Table.from_batches(done)
                held = [part.slice(int(new[-1]))]
            else:
                held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _linked(cosine: float, config: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            table = table.combine_chunks()
            keys = np.stack([table.column(i).to_numpy() for i in range(3)])
            starts = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1, [table.num_rows]])
            node, weight, left = (table.column(i).to_numpy() for i in (3, 4, 5))
            place = {}  # a cell holds vectors of one length, and so does a group
            for rows, unit in _matrices(table.column(6)):
                place |= dict.fromkeys(rows[np.isin(rows, starts)].tolist(), (rows, unit))
            found = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if b - a < 2:
                    continue
                rows, unit = place[a]
                at = np.searchsorted(rows, a)
                links, root = compare(int(keys[0, a]), unit[at : at + b - a], weight[a:b], left[a:b].astype(bool), cosine, config)
                hit = np.flatnonzero((links > 0) | (root != np.arange(b - a)))
                found.append((node[a:b][hit], links[hit], node[a:b][root[hit]]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["node", "links", "near"])

    return run


def _usable(vector: str) -> Column:
    """Vectors that have a direction."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def link_vectors(
    distinct: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, tile: int = TILE, seed: int = SEED
) -> DataFrame:
    """Distinct vectors (node, weight, vector), written to files, to (node, links, root) for all that link to another
    one: the weight of the vectors linked directly, and a number that a component shares."""
    spark = distinct.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    config = (tables, probes, width, seed)
    entered = save(map_batches(distinct.select("node", "vector"), "cell bigint, node bigint", lambda b: _entries(b, config), _ROWS), "cells")
    sizes = entered.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = save(sizes.select("cell", F.ceil(F.col("n") / tile).cast("int").alias("shares")), "shared-cells")
    members = entered.join(shared, "cell").withColumn("share", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("other")
    dealt = members.select("cell", "node", "share", others)
    dealt = dealt.select("cell", F.least("share", "other").alias("low"), F.greatest("share", "other").alias("high"), "node", (F.col("share") <= F.col("other")).alias("left"))
    carried = dealt.join(distinct.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"))
    carried = carried.select("cell", "low", "high", "node", "weight", F.col("left").cast("int").alias("left"), "vector")
    key = ["cell", "low", "high"]
    found = carried.repartition(tasks, *key).sortWithinPartitions(*key)
    found = save(found.mapInArrow(_linked(cosine, config), "node bigint, links bigint, near bigint"), "links")
    roots = components(found.select(F.col("node").alias("a"), F.col("near").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    return save(counts.join(roots, "node"), "linked-vectors")


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """One row per row: its id, `n_links`, `component_id` and `kept`. Options as of `link_vectors`."""
    digest = [F.xxhash64(vector).alias("_d0"), F.xxhash64(F.lit(1), F.col(vector)).alias("_d1")]
    rows = df.select(F.col(vec_id).alias("vec_id"), F.when(_usable(vector), F.col(vector)).alias("vector"), *digest)
    usable = rows.filter("vector is not null")
    equal = usable.groupBy("_d0", "_d1").agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"), F.first("vector").alias("vector"))
    distinct = save(equal.withColumn("node", F.monotonically_increasing_id()), "vectors")
    linked = link_vectors(distinct.select("node", "weight", "vector"), **options).withColumnRenamed("node", "_node")
    slim = distinct.drop("vector").join(linked, F.col("node") == F.col("_node"), "left")
    slim = save(slim.select("_d0", "_d1", "low", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("root").alias("root")), "classes")
    lowest = slim.filter("root is not null").groupBy(F.col("root").alias("_root")).agg(F.min("low").alias("_low"))
    slim = save(slim.join(lowest, F.col("root") == F.col("_root"), "left").select("_d0", "_d1", "n_links", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("_low")).alias("component_id")), "classes")
    found = usable.select("vec_id", "_d0", "_d1").join(slim, ["_d0", "_d1"]).select("vec_id", "n_links", "component_id")
    none = rows.filter("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return found.union(none).select("vec_id", "n_links", "component_id", kept)
