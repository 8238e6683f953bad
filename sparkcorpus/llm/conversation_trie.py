"""Prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by the rest of its own: a list of references to
stored turns, whose texts are never put together. A sequence of turns has a fingerprint (length, value) in a monoid: two
sequences in a row combine to (m + n, x + r**m * y) modulo a prime, in four primes at a time. Prefix products of each
stored conversation are scanned once, in sorted ranges whose products combine across ranges; then the product of the
base's head and of the own suffix, as a quotient of two prefix products, combine symbolically to those of all prefixes
of the rebuilt conversation. Prefixes with one fingerprint are a node.

Equality is verified: turns with one fingerprint are compared by role and text, and the members of each node by parent
and last turn, so that by induction over the depth all their turns are equal. If that ever fails, the trie is built
again with other numbers. Nodes keep a reference (conversation, place) to the stored turn that ends them.

Subtrees need no walk. Each node is owned by its smallest member, and the nodes that a conversation owns are the end of
its path. A subtree holds, of each member but its owner, all that this member owns, and of its owner all from the
node's depth on: so subtree sums are one sum over members, less the owner's sum above the node.

Sums combine before every shuffle, long conversations are scanned in ranges, and joins are plain, so that AQE splits
crowded nodes such as the root. The digest of a node's ends needs their ids in order: they are joined to strings in
sorted ranges, and one stream per node hashes those strings without holding them; a node where a third of all
conversations end is still one stream, for a SHA-256 cannot be cut.

Rows without an id belong to no conversation. Null roles and texts are empty. Turns of equal number follow each other
by role, then by the text's md5; repeated rows are turns of their own. Other columns are not read. An empty table has
no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import save, sums_before, word_count

GROUP, HEADS = 20, 4
#: Primes below 2**31: products of two residues fit into a long.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_LANES = range(len(PRIMES))
_OWN, _X, _Y = ["conv_id", "range", "t0", "t1", "words"], [f"x{i}" for i in _LANES], [f"y{i}" for i in _LANES]
_CHUNK = 1 << 12


def bases(seed: int) -> list[int]:
    return np.random.default_rng([seed, 29]).integers(1 << 20, 1 << 30, len(PRIMES)).tolist()


def _lanes(role: Column, text: Column, seed: int) -> Column:
    """A turn's value in each prime."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(seed * len(PRIMES) + i), role, text), F.lit(p)) for i, p in enumerate(PRIMES)])


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    found = np.ones(1, np.int64)
    while len(found) < n:
        found = np.concatenate([found, found * pow(base, len(found), prime) % prime])
    return found[:n]


def _scan(seed: int):
    """Rows sorted by conversation and turn to the prefix products of each conversation's part in this range. `last`
    marks the last row of such a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, powers = bases(seed), [np.ones(1, np.int64)] * len(PRIMES)
        conv, length, sums, held = None, 0, [0] * len(PRIMES), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = batch.column("conv_id").to_numpy()
            if held is not None:
                yield _marked(held, ids[0] != conv)
            new = np.concatenate([[ids[0] != conv], ids[1:] != ids[:-1]])
            starts = np.flatnonzero(new)
            first = np.zeros(n, np.int64)
            first[starts] = starts
            first = np.maximum.accumulate(first)
            places = np.arange(n) - first
            carried = np.maximum.accumulate(new) == 0
            places[carried] += length
            values = batch.column("lanes").flatten().to_numpy().reshape(n, len(PRIMES))
            prefix, earlier = [], []
            for i, p in enumerate(PRIMES):
                if len(powers[i]) <= places.max():
                    powers[i] = _powers(numbers[i], p, 2 * int(places.max()) + 1)
                terms = values[:, i] * powers[i][places] % p
                total = np.cumsum(terms)
                before = np.where(first > 0, total[first - 1], 0)
                prefix.append((total - before + np.where(carried, sums[i], 0)) % p)
                earlier.append((prefix[-1] - terms) % p)
            conv, length, sums = ids[-1], int(places[-1]) + 1, [int(x[-1]) for x in prefix]
            marks = np.concatenate([new[1:], [False]])
            own = [batch.column(c) for c in _OWN]
            columns = [*own, *map(pa.array, (places + 1, *prefix, *earlier, marks))]
            held = pa.RecordBatch.from_arrays(columns, names=[*_OWN, "n", *_X, *_Y, "last"])
        if held is not None:
            yield _marked(held, True)

    return run


def _marked(batch: pa.RecordBatch, last: bool) -> pa.RecordBatch:
    marks = batch.column("last").to_numpy(zero_copy_only=False).copy()
    marks[-1] = last
    return batch.set_column(batch.schema.get_field_index("last"), "last", pa.array(marks))


def _power(base: int, prime: int, column: str) -> Column:
    return F.arrow_udf(lambda n: pa.array([pow(base, k, prime) for k in n.to_pylist()], pa.int64()), "bigint")(column)


def prefix_products(turns: DataFrame, seed: int = 0) -> DataFrame:
    """Turns (conv_id, turn, role, text) to rows (conv_id, n, x0..x3, y0..y3, t0, t1, words): the products of
    each conversation's first n turns and of those before the n-th, and that turn's own fingerprint and number of words."""
    slim = turns.select("conv_id", "turn", "role", F.unhex(F.md5("text")).alias("md5"), _lanes(F.col("role"), F.col("text"), seed).alias("lanes"), word_count("text").alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("md5")]
    packed = [(F.element_at("lanes", 2 * i + 1) * (1 << 31) + F.element_at("lanes", 2 * i + 2)).alias(f"t{i}") for i in range(2)]
    rows = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", F.spark_partition_id().alias("range"), *packed, "words", "lanes")
    schema = "conv_id bigint, range int, t0 bigint, t1 bigint, words bigint, n bigint, " + ", ".join(f"{c} bigint" for c in _X + _Y) + ", last boolean"
    parts = save(rows.mapInArrow(_scan(seed), schema), "prefixes")
    # What a conversation has in earlier ranges. Only conversations of several ranges get here, and of a range only the
    # one that goes on with the range before gets a shift: fewer rows than ranges, so they can be broadcast.
    ends = parts.filter("last").select("conv_id", "range", "n", *_X)
    several = ends.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1").select("conv_id")
    totals = sums_before(save(ends.join(several, "conv_id"), "long"), "conv_id", [F.col("range")], "n", "before")
    totals = totals.select("*", *[_power(b, p, "before").alias(f"p{i}") for i, (b, p) in enumerate(zip(bases(seed), PRIMES))])
    for i, p in enumerate(PRIMES):
        totals = totals.withColumn(f"s{i}", F.col(f"x{i}") * F.col(f"p{i}") % p)
    totals = save(totals, "shifted")
    for i in _LANES:
        totals = sums_before(totals, "conv_id", [F.col("range")], f"s{i}", f"b{i}")
    shifts = totals.filter("before > 0").select(F.col("conv_id").alias("_conv"), F.col("range").alias("_range"), "before", *[f"{c}{i}" for c in "pb" for i in _LANES])
    joined = parts.join(F.broadcast(shifts), (F.col("range") == F.col("_range")) & (F.col("conv_id") == F.col("_conv")), "left")
    n = (F.col("n") + F.coalesce("before", F.lit(0))).alias("n")
    whole = [F.when(F.col("before").isNull(), F.col(f"{c}{i}")).otherwise((F.col(f"{c}{i}") * F.col(f"p{i}") + F.col(f"b{i}")) % p).alias(f"{c}{i}") for c in "xy" for i, p in enumerate(PRIMES)]
    return save(joined.select("conv_id", n, *whole, "t0", "t1", "words"), "products")


def _packed(values: list[Column], name: str) -> list[Column]:
    return [(values[2 * i] * (1 << 31) + values[2 * i + 1]).alias(f"{name}{i}") for i in range(2)]


def instances(products: DataFrame, seed: int = 0, group: int = GROUP) -> DataFrame:
    """A row per rebuilt conversation and depth: `conv_id`, `depth`, fingerprints `f0`, `f1` of the prefix and `p0`, `p1`
    of that before, those of the last turn `t0`, `t1`, its `words` and where it is stored, `ref_conv` and `ref_n`;
    `ends` marks a conversation's last row. The root has no turn, and no prefix before."""
    turn = F.struct(*_X, "t0", "t1", "words")
    heads = [F.max(F.when(F.col("n") == k, turn)).alias(f"h{k}") for k in range(1, HEADS)]
    convs = save(products.groupBy("conv_id").agg(F.max("n").alias("size"), *heads), "conversations")
    base = convs.select(F.col("conv_id").alias("_base"), F.col("size").alias("_size"), *[F.col(f"h{k}").alias(f"b{k}") for k in range(1, HEADS)])
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % HEADS).alias("h")
    joined = convs.select("*", h).join(base, F.col("_base") == F.col("conv_id") - F.col("conv_id") % group, "left")
    joined = joined.withColumn("head", F.least("h", F.coalesce("_size", F.lit(0))))
    convs = save(joined.withColumn("total", F.col("head") + F.greatest(F.col("size") - F.col("h"), F.lit(0))), "rebuilt")

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    product = lambda of, k: [F.col(f"{of}{k}.x{i}") if k else zero for i in _LANES]

    def product_at(of: str, by: str) -> list[Column]:
        """The product of as many turns as the column `by` says, fewer than HEADS."""
        found = [zero] * len(PRIMES)
        for k in range(1, HEADS):
            found = [F.when(F.col(by) == k, x).otherwise(y) for x, y in zip(product(of, k), found)]
        return found

    blank = [zero.alias(c) for c in ("depth", "f0", "f1")] + [none.alias(c) for c in ("p0", "p1")] + [zero.alias(c) for c in ("t0", "t1", "words")]
    rows = [F.struct(*blank, *[none.alias(c) for c in ("ref_conv", "ref_n")])]
    for k in range(1, HEADS):
        fields = [F.lit(k).cast("long").alias("depth"), *_packed(product("b", k), "f"), *_packed(product("b", k - 1), "p")]
        fields += [F.col(f"b{k}.{c}").alias(c) for c in ("t0", "t1", "words")]
        rows.append(F.struct(*fields, F.col("_base").alias("ref_conv"), F.lit(k).cast("long").alias("ref_n")))
    of_head = convs.select("conv_id", "total", "head", F.explode(F.array(*rows)).alias("r")).filter("r.depth <= head")
    of_head = of_head.select("conv_id", "r.*", (F.col("r.depth") == F.col("total")).alias("ends"))

    cuts = convs.filter("size > h").select(
        F.col("conv_id").alias("_conv"), "h", "head", "total",
        *[x.alias(f"head{i}") for i, x in enumerate(product_at("b", "head"))], *[x.alias(f"cut{i}") for i, x in enumerate(product_at("h", "h"))],
    )
    own = products.join(cuts, F.col("conv_id") == F.col("_conv")).filter("n > h")

    def rebuilt(name: str) -> list[Column]:
        """The own prefix less its first h turns, moved behind the head by head - h places, which are few."""
        found = []
        for i, (p, r) in enumerate(zip(PRIMES, bases(seed))):
            rest = F.pmod(F.col(f"{name}{i}") - F.col(f"cut{i}"), F.lit(p))
            moved = rest
            for back in range(1, HEADS):
                moved = F.when(F.col("h") - F.col("head") == back, rest * pow(r, -back, p) % p).otherwise(moved)
            found.append((F.col(f"head{i}") + moved) % p)
        return found

    depth = F.col("n") - F.col("h") + F.col("head")
    own = own.select(
        "conv_id", depth.alias("depth"), *_packed(rebuilt("x"), "f"), *_packed(rebuilt("y"), "p"), "t0", "t1", "words",
        F.col("conv_id").alias("ref_conv"), F.col("n").alias("ref_n"), (depth == F.col("total")).alias("ends"),
    )
    return save(of_head.union(own), "prefixes")


def _unequal(turns: DataFrame, seed: int) -> DataFrame:
    """Fingerprints that turns of different role or text share."""
    content = F.struct("role", "text")
    lanes = _lanes(F.col("role"), F.col("text"), seed).alias("lanes")
    both = turns.select(lanes, content.alias("c")).groupBy("lanes").agg(F.min("c").alias("a"), F.max("c").alias("b"))
    return both.filter("a <> b")


def _ends_digests(rows: DataFrame) -> DataFrame:
    """(f0, f1, depth, conv_id) to the digest of each node's ids in order."""
    key = ["depth", "f0", "f1"]

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                keys = np.stack([part.column(c).to_numpy() for c in key])
                cuts = np.concatenate([[0], np.flatnonzero((np.diff(keys, axis=1) != 0).any(0)) + 1, [part.num_rows]]).tolist()
                ids = part.column("conv_id").to_pylist()
                lists = [",".join(map(str, ids[a:b])) for a, b in zip(cuts, cuts[1:])]
                columns = [pa.array(k[cuts[:-1]]) for k in keys] + [pa.array([ids[a] for a in cuts[:-1]], pa.int64()), pa.array(lists, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*key, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            rows = zip(zip(*[batch.column(c).to_pylist() for c in key]), batch.column("ids").to_pylist())
            for found, ids in rows:
                if found != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = found, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*key, "ends_sha256"])
                done = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*node, digest.hexdigest())], names=[*key, "ends_sha256"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    parts = ranged.mapInArrow(joined, "depth bigint, f0 bigint, f1 bigint, first bigint, ids string")
    return parts.repartition(tasks, *key).sortWithinPartitions(*key, "first").mapInArrow(hashed, "depth bigint, f0 bigint, f1 bigint, ends_sha256 string")


def build(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = GROUP, seeds: int = 3) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations: `conv_id`, `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves`, `saved_tokens`, `ends_sha256`, and `ref_conv` and `ref_n`, where the turn that ends it is stored."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = turns.filter(F.col(conv_id).isNotNull())
    turns = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    key = ["depth", "f0", "f1"]
    for seed in range(seeds):
        if not _unequal(turns, seed).isEmpty():
            continue
        rows = instances(prefix_products(turns, seed), seed, group)
        last = F.struct("p0", "p1", "t0", "t1")
        nodes = rows.groupBy(key).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min(last).alias("last"), F.max(last).alias("other"),
            F.min(F.struct("ref_conv", "ref_n")).alias("ref"), F.max("words").alias("words"),
        )
        nodes = save(nodes, "nodes")
        if nodes.filter("not (last <=> other)").isEmpty():
            break
    else:
        raise RuntimeError(f"fingerprints of unequal prefixes met under {seeds} seeds")

    above = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("last.p0").alias("f0"), F.col("last.p1").alias("f1"))
    nodes = nodes.join(above.agg(F.count("*").alias("n_children")), key, "left").fillna(0, ["n_children"])
    nodes = save(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    owned = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves"))
    owned = save(owned.filter("saved > 0 or leaves > 0").withColumnRenamed("conv_id", "_owner"), "owned")
    sums = rows.join(owned, F.col("conv_id") == F.col("_owner")).groupBy(key).agg(F.sum("saved").alias("_saved"), F.sum("leaves").alias("n_leaves"))
    earlier = sums_before(nodes.filter("n_convs > 1").select("conv_id", "depth", "f0", "f1", "saved"), "conv_id", [F.col("depth")], "saved", "_above")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id"))
    ends = save(_ends_digests(rows.filter("ends").select(*key, "conv_id")), "ends")

    found = nodes.select("*", F.col("last.p0").alias("p0"), F.col("last.p1").alias("p1")).join(parents, ["depth", "p0", "p1"], "left")
    found = found.join(sums, key, "left").join(earlier.select(*key, "_above"), key, "left").join(ends, key, "left")
    below = F.when(F.col("n_convs") > 1, F.coalesce("_saved", F.lit(0)) - F.col("_above")).otherwise(F.lit(0))  # nothing below a single member is shared
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", below.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "ref.ref_conv", "ref.ref_n",
    )
