"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis).

Every document draws an exponential key scaled by its quality weight: -ln(u) / quality, with u from a hash of seed and
id. In the order of these keys the first documents of a source are a weighted sample of it, whatever the sample's size.
A source whose target exceeds its size is taken whole as often as it fits (complete epochs); the rest of the target is
filled in key order until the running sum of words reaches it. The document in which the sum crosses the target is
taken if at least half of it fits, so a source misses its target by half a document at most.

Only one slim row per document is shuffled; what the sample decides comes back as one row per source: its epochs and
the last key taken.

Nulls: a null text has size 0, a null source is a source of its own (last in order), a null quality counts as the
smallest weight. Rows that repeat (same source, id and text) share one decision and are summed as one unit. An empty
table gives an empty mix. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import numbered, save, sums_before, whole_row

MIN_QUALITY = 1e-3
_ID, _HASH, _SOURCE = "_id", "_hash", "_source"


def sampling_key(seed: int, doc_id: Column, quality: Column) -> Column:
    """-ln(u) / quality; u in (0, 1) from 52 bits of an md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2**52 + 1))
    return -F.log(u) / F.greatest(F.coalesce(quality, F.lit(MIN_QUALITY)), F.lit(MIN_QUALITY))


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add `weight` and `target` to one row per source (`_source`, `source_size`). Weights repeat over the sources in
    order. `share` times the whole is dealt out by weight; a target stops at `most` times the source's size and the
    excess goes to the others by weight, until none is above."""
    if not 0 < share < most:
        raise ValueError("share must lie between 0 and most")
    ranked = numbered(sizes, [F.col(_SOURCE).asc_nulls_last()], "_rank")
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.pmod(F.col("_rank"), F.lit(len(weights))).cast("int")]
    table = save(ranked.select(_SOURCE, "source_size", weight.alias("weight")), "sources")
    cap = F.lit(float(most)) * F.col("source_size")
    whole = table.agg((F.sum("source_size") * share).cast("double")).first()[0] or 0.0
    level, settled = 0.0, None
    while settled != level:  # each round lifts the level, so sources only ever join the capped ones
        full = cap <= F.lit(level) * F.col("weight")
        capped, free = table.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        settled, level = level, (whole - (capped or 0.0)) / free if free else level
    return table.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame, size: Column, quality: Column, weights: Sequence[float], share: float, most: float = 2.0, seed: int = 0,
    doc_id: str = "doc_id", source: str = "source", text: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Every row (or the columns to keep) as struct `row`, with `size`, `source_size`, `target` and `copies` (how often the mix takes it)."""
    key = sampling_key(seed, F.col(doc_id), quality)
    slim = docs.select(
        F.col(source).alias(_SOURCE), key.alias("_key"), F.col(doc_id).alias(_ID),
        F.xxhash64(F.col(text)).alias(_HASH), size.cast("long").alias("size"),
    )
    units = save(slim.groupBy(_SOURCE, "_key", _ID, _HASH).agg(F.sum("size").alias("size")), "mix-units")
    targets = source_targets(units.groupBy(_SOURCE).agg(F.sum("size").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("long"))
    targets = save(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    wanted = targets.select(F.col(_SOURCE).alias("_wanted"), "rest")

    order = [F.col("_key"), F.col(_ID).asc_nulls_last(), F.col(_HASH)]
    placed = sums_before(units, _SOURCE, order, "size", "before").join(wanted, F.col(_SOURCE).eqNullSafe(F.col("_wanted")))
    taken = placed.filter(F.col("before") + F.col("size") / 2 <= F.col("rest")).filter("size > 0")
    place = F.struct("_key", F.col(_ID).isNull().alias("none"), _ID, _HASH)
    last = taken.groupBy(F.col(_SOURCE).alias("_wanted")).agg(F.max(place).alias("_last"))
    plan = targets.join(last, F.col(_SOURCE).eqNullSafe(F.col("_wanted")), "left")
    plan = save(plan.select(F.col(_SOURCE).alias("_of"), "source_size", "target", "epochs", "_last"), "mix-plan")

    here = F.struct(key.alias("_key"), F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias(_ID), F.xxhash64(F.col(text)).alias(_HASH))
    rows = docs.select(whole_row(docs, keep), size.cast("long").alias("size"), here.alias("_here"), F.col(source).alias(_SOURCE))
    joined = rows.join(plan, F.col(_SOURCE).eqNullSafe(F.col("_of")))
    extra = (F.col("_last").isNotNull() & (F.col("_here") <= F.col("_last"))).cast("long")
    copies = F.when(F.col("size") > 0, F.col("epochs") + extra).otherwise(0)
    return joined.select("row", "size", "source_size", "target", copies.alias("copies"))
