"""Global order on a partitioned engine: prefix sums, positions, slices, strides, budgets.

A window without partition keys pulls everything into one task. Here every row gets a deterministic,
order-preserving bucket of bounded size; bucket totals are summed in two levels; the running window then works
inside a bucket only. Hot groups are split by the same buckets, so no group has to fit one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkcorpus.session import fresh_path

_BUCKET, _SPAN = "_bucket", "_span"
_BUCKETS_PER_SPAN = 4096


def join_values(df: DataFrame, values: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which null is a key like any other; the keys of `df` stay."""
    named = values.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in values.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys], F.lit(True))
    return df.join(named, same, how).drop(*[f"_key_{k}" for k in keys])


def bucket_offsets(df: DataFrame, bucket: Column, measures: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, bucket): the sum of each measure inside (`<name>_in`) and before (`<name>_off`) the bucket."""
    totals = (
        df.select(*by, bucket.alias(_BUCKET), *[m.alias(n) for n, m in measures.items()])
        .groupBy(*by, _BUCKET)
        .agg(*[F.sum(n).alias(f"{n}_in") for n in measures])
        .withColumn(_SPAN, F.floor(F.col(_BUCKET) / _BUCKETS_PER_SPAN))
    )
    spans = totals.groupBy(*by, _SPAN).agg(*[F.sum(f"{n}_in").alias(f"{n}_span") for n in measures])
    over_spans = Window.partitionBy(*by).orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *by, _SPAN, *[F.coalesce(F.sum(f"{n}_span").over(over_spans), F.lit(0)).alias(f"{n}_base") for n in measures]
    )
    inside = Window.partitionBy(*by, _SPAN).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return join_values(totals, spans, [*by, _SPAN]).select(
        *by,
        _BUCKET,
        *[F.col(f"{n}_in") for n in measures],
        *[(F.col(f"{n}_base") + F.coalesce(F.sum(f"{n}_in").over(inside), F.lit(0))).alias(f"{n}_off") for n in measures],
    )


def prefix_sums(
    df: DataFrame, order: Sequence[str], bucket: Column, measures: Mapping[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Add for every measure the sum over all rows *before* the row, in (by, order). `bucket` must follow the
    order and be bounded in size (see `functions.keys`); a null group is a group of its own."""
    offsets = bucket_offsets(df, bucket, measures, by)
    inside = Window.partitionBy(*by, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = join_values(df.withColumn(_BUCKET, bucket), offsets, [*by, _BUCKET])
    return joined.select(
        *df.columns,
        *[(F.col(f"{n}_off") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(n) for n, m in measures.items()],
    )


def with_position(
    df: DataFrame, order: Sequence[str], bucket: Column, name: str = "pos", by: Sequence[str] = ()
) -> DataFrame:
    """Dense 0-based position in the global (or per-group) order."""
    return prefix_sums(df, order, bucket, {name: F.lit(1).cast("long")}, by)


def running_min(df: DataFrame, order: Sequence[str], bucket: Column, value: str, name: str, by: Sequence[str]) -> DataFrame:
    """Smallest value so far, current row included, per group; the minimum of earlier buckets is carried in."""
    lows = df.groupBy(*by, bucket.alias(_BUCKET)).agg(F.min(value).alias("_low"))
    lows = lows.withColumn(_SPAN, F.floor(F.col(_BUCKET) / _BUCKETS_PER_SPAN))
    over_spans = Window.partitionBy(*by).orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    spans = lows.groupBy(*by, _SPAN).agg(F.min("_low").alias("_span_low"))
    spans = spans.select(*by, _SPAN, F.min("_span_low").over(over_spans).alias("_base_low"))
    inside_span = Window.partitionBy(*by, _SPAN).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    carried = join_values(lows, spans, [*by, _SPAN]).select(
        *by, _BUCKET, F.least(F.col("_base_low"), F.min("_low").over(inside_span)).alias("_carried")
    )
    inside = Window.partitionBy(*by, _BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_values(df.withColumn(_BUCKET, bucket), carried, [*by, _BUCKET])
    return joined.select(*df.columns, F.least(F.col("_carried"), F.min(value).over(inside)).alias(name))


def budget_crossing(df: DataFrame, order: Sequence[str], bucket: Column, size: Column, limit: int):
    """The row in which the running total of `size` reaches `limit`, as one driver-side Row with the order columns,
    `before` (total of all earlier rows) and `size`; None when the whole table stays below.

    Only bucket totals and one bucket are touched, and never the text, so callers can filter the corpus by the
    returned key without moving it."""
    slim = df.select(*order, bucket.alias(_BUCKET), size.cast("long").alias("size"))
    offsets = bucket_offsets(slim, F.col(_BUCKET), {"size": F.col("size")})
    hit = (
        offsets.filter((F.col("size_off") < limit) & (F.col("size_off") + F.col("size_in") >= limit))
        .select(_BUCKET, "size_off")
        .first()
    )
    if hit is None:
        return None
    running = Window.partitionBy(_BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        slim.filter(F.col(_BUCKET) == hit[_BUCKET])
        .withColumn("before", F.lit(hit["size_off"]) + F.coalesce(F.sum("size").over(running), F.lit(0)))
        .filter((F.col("before") < limit) & (F.col("before") + F.col("size") >= limit))
        .select(*order, "before", "size")
        .first()
    )


def at_or_before(order: Sequence[str], row) -> Column:
    """Rows up to and including `row` in lexicographic order of the order columns."""
    condition = F.lit(True)
    for name in reversed(order):
        condition = (F.col(name) < F.lit(row[name])) | ((F.col(name) == F.lit(row[name])) & condition)
    return condition


def seeded_shuffle(df: DataFrame, seed: int, key: str, per_bucket: int = 65_536, name: str = "shuffled_pos") -> DataFrame:
    """Position of every row in a pseudo-random order that depends on seed and key only. The number of buckets follows
    the number of rows; the order does not depend on it."""
    from sparkcorpus.functions.keys import hex_bucket, key_digits, shuffle_key

    digits = key_digits(df.count(), per_bucket)
    keyed = df.withColumn("_key", shuffle_key(seed, key))
    return with_position(keyed, ["_key", key], hex_bucket(F.col("_key"), digits), name).drop("_key")


def shuffled_layout(df: DataFrame, seed: int, key: str, partitions: int) -> DataFrame:
    """The same order as a physical layout: range partitions on the key, sorted inside. No positions needed."""
    from sparkcorpus.functions.keys import shuffle_key

    keyed = df.withColumn("_key", shuffle_key(seed, key))
    return keyed.repartitionByRange(partitions, "_key", key).sortWithinPartitions("_key", key).drop("_key")


def slice_rows(df: DataFrame, pos: str, start: int = 0, stop: int | None = None, step: int = 1) -> DataFrame:
    """Logical slice [start, stop) step; rows are renumbered from 0."""
    if start < 0 or step < 1 or (stop is not None and stop < start):
        raise ValueError("start must be >= 0, stop >= start and step >= 1")
    p = F.col(pos)
    kept = (p >= start) & ((p - start) % step == 0)
    if stop is not None:
        kept = kept & (p < stop)
    return df.filter(kept).withColumn(pos, F.floor((p - start) / step).cast("long"))


def stride_groups(df: DataFrame, pos: str, group_rows: int, start: int, step: int) -> DataFrame:
    """Row groups start, start+step, ... of a scan; `group_no` is derived from the position."""
    group = F.floor(F.col(pos) / group_rows).cast("long")
    return df.withColumn("group_no", group).filter((F.col("group_no") >= start) & ((F.col("group_no") - start) % step == 0))


def assign_workers(df: DataFrame, pos: str, workers: int) -> DataFrame:
    return df.withColumn("worker", F.pmod(F.col(pos), F.lit(workers)).cast("int"))


def first_n_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, spread: str, salts: int = 32) -> DataFrame:
    """First n rows of each group. A group is first cut inside `salts` slices, so a hot group never meets one task
    whole; the exact cut then sees at most salts*n rows of it."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    local = Window.partitionBy(*by, "_salt").orderBy(*order)
    total = Window.partitionBy(*by).orderBy(*order)
    return (
        salted.withColumn("_rank", F.row_number().over(local)).filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(total)).filter(F.col("_rank") <= n)
        .drop("_salt", "_rank")
    )


def join_group_values(df: DataFrame, values: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach one row of `values` per group to the rows of `df`. The group table is written once, so Catalyst knows its
    size: it is broadcast if that allows, else both sides are shuffled and AQE splits hot groups."""
    path = fresh_path(df.sparkSession, "group-values")
    values.write.parquet(path)
    return join_values(df, df.sparkSession.read.schema(values.schema).parquet(path), by)
