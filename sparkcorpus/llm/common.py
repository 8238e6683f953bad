"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkcorpus.session import bound_batches, fresh_path  # noqa: F401

#: A run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
_TEXTS = 512

#: Positions in one bitmap, and the bitmaps that may be broadcast: 64 MB of them.
_BITS, _BITMAPS = 32_768, 16_384


def save(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage at a place that survives lost executors, and lets
    Catalyst plan later joins by the table's real size."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    saved = df.sparkSession.read.schema(df.schema).parquet(path)
    saved.written_to = path
    return saved


def drop(*tables: DataFrame) -> None:
    """Delete tables that `save` wrote, once nothing will read them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def located(docs: DataFrame, columns: list[Column], in_place: bool) -> DataFrame:
    """Columns of the documents with `_file` and `_place`, which name a row's file and its place there. Only a table
    that was just read has them (`in_place`); anything else is written first."""
    if in_place:
        try:
            return _with_places(docs, columns)
        except AnalysisException:  # made of something else than files
            pass
    return _with_places(save(docs, "rows"), columns)


def _with_places(df: DataFrame, columns: list[Column]) -> DataFrame:
    place = df.metadataColumn("_metadata")
    return df.select(*columns, F.xxhash64(place["file_path"]).alias("_file"), place["row_index"].alias("_place"))


def at_places(rows: DataFrame, places: DataFrame, wanted: bool = True) -> DataFrame:
    """The located rows whose (`_file`, `_place`) is (or is not) among `places`, which leaves the rows where they are."""
    return flag_places(rows, places, "_hit").filter("_hit" if wanted else "not _hit").drop("_hit")


def flag_places(rows: DataFrame, places: DataFrame, name: str) -> DataFrame:
    """Located rows with a flag: is their (`_file`, `_place`) among `places`? Those are packed into bitmaps, a bit a row,
    so the rows themselves stay where they are: bitmaps of up to 64 MB (for some 500 million rows) are broadcast.
    Beyond that the join is left to Catalyst."""
    bucket, bit = F.floor(F.col("_place") / _BITS), F.col("_place") % _BITS
    maps = places.groupBy(F.col("_file").alias("_f"), bucket.alias("_b")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    maps = save(maps, "bitmaps")
    if maps.count() <= _BITMAPS:
        maps = F.broadcast(maps)
    joined = rows.join(maps, (F.col("_file") == F.col("_f")) & (bucket == F.col("_b")), "left")
    byte = F.conv(F.hex(F.substr("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(byte, F.lit(0))
    mask = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))
    return joined.withColumn(name, found.bitwiseAND(mask) != 0).drop("_f", "_b", "_bits")


def whole_row(df: DataFrame, keep: list[str] | None = None) -> Column:
    """The row, or the columns to keep of it, as one struct: no added column can clash with its names."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias("row")


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each string, empty for null; only some hundred texts are Python objects at a time."""
    for at in range(0, len(column), _TEXTS):
        for text in column.slice(at, _TEXTS).cast(pa.binary()).to_pylist():
            yield text or b""


def map_batches(
    df: DataFrame, schema: str, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], rows: int | None = None
) -> DataFrame:
    """mapInArrow for a function of one batch (of at most `rows` rows) that yields any number of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                yield from function(batch.slice(at, rows))

    return df.mapInArrow(run, schema)


def word_count(text: str | Column) -> Column:
    """Number of words split by ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_ranges(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows dealt into sorted ranges of the order, saved with the range's number in `_range`. A range holds a
    bounded number of rows even if one group holds most of the table."""
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return save(ranged, label)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Dense position from 0 in a global order, without a window over the whole table: only the row count of each
    range meets in one place."""
    ranged = in_ranges(df, order, "numbered")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order)
    placed = ranged.withColumn("_row", F.row_number().over(inside)).join(F.broadcast(sizes), "_range")
    return placed.withColumn(name, F.col("_before") + F.col("_row") - 1).drop("_range", "_before", "_row")


def sums_before(df: DataFrame, by: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Add the sum of `value` over the earlier rows of the same `by` group (null is a group)."""
    ranged = in_ranges(df, [F.col(by).asc_nulls_last(), *order], "sums")
    totals = ranged.groupBy(by, "_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = save(totals.select(F.col(by).alias("_by"), F.col("_range").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base")), "range-sums")
    inside = Window.partitionBy("_range", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = running.join(totals, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_range") == F.col("_of")))
    return joined.withColumn(name, F.col("_base") + F.col("_in")).drop("_by", "_of", "_base", "_in", "_range")
