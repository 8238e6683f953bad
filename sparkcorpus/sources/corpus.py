"""Corpus shards: scan, split, stride, resume, size-bounded sharding, parquet sink, manifests."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators.ordering import prefix_sums, with_position
from sparkcorpus.session import cut_lineage, fresh_path

#: Blocks of a sharded corpus that the driver holds, at 24 bytes each.
MOST_BLOCKS = 1_048_576


def _plain(path: str) -> str:
    return path.replace(":///", ":/")


def scan_corpus(spark: SparkSession, path: str, glob: str = "*.parquet", columns: Sequence[str] = ("text",)) -> DataFrame:
    """Shards in lexicographic path order. `pos` is the row's index inside its file, taken from the parquet reader,
    so the order needs no sort. Files that do not match the pattern, such as unfinished ones, are ignored."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").parquet(path)
    names = sorted(_plain(f) for f in files.inputFiles())
    path_of_numbers = fresh_path(spark, "shard-numbers")  # as a table, so that the plan follows its size
    spark.createDataFrame(list(zip(names, range(len(names)))), "_path string, shard int").write.parquet(path_of_numbers)
    shards = spark.read.schema("_path string, shard int").parquet(path_of_numbers)
    rows = files.select(
        F.replace(F.col("_metadata.file_path"), F.lit(":///"), F.lit(":/")).alias("_path"),
        F.col("_metadata.row_index").alias("pos"),
        *columns,
    )
    return rows.join(shards, "_path").select("shard", "pos", *columns)


def split_by_last_shard(df: DataFrame, shard: str = "shard") -> DataFrame:
    """The last shard validates, the others train."""
    last = df.agg(F.max(shard)).scalar()
    return df.withColumn("split", F.when(F.col(shard) == last, "val").otherwise("train"))


def batch_documents(df: DataFrame, group: Sequence[str], pos: str, group_rows: int, batch: int, value: str) -> DataFrame:
    """Row groups cut into batches of at most `batch` documents, in order."""
    numbered = df.withColumn("batch_no", F.floor(F.pmod(F.col(pos), F.lit(group_rows)) / batch).cast("long"))
    return numbered.groupBy(*group, "batch_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(pos, value))), lambda s: s[value]).alias("batch")
    )


def replay_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """The corpus once per epoch; epochs count from 1."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def resume_from(
    df: DataFrame, worker: int, workers: int, epoch: int, shard: int, group: int | None,
    epoch_col: str = "epoch", shard_col: str = "shard", group_col: str = "group_no",
) -> DataFrame:
    """What one worker still has to read after the saved position. It goes on behind the saved stride in the saved
    shard and reads later shards and epochs from its first group. group None means a start from scratch."""
    e, s, g = F.col(epoch_col), F.col(shard_col), F.col(group_col)
    first = worker if group is None else (group // workers + 1) * workers
    here = (e == epoch) & (s == shard) & (g >= first)
    later = (e > epoch) | ((e == epoch) & (s > shard))
    return df.filter((g % workers == worker) & (here | later))


def missing_shards(present: DataFrame, first_n: int, validation: int, shard: str = "shard") -> DataFrame:
    """Wanted shards (first n and the pinned validation shard) that are not there yet."""
    spark = present.sparkSession
    wanted = spark.range(first_n).union(spark.range(validation, validation + 1)).distinct().withColumnRenamed("id", shard)
    return wanted.join(present.select(F.col(shard).cast("long")).distinct(), shard, "left_anti")


def project_text(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(column).alias("text"))


def assign_shards(
    df: DataFrame, pos: str, size: Column, threshold: int, block_rows: int = 1024, keep_tail: bool = False, most_blocks: int = MOST_BLOCKS
) -> DataFrame:
    """Number the shards of a size-bounded writer: a shard ends at the first multiple of block_rows documents that
    brings it to `threshold`. Only block totals are used. The rows after the last end form an unfinished shard and
    are left out unless keep_tail.

    Up to `most_blocks` blocks (a billion documents) the chain of ends is followed on the driver, by bisection in two
    arrays, and shard numbers reach the rows by broadcast: the only shuffle of the text is the
    writer's. Larger tables give the same numbers by doubling jumps and a join."""
    block = F.floor(F.col(pos) / block_rows).cast("long")
    blocks = df.groupBy(block.alias("block")).agg(F.sum(size).cast("long").alias("chars"), F.count("*").alias("docs"))
    blocks = cut_lineage(blocks)
    few = blocks.count() <= most_blocks
    shard_of = _chained_shards(blocks, threshold, block_rows, keep_tail) if few else _jumped_shards(blocks, threshold, block_rows, keep_tail)
    return df.withColumn("block", block).join(F.broadcast(shard_of) if few else shard_of, "block").drop("block")


def _chained_shards(blocks: DataFrame, threshold: int, block_rows: int, keep_tail: bool) -> DataFrame:
    rows = blocks.orderBy("block").toPandas()
    through = rows["chars"].to_numpy(np.int64).cumsum()
    ends = np.flatnonzero((rows["docs"].to_numpy() == block_rows) & (rows["chars"].to_numpy() > 0))
    shard, start, shards = 0, 0, np.full(len(rows), -1, np.int32)
    while start < len(rows):
        before = int(through[start - 1]) if start else 0
        at = ends.searchsorted(start) + through[ends[ends.searchsorted(start) :]].searchsorted(before + threshold)
        end = int(ends[at]) + 1 if at < len(ends) else len(rows)
        if at < len(ends) or keep_tail:
            shards[start:end] = shard
        start, shard = end, shard + 1
    found = pd.DataFrame({"block": rows["block"], "shard": shards})[shards >= 0]
    return blocks.sparkSession.createDataFrame(found, "block long, shard int")


def _jumped_shards(blocks: DataFrame, threshold: int, block_rows: int, keep_tail: bool) -> DataFrame:
    """From every block the end of a shard that would start there follows from prefix sums; the starts really taken are
    the chain from block 0, found by doubling jumps, so no task walks the block table."""
    spark = blocks.sparkSession
    blocks = prefix_sums(blocks, ["block"], width_bucket(F.col("block"), 4096), {"before": F.col("chars")})
    blocks = cut_lineage(blocks)

    through = F.col("before") + F.col("chars")
    cells = F.sequence(F.floor(F.col("before") / threshold), F.floor(through / threshold))
    ends = blocks.filter((F.col("docs") == block_rows) & (F.col("chars") > 0)).select(
        F.explode(cells).alias("cell"), through.alias("at"), F.lit(1).alias("is_end"), "block"
    )
    target = F.col("before") + threshold
    starts = blocks.select(F.floor(target / threshold).alias("cell"), target.alias("at"), F.lit(0).alias("is_end"), "block")
    nearest = Window.partitionBy("cell").orderBy(F.desc("at"), F.desc("is_end")).rowsBetween(Window.unboundedPreceding, 0)
    end_block = F.last(F.when(F.col("is_end") == 1, F.col("block")), ignorenulls=True).over(nearest)
    jumps = (
        ends.unionByName(starts).withColumn("end_block", end_block)
        .filter("is_end = 0 and end_block is not null")
        .select(F.col("block").alias("start"), (F.col("end_block") + 1).alias("next"))
    )
    jumps = cut_lineage(jumps)
    reached, known = spark.createDataFrame([(0,)], "start long"), 0
    while known < (size_now := reached.count()):
        known = size_now
        reached = cut_lineage(reached.union(reached.join(jumps, "start").select("next")).distinct())
        onward = jumps.select(F.col("start").alias("next"), F.col("next").alias("after"))
        jumps = cut_lineage(jumps.join(onward, "next").select("start", F.col("after").alias("next")))

    marked = blocks.select("block").join(
        reached.select(F.col("start").alias("block"), F.lit(1).cast("long").alias("is_start")), "block", "left"
    ).select("block", F.coalesce("is_start", F.lit(0).cast("long")).alias("is_start"))
    numbered = prefix_sums(marked, ["block"], width_bucket(F.col("block"), 4096), {"earlier": F.col("is_start")})
    shard_of = numbered.select("block", (F.col("earlier") + F.col("is_start") - 1).cast("int").alias("shard"))
    if not keep_tail:
        shard_of = shard_of.filter(F.col("block") < F.lit(reached.agg(F.max("start")).first()[0]))
    return shard_of


def shard_report(df: DataFrame, shard: str = "shard", text: str = "text") -> DataFrame:
    return df.groupBy(shard).agg(F.count("*").alias("documents"), F.sum(F.length(text)).cast("long").alias("characters"))


def write_shards(df: DataFrame, path: str, shard: str, order: str, columns: Sequence[str] = ("text",), group_rows: int = 1024) -> None:
    """One file per shard, below zero-padded folders so that path order is shard order. Row groups of group_rows,
    zstd level 3, no dictionary and no column statistics, which do not help for text."""
    (
        df.withColumn("shard_dir", F.lpad(F.col(shard).cast("string"), 5, "0"))
        .repartition("shard_dir")
        .sortWithinPartitions("shard_dir", order)
        .select("shard_dir", *columns)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", "3")
        .option("parquet.block.row.count.limit", str(group_rows))
        .option("parquet.enable.dictionary", "false")
        .option("parquet.column.statistics.enabled", "false")
        .partitionBy("shard_dir")
        .parquet(path)
    )


def _listing(spark: SparkSession, *folders: str) -> DataFrame:
    """One row per file below the folders; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(list(folders))
    return files.select(F.col("_metadata.file_path").alias("path"))


def write_list_manifest(spark: SparkSession, path: str, manifest: str) -> None:
    """List the finished files of a dataset, one row a file. Written last: its presence says the dataset is complete."""
    _listing(spark, path).select(F.lit(path).alias("root"), "path").write.mode("errorifexists").json(manifest)


def read_manifested(spark: SparkSession, manifest: str, schema=None) -> DataFrame:
    """The rows of the files listed in the manifest. Without a manifest the dataset is incomplete, and so it is if a
    listed file is gone: errors. Only the few folders come to the driver; files are matched with the manifest where they
    are read, so rows of unlisted files are read and dropped."""
    listed = spark.read.schema("root string, path string").json(manifest)
    roots = [r["root"] for r in listed.select("root").distinct().collect()]
    gone = listed.select("path").join(_listing(spark, *roots), "path", "left_anti").first()
    if gone is not None:
        raise FileNotFoundError(f"listed in {manifest}, but gone: {gone['path']}")
    reader = spark.read.option("recursiveFileLookup", "true")
    rows = (reader if schema is None else reader.schema(schema)).parquet(*roots)
    wanted = listed.select(F.col("path").alias("_listed"))
    return rows.join(wanted, rows.metadataColumn("_metadata")["file_path"] == F.col("_listed"), "left_semi")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str = "text string") -> DataFrame:
    return spark.read.schema(schema).json(path)
