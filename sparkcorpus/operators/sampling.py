"""Budgets, manifests, integrity audits and artifact catalogues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkcorpus.functions.keys import shuffle_key
from sparkcorpus.functions.text import utf8_prefix
from sparkcorpus.operators.ordering import at_or_before, budget_crossing, first_n_per_group
from sparkcorpus.session import fresh_path, path_exists

#: Bytes of the largest file that Spark's binary reader can hold in a record.
MOST_HASHED = 2_000_000_000


def cap_text(df: DataFrame, cap: int, text: str = "text") -> DataFrame:
    return df.withColumn(text, F.substring(text, 1, cap))


def char_budget(df: DataFrame, order: Sequence[str], bucket: Column, max_chars: int, text: str = "text") -> DataFrame:
    """Prefix of the corpus: a document is kept iff at most max_chars characters come before it. The document that
    crosses the budget is kept whole."""
    row = budget_crossing(df, order, bucket, F.length(text), max_chars + 1)
    return df if row is None else df.filter(at_or_before(order, row))


def byte_budget(df: DataFrame, order: Sequence[str], bucket: Column, target: int, text: str = "text") -> DataFrame:
    """Prefix with exactly `target` text bytes, up to 3 fewer where the cut would split a character. Empty documents
    are skipped. The last document is cut on a character boundary and dropped if nothing of it is left."""
    full = df.filter(F.octet_length(text) > 0)
    path = fresh_path(df.sparkSession, "byte-lengths")  # the text is read here once, and once more for the result
    full.select(*order, bucket.alias("_at"), F.octet_length(text).alias("_bytes")).write.parquet(path)
    sizes = df.sparkSession.read.parquet(path)
    row = budget_crossing(sizes, order, F.col("_at"), F.col("_bytes"), target)
    if row is None:
        have = sizes.agg(F.sum("_bytes").alias("n")).first()["n"] or 0
        if have < target - 3:
            raise ValueError(f"not enough text: {have} bytes for a budget of {target}")
        return full
    last = F.lit(True)
    for name in order:
        last = last & (F.col(name) == F.lit(row[name]))
    cut = F.when(last, utf8_prefix(F.col(text), F.lit(target - row["before"]))).otherwise(F.col(text))
    return full.filter(at_or_before(order, row)).withColumn(text, cut).filter(F.octet_length(text) > 0)


def sample_manifest(df: DataFrame, key: str, source: str, target: int, text: str = "text", digits: int = 2) -> DataFrame:
    """One row: documents, characters, bytes, source count, truncation flag and a digest. The digest is a hash of
    hashes: per row, then per bucket of row hashes, then over the bucket digests in bucket order. A bucket holds
    fixed-size sums, so no task collects the corpus."""
    row_hash = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.col(text)), 256)
    lanes = df.select(
        F.col(source).alias("_source"),
        F.length(text).cast("long").alias("c"),
        F.octet_length(text).cast("long").alias("b"),
        F.substring(row_hash, 1, digits).alias("bucket"),
        F.conv(F.substring(row_hash, digits + 1, 12), 16, 10).cast("decimal(38,0)").alias("h"),
    )
    buckets = lanes.groupBy("bucket").agg(
        F.count("*").alias("documents"), F.sum("c").alias("characters"), F.sum("b").alias("bytes"), F.sum("h").alias("h")
    )
    mixed = F.concat_ws(":", F.col("bucket"), F.col("documents").cast("string"), F.col("h").cast("string"))
    total = buckets.agg(
        F.sum("documents").alias("documents"),
        F.sum("characters").alias("characters"),
        F.sum("bytes").alias("bytes"),
        F.md5(F.array_join(F.array_sort(F.collect_list(mixed)), ",")).alias("digest"),
    )
    return total.select(
        "*", lanes.agg(F.countDistinct("_source")).scalar().alias("sources"), (F.col("bytes") < target).alias("truncated_short")
    )


def verify_manifest(actual: DataFrame, manifest: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Rows whose recomputed fields differ from the manifest, or that exist on one side only."""
    a = actual.select(*keys, *[F.col(f).alias(f"actual_{f}") for f in fields], F.lit(True).alias("_a"))
    m = manifest.select(*keys, *[F.col(f).alias(f"manifest_{f}") for f in fields], F.lit(True).alias("_m"))
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"actual_{f}").eqNullSafe(F.col(f"manifest_{f}"))
    status = (
        F.when(F.col("_a").isNull(), "missing").when(F.col("_m").isNull(), "unlisted").when(~same, "changed").otherwise("ok")
    )
    return a.join(m, list(keys), "full_outer").withColumn("status", status).filter("status <> 'ok'").drop("_a", "_m")


def single_source(df: DataFrame, run: str, digest: str) -> DataFrame:
    """One row: are all runs based on the same sample?"""
    return df.agg(
        F.countDistinct(run).alias("runs"),
        F.countDistinct(digest).alias("digests"),
        (F.countDistinct(digest) == 1).alias("consistent"),
    )


def sample_per_task(df: DataFrame, task: str, key: str, n: int, seed: int) -> DataFrame:
    """First n rows per task in seeded order."""
    keyed = df.withColumn("_order", shuffle_key(seed, task, key))
    return first_n_per_group(keyed, [task], ["_order", key], n, spread=key).drop("_order")


def fixed_eval_subset(rows: DataFrame, split: str, row_no: str, batch_rows: int, seq_len: int, budget: int) -> DataFrame:
    """Packed rows covered by the token budget of each split, rounded down to whole batches."""
    batches = budget // (batch_rows * seq_len)
    return rows.filter(F.col(row_no) < batches * batch_rows)


def kept_eval_subset(rows: DataFrame, folder: str, split: str, row_no: str, batch_rows: int, seq_len: int, budget: int) -> DataFrame:
    """The subset of `fixed_eval_subset`, written by the first call for a folder and these parameters and read by all
    later ones, so that every measurement sees the same rows, whatever has become of the corpus. A folder without its
    success marker comes from a call that was interrupted, and is written again."""
    spark = rows.sparkSession
    path = f"{folder.rstrip('/')}/batch_rows={batch_rows}-seq_len={seq_len}-budget={budget}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        fixed_eval_subset(rows, split, row_no, batch_rows, seq_len, budget).write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def inspect_dataset(raw: DataFrame, converted: DataFrame, pos: str, k: int) -> DataFrame:
    """First k raw rows beside their converted form, with the total row count."""
    head = raw.filter(F.col(pos) < k).join(converted.filter(F.col(pos) < k), pos)
    return head.withColumn("total_rows", raw.agg(F.count("*")).scalar())


def hash_files(spark: SparkSession, folder: str, glob: str = "*", most: int = MOST_HASHED) -> DataFrame:
    """(path, n_bytes, sha256) of all files below a folder. A file is one record while it is hashed, so larger ones than
    `most` bytes, which no record can hold, are not read and have a null hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    read = files.filter(F.col("length") <= most).select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > most).select("path", F.col("length").alias("n_bytes"), F.lit(None).cast("string").alias("sha256"))
    return read.union(large)


def audit_files(hashed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Compare hashed files (path, n_bytes, sha256) with a manifest (path, sha256). Returns all files with a status; a
    file that was too large to be hashed is an error row, listed or not."""
    a = hashed.select("path", F.col("sha256").alias("actual"), "n_bytes")
    m = manifest.select("path", F.col("sha256").alias("expected"))
    status = (
        F.when(F.col("n_bytes").isNull(), "missing")
        .when(F.col("actual").isNull(), "too_large")
        .when(F.col("expected").isNull(), "unlisted")
        .when(F.col("actual") != F.col("expected"), "changed")
        .otherwise("ok")
    )
    return a.join(m, "path", "full_outer").withColumn("status", status).drop("n_bytes")


def latest_artifacts(listing: DataFrame, path: str = "path", modified: str = "modified") -> DataFrame:
    """Per folder the largest step in model_<step>.pt; per root the largest depth d<depth>, else the newest folder."""
    file = F.col(path)
    parsed = listing.select(
        F.regexp_extract(file, r"^(.*)/[^/]+/[^/]+$", 1).alias("root"),
        F.regexp_extract(file, r"([^/]+)/[^/]+$", 1).alias("folder"),
        F.regexp_extract(file, r"/model_(\d+)\.pt$", 1).try_cast("long").alias("step"),
        F.col(modified).alias("modified"),
    ).filter("step is not null")
    folders = parsed.groupBy("root", "folder").agg(F.max("step").alias("last_step"), F.max("modified").alias("modified"))
    depth = F.regexp_extract("folder", r"^d(\d+)", 1).try_cast("long")
    return folders.groupBy("root").agg(
        F.count("*").alias("folders"),
        F.max_by("folder", F.struct(F.coalesce(depth, F.lit(-1)), F.col("modified"), F.col("folder"))).alias("best_folder"),
        F.max_by("last_step", F.struct(F.coalesce(depth, F.lit(-1)), F.col("modified"), F.col("folder"))).alias("last_step"),
    )
