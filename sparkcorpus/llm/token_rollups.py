"""Token totals by source, language and tokenizer version, kept up to date by signed batches.

A batch names documents and what happened to their counts: insert, revise or delete. What a batch means for the totals
are signed rows: minus one for the count that a document and version had, plus one for the count it has now. The rows
go to a ledger, which only grows and is not read again, and their sums by group change the totals.

Two things are kept beside the ledger: the current counts, in `BUCKETS` buckets by the hash of document and version, and
the totals. A batch reads and writes anew the buckets of the documents that it names, and the totals, which have a row
for each group; what it costs follows the batch and these buckets, not the history. Each version of a bucket, and of the
totals, is a table of its own, named by the number of the batch that wrote it.

A batch is written to folders of its own, and a marker written last commits it, with its number and buckets; markers
say which version of a bucket is current. A batch that is committed already changes nothing; one that broke off is
invisible and is written anew. So repeats after a lost driver or executor are safe. Batches are to be committed one
after the other. `compact` deletes versions that are not current any more.

Nulls are values: a null source, language, version or id is a group, version or document of its own; a null count is
0. Ids may be of any type that has a string form. A batch that names a document and version several times counts the
last by `seq` (null first; ties: the larger operation name, then the larger count, source and language), so rows that
repeat count once. Deleting what is not there does nothing; revising it inserts it; inserting what is there revises it.
An empty batch commits nothing but itself. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkcorpus.llm.common import drop, save
from sparkcorpus.session import delete_path, path_exists

INSERT, REVISE, DELETE = "insert", "revise", "delete"
GROUP = ("source", "lang", "version")
BUCKETS = 256
_COUNTS = "doc_id string, version string, source string, lang string, n_tokens bigint"
_TOTALS = "source string, lang string, version string, n_docs bigint, n_tokens bigint"
_COMMITS = "batch string, no bigint, buckets array<int>"


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id", "version"), F.lit(BUCKETS)).cast("int")


class TokenRollup:
    """Ledger, current counts, totals and markers below one folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        spark.createDataFrame([], _COMMITS).write.mode("ignore").parquet(f"{self.folder}/commits/none")

    def commits(self) -> DataFrame:
        """One row per committed batch: its name, number, and the buckets it wrote."""
        return self.spark.read.schema(_COMMITS).option("recursiveFileLookup", "true").parquet(f"{self.folder}/commits")

    def ledger(self) -> DataFrame:
        """All signed rows of committed batches."""
        rows = self.spark.read.schema(f"batch string, {_COUNTS}, sign bigint").option("recursiveFileLookup", "true")
        rows = rows.parquet(f"{self.folder}/ledger") if path_exists(self.spark, f"{self.folder}/ledger") else self.spark.createDataFrame([], f"batch string, {_COUNTS}, sign bigint")
        return rows.join(self.commits().select("batch"), "batch", "left_semi")

    def _versions(self) -> dict[int, int]:
        """The number of the batch that wrote the current version of each bucket: one entry a bucket at most."""
        found = self.commits().select("no", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.max("no").alias("no"))
        return {r["bucket"]: r["no"] for r in found.collect()}

    def current(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The counts that hold now, of some buckets or of all."""
        paths = [f"{self.folder}/current/no={no}/bucket={b}" for b, no in self._versions().items() if buckets is None or b in buckets]
        paths = [p for p in paths if path_exists(self.spark, p)]  # a bucket that was emptied has no folder
        return self.spark.read.schema(_COUNTS).parquet(*paths) if paths else self.spark.createDataFrame([], _COUNTS)

    def _last(self) -> int:
        return self.commits().agg(F.max("no")).first()[0] or 0

    def _groups(self, no: int) -> DataFrame:
        if not no:
            return self.spark.createDataFrame([], _TOTALS)
        return self.spark.read.schema(_TOTALS).parquet(f"{self.folder}/totals/no={no}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of (doc_id, version, op, n_tokens, source, lang, seq); False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
            raise ValueError("a batch is named by letters, digits, dots, dashes and underscores")
        if path_exists(self.spark, f"{self.folder}/commits/{batch}/_SUCCESS"):
            return False
        last = self._last()
        no = last + 1
        place = F.struct("seq", "op", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "source", "lang")
        known = changes.filter(F.col("op").isin(INSERT, REVISE, DELETE)).withColumn("doc_id", F.col("doc_id").cast("string"))
        named = known.groupBy("doc_id", "version").agg(F.max(place).alias("c"))
        named = save(named.select("doc_id", "version", F.col("c").alias("change")), "batch")
        touched = sorted(r[0] for r in named.select(_bucket()).distinct().collect())

        was = self.current(touched).select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), F.struct("source", "lang", "n_tokens").alias("was"))
        same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.col("version").eqNullSafe(F.col("_version"))
        both = named.withColumn("named", F.lit(True)).join(was.withColumn("there", F.lit(True)), same, "full")
        is_named, is_there = F.col("named").isNotNull(), F.col("there").isNotNull()
        stays = is_named & (F.col("change.op") != DELETE) | ~is_named
        now = F.when(is_named, F.struct("change.source", "change.lang", "change.n_tokens")).otherwise(F.col("was"))
        both = both.select(
            F.when(is_named, F.col("doc_id")).otherwise(F.col("_doc")).alias("doc_id"), F.when(is_named, F.col("version")).otherwise(F.col("_version")).alias("version"),
            F.when(stays, now).alias("now"), F.when(is_named & is_there, F.col("was")).alias("was"), is_named.alias("named"),
        )
        both = save(both, "changed-buckets")
        counts = both.filter("now is not null").select("doc_id", "version", "now.*").withColumn("bucket", _bucket())
        counts.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/current/no={no}")

        signed = [both.filter(f"named and {side} is not null").select("doc_id", "version", f"{side}.*", F.lit(sign).cast("long").alias("sign")) for side, sign in (("was", -1), ("now", 1))]
        signed = signed[0].union(signed[1])
        signed.select(F.lit(batch).alias("batch"), "*").write.mode("overwrite").parquet(f"{self.folder}/ledger/{batch}")
        sums = signed.select(*GROUP, F.col("sign").alias("n_docs"), (F.col("sign") * F.col("n_tokens")).alias("n_tokens")).union(self._groups(last))
        sums = sums.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0")
        sums.write.mode("overwrite").parquet(f"{self.folder}/totals/no={no}")
        marker = self.spark.createDataFrame([(batch, no, touched)], _COMMITS).coalesce(1)
        marker.write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")
        drop(named, both)
        return True

    def compact(self) -> None:
        """Delete versions of buckets and totals that are not current any more. Not while a batch is being committed."""
        last, versions = self._last(), self._versions()
        old = self.commits().select("no", F.explode("buckets").alias("bucket")).filter(F.col("no") < last)
        for r in old.toLocalIterator():
            if r["no"] < versions[r["bucket"]]:
                delete_path(self.spark, f"{self.folder}/current/no={r['no']}/bucket={r['bucket']}")
        for r in self.commits().filter(F.col("no") < last).toLocalIterator():
            delete_path(self.spark, f"{self.folder}/totals/no={r['no']}")

    def totals(self, by: Sequence[str] = GROUP) -> DataFrame:
        """Documents and tokens by group after all committed batches; groups without documents are left out."""
        sums = self._groups(self._last()).groupBy(*by)
        return sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0")
