"""Shards that arrive, metric rows that are appended, requests that come in. Every query processes what is there and
stops (availableNow), so the same job can be scheduled again and goes on from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators.conversations import validate_requests
from sparkcorpus.operators.ordering import join_values, running_min, with_position
from sparkcorpus.operators.runs import debiased_ema
from sparkcorpus.session import cut_lineage


#: State tasks of a batch of running totals. Batches grow with the shards that arrive, so their tasks must not.
_STATE_PARTITIONS = 4
_SHUFFLE = "spark.sql.shuffle.partitions"


def _drain(stream: DataFrame, out: str, checkpoint: str, mode: str, partitions: int | None = None) -> None:
    """Run one stream to its end. Every batch overwrites its own folder, so a repeated batch leaves no duplicates. A new
    stream keeps its state in `partitions` parts at most, else in the session's number; a resumed one in those it has."""
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    conf = stream.sparkSession.conf
    usual = conf.get(_SHUFFLE)
    if partitions is not None:
        conf.set(_SHUFFLE, str(min(int(usual), partitions)))
    try:  # a stream takes the session's settings as it starts
        query = (
            stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(save).start()
        )
    finally:
        conf.set(_SHUFFLE, usual)
    query.awaitTermination()


def _read_all(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").drop("batch")


def _read_last(spark: SparkSession, out: str) -> DataFrame:
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return rows.filter(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch")


def stream_shard_totals(spark: SparkSession, path: str, schema, out: str, checkpoint: str, glob: str = "*.parquet", files_per_batch: int = 1) -> DataFrame:
    """Running totals over shards as they appear: documents, characters and bytes per source. Shards are added up before
    the shuffle, so the state of a batch, a row a source, meets in a few tasks."""
    shards = (
        spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", str(files_per_batch)).parquet(path)
    )
    totals = shards.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum(F.length("text")).cast("long").alias("characters"),
        F.sum(F.octet_length("text")).cast("long").alias("n_bytes"),
    )
    _drain(totals, out, checkpoint, "complete", _STATE_PARTITIONS)
    return _read_last(spark, out)


_EMA_STATE = "run long, s double, n long, best double, last long"


def stream_ema(spark: SparkSession, path: str, out: str, checkpoint: str, beta: float = 0.9) -> DataFrame:
    """Debiased EMA and running best per run over appended JSON rows (run, step, loss). State per run: smoothed value,
    step count, best, last step.

    All files that are there when the job runs are one batch, which each run takes in order of its steps, however they
    lie in the files. Of rows that repeat a step the one of lowest loss counts; a step equal to the saved one is a
    duplicate. A step that arrives behind the saved one cannot be smoothed any more; it goes to the side table
    `late_steps`, never away.

    A batch is smoothed by composing maps (`operators.runs.debiased_ema`), and since they are linear, the saved value
    enters as beta**k times itself after k steps: a run may hold any share of a backlog. State is a table per batch,
    written before the batch's rows and keyed by its number, so that a repeated batch starts from the same state."""
    states = f"{checkpoint.rstrip('/')}-states"

    def saved(batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], _EMA_STATE)
        return spark.read.schema(_EMA_STATE).parquet(f"{states}/{batch_id - 1}")

    def advance(batch: DataFrame, batch_id: int) -> None:
        before = saved(batch_id)
        rows = batch.groupBy("run", "step").agg(F.min("loss").alias("loss"))
        rows = cut_lineage(join_values(rows, before, ["run"], "left"))
        fresh = rows.filter("last is null or step > last").select("run", "step", "loss")
        start = before.select("run", F.col("s").alias("_s"), F.col("n").alias("_n"), F.col("best").alias("_best"))
        ema = debiased_ema(fresh, "run", "step", "loss", beta)
        order = width_bucket(F.col("step"), 65_536)
        placed = running_min(with_position(ema, ["step"], order, "_k", ["run"]), ["step"], order, "loss", "_low", ["run"])
        placed = join_values(placed, start, ["run"], "left").fillna(0, ["_s", "_n"])
        k = F.col("_k") + 1
        decay = lambda n: F.pow(F.lit(beta), n)
        smoothed = decay(k) * F.col("_s") + F.col("ema") * (1 - decay(k))
        shown = F.when(F.col("_n") == 0, F.col("ema")).otherwise(smoothed / (1 - decay(F.col("_n") + k)))
        best = F.least("_low", F.coalesce("_best", "_low"))
        done = cut_lineage(placed.select("run", "step", shown.alias("ema"), best.alias("best_so_far"), smoothed.alias("s"), (F.col("_n") + k).alias("n")))
        now = done.groupBy("run").agg(F.max_by("s", "step").alias("s"), F.max("n").alias("n"), F.min("best_so_far").alias("best"), F.max("step").alias("last"))
        kept = before.join(now.select(F.col("run").alias("_run")), F.col("run").eqNullSafe(F.col("_run")), "left_anti")
        now.select("run", "s", "n", "best", "last").union(kept).write.mode("overwrite").parquet(f"{states}/{batch_id}")
        late = rows.filter("step < last").select("run", "step", F.col("loss").alias("ema"), F.col("loss").alias("best_so_far"), F.lit(True).alias("late"))
        found = done.select("run", "step", "ema", "best_so_far", F.lit(False).alias("late")).union(late)
        found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    rows = spark.readStream.schema("run long, step long, loss double").json(path)
    query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(advance).start()
    query.awaitTermination()
    return _read_all(spark, out).filter("not late").drop("late")


def late_steps(spark: SparkSession, out: str) -> DataFrame:
    """The rows that `stream_ema` got behind a step it had saved, with the `reason`."""
    late = _read_all(spark, out).filter("late")
    return late.select("run", "step", F.col("ema").alias("loss"), F.lit("behind_saved_step").alias("reason"))


REQUEST_SCHEMA = (
    "request_id long, messages array<struct<role:string,content:string,parts:array<struct<type:string,text:string>>>>, "
    "temperature double, top_k int, max_tokens int"
)


def stream_requests(spark: SparkSession, path: str, out: str, checkpoint: str) -> DataFrame:
    """Requests with the first broken rule, stateless."""
    requests = spark.readStream.schema(REQUEST_SCHEMA).json(path)
    _drain(validate_requests(requests), out, checkpoint, "append")
    return _read_all(spark, out)
