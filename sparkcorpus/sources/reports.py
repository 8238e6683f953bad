"""Evaluation bundle (JSONL items, CSV baselines, task table), score reports and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkcorpus.operators.ordering import with_position

ITEM_SCHEMA = (
    "label string, idx int, query string, choices array<string>, gold int, "
    "context string, context_options array<string>, continuation string"
)
TASK_SCHEMA = "label string, task_type string, dataset_uri string, num_fewshot int, continuation_delimiter string"


def read_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ITEM_SCHEMA).json(path)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """Task table; a missing delimiter is one blank."""
    return spark.read.schema(TASK_SCHEMA).json(path).fillna({"continuation_delimiter": " "})


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    """The file holds percent; the table holds fractions."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(F.col("Eval Task").alias("label"), (F.col("Random baseline").cast("double") * 0.01).alias("random_baseline"))


def read_eval_bundle(spark: SparkSession, items: str, tasks: str, baselines: str) -> DataFrame:
    """Items with the settings and the random baseline of their task."""
    return read_items(spark, items).join(read_tasks(spark, tasks), "label").join(read_baselines(spark, baselines), "label")


def write_score_report(scores: DataFrame, path: str) -> None:
    """Padded `Task, Accuracy, Centered` lines and a last CORE line, as one small text file in label order."""
    def line(task, accuracy, centered):
        return F.concat(F.rpad(task, 35, " "), F.lit(", "), F.rpad(accuracy, 10, " "), F.lit(", "), F.rpad(centered, 10, " "))

    six = lambda c: F.format_string("%.6f", F.col(c))
    body = scores.select(F.lit(1).alias("part"), "label", line(F.col("label"), six("accuracy"), six("centered")).alias("value"))
    core = scores.agg(F.format_string("%.6f", F.avg("centered")).alias("core")).select(
        F.lit(2).alias("part"), F.lit("CORE").alias("label"), line(F.lit("CORE"), F.lit(""), F.col("core")).alias("value")
    )
    head = scores.sparkSession.range(1).select(
        F.lit(0).alias("part"), F.lit("").alias("label"), line(F.lit("Task"), F.lit("Accuracy"), F.lit("Centered")).alias("value")
    )
    head.unionByName(body).unionByName(core).coalesce(1).sortWithinPartitions("part", "label").select("value").write.mode(
        "errorifexists"
    ).text(path)


def read_score_report(spark: SparkSession, path: str) -> DataFrame:
    """Tolerant reader: cells are trimmed, the header is skipped, blank or non-numeric cells become null."""
    cells = F.split("value", ",")
    cell = lambda i: F.trim(F.try_element_at(cells, F.lit(i)))
    rows = spark.read.text(path).select(
        cell(1).alias("label"), cell(2).try_cast("double").alias("accuracy"), cell(3).try_cast("double").alias("centered")
    )
    return rows.filter((F.col("label") != "Task") & (F.col("label") != ""))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line). Files are read in blocks; inside a block rows keep the file order, and line numbers come
    from the number of lines in earlier blocks. So a log may be larger than a task."""
    text = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    return with_position(lines, ["block", "row"], F.col("block"), "line_no", ["path"]).select("path", "line_no", "line")
