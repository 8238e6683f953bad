"""Scores from model outputs given as tables: losses, predictions, accuracies, bits per byte."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.functions.text import extract_answer, last_number


def align_losses(df: DataFrame, ids: str, losses: str) -> DataFrame:
    """Position i predicts token i+1: adds `aligned ARRAY<STRUCT<target, loss>>` whose last element has no target and
    no loss."""
    target = F.transform(ids, lambda t, i: F.get(F.col(ids), i + 1))
    return df.withColumn(
        "aligned",
        F.zip_with(target, F.col(losses), lambda t, l: F.struct(t.alias("target"), F.when(t.isNotNull(), l).alias("loss"))),
    )


def score_options(options: DataFrame, item: Sequence[str]) -> DataFrame:
    """Mean loss over [start-1, end-1) per option; the first option with the smallest mean is the prediction.
    options: item, option, losses ARRAY<DOUBLE> (one per position), start, end, gold. The span is taken from the array where it
    lies, so a number per option is all that is shuffled. An option whose span holds no loss is left out."""
    first = F.greatest(F.col("start") - 1, F.lit(0))
    inside = F.filter(F.slice("losses", (first + 1).cast("int"), F.greatest(F.col("end") - 1 - first, F.lit(0)).cast("int")), lambda x: x.isNotNull())
    rows = options.select(*item, "option", "gold", inside.alias("inside"))
    total = F.aggregate("inside", F.lit(0.0), lambda acc, x: acc + x)
    means = rows.filter(F.size("inside") > 0).select(*item, "option", "gold", (total / F.size("inside")).alias("mean_loss"))
    return means.groupBy(*item).agg(
        F.min_by("option", F.struct("mean_loss", "option")).alias("predicted"),
        F.min("mean_loss").alias("best_loss"),
        F.min_by("gold", "option").alias("gold"),
    ).withColumn("correct", F.col("predicted") == F.col("gold"))


def score_exact_span(predictions: DataFrame, spans: DataFrame, item: Sequence[str]) -> DataFrame:
    """Correct when every token of the span was predicted. predictions: item, pos, pred_id, target_id where
    position p predicts token p+1."""
    inside = (F.col("pos") >= F.col("start") - 1) & (F.col("pos") < F.col("end") - 1)
    return predictions.join(spans, list(item)).filter(inside).groupBy(*item).agg(
        F.bool_and(F.col("pred_id") == F.col("target_id")).alias("correct"), F.count("*").alias("span_tokens")
    )


def task_accuracy(df: DataFrame, by: Sequence[str], correct: str = "correct") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("items"), F.avg(F.col(correct).cast("double")).alias("accuracy"))


def centered(accuracy: Column, baseline: Column) -> Column:
    """0 at the random baseline (a fraction), 1 when perfect."""
    return (accuracy - baseline) / (F.lit(1.0) - baseline)


def centered_scores(accuracies: DataFrame, baselines: DataFrame, label: str = "label") -> DataFrame:
    """Per task the centered accuracy; the one overall score is its mean, see `core_score`."""
    return accuracies.join(baselines, label).withColumn("centered", centered(F.col("accuracy"), F.col("random_baseline")))


def core_score(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scores.groupBy(*by).agg(F.avg("centered").alias("core"), F.count("*").alias("tasks"))


def composite_score(scores: DataFrame, required: DataFrame, by: Sequence[str], label: str = "label") -> DataFrame:
    """required: label, random_baseline, categorical. Overall mean only where every required task is present; the
    categorical mean over the categorical tasks, likewise only when complete."""
    wanted = required.agg(F.count("*")).scalar()
    wanted_cat = required.agg(F.sum(F.col("categorical").cast("long"))).scalar()
    rows = scores.join(required, label).withColumn("centered", centered(F.col("accuracy"), F.col("random_baseline")))
    sums = rows.groupBy(*by).agg(
        F.countDistinct(label).alias("tasks"),
        F.countDistinct(F.when(F.col("categorical"), F.col(label))).alias("cat_tasks"),
        F.avg("centered").alias("all_mean"),
        F.avg(F.when(F.col("categorical"), F.col("centered"))).alias("cat_mean"),
    )
    return sums.select(
        *by, "tasks",
        F.when(F.col("tasks") == wanted, F.col("all_mean")).alias("composite"),
        F.when(F.col("cat_tasks") == wanted_cat, F.col("cat_mean")).alias("composite_cat"),
    )


def choose_letter(df: DataFrame, scores: str, allowed: str) -> DataFrame:
    """Index of the best allowed id; the first one wins a tie."""
    values = F.transform(allowed, lambda i: F.get(F.col(scores), i))
    return df.withColumn("chosen", (F.array_position(values, F.array_max(values)) - 1).cast("int"))


def grade_math(df: DataFrame, reference: str, response: str) -> DataFrame:
    """Extracted answers are compared null-safely: two missing answers count as equal; `unparsed` marks them."""
    ref, pred = extract_answer(F.col(reference)), extract_answer(F.col(response))
    return df.withColumn("ref_answer", ref).withColumn("pred_answer", pred).withColumn(
        "correct", F.col("ref_answer").eqNullSafe(F.col("pred_answer"))
    ).withColumn("unparsed", F.col("pred_answer").isNull())


def grade_choice(df: DataFrame, response: str, gold: str, letters: str) -> DataFrame:
    """The response must be one of the letters, otherwise the row is an error; correct when it is the right one."""
    allowed = F.array_contains(letters, F.col(response))
    return df.withColumn("fault", F.when(~allowed, "not_a_letter")).withColumn("correct", F.when(allowed, F.col(response) == F.col(gold)))


_GRADERS = {"math": grade_math, "choice": grade_choice}


def register_grader(name: str, grader) -> None:
    _GRADERS[name] = grader


def grade(name: str, df: DataFrame, *columns: str) -> DataFrame:
    return _GRADERS[name](df, *columns)


def format_diagnostics(df: DataFrame, reference: str, response: str) -> DataFrame:
    """Per response: official parse, last number, and whether only the format was wrong."""
    graded = grade_math(df, reference, response).withColumn("last_number", last_number(F.col(response)))
    return graded.withColumn(
        "format_only_failure",
        F.coalesce(F.col("unparsed") & ~F.col("correct") & (F.col("last_number").try_cast("double") == F.col("ref_answer").try_cast("double")), F.lit(False)),
    )


def diagnostics_summary(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    count = lambda c: F.sum(c.cast("long")).alias
    return df.groupBy(*by).agg(
        F.count("*").alias("responses"),
        count(F.col("correct"))("correct"),
        count(F.col("unparsed"))("unparsed"),
        count(F.col("last_number").isNotNull())("with_number"),
        count(F.col("format_only_failure"))("format_only"),
    )


def _by_target(losses: DataFrame, token_bytes: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and target (ignored targets, below 0, are left out) with the target's byte length, null for an
    id that the vocabulary lacks. Losses are summed before the lookup, which so meets a vocabulary's worth of rows per
    group at most."""
    bad = F.isnan("loss") | (F.abs("loss") == float("inf")) | F.col("loss").isNull()
    sums = losses.filter("target_id >= 0").groupBy(*by, "target_id").agg(
        F.sum(F.when(bad, 0.0).otherwise(F.col("loss"))).alias("loss"),
        F.count(F.when(~bad, 1)).alias("n"),
        F.count(F.when(bad, 1)).alias("bad"),
    )
    lookup = token_bytes.select(F.col("token_id").alias("target_id"), F.col("n_bytes").alias("bytes_each"))
    return sums.join(lookup, "target_id", "left")


def _per_byte(sums: DataFrame) -> DataFrame:
    bpb = F.col("nats") / (F.lit(math.log(2)) * F.col("n_bytes"))
    return sums.withColumn("bpb", F.when(F.col("n_bytes") > 0, bpb).otherwise(F.lit(float("inf"))))


def bits_per_byte(losses: DataFrame, token_bytes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Nats of targets that have bytes, over ln 2 times their bytes; infinite without bytes. Targets that the
    vocabulary lacks are counted in `unknown_targets`, non-finite losses in `bad_losses`; neither enters the rest."""
    has_bytes = F.coalesce(F.col("bytes_each"), F.lit(0)) > 0
    return _per_byte(_by_target(losses, token_bytes, by).groupBy(*by).agg(
        F.sum(F.when(has_bytes, F.col("loss")).otherwise(0.0)).alias("nats"),
        F.sum(F.when(has_bytes, F.col("n") * F.col("bytes_each")).otherwise(0)).cast("long").alias("n_bytes"),
        F.sum(F.when(F.col("bytes_each").isNull(), F.col("n") + F.col("bad")).otherwise(0)).alias("unknown_targets"),
        F.sum(F.when(F.col("bytes_each").isNotNull(), F.col("bad")).otherwise(0)).alias("bad_losses"),
    ))


def loss_summary(losses: DataFrame, token_bytes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean loss over all valid targets, specials included, beside bits per byte. Non-finite losses are counted in
    `bad_losses`, targets that the vocabulary lacks in `unknown_targets`; both are kept out of the sums."""
    known = F.col("bytes_each").isNotNull()
    has_bytes = F.coalesce(F.col("bytes_each"), F.lit(0)) > 0
    total = lambda condition, value: F.sum(F.when(condition, value).otherwise(0))
    return _per_byte(_by_target(losses, token_bytes, by).groupBy(*by).agg(
        total(known, F.col("bad")).alias("bad_losses"),
        (F.sum(F.when(known, F.col("loss"))) / F.sum(F.when(known & (F.col("n") > 0), F.col("n")))).alias("mean_loss"),
        total(known, F.col("n")).alias("targets"),
        F.sum(F.when(has_bytes, F.col("loss")).otherwise(0.0)).alias("nats"),
        total(has_bytes, F.col("n") * F.col("bytes_each")).cast("long").alias("n_bytes"),
        total(~known, F.col("n") + F.col("bad")).alias("unknown_targets"),
    ))


def error_losses(losses: DataFrame, token_bytes: DataFrame) -> DataFrame:
    """The rows that the summaries leave out, with the `reason`: an unknown target or a loss that is no number. The
    vocabulary is broadcast, so tokens are looked up where they are."""
    known = token_bytes.select(F.col("token_id").alias("target_id"), F.lit(True).alias("_known"))
    rows = losses.filter("target_id >= 0").join(F.broadcast(known), "target_id", "left")
    bad = F.isnan("loss") | (F.abs("loss") == float("inf")) | F.col("loss").isNull()
    reason = F.when(F.col("_known").isNull(), "unknown_target").when(bad, "loss_not_finite")
    return rows.withColumn("reason", reason).filter("reason is not null").drop("_known")


def reconcile_metrics(a: DataFrame, b: DataFrame, by: Sequence[str], value: str, rel: float = 2e-5, absolute: float = 2e-5) -> DataFrame:
    """Do two computations of a metric agree within the tolerances?"""
    left, right = a.select(*by, F.col(value).alias("left_value")), b.select(*by, F.col(value).alias("right_value"))
    gap = F.abs(F.col("left_value") - F.col("right_value"))
    limit = F.greatest(rel * F.greatest(F.abs("left_value"), F.abs("right_value")), F.lit(absolute))
    return left.join(right, list(by), "full_outer").withColumn("agrees", F.coalesce(gap <= limit, F.lit(False)))
