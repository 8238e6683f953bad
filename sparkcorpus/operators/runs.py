"""Training-run records: log extraction, sweeps, smoothing, throughput, latency, records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators.ordering import join_values, prefix_sums, running_min, with_position
from sparkcorpus.session import cut_lineage

# What a training log says and where the number stands.
LOG_RULES = {
    "params_wte": r"^wte .*?([\d,]+)",
    "params_value_embeds": r"^value_embeds .*?([\d,]+)",
    "params_lm_head": r"^lm_head .*?([\d,]+)",
    "params_transformer": r"^transformer_matrices .*?([\d,]+)",
    "params_scalars": r"^scalars .*?([\d,]+)",
    "params_total": r"^total .*?([\d,]+)",
    "num_iterations": r"Calculated number of iterations.*: ([\d,]+)",
    "batch_size": r"Total batch size ([\d,]+)",
    "val_bpb": r"Validation bpb:.*?([\d.]+)$",
    "core_score": r"CORE metric:.*?(\S+)$",
}

# What the log of a series of sizes says of each run. The first number of the line counts all parameters.
SERIES_RULES = {
    "num_params": r"^(?=.*Number of parameters:)[^\d,]*([\d,]+)",
    "num_scaling_params": r"Number of parameters:.*scaling: ([\d,]+)",
    "num_iterations": r"Calculated number of iterations.*: ([\d,]+)",
    "val_bpb": r"Validation bpb:.*?([\d.]+)$",
    "core_score": r"CORE metric:.*?(\S+)$",
}
SERIES_BATCH_TOKENS = 524_288

# Fixed value: a step line of a training log.
STEP_LINE = r"step (\d+)/\d+ .*?\| dt: ([\d.]+)ms"


def extract_run_stats(lines: DataFrame, rules: Mapping[str, str] = LOG_RULES) -> DataFrame:
    """Last match per rule and run (path), thousands commas removed, as one column per rule. A missing score is 0.
    Only matches leave the scan; the last one per key is found with partial aggregation."""
    tried = F.array(*[
        F.struct(F.lit(k).alias("key"), F.regexp_extract("line", r, 1).alias("value")) for k, r in rules.items()
    ])
    hits = lines.select("path", "line_no", F.explode(F.filter(tried, lambda h: h["value"] != "")).alias("h"))
    last = hits.groupBy("path", "h.key").agg(F.max_by("h.value", "line_no").alias("value"))
    cell = lambda k: F.max(F.when(F.col("key") == k, F.replace("value", F.lit(","), F.lit("")))).try_cast("double").alias(k)
    wide = last.groupBy("path").agg(*[cell(k) for k in rules])
    return wide.withColumn("core_score", F.coalesce("core_score", F.lit(0.0))) if "core_score" in rules else wide


def derive_series(stats: DataFrame, depth: Column) -> DataFrame:
    """Runs of a series of sizes (rules `SERIES_RULES`) with their model width, tokens and tokens per scaling parameter."""
    tokens = F.col("num_iterations") * SERIES_BATCH_TOKENS
    ratio = F.when(F.col("num_scaling_params") > 0, F.round(tokens / F.col("num_scaling_params"), 2))
    return stats.withColumns({"model_dim": depth * 64, "tokens_trained": tokens, "param_data_ratio": ratio})


def parse_step_log(lines: DataFrame) -> DataFrame:
    """Every step line: path, step, seconds."""
    step = F.regexp_extract("line", STEP_LINE, 1)
    return lines.filter(F.rlike("line", F.lit(STEP_LINE))).select(
        "path", "line_no", step.cast("long").alias("step"),
        (F.regexp_extract("line", STEP_LINE, 2).cast("double") / 1000).alias("seconds"),
    )


def step_log_summary(steps: DataFrame, tokens_per_step: int, expected_steps: int, warmup: int = 10) -> DataFrame:
    steady = F.when(F.col("step") >= warmup, F.col("seconds"))
    return steps.groupBy("path").agg(
        F.count("*").alias("completed_steps"), F.avg(steady).alias("mean_seconds")
    ).withColumn("tokens_per_second", F.lit(tokens_per_step) / F.col("mean_seconds")).withColumn(
        "complete", F.col("completed_steps") == expected_steps
    )


def sweep_grid(budgets: DataFrame, depths: DataFrame) -> DataFrame:
    """Every budget with every depth. Both are short planning lists, so the shorter one is folded into an array."""
    listed = depths.agg(F.array_sort(F.collect_set("depth"))).scalar()
    return budgets.withColumn("depth", F.explode(listed))


def pending_runs(grid: DataFrame, results: DataFrame, keys: Sequence[str] = ("flops_budget", "depth")) -> DataFrame:
    return grid.join(results.select(*keys).distinct(), list(keys), "left_anti")


def derive_runs(runs: DataFrame) -> DataFrame:
    return runs.withColumn("tokens_trained", F.col("num_iterations") * F.col("batch_size")).withColumn(
        "model_dim", F.col("depth") * 64
    ).withColumn("tokens_per_param", F.col("tokens_trained") / F.col("params_total"))


def valid_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("val_bpb").isNotNull() & ~F.isnan("val_bpb") & (F.col("val_bpb") > 0))


_CONVENTIONS = {
    "all": lambda: F.col("params_total"),
    "matrices_and_head": lambda: F.col("params_transformer") + F.col("params_lm_head"),
    "matrices": lambda: F.col("params_transformer"),
}


def register_convention(name: str, expression) -> None:
    """Add a way to count parameters: a function without arguments that returns a column."""
    _CONVENTIONS[name] = expression


def effective_params(runs: DataFrame, convention: str = "matrices_and_head") -> DataFrame:
    return runs.withColumn("effective_params", _CONVENTIONS[convention]()).withColumn(
        "param_data_ratio", F.col("tokens_trained") / F.col("effective_params")
    )


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group in the given order, by partial aggregation instead of a sort."""
    rest = [c for c in df.columns if c not in by]
    row = F.struct(*rest)
    return df.groupBy(*by).agg(F.min_by(row, F.struct(*order)).alias("_row")).select(*by, "_row.*")


def best_runs(runs: DataFrame, by: Sequence[str], tie: str, metric: str = "val_bpb") -> DataFrame:
    """Run with the lowest metric per group; the smallest `tie` wins among equals."""
    return first_per_group(runs, by, [metric, tie])


def debiased_ema(steps: DataFrame, run: str, step: str, value: str, beta: float = 0.9, chunk: int = 256) -> DataFrame:
    """Adds `ema`: s = beta*s + (1-beta)*x over a run's steps in order, divided by 1-beta**n.

    A step is the map s -> beta*s + (1-beta)*x, and maps compose. Runs are cut into chunks of consecutive steps;
    each chunk is one composed map; spans of chunks are composed again; only then values are carried back down. So a
    run never has to fit one task. Rows that repeat a step count one after the other, the lower value first."""
    rows = with_position(steps, [step, value], width_bucket(F.col(step), 65_536), "_n", [run])
    rows = rows.withColumn("_chunk", F.floor(F.col("_n") / chunk)).withColumn("_span", F.floor(F.col("_chunk") / chunk))

    def scanned(inputs: Column, start: Column) -> Column:
        """Running values after each `STRUCT<k, a, b>` map of an ordered array, beginning with `start`."""
        return F.aggregate(
            inputs,
            F.struct(start.alias("s"), F.array().cast("array<double>").alias("out")),
            lambda acc, m: F.struct(
                (m["a"] * acc["s"] + m["b"]).alias("s"),
                F.concat(acc["out"], F.array(m["a"] * acc["s"] + m["b"])).alias("out"),
            ),
        )["out"]

    def composed(inputs: Column) -> Column:
        """One map STRUCT<a, b> for an ordered array of maps."""
        return F.aggregate(
            inputs, F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")),
            lambda acc, m: F.struct((m["a"] * acc["a"]).alias("a"), (m["a"] * acc["b"] + m["b"]).alias("b")),
        )

    step_map = F.struct(F.col("_n").alias("k"), F.lit(beta).alias("a"), (F.lit(1.0 - beta) * F.col(value)).alias("b"), F.struct(*steps.columns).alias("row"))
    chunks = rows.groupBy(run, "_span", "_chunk").agg(F.array_sort(F.collect_list(step_map)).alias("maps"))
    chunks = chunks.withColumn("map", composed(F.col("maps")))
    chunk_map = F.struct(F.col("_chunk").alias("k"), F.col("map.a").alias("a"), F.col("map.b").alias("b"))
    spans = chunks.groupBy(run, "_span").agg(F.array_sort(F.collect_list(chunk_map)).alias("maps"))
    spans = spans.withColumn("map", composed(F.col("maps")))
    span_map = F.struct(F.col("_span").alias("k"), F.col("map.a").alias("a"), F.col("map.b").alias("b"))
    top = spans.groupBy(run).agg(F.array_sort(F.collect_list(span_map)).alias("maps"))

    def carried(level: DataFrame, start: Column, key: str) -> DataFrame:
        """Value that enters each element of `maps`."""
        entry = F.concat(F.array(start), scanned(F.col("maps"), start))
        pairs = F.zip_with(F.col("maps"), entry, lambda m, s: F.struct(m["k"].alias(key), s.alias("_in")))
        kept = F.filter(pairs, lambda p: p[key].isNotNull())
        return level.select(run, F.explode(kept).alias("p")).select(run, f"p.{key}", "p._in")

    into_spans = carried(top, F.lit(0.0), "_span")
    into_chunks = carried(join_values(spans, into_spans, [run, "_span"]), F.col("_in"), "_chunk")
    values = join_values(chunks, into_chunks, [run, "_chunk"])
    done = F.zip_with(
        F.col("maps"), scanned(F.col("maps"), F.col("_in")),
        lambda m, s: F.struct(m["row"].alias("row"), (s / (1 - F.pow(F.lit(beta), m["k"] + 1))).alias("ema")),
    )
    return values.select(F.explode(done).alias("v")).select("v.row.*", "v.ema")


def throughput_report(
    steps: DataFrame, run: str, step: str, seconds: str, batch_tokens: int, flops_per_token: float, peak_flops: float, warmup: int = 10
) -> DataFrame:
    """Tokens/s, FLOP/s, utilisation %, training time without the first steps, and time left. `num_iterations` is a
    column of the input. Rates of a step without measured time are null."""
    elapsed = F.when(F.col(seconds) > 0, F.col(seconds))
    timed = F.when(F.col(step) > warmup, F.col(seconds)).otherwise(0.0)
    placed = prefix_sums(steps, [step], width_bucket(F.col(step), 65_536), {"_before": timed}, [run])
    total = F.col("_before") + timed
    done = F.col(step) - warmup
    flops = F.lit(flops_per_token * batch_tokens) / elapsed
    return placed.select(
        *steps.columns,
        F.floor(F.lit(batch_tokens) / elapsed).alias("tokens_per_second"),
        flops.alias("flops_per_second"),
        (100 * flops / F.lit(peak_flops)).alias("utilisation_pct"),
        total.alias("training_seconds"),
        F.when(done > 0, (F.col("num_iterations") - F.col(step)) * total / done).alias("eta_seconds"),
    )


def running_best(evals: DataFrame, run: str, step: str, metric: str) -> DataFrame:
    """Lowest metric so far at each evaluation."""
    return running_min(evals, [step], width_bucket(F.col(step), 65_536), metric, "best_so_far", [run])


def best_step(evals: DataFrame, run: str, step: str, metric: str) -> DataFrame:
    return evals.groupBy(run).agg(F.min(metric).alias("best"), F.min_by(step, F.struct(metric, step)).alias("best_step"))


def evaluation_endpoints(rows: DataFrame, run: str, kind: str, step: str, value: str, last_step: Column) -> DataFrame:
    """First and last evaluation per run, and whether the log is complete: evaluations at step 0 and at the end and a
    training row at the end."""
    evaluation, training = F.col(kind) == "evaluation", F.col(kind) == "training"
    at = F.when(evaluation, F.col(step))
    return rows.groupBy(run).agg(
        F.min(at).alias("first_step"),
        F.max(at).alias("last_step"),
        F.min_by(value, at).alias("first_value"),
        F.max_by(value, at).alias("last_value"),
        F.max(last_step).alias("_end"),
        F.coalesce(F.bool_or(training & (F.col(step) == last_step)), F.lit(False)).alias("_trained"),
    ).withColumn(
        "complete", F.coalesce((F.col("first_step") == 0) & (F.col("last_step") == F.col("_end")) & F.col("_trained"), F.lit(False))
    ).drop("_end", "_trained")


# Peak dense half-precision FLOP/s by device name. All words must occur; the first row that fits wins.
PEAK_FLOPS = [
    (["gb200"], 2.5e15),
    (["grace blackwell"], 2.5e15),
    (["b200"], 2.25e15),
    (["b100"], 1.8e15),
    (["h200", "nvl"], 836e12),
    (["h200", "pcie"], 836e12),
    (["h200"], 989e12),
    (["h100", "nvl"], 835e12),
    (["h100", "pcie"], 756e12),
    (["h100"], 989e12),
    (["h800", "nvl"], 989e12),
    (["h800"], 756e12),
    (["a100"], 312e12),
    (["a800"], 312e12),
    (["a40"], 149.7e12),
    (["a30"], 165e12),
    (["l40s"], 362e12),
    (["l40-s"], 362e12),
    (["l40 s"], 362e12),
    (["l4"], 121e12),
    (["mi355"], 2.5e15),
    (["mi325"], 1.3074e15),
    (["mi300x"], 1.3074e15),
    (["mi300a"], 980.6e12),
    (["mi250x"], 383e12),
    (["mi250"], 362.1e12),
    (["5090"], 209.5e12),
    (["4090"], 165.2e12),
    (["3090"], 71e12),
]

# Peak memory bandwidth in bytes/s by device name.
PEAK_BANDWIDTH = [
    (["gb200"], 8.0e12),
    (["grace blackwell"], 8.0e12),
    (["b200"], 8.0e12),
    (["b100"], 8.0e12),
    (["h200"], 4.8e12),
    (["h100", "nvl"], 3.9e12),
    (["h100", "pcie"], 2.0e12),
    (["h100"], 3.35e12),
    (["h800", "pcie"], 2.0e12),
    (["h800"], 3.35e12),
    (["a100"], 2.0e12),
    (["a800"], 2.0e12),
    (["a40"], 696e9),
    (["a30"], 933e9),
    (["l40s"], 864e9),
    (["l40-s"], 864e9),
    (["l40 s"], 864e9),
    (["l4"], 300e9),
    (["mi355"], 8.0e12),
    (["mi325"], 6.0e12),
    (["mi300x"], 5.3e12),
    (["mi300a"], 5.3e12),
    (["mi250x"], 3.28e12),
    (["mi250"], 3.28e12),
    (["5090"], 1.79e12),
    (["4090"], 1.01e12),
    (["3090"], 936e9),
]


def match_device(name: Column, table: Sequence[tuple[Sequence[str], float]]) -> Column:
    """Value of the first table row whose words all occur in the device name, else infinity. A fixed short table
    becomes one expression."""
    lowered, result = F.lower(name), F.lit(float("inf"))
    for words, value in reversed(table):
        fits = F.lit(True)
        for word in words:
            fits = fits & F.contains(lowered, F.lit(word))
        result = F.when(fits, F.lit(float(value))).otherwise(result)
    return result


# Reference batch size and exponent of the batch-size rule.
REFERENCE_BATCH = 2**19
BATCH_EXPONENT = 0.383


def plan_horizon(runs: DataFrame, target_ratio: float, reference_params: float, weight_decay: float) -> DataFrame:
    """Training plan per run from columns scaling_params, flops_per_token, given_iterations, target_flops (<= 0: not
    given): batch size, iterations, tokens, learning-rate and weight-decay scale. Halves round to even."""
    reference_tokens = target_ratio * reference_params
    tokens = F.floor(F.lit(target_ratio) * F.col("scaling_params"))
    predicted = F.lit(float(REFERENCE_BATCH)) * F.pow(tokens / F.lit(reference_tokens), F.lit(BATCH_EXPONENT))
    batch = F.pow(F.lit(2.0), F.bround(F.log2(predicted)))
    iterations = (
        F.when(F.col("given_iterations") > 0, F.col("given_iterations"))
        .when(F.col("target_flops") > 0, F.bround(F.col("target_flops") / (F.col("flops_per_token") * F.col("batch_size"))))
        .otherwise(F.floor(F.col("target_tokens") / F.col("batch_size")))
    )
    scale = F.sqrt(F.col("batch_size") / REFERENCE_BATCH)
    return (
        runs.withColumn("target_tokens", tokens)
        .withColumn("batch_size", batch.cast("long"))
        .withColumn("num_iterations", iterations.cast("long"))
        .withColumn("total_tokens", F.col("num_iterations") * F.col("batch_size"))
        .withColumn("lr_scale", scale)
        .withColumn("weight_decay", F.lit(weight_decay) * scale * (F.lit(reference_tokens) / F.col("target_tokens")))
    )


def upper_medians(values: DataFrame, by: str, value: str, bins: int = 1024, most: int = 65_536) -> DataFrame:
    """Per group the value at place n // 2 of its n sorted values: (`by`, `median`). Exact, by refining: distinct values
    are counted in bins of the group's own range, and the bin that holds the middle is the next range, until it has at
    most `most` distinct values. So neither a narrow spread nor an outlier brings a group's values into one task."""
    counts = cut_lineage(values.filter(F.col(value).isNotNull()).groupBy(F.col(by).alias("_by"), F.col(value).alias("_v")).agg(F.count("*").alias("_n")))
    ranges = counts.groupBy("_by").agg(F.floor(F.sum("_n") / 2).alias("_middle"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_rows"))
    ranges = cut_lineage(ranges.withColumn("_below", F.lit(0).cast("long")))
    in_range = lambda: join_values(counts, ranges, ["_by"]).filter("_v between _low and _high")
    while not ranges.filter(F.col("_rows") > most).isEmpty():
        place = F.when(F.col("_high") > F.col("_low"), F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins)).otherwise(0)
        binned = in_range().groupBy("_by", "_middle", "_below", F.least(place, F.lit(bins - 1)).alias("_bin")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_rows")
        )
        earlier = Window.partitionBy("_by").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = binned.withColumn("_below", F.col("_below") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        holds = (F.col("_below") <= F.col("_middle")) & (F.col("_below") + F.col("_n") > F.col("_middle"))
        ranges = cut_lineage(placed.filter(holds).select("_by", "_middle", "_low", "_high", "_rows", "_below"))
    earlier = Window.partitionBy("_by").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = in_range().withColumn("_below", F.col("_below") + F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    holds = (F.col("_below") <= F.col("_middle")) & (F.col("_below") + F.col("_n") > F.col("_middle"))
    return placed.filter(holds).select(F.col("_by").alias(by), F.col("_v").alias("median"))


def latency_report(
    steps: DataFrame, by: str, seconds: str, expected_steps: Column, bytes_per_step: Column, flops_per_step: Column,
    peak_bandwidth: float, peak_flops: float,
) -> DataFrame:
    """Per batch size: upper median step time, tokens/s, bandwidth and compute utilisation, early stop."""
    totals = steps.groupBy(by).agg(F.count("*").alias("steps"), F.sum(seconds).alias("total_seconds"))
    median = totals.join(upper_medians(steps, by, seconds).withColumnRenamed("median", "tpot"), by)
    return median.select(
        by, "steps", "tpot",
        (F.col(by) * F.col("steps") / F.col("total_seconds")).alias("tokens_per_second"),
        (100 * bytes_per_step / F.col("tpot") / peak_bandwidth).alias("bandwidth_pct"),
        (100 * flops_per_step / F.col("tpot") / peak_flops).alias("compute_pct"),
        (F.col("steps") != expected_steps).alias("early_stop"),
    )


def roofline(df: DataFrame) -> DataFrame:
    """peak_bandwidth, weight_bytes, kv_read_bytes, memory_bytes, kv_bytes_per_token, seq_len -> token ceiling at batch
    1 and rows of full context that fit beside the weights."""
    return df.withColumn(
        "token_ceiling", F.col("peak_bandwidth") / (F.col("weight_bytes") + F.col("kv_read_bytes"))
    ).withColumn(
        "max_rows", ((F.col("memory_bytes") - F.col("weight_bytes")) / (F.col("kv_bytes_per_token") * F.col("seq_len"))).cast("long")
    )


def record_progression(runs: DataFrame, board: str, order: str, score: str, seconds: str, threshold: float) -> DataFrame:
    """Runs above the score threshold that beat every earlier time on their board, with the gain on the record before."""
    eligible = runs.filter(F.col(score) > threshold)
    bucket = width_bucket(F.col(order), 65_536)
    best = running_min(eligible, [order], bucket, seconds, "_best", [board])
    placed = with_position(eligible, [order], bucket, "_n", [board])
    earlier = best.join(placed.select(board, order, "_n"), [board, order])
    before = earlier.select(board, (F.col("_n") + 1).alias("_n"), F.col("_best").alias("previous_record"))
    records = earlier.join(before, [board, "_n"], "left").filter(
        F.col("previous_record").isNull() | (F.col(seconds) < F.col("previous_record"))
    )
    gain = (F.col("previous_record") - F.col(seconds)) / F.col("previous_record") * 100
    return records.select(*runs.columns, "previous_record", gain.alias("gain_pct"))


def repeat_spread(runs: DataFrame, by: Sequence[str], score: str, threshold: float) -> DataFrame:
    return runs.groupBy(*by).agg(
        F.count("*").alias("runs"),
        F.avg(score).alias("mean_score"),
        (F.max(score) - F.min(score)).alias("spread"),
        F.avg((F.col(score) > threshold).cast("double")).alias("share_above"),
    )


def stage_deltas(wide: DataFrame, stage_no: str, stage: str, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Wide stage scores to long rows with the change since the stage before, which is the one of the next lower
    number that is there."""
    long = wide.unpivot([*by, stage_no, stage], list(metrics), "metric", "score")
    in_order = Window.partitionBy(*by, "metric").orderBy(stage_no, stage)
    return long.withColumn("change", F.col("score") - F.lag("score").over(in_order))


def stages_wide(long: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    return long.groupBy(*by).pivot("metric", list(metrics)).agg(F.first("score"))
