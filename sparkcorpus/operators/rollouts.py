"""Sampled completions: pass rates, advantages, policy objective, truncation, tool spans, outcomes, sampling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.functions.arrays import mask_targets, shift_inputs, shift_targets
from sparkcorpus.functions.chat import special_id
from sparkcorpus.functions.text import strip
from sparkcorpus.operators.ordering import join_group_values
from sparkcorpus.operators.packing import pad_group


def any_pass_rate(samples: DataFrame, problem: str, by: Sequence[str] = (), correct: str = "correct") -> DataFrame:
    """Share of problems with at least one correct sample."""
    per_problem = samples.groupBy(*by, problem).agg(F.bool_or(correct).alias("passed"))
    return per_problem.groupBy(*by).agg(F.count("*").alias("problems"), F.avg(F.col("passed").cast("double")).alias("pass_rate"))


def pass_at_k(samples: DataFrame, problem: str, sample_no: str, k_max: int, correct: str = "correct") -> DataFrame:
    """Share of problems solved by the first k samples, k = 1..k_max. sample_no counts from 1. Each problem shrinks to
    the number of its first correct sample, then to one histogram."""
    first = samples.groupBy(problem).agg(F.min(F.when(F.col(correct), F.col(sample_no))).alias("first_ok"))
    histogram = first.groupBy(F.coalesce("first_ok", F.lit(k_max + 1)).alias("first_ok")).agg(F.count("*").alias("n"))
    ks = histogram.select("first_ok", "n", F.explode(F.sequence(F.lit(1), F.lit(k_max))).alias("k"))
    return ks.groupBy("k").agg(
        F.sum("n").alias("problems"), (F.sum(F.when(F.col("first_ok") <= F.col("k"), F.col("n")).otherwise(0)) / F.sum("n")).alias("pass_rate")
    )


def advantages(samples: DataFrame, by: Sequence[str], reward: str = "reward") -> DataFrame:
    """Reward minus the mean reward of the group, without variance scaling."""
    means = samples.groupBy(*by).agg(F.avg(reward).alias("mean_reward"))
    return join_group_values(samples, means, by).withColumn("advantage", F.col(reward) - F.col("mean_reward"))


def rollout_targets(samples: DataFrame, by: Sequence[str], ids: str, mask: str, pad_id: int) -> DataFrame:
    """Rows padded to the longest of their batch, inputs, and targets with prompt, tool and padding tokens ignored."""
    padded = pad_group(samples, by, ids, pad_id, (mask, 0))
    return padded.withColumn("inputs", shift_inputs(F.col(ids))).withColumn(
        "targets", mask_targets(shift_targets(F.col(ids)), F.col(mask))
    )


def policy_objective(tokens: DataFrame, step: str, pass_no: str, passes: int, examples: int) -> DataFrame:
    """Per pass: sum of logp * advantage over valid targets, over max(valid, 1) * passes * examples.
    tokens: step, pass_no, target_id, logp, advantage."""
    valid = F.col("target_id") >= 0
    return tokens.groupBy(step, pass_no).agg(
        F.sum(F.when(valid, F.col("logp") * F.col("advantage")).otherwise(0.0)).alias("weighted"),
        F.count(F.when(valid, 1)).alias("valid_tokens"),
    ).withColumn("objective", F.col("weighted") / (F.greatest(F.col("valid_tokens"), F.lit(1)) * passes * examples))


def rollout_report(samples: DataFrame, step: str, prompt: str, reward: str, length: str) -> DataFrame:
    """Per step: mean over prompts of the mean reward, and mean sequence length."""
    per_prompt = samples.groupBy(step, prompt).agg(
        F.avg(reward).alias("r"), F.sum(length).alias("length"), F.count("*").alias("n")
    )
    return per_prompt.groupBy(step).agg(
        F.avg("r").alias("mean_reward"), (F.sum("length") / F.sum("n")).alias("mean_length"), F.sum("n").alias("samples")
    )


def truncate_completions(df: DataFrame, ids: str, ordinary_size: int = 256) -> DataFrame:
    """Cut at the first assistant end or document start, which is excluded; says why generation stopped."""
    ends = [special_id("assistant_end", ordinary_size), special_id("bos", ordinary_size)]
    found = [F.array_position(ids, F.lit(e)) for e in ends]
    first = F.least(*[F.when(p > 0, p) for p in found])
    return df.withColumn("kept", F.when(first.isNull(), F.col(ids)).otherwise(F.slice(ids, F.lit(1), (first - 1).cast("int")))).withColumn(
        "stop_reason",
        F.when(first.isNull(), "max_new_tokens").when(first == found[0], "assistant_end").otherwise("bos"),
    )


_SPAN_KINDS = {"python": ("python_start", "python_end"), "output": ("output_start", "output_end")}


def extract_tool_spans(df: DataFrame, keep: Sequence[str], ids: str, mask: str, ordinary_size: int = 256) -> DataFrame:
    """Tool calls of each sequence: the tokens between python_start and python_end, the same for tool output, and how
    many of the tokens were sampled (mask 1) or forced (mask 0). Among the markers of one kind a span is a start directly
    followed by an end; an earlier start that was opened again does not count. A batch of sequences is searched at once,
    without an object for each token."""
    markers = {kind: [special_id(name, ordinary_size) for name in names] for kind, names in _SPAN_KINDS.items()}
    kept = df.select(ids).schema[0].dataType.elementType.simpleString()
    span = f"struct<kind:string,start:int,end:int,span_ids:array<{kept}>,sampled:int>"
    found = F.arrow_udf(lambda rows, flags: _tool_spans(rows, flags, markers), f"struct<forced_tokens:int,n_tokens:int,spans:array<{span}>>")
    rows = df.select(*keep, found(ids, mask).alias("_found"))
    rows = rows.select(*keep, "_found.forced_tokens", "_found.n_tokens", F.explode("_found.spans").alias("s"))
    return rows.select(*keep, "forced_tokens", "n_tokens", "s.kind", "s.start", "s.end", "s.span_ids", "s.sampled")


def _tool_spans(rows: pa.Array, flags: pa.Array, markers: dict[str, list[int]]) -> pa.Array:
    begins, flag_begins = rows.offsets.to_numpy(), flags.offsets.to_numpy()
    values = rows.values.slice(begins[0], begins[-1] - begins[0])
    tokens = values.fill_null(-1).to_numpy()
    begins = begins - begins[0]
    marked = flags.values.slice(flag_begins[0], flag_begins[-1] - flag_begins[0]).fill_null(-1).to_numpy()
    flag_begins = flag_begins - flag_begins[0]
    before = lambda value: np.concatenate([[0], np.cumsum(marked == value)])
    ones, zeros = before(1), before(0)

    first, last, kinds = [], [], []
    for kind, (start, end) in markers.items():
        at = np.flatnonzero((tokens == start) | (tokens == end))
        row = begins[1:].searchsorted(at, "right")
        opens = np.flatnonzero((tokens[at[:-1]] == start) & (tokens[at[1:]] == end) & (row[:-1] == row[1:]))
        first.append(at[opens])
        last.append(at[opens + 1])
        kinds += [kind] * len(opens)
    first, last = np.concatenate(first), np.concatenate(last)
    row = begins[1:].searchsorted(first, "right")
    order = np.argsort(row, kind="stable")
    first, last, row = first[order], last[order], row[order]

    sizes = last - first - 1
    ends = np.concatenate([[0], np.cumsum(sizes)])
    inside = np.arange(ends[-1]) + np.repeat(first + 1 - ends[:-1], sizes)
    flag_at = lambda place: np.minimum(flag_begins[row] + place - begins[row], flag_begins[row + 1])
    int32 = lambda numbers, mask=None: pa.array(numbers.astype(np.int32), mask=mask)
    no_flags = flags.is_null().to_numpy(zero_copy_only=False)
    spans = pa.StructArray.from_arrays(
        [
            pa.array(kinds, pa.string()).take(pa.array(order)), int32(first - begins[row]), int32(last - begins[row]),
            pa.ListArray.from_arrays(int32(ends), values.take(pa.array(inside))),
            int32(ones[flag_at(last)] - ones[flag_at(first + 1)], no_flags[row]),
        ],
        ["kind", "start", "end", "span_ids", "sampled"],
    )
    per_row = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(rows)))])
    forced = int32(zeros[flag_begins[1:]] - zeros[flag_begins[:-1]], no_flags)
    return pa.StructArray.from_arrays(
        [forced, int32(np.diff(begins)), pa.ListArray.from_arrays(int32(per_row), spans)], ["forced_tokens", "n_tokens", "spans"]
    )


def classify_outcomes(df: DataFrame) -> DataFrame:
    """returncode, stdout, stderr, timed_out -> success, error, timeout, memory_exceeded. The last line of stderr names
    the error; a timeout discards the output."""
    timed_out = F.col("timed_out")
    success = ~timed_out & (F.col("returncode") == 0)
    trimmed = strip(F.col("stderr"))
    last = F.when(trimmed == "", "Execution failed").otherwise(F.element_at(F.split(trimmed, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), -1))
    error = F.when(timed_out, "Execution timed out (process killed)").when(~success, last)
    return df.withColumn("success", success).withColumn("error", error).withColumn("timeout", timed_out).withColumn(
        "memory_exceeded", ~timed_out & F.contains("stderr", F.lit("MemoryError"))
    )


def topk_softmax(df: DataFrame, scores: str, k: int | None, temperature: float, key: Column | None = None) -> DataFrame:
    """Per row `top ARRAY<STRUCT<idx, p>>`, best first: the k best scores (k None or <= 0: all), softmax of score over
    temperature. Temperature 0 keeps the first maximum. With `key` a reproducible draw `picked` is added: its md5 as
    a uniform number against the cumulative shares."""
    if temperature < 0:
        raise ValueError("temperature must not be negative")
    ranked = F.array_sort(F.transform(scores, lambda s, i: F.struct((-s.cast("double")).alias("neg"), i.alias("idx"))))
    keep = 1 if temperature == 0 else (k if k and k > 0 else None)
    kept = F.slice(ranked, 1, keep) if keep else ranked
    scale = temperature if temperature > 0 else 1.0
    best = kept[0]["neg"]
    weighted = F.transform(kept, lambda e: F.struct(e["idx"].alias("idx"), F.exp((best - e["neg"]) / scale).alias("w")))
    out = df.withColumn("_w", weighted).withColumn("_sum", F.aggregate("_w", F.lit(0.0), lambda a, e: a + e["w"]))
    out = out.withColumn("top", F.transform("_w", lambda e: F.struct(e["idx"].alias("idx"), (e["w"] / F.col("_sum")).alias("p"))))
    if key is not None:
        uniform = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
        cumulative = F.aggregate(
            "top",
            F.struct(F.lit(0.0).alias("c"), F.lit(None).cast("int").alias("i")),
            lambda a, e: F.struct(
                (a["c"] + e["p"]).alias("c"),
                F.coalesce(a["i"], F.when(F.col("_u") < a["c"] + e["p"], e["idx"])).alias("i"),
            ),
        )
        out = out.withColumn("_u", uniform).withColumn("picked", F.coalesce(cumulative["i"], F.element_at("top", -1)["idx"])).drop("_u")
    return out.drop("_w", "_sum")
