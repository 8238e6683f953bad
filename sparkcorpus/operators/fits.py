"""Fits on run tables. Every fit is one or two aggregations of power sums; only closed forms follow."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.operators.ordering import join_group_values
from sparkcorpus.session import cut_lineage


def isoflop_optima(
    runs: DataFrame, by: Sequence[str], params: str = "effective_params", loss: str = "val_bpb",
    tokens: str = "tokens_trained", ratio: str = "param_data_ratio",
) -> DataFrame:
    """Per budget the optimum of a quadratic of the loss in log10(params), from centred power sums. Without a minimum
    (or with fewer than three sizes) the best observed run is taken. Tokens and ratio are interpolated."""
    named = runs.select(
        *by, F.log10(F.col(params).cast("double")).alias("x"), F.col(loss).cast("double").alias("y"),
        F.col(params).cast("double").alias("p"), F.col(tokens).cast("double").alias("t"), F.col(ratio).cast("double").alias("r"),
    )
    # Power sums around each group's own mean; a common centre would cancel digits of the fourth powers.
    means = named.groupBy(*by).agg(F.avg("x").alias("center"))
    u, n = F.col("x") - F.col("center"), F.col("n")
    sums = join_group_values(named, means, by).groupBy(*by).agg(
        F.count("*").cast("double").alias("n"), F.max("center").alias("center"),
        F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"), F.sum(u * u * u * u).alias("s4"),
        F.sum("y").alias("t0"), F.sum(u * F.col("y")).alias("t1"), F.sum(u * u * F.col("y")).alias("t2"),
        F.min_by(F.struct("p", "t", "r", "y"), F.struct("y", "p")).alias("best"),
    )
    c = {k: F.col(k) for k in ("n", "s2", "s3", "s4", "t0", "t1", "t2")}
    det = c["s4"] - c["s3"] * c["s3"] / c["s2"] - c["s2"] * c["s2"] / c["n"]
    a = (c["t2"] - c["s3"] * c["t1"] / c["s2"] - c["s2"] * c["t0"] / c["n"]) / F.col("det")
    fitted = (
        sums.withColumn("det", F.when(F.col("s2") > 1e-12 * n, det))
        .withColumn("a", F.when(F.col("det") > 1e-12 * F.col("s4"), a))
        .withColumn("b", F.when(F.col("s2") > 1e-12 * n, (c["t1"] - c["s3"] * F.col("a")) / c["s2"]))
        .withColumn("c", (c["t0"] - c["s2"] * F.col("a")) / c["n"])
        .withColumn("u", F.when(F.col("a") > 0, -F.col("b") / (2 * F.col("a"))))
        .withColumn("opt_x", F.col("center") + F.col("u"))
        .withColumn("opt_y", F.col("a") * F.col("u") * F.col("u") + F.col("b") * F.col("u") + F.col("c"))
    )
    fitted = cut_lineage(fitted)
    at = interp_at(named, fitted.filter("opt_x is not null").select(*by, F.col("opt_x").alias("at")), by, "x", ["t", "r"])
    fit = F.col("opt_x").isNotNull()
    return fitted.join(at, list(by), "left").select(
        *by,
        F.when(fit, F.pow(F.lit(10.0), F.col("opt_x"))).otherwise(F.col("best.p")).alias("params"),
        F.when(fit, F.col("t_at")).otherwise(F.col("best.t")).alias("tokens"),
        F.when(fit, F.col("r_at")).otherwise(F.col("best.r")).alias("ratio"),
        F.when(fit, F.col("opt_y")).otherwise(F.col("best.y")).alias("bpb"),
        fit.alias("fitted"),
    )


def interp_at(curve: DataFrame, queries: DataFrame, by: Sequence[str], x: str, values: Sequence[str]) -> DataFrame:
    """Linear interpolation of each group's curve at its one query point `at`, clamped at the ends. The neighbours are
    a maximum below and a minimum above, so the curve is never sorted."""
    points = join_group_values(curve, queries, by)
    row = F.struct(F.col(x).alias("x"), *[F.col(v) for v in values])
    around = points.groupBy(*by, "at").agg(
        F.max(F.when(F.col(x) <= F.col("at"), row)).alias("lo"), F.min(F.when(F.col(x) > F.col("at"), row)).alias("hi")
    )
    share = (F.col("at") - F.col("lo.x")) / (F.col("hi.x") - F.col("lo.x"))

    def value(v: str) -> Column:
        return F.coalesce(F.col(f"lo.{v}") + share * (F.col(f"hi.{v}") - F.col(f"lo.{v}")), F.col(f"lo.{v}"), F.col(f"hi.{v}"))

    return around.select(*by, *[value(v).alias(f"{v}_at") for v in values])


def power_law(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """log10-log10 line: y = 10**intercept * x**slope."""
    lx, ly = F.log10(F.col(x).cast("double")), F.log10(F.col(y).cast("double"))
    return df.groupBy(*by).agg(F.regr_slope(ly, lx).alias("slope"), F.regr_intercept(ly, lx).alias("intercept"))


def ratio_summary(optima: DataFrame, budget: str, params: str = "params", tokens: str = "tokens", ratio: str = "ratio") -> DataFrame:
    """Optimal tokens per parameter at the geometric-mean budget, mean and sample deviation of the ratios, and the
    exponent of the ratio."""
    lf = F.log10(F.col(budget).cast("double"))
    ln, ld = F.log10(F.col(params).cast("double")), F.log10(F.col(tokens).cast("double"))
    s = optima.agg(
        F.regr_slope(ln, lf).alias("slope_n"), F.regr_intercept(ln, lf).alias("i_n"),
        F.regr_slope(ld, lf).alias("slope_d"), F.regr_intercept(ld, lf).alias("i_d"),
        F.sqrt(F.min(budget) * F.max(budget)).alias("reference_budget"),
        F.avg(ratio).alias("mean_ratio"), F.stddev_samp(ratio).alias("std_ratio"),
    )
    at = F.log10("reference_budget")
    predicted = (F.col("i_d") + F.col("slope_d") * at) - (F.col("i_n") + F.col("slope_n") * at)
    return s.select(
        "slope_n", "slope_d", (F.col("slope_d") - F.col("slope_n")).alias("ratio_exponent"), "reference_budget",
        F.pow(F.lit(10.0), predicted).alias("optimal_ratio"), "mean_ratio", "std_ratio",
    )


def feature_matrix(long: DataFrame, by: Sequence[str], label: str, labels: Sequence[str], value: str) -> DataFrame:
    """Long centred scores to one column per label, plus the row mean over the labels present."""
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col(label) == l, F.col(value))).alias(l) for l in labels],
        F.avg(F.when(F.col(label).isin(list(labels)), F.col(value))).alias("row_mean"),
    )


def fit_simple(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line and R2."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"),
        F.count("*").alias("n"),
    )


def fit_ridge(df: DataFrame, features: Sequence[str], target: str, alphas: Sequence[float]) -> DataFrame:
    """Ridge regression for several alphas, intercept not penalised: alpha, intercept, w_<feature>, r2, weight_norm.
    All cross products come from one aggregation; a system of len(features)+1 equations is solved on the driver."""
    names = ["_one", *features, target]
    wide = df.select(F.lit(1.0).alias("_one"), *[F.col(c).cast("double").alias(c) for c in [*features, target]])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = wide.agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"p{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(names), len(names)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"p{i}_{j}"]
    xtx, xty, yty, n = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1], gram[0, 0]
    total = yty - gram[0, -1] ** 2 / n
    rows = []
    for alpha in alphas:
        penalty = alpha * np.eye(len(features) + 1)
        penalty[0, 0] = 0.0
        w = np.linalg.solve(xtx + penalty, xty)
        residual = yty - 2 * w @ xty + w @ xtx @ w
        rows.append((float(alpha), *[float(v) for v in w], float(1 - residual / total), float(np.sqrt(np.sum(w[1:] ** 2)))))
    columns = ["alpha", "intercept", *[f"w_{f}" for f in features], "r2", "weight_norm"]
    return df.sparkSession.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def rank_features(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """One regression per feature, from one pass; rank 1 has the highest R2."""
    wide = df.agg(*[
        F.struct(F.regr_slope(target, f).alias("slope"), F.regr_intercept(target, f).alias("intercept"), F.regr_r2(target, f).alias("r2")).alias(f)
        for f in features
    ])
    entries = F.array_sort(F.array(*[
        F.struct((-F.col(f"{f}.r2")).alias("o"), F.lit(f).alias("feature"), F.col(f"{f}.slope").alias("slope"),
                 F.col(f"{f}.intercept").alias("intercept"), F.col(f"{f}.r2").alias("r2"))
        for f in features
    ]))
    return wide.select(F.posexplode(entries).alias("i", "e")).select(
        (F.col("i") + 1).alias("rank"), "e.feature", "e.slope", "e.intercept", "e.r2"
    )


def estimate_scores(df: DataFrame, models: dict[str, tuple[float, dict[str, float]]], name: str = "estimate") -> DataFrame:
    """Apply linear models {name: (intercept, {feature: weight})} and average them."""
    out = df
    for model, (intercept, weights) in models.items():
        value = F.lit(float(intercept))
        for feature, weight in weights.items():
            value = value + F.lit(float(weight)) * F.col(feature)
        out = out.withColumn(model, value)
    mean = sum((F.col(m) for m in models), F.lit(0.0)) / len(models)
    return out.withColumn(name, mean)


def compare_pairs(left: DataFrame, right: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Right against left in percent, for rows paired on the keys."""
    a, b = left.select(*on, F.col(value).alias("base")), right.select(*on, F.col(value).alias("other"))
    return a.join(b, list(on)).withColumn("change", F.col("other") - F.col("base")).withColumn(
        "improvement_pct", F.when(F.col("base") != 0, 100 * (F.col("other") - F.col("base")) / F.col("base"))
    )
