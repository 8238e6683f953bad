import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcorpus.operators import fits, runs


def test_log_extraction(spark):
    text = ["wte                     : 1,000", "wte                     : 25,165,824", "x wte : 9", "Calculated number of iterations from target FLOPs: 1,234",
            "Total batch size 524,288 => gradient accumulation steps: 2", "Step 1 | Validation bpb: 0.9123", "Validation bpb: 0.8123", "noise"]
    lines = [("a", i, t) for i, t in enumerate(text)] + [("b", 0, "CORE metric: 0.2500")]
    out = {r.path: r for r in runs.extract_run_stats(spark.createDataFrame(lines, "path string, line_no long, line string")).collect()}
    assert out["a"].params_wte == 25165824 and out["a"].num_iterations == 1234 and out["a"].batch_size == 524288
    assert out["a"].val_bpb == 0.8123 and out["a"].core_score == 0.0 and out["a"].params_lm_head is None
    assert out["b"].core_score == 0.25 and out["b"].params_total is None


def test_step_log(spark):
    lines = [("a", i, f"step {i:05d}/00030 (1%) | loss: 1.0 | lrm: 1.00 | dt: {100 + i}.00ms | tok/sec: 1") for i in range(30)]
    steps = runs.parse_step_log(spark.createDataFrame(lines + [("a", 99, "step x")], "path string, line_no long, line string"))
    row = runs.step_log_summary(steps, 2048, 30).first()
    assert row.completed_steps == 30 and row.complete
    assert row.mean_seconds == pytest.approx(np.mean([(100 + i) / 1000 for i in range(10, 30)]))
    assert row.tokens_per_second == pytest.approx(2048 / row.mean_seconds)


def sweep(spark, seed):
    rng = random.Random(seed)
    rows = []
    for budget in (1e18, 3e18, 1e19):
        for _ in range(12):
            params = 10 ** rng.uniform(7.0, 9.5)
            sign = -1 if budget == 3e18 else 1
            rows.append((budget, params, 0.9 + sign * 0.1 * (math.log10(params) - 8.3) ** 2 + rng.uniform(0, 0.01), budget / params, budget / params**2))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_isoflop_optima_equal_polyfit_and_interp(spark, seed):
    rows = sweep(spark, seed)
    df = spark.createDataFrame(rows, "budget double, effective_params double, val_bpb double, tokens_trained double, param_data_ratio double")
    out = {r.budget: r for r in fits.isoflop_optima(df, ["budget"]).collect()}
    for budget in (1e18, 3e18, 1e19):
        x, y, t, ratio = (np.array(v) for v in zip(*sorted((math.log10(r[1]), r[2], r[3], r[4]) for r in rows if r[0] == budget)))
        a, b, c = np.polyfit(x, y, 2)
        got = out[budget]
        if a > 0:
            v = -b / (2 * a)
            assert got.fitted and math.log10(got.params) == pytest.approx(v, abs=1e-7)
            assert got.bpb == pytest.approx(a * v * v + b * v + c, abs=1e-9)
            assert got.tokens == pytest.approx(np.interp(v, x, t), rel=1e-6) and got.ratio == pytest.approx(np.interp(v, x, ratio), rel=1e-6)
        else:
            assert not got.fitted and got.bpb == y.min()


def test_too_few_sizes_fall_back_to_the_best_run(spark):
    df = spark.createDataFrame([(1.0, 10.0, 0.9, 5.0, 1.0), (1.0, 100.0, 0.8, 6.0, 2.0)], "budget double, effective_params double, val_bpb double, tokens_trained double, param_data_ratio double")
    row = fits.isoflop_optima(df, ["budget"]).first()
    assert (row.fitted, row.params, row.bpb, row.tokens) == (False, 100.0, 0.8, 6.0)


def test_interpolation_clamps(spark):
    curve = spark.createDataFrame([(g, x, 10 * x) for g in "abc" for x in (1.0, 2.0, 4.0)], "g string, x double, y double")
    points = spark.createDataFrame([("a", 0.0), ("b", 3.0), ("c", 9.0)], "g string, at double")
    assert {r.g: r.y_at for r in fits.interp_at(curve, points, ["g"], "x", ["y"]).collect()} == {"a": 10.0, "b": 30.0, "c": 40.0}


def test_power_law(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x**0.5) for x in (1, 10, 100, 1000)], "x double, y double")
    row = fits.power_law(df, "x", "y").first()
    assert row.slope == pytest.approx(0.5) and 10**row.intercept == pytest.approx(3.0)


@pytest.mark.parametrize("alpha", [0.0, 0.1, 10.0])
def test_ridge_equals_the_normal_equations(spark, alpha):
    rng = np.random.default_rng(0)
    x, noise = rng.normal(size=(60, 3)), rng.normal(size=60)
    y = x @ [1.0, -2.0, 0.5] + 4 + noise
    df = spark.createDataFrame([(*map(float, row), float(v)) for row, v in zip(x, y)], "a double, b double, c double, y double")
    row = fits.fit_ridge(df, ["a", "b", "c"], "y", [alpha]).first()
    full = np.column_stack([np.ones(60), x])
    w = np.linalg.solve(full.T @ full + alpha * np.diag([0, 1, 1, 1]), full.T @ y)
    assert [row.intercept, row.w_a, row.w_b, row.w_c] == pytest.approx(list(w))
    assert row.r2 == pytest.approx(1 - ((y - full @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row.weight_norm == pytest.approx(np.linalg.norm(w[1:]))


@pytest.mark.parametrize("beta, chunk", [(0.9, 4), (0.999, 7), (0.9, 256)])
def test_ema_equals_the_plain_loop(spark, beta, chunk):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.8 else "cold", i * 3, rng.random()) for i in range(700)]
    df = spark.createDataFrame(rows, "run string, step long, v double").repartition(3)
    got = {(r.run, r.step): r.ema for r in runs.debiased_ema(df, "run", "step", "v", beta, chunk).collect()}
    state = {}
    for run, step, v in rows:
        s, n = state.get(run, (0.0, 0))
        s, n = beta * s + (1 - beta) * v, n + 1
        state[run] = (s, n)
        assert got[(run, step)] == pytest.approx(s / (1 - beta**n))
    assert len(got) == 700


def test_throughput(spark):
    df = spark.createDataFrame([("r", i, 0.5) for i in range(15)], "run string, step long, dt double").withColumn("num_iterations", F.lit(20))
    rows = {r.step: r for r in runs.throughput_report(df, "run", "step", "dt", 1000, 2.0, 8000.0).collect()}
    assert rows[10].eta_seconds is None and rows[10].training_seconds == 0.0
    assert rows[14].training_seconds == 2.0 and rows[14].eta_seconds == pytest.approx(6 * 2.0 / 4)
    assert rows[0].tokens_per_second == 2000 and rows[0].utilisation_pct == 50.0


def test_devices(spark):
    df = spark.createDataFrame([("NVIDIA H100 PCIe",), ("NVIDIA H100 80GB HBM3",), ("Grace Blackwell x",), ("mystery",), ("L40S",)], "d string")
    rows = df.select(runs.match_device(F.col("d"), runs.PEAK_FLOPS).alias("f"), runs.match_device(F.col("d"), runs.PEAK_BANDWIDTH).alias("b")).collect()
    assert [r.f for r in rows] == [756e12, 989e12, 2.5e15, float("inf"), 362e12]
    assert [r.b for r in rows] == [2.0e12, 3.35e12, 8.0e12, float("inf"), 864e9]


def test_horizon(spark):
    cases = [(10_000_000, 6e7, 0, 0.0), (200_000_000, 1e9, 0, 1e19), (50_000_000, 3e8, 777, 1e19)]
    df = spark.createDataFrame(cases, "scaling_params long, flops_per_token double, given_iterations long, target_flops double")
    d_ref = 10.5 * 1.2e8
    for row, (params, flops, given, target) in zip(runs.plan_horizon(df, 10.5, 1.2e8, 0.2).collect(), cases):
        tokens = int(10.5 * params)
        batch = 2 ** round(math.log2(2**19 * (tokens / d_ref) ** 0.383))
        iterations = given or (round(target / (flops * batch)) if target else tokens // batch)
        assert (row.target_tokens, row.batch_size, row.num_iterations, row.total_tokens) == (tokens, batch, iterations, batch * iterations)
        assert row.lr_scale == pytest.approx((batch / 2**19) ** 0.5)
        assert row.weight_decay == pytest.approx(0.2 * math.sqrt(batch / 2**19) * d_ref / tokens)


def test_medians_refine_ranges(spark):
    rng = random.Random(9)
    rows = [(1, 0.021 + rng.random() * 1e-4) for _ in range(3000)] + [(1, 5000.0), (2, 7.0), (2, None), (3, 1.0), (3, 2.0)] + [(4, -rng.random()) for _ in range(2001)]
    rows += [(5, 0.5)] * 1000 + [(5, rng.random()) for _ in range(999)]
    out = {r.b: r["median"] for r in runs.upper_medians(spark.createDataFrame(rows, "b long, s double"), "b", "s", bins=8, most=5).collect()}
    groups = {b: sorted(s for k, s in rows if k == b and s is not None) for b in range(1, 6)}
    assert out == {b: v[len(v) // 2] for b, v in groups.items()}


def test_latency_takes_the_upper_median(spark):
    rng = random.Random(8)
    rows = [(b, round(rng.random() * 3, 2)) for b in (1, 2) for _ in range(50 + b)]
    out = {r.b: r for r in runs.latency_report(spark.createDataFrame(rows, "b long, s double"), "b", "s", F.lit(51), F.lit(1.0), F.lit(1.0), 1.0, 1.0).collect()}
    for b in (1, 2):
        times = sorted(s for k, s in rows if k == b)
        assert out[b].tpot == times[len(times) // 2] and out[b].tokens_per_second == pytest.approx(b * len(times) / sum(times))
    assert [out[1].early_stop, out[2].early_stop] == [False, True]


def test_records_and_spread(spark):
    rows = [("x", 1, 0.3, 100.0), ("x", 2, 0.2, 50.0), ("x", 3, 0.3, 120.0), ("x", 4, 0.4, 80.0), ("x", 5, 0.3, 80.0)]
    df = spark.createDataFrame(rows, "board string, n long, score double, seconds double")
    out = [(r.n, r.previous_record, r.gain_pct) for r in runs.record_progression(df, "board", "n", "score", "seconds", 0.25).orderBy("n").collect()]
    assert out == [(1, None, None), (4, 100.0, 20.0)]
    row = runs.repeat_spread(df, ["board"], "score", 0.25).first()
    assert row.runs == 5 and row.spread == pytest.approx(0.2) and row.share_above == pytest.approx(0.8)


def test_endpoints_and_sweeps(spark):
    log = [("a", "evaluation", 0, 3.0), ("a", "training", 20, 1.0), ("a", "evaluation", 20, 2.0), ("b", "evaluation", 5, 1.0)]
    rows = spark.createDataFrame(log, "run string, kind string, step long, v double")
    out = {r.run: (r.first_step, r.last_step, r.first_value, r.last_value, r.complete) for r in runs.evaluation_endpoints(rows, "run", "kind", "step", "v", F.lit(20)).collect()}
    assert out == {"a": (0, 20, 3.0, 2.0, True), "b": (5, 5, 1.0, 1.0, False)}
    grid = runs.sweep_grid(spark.createDataFrame([(1.0,), (2.0,)], "flops_budget double"), spark.createDataFrame([(4,), (8,)], "depth int"))
    done = spark.createDataFrame([(1.0, 8)], "flops_budget double, depth int")
    assert sorted(map(tuple, runs.pending_runs(grid, done).collect())) == [(1.0, 4), (2.0, 4), (2.0, 8)]


def test_stage_deltas(spark):
    wide = spark.createDataFrame([(0, "pre", 24.2, 0.0), (1, "mid", 26.64, 0.61), (2, "sft", 24.66, 0.0)], "stage_no int, stage string, arc double, gsm double")
    long = runs.stage_deltas(wide, "stage_no", "stage", ["arc", "gsm"])
    changes = {(r.stage, r.metric): r.change for r in long.collect()}
    assert changes[("pre", "arc")] is None and changes[("mid", "arc")] == pytest.approx(2.44) and changes[("sft", "gsm")] == pytest.approx(-0.61)
    assert sorted(map(tuple, runs.stages_wide(long, ["stage"], ["arc", "gsm"]).collect())) == [("mid", 26.64, 0.61), ("pre", 24.2, 0.0), ("sft", 24.66, 0.0)]
