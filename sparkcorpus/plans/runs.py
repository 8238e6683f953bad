"""Run-analytics queries. Line items and orders stand for training runs, events for their steps; the columns of a run
are SQL expressions both engines evaluate."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators import fits, ordering, runs
from sparkcorpus.plans.evaluation import labelled
from sparkcorpus.plans.registry import query, table

EFFECTIVE = "((l_partkey + 50) * 1000 + (l_suppkey + 1) * 100)"
RUN_FIELDS = {
    "run_id": "l_orderkey * 100000 + l_partkey",
    "budget": "l_linenumber",
    "flops_budget": "cast(concat('1e', cast(17 + l_linenumber as varchar(20))) as double)",
    "depth": "4 + l_suppkey % 24",
    "params_transformer": "(l_partkey + 50) * 1000",
    "params_lm_head": "(l_suppkey + 1) * 100",
    "params_total": "(l_partkey + 50) * 1000 + (l_suppkey + 1) * 100 + l_orderkey % 1000",
    "num_iterations": "1000 + l_orderkey % 5000",
    "batch_size": "cast(32768 * (1 + l_linenumber % 3) as bigint)",
    "val_bpb": f"""case when l_orderkey % 50 = 0 then null when l_orderkey % 50 = 1 then -1.0
        when l_linenumber = 7 then 1.2 - 0.15 * pow(log10({EFFECTIVE}) - 5.8, 2) + l_discount * 0.05
        else 0.8 + 0.15 * pow(log10({EFFECTIVE}) - 5.3 - 0.05 * l_linenumber, 2) + l_discount * 0.05 end""",
    "core_score": "l_discount * 3",
    "train_seconds": "cast(l_quantity * 100 + l_partkey % 100 as bigint)",
}
RUNS_SQL = "runs as (select " + ", ".join(f"{e} as {n}" for n, e in RUN_FIELDS.items()) + """ from lineitem),
valid as (
  select *, num_iterations * batch_size as tokens_trained, params_transformer + params_lm_head as effective_params,
         num_iterations * batch_size / (params_transformer + params_lm_head) as param_data_ratio from runs where val_bpb > 0)"""


def run_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(n) for n, e in RUN_FIELDS.items()])


def fitted_runs(spark, sf_dir):
    return runs.effective_params(runs.derive_runs(runs.valid_runs(run_rows(spark, sf_dir))))


def rounded(df, digits: int, *names: str):
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- logs ---------------------------------------------------------------------------------------------------------

LOG_LINE = """case o_orderkey % 13
 when 0 then concat('wte                     : ', cast(o_orderkey as varchar(20)), ',165,824')
 when 1 then concat('value_embeds            : ', cast(o_orderkey as varchar(20)), ',000')
 when 2 then concat('lm_head                 : 1,', cast(o_custkey as varchar(20)))
 when 3 then concat('transformer_matrices    : ', cast(o_orderkey as varchar(20)))
 when 4 then concat('scalars                 : ', cast(o_custkey as varchar(20)))
 when 5 then concat('total                   : 9,', cast(o_orderkey as varchar(20)))
 when 6 then concat('Calculated number of iterations from target FLOPs: 1,', cast(o_orderkey as varchar(20)))
 when 7 then concat('Total batch size ', cast(o_orderkey * 7 as varchar(20)), ' => gradient accumulation steps: 4')
 when 8 then concat('Step 00100 | Validation bpb: 0.', cast(o_orderkey as varchar(20)))
 when 9 then case when o_custkey % 12 = 5 then 'no metric' else concat('CORE metric: 0.', cast(o_orderkey as varchar(20))) end
 when 10 then concat('step 000', cast(o_orderkey % 40 as varchar(20)), '/00040 (1.00%) | loss: 3.5 | lrm: 1.00 | dt: ', cast(o_orderkey % 700 as varchar(20)), '.25ms | tok/sec: 12,345')
 when 11 then concat('the total : ', cast(o_orderkey as varchar(20)))
 else concat('step x/40 | dt: ', cast(o_orderkey as varchar(20)), 'ms') end"""
LOG_FIELDS = {"path": "concat('run', cast(o_custkey % 12 as varchar(20)))", "line_no": "o_orderkey", "line": LOG_LINE}
LINES_SQL = "lines as (select " + ", ".join(f"{e} as {n}" for n, e in LOG_FIELDS.items()) + " from orders)"


def log_lines(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*[F.expr(e).alias(n) for n, e in LOG_FIELDS.items()])


def _stat(key: str, rule: str) -> str:
    rule = rule.replace("'", "''")
    value = f"try_cast(replace(arg_max(regexp_extract(line, '{rule}', 1), line_no) filter (regexp_extract(line, '{rule}', 1) <> ''), ',', '') as double)"
    return f"coalesce({value}, 0.0) as {key}" if key == "core_score" else f"{value} as {key}"


@query(f"with {LINES_SQL} select path, " + ", ".join(_stat(k, r) for k, r in runs.LOG_RULES.items()) + " from lines group by 1")
def extract_run_stats(spark, sf_dir):
    return runs.extract_run_stats(log_lines(spark, sf_dir))


SERIES_LINE = """case o_orderkey % 6
 when 0 then concat('Number of parameters: ', cast(o_orderkey as varchar(20)), ',165,824 (scaling: ', cast(o_orderkey % 97 as varchar(20)), ',824)')
 when 1 then concat('Calculated number of iterations from target data:param ratio: 2,', cast(o_orderkey as varchar(20)))
 when 2 then concat('Step 00100 | Validation bpb: 0.', cast(o_orderkey as varchar(20)))
 when 3 then case when o_custkey % 12 = 5 then 'no metric' else concat('CORE metric: 0.', cast(o_orderkey as varchar(20))) end
 when 4 then concat('d', cast(o_orderkey as varchar(20)), ' Number of parameters: 7')
 else 'scaling: 1,000' end"""


@query(f"""
with lines as (select o_custkey % 12 as run, o_orderkey as line_no, {SERIES_LINE} as line from orders),
found as (
  select run, line_no, case when contains(line, 'Number of parameters:') then regexp_extract(line, '[0-9,]+') else '' end as params,
         regexp_extract(line, 'Number of parameters:.*scaling: ([0-9,]+)', 1) as scaling, regexp_extract(line, 'iterations.*: ([0-9,]+)', 1) as iterations,
         regexp_extract(line, 'Validation bpb:.*?([0-9.]+)$', 1) as bpb, regexp_extract(line, 'CORE metric:.*?(\\S+)$', 1) as core from lines),
stats as (
  select run, replace(arg_max(params, line_no) filter (params <> ''), ',', '')::double as num_params,
         replace(arg_max(scaling, line_no) filter (scaling <> ''), ',', '')::double as num_scaling_params,
         replace(arg_max(iterations, line_no) filter (iterations <> ''), ',', '')::double as num_iterations,
         (arg_max(bpb, line_no) filter (bpb <> ''))::double as val_bpb, coalesce((arg_max(core, line_no) filter (core <> ''))::double, 0.0) as core_score from found group by 1)
select *, run * 64 as model_dim, num_iterations * 524288 as tokens_trained, round(num_iterations * 524288 / num_scaling_params, 2) as param_data_ratio from stats""")
def extract_series_stats(spark, sf_dir):
    """What the logs of a series of model sizes say of each run."""
    orders = table(spark, sf_dir, "orders")
    lines = orders.select((F.col("o_custkey") % 12).alias("path"), F.col("o_orderkey").alias("line_no"), F.expr(SERIES_LINE).alias("line"))
    return runs.derive_series(runs.extract_run_stats(lines, runs.SERIES_RULES), F.col("path")).withColumnRenamed("path", "run")


@query(f"""
with {LINES_SQL}
select path, line_no, regexp_extract(line, '{runs.STEP_LINE}', 1)::bigint as step, regexp_extract(line, '{runs.STEP_LINE}', 2)::double / 1000 as seconds
from lines where regexp_matches(line, '{runs.STEP_LINE}')""")
def parse_step_log(spark, sf_dir):
    return runs.parse_step_log(log_lines(spark, sf_dir))


@query(f"""
with {LINES_SQL},
steps as (
  select path, regexp_extract(line, '{runs.STEP_LINE}', 1)::bigint as step, regexp_extract(line, '{runs.STEP_LINE}', 2)::double / 1000 as seconds
  from lines where regexp_matches(line, '{runs.STEP_LINE}'))
select path, count(*) as completed_steps, round(avg(seconds) filter (step >= 10), 9) as mean_seconds,
       round(2048 / avg(seconds) filter (step >= 10), 6) as tokens_per_second, count(*) = 96 as complete from steps group by 1""")
def step_log_summary(spark, sf_dir):
    out = runs.step_log_summary(runs.parse_step_log(log_lines(spark, sf_dir)), 2048, 96)
    return rounded(rounded(out, 9, "mean_seconds"), 6, "tokens_per_second")


# --- sweeps -------------------------------------------------------------------------------------------------------


def grid(spark, sf_dir):
    rows = run_rows(spark, sf_dir)
    return runs.sweep_grid(rows.select("flops_budget").distinct(), rows.select("depth").distinct())


@query(f"with {RUNS_SQL} select flops_budget, depth from (select distinct flops_budget from runs), (select distinct depth from runs)")
def sweep_grid(spark, sf_dir):
    return grid(spark, sf_dir)


@query(f"""
with {RUNS_SQL}, done as (select distinct flops_budget, depth from runs where depth % 3 = 0 and budget <> 2)
select flops_budget, depth from (select distinct flops_budget from runs), (select distinct depth from runs)
where (flops_budget, depth) not in (select flops_budget, depth from done)""")
def pending_runs(spark, sf_dir):
    return runs.pending_runs(grid(spark, sf_dir), run_rows(spark, sf_dir).filter("depth % 3 = 0 and budget <> 2"))


@query(f"""
with {RUNS_SQL}
select run_id, budget, num_iterations * batch_size as tokens_trained, depth * 64 as model_dim,
       round(num_iterations * batch_size / params_total, 6) as tokens_per_param from runs""")
def derive_runs(spark, sf_dir):
    out = runs.derive_runs(run_rows(spark, sf_dir))
    return rounded(out.select("run_id", "budget", "tokens_trained", "model_dim", "tokens_per_param"), 6, "tokens_per_param")


@query(f"with {RUNS_SQL} select run_id, budget, round(val_bpb, 9) as val_bpb from valid")
def valid_runs(spark, sf_dir):
    return rounded(runs.valid_runs(run_rows(spark, sf_dir)).select("run_id", "budget", "val_bpb"), 9, "val_bpb")


@query(f"""
with {RUNS_SQL}
select run_id, budget, 'all' as convention, params_total as effective_params, round(tokens_trained / params_total, 6) as param_data_ratio from valid
union all select run_id, budget, 'matrices_and_head', effective_params, round(param_data_ratio, 6) from valid
union all select run_id, budget, 'matrices', params_transformer, round(tokens_trained / params_transformer, 6) from valid""")
def effective_params(spark, sf_dir):
    base, union = runs.derive_runs(runs.valid_runs(run_rows(spark, sf_dir))), None
    for convention in ("all", "matrices_and_head", "matrices"):
        part = runs.effective_params(base, convention).select("run_id", "budget", F.lit(convention).alias("convention"), "effective_params", "param_data_ratio")
        union = part if union is None else union.unionByName(part)
    return rounded(union, 6, "param_data_ratio")


@query(f"""
with {RUNS_SQL}
select budget, run_id, depth, effective_params from (
  select *, row_number() over (partition by budget order by depth, run_id) as r from valid) where r = 1""")
def first_per_group(spark, sf_dir):
    rows = fitted_runs(spark, sf_dir).select("budget", "run_id", "depth", "effective_params")
    return runs.first_per_group(rows, ["budget"], ["depth", "run_id"])


@query(f"""
with {RUNS_SQL}
select budget, run_id, depth, round(val_bpb, 9) as val_bpb from (
  select *, row_number() over (partition by budget order by val_bpb, run_id) as r from valid) where r = 1""")
def best_runs(spark, sf_dir):
    rows = fitted_runs(spark, sf_dir).select("budget", "run_id", "depth", "val_bpb")
    return rounded(runs.best_runs(rows, ["budget"], "run_id"), 9, "val_bpb")


OPTIMA_SQL = f"""
{RUNS_SQL},
points as (
  select budget, log10(effective_params) as x, val_bpb as y, effective_params::double as p, tokens_trained::double as t, param_data_ratio as r from valid),
moments as (
  select budget, count(*) as n, max(c) as center, sum(pow(u, 2)) as s2, sum(pow(u, 3)) as s3, sum(pow(u, 4)) as s4, sum(y) as t0, sum(u * y) as t1, sum(u * u * y) as t2,
         min(struct_pack(y := y, p := p, t := t, r := r)) as best
  from (select *, x - avg(x) over (partition by budget) as u, avg(x) over (partition by budget) as c from points) group by 1),
quadratic as (
  select *, (t2 - s3 * t1 / s2 - s2 * t0 / n) / (s4 - s3 * s3 / s2 - s2 * s2 / n) as a from moments),
vertex as (
  select *, case when a > 0 then -((t1 - s3 * a) / s2) / (2 * a) end as u from quadratic),
optima as (
  select budget, best, center + u as spot, a * u * u + (t1 - s3 * a) / s2 * u + (t0 - s2 * a) / n as y from vertex),
sides as (
  select p.budget, max(struct_pack(x := x, t := t, r := r)) filter (x <= spot) as lo, min(struct_pack(x := x, t := t, r := r)) filter (x > spot) as hi
  from points p join optima o on o.budget = p.budget and spot is not null group by 1),
solved as (
  select o.budget, spot is not null as fitted, coalesce(pow(10.0, spot), best.p) as params, coalesce(y, best.y) as bpb,
         case when spot is null then best.t else coalesce(lo.t + (spot - lo.x) / (hi.x - lo.x) * (hi.t - lo.t), lo.t, hi.t) end as tokens,
         case when spot is null then best.r else coalesce(lo.r + (spot - lo.x) / (hi.x - lo.x) * (hi.r - lo.r), lo.r, hi.r) end as ratio
  from optima o left join sides s on s.budget = o.budget)"""


@query(f"with {OPTIMA_SQL} select budget, fitted, round(params, 2) as params, round(tokens, -3) as tokens, round(ratio, 5) as ratio, round(bpb, 8) as bpb from solved")
def isoflop_optima(spark, sf_dir):
    out = fits.isoflop_optima(fitted_runs(spark, sf_dir), ["budget"])
    return rounded(rounded(rounded(rounded(out, 2, "params"), -3, "tokens"), 5, "ratio"), 8, "bpb")


@query(f"""
with {RUNS_SQL},
curve as (select budget, min(log10(effective_params)) + 0.1 * budget as spot from valid group by 1),
sides as (
  select v.budget, max(spot) as spot, max(struct_pack(x := log10(effective_params), t := tokens_trained::double)) filter (log10(effective_params) <= spot) as lo,
         min(struct_pack(x := log10(effective_params), t := tokens_trained::double)) filter (log10(effective_params) > spot) as hi
  from valid v join curve c on c.budget = v.budget group by 1)
select budget, round(coalesce(lo.t + (spot - lo.x) / (hi.x - lo.x) * (hi.t - lo.t), lo.t, hi.t), 1) as t_at from sides""")
def interp_at(spark, sf_dir):
    rows = fitted_runs(spark, sf_dir).select("budget", F.log10("effective_params").alias("x"), F.col("tokens_trained").cast("double").alias("t"))
    points = rows.groupBy("budget").agg((F.min("x") + F.lit(0.1) * F.col("budget")).alias("at"))
    return rounded(fits.interp_at(rows, points, ["budget"], "x", ["t"]), 1, "t_at")


@query(f"""
with {RUNS_SQL}
select budget, round(regr_slope(log10(tokens_trained), log10(effective_params)), 8) as slope,
       round(regr_intercept(log10(tokens_trained), log10(effective_params)), 8) as intercept from valid group by 1""")
def power_law(spark, sf_dir):
    return rounded(fits.power_law(fitted_runs(spark, sf_dir), "effective_params", "tokens_trained", ["budget"]), 8, "slope", "intercept")


@query(f"""
with {OPTIMA_SQL},
logs as (select log10(pow(10.0, 17 + budget)) as f, log10(params) as n, log10(tokens) as d, ratio, pow(10.0, 17 + budget) as flops from solved),
fit as (
  select regr_slope(n, f) as slope_n, regr_intercept(n, f) as i_n, regr_slope(d, f) as slope_d, regr_intercept(d, f) as i_d,
         sqrt(min(flops) * max(flops)) as reference_budget, avg(ratio) as mean_ratio, stddev_samp(ratio) as std_ratio from logs)
select round(slope_n, 7) as slope_n, round(slope_d, 7) as slope_d, round(slope_d - slope_n, 7) as ratio_exponent, round(log10(reference_budget), 7) as reference_log,
       round(pow(10.0, (i_d + slope_d * log10(reference_budget)) - (i_n + slope_n * log10(reference_budget))), 4) as optimal_ratio,
       round(mean_ratio, 4) as mean_ratio, round(std_ratio, 4) as std_ratio from fit""")
def ratio_summary(spark, sf_dir):
    optima = fits.isoflop_optima(fitted_runs(spark, sf_dir), ["budget"]).withColumn("flops", F.expr("pow(10.0, 17 + budget)"))
    out = fits.ratio_summary(optima, "flops").withColumn("reference_log", F.log10("reference_budget")).drop("reference_budget")
    return rounded(rounded(out, 7, "slope_n", "slope_d", "ratio_exponent", "reference_log"), 4, "optimal_ratio", "mean_ratio", "std_ratio")


# --- score models -------------------------------------------------------------------------------------------------

LANGS = ["en", "fr", "de", "es"]


@query("""
with long as (select source, lang, (avg(quality) - 0.25) / 0.75 as v from documents join labels using (doc_id) group by 1, 2)
select source, """ + ", ".join(f"round(max(v) filter (lang = '{l}'), 9) as {l}" for l in LANGS) + ", round(avg(v), 9) as row_mean from long group by 1")
def feature_matrix(spark, sf_dir):
    long = labelled(spark, sf_dir).groupBy("source", "lang").agg(((F.avg("quality") - 0.25) / 0.75).alias("v"))
    return rounded(fits.feature_matrix(long, ["source"], "lang", LANGS, "v"), 9, *LANGS, "row_mean")


@query("""
select l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) as slope, round(regr_intercept(l_extendedprice, l_quantity), 4) as intercept,
       round(regr_r2(l_extendedprice, l_quantity), 9) as r2, count(*) as n from lineitem group by 1""")
def fit_simple(spark, sf_dir):
    out = fits.fit_simple(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rounded(rounded(rounded(out, 6, "slope"), 4, "intercept"), 9, "r2")


@query("""
with m as (
  select count(*) as n, avg(l_quantity) as mx, avg(l_discount) as mz, avg(l_extendedprice) as my, var_pop(l_quantity) * count(*) as cxx,
         var_pop(l_discount) * count(*) as czz, covar_pop(l_quantity, l_discount) * count(*) as cxz, covar_pop(l_quantity, l_extendedprice) * count(*) as cxy,
         covar_pop(l_discount, l_extendedprice) * count(*) as czy, var_pop(l_extendedprice) * count(*) as cyy from lineitem),
w as (
  select *, (cxy * (czz + alpha) - czy * cxz) / ((cxx + alpha) * (czz + alpha) - cxz * cxz) as w1,
         (czy * (cxx + alpha) - cxy * cxz) / ((cxx + alpha) * (czz + alpha) - cxz * cxz) as w2 from m, (select unnest([0.0, 0.01, 1.0, 100.0])::double as alpha))
select alpha, round(my - w1 * mx - w2 * mz, 3) as intercept, round(w1, 4) as w_l_quantity, round(w2, 3) as w_l_discount,
       round(1 - (cyy - 2 * (w1 * cxy + w2 * czy) + w1 * w1 * cxx + 2 * w1 * w2 * cxz + w2 * w2 * czz) / cyy, 6) as r2, round(sqrt(w1 * w1 + w2 * w2), 3) as weight_norm from w""")
def fit_ridge(spark, sf_dir):
    out = fits.fit_ridge(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", [0.0, 0.01, 1.0, 100.0])
    return rounded(rounded(rounded(out, 3, "intercept", "w_l_discount", "weight_norm"), 4, "w_l_quantity"), 6, "r2")


@query("""
with f as (""" + " union all ".join(
    f"select '{c}' as feature, regr_slope(l_extendedprice, {c}) as slope, regr_intercept(l_extendedprice, {c}) as intercept, regr_r2(l_extendedprice, {c}) as r2 from lineitem"
    for c in ("l_quantity", "l_discount", "l_tax")) + """)
select row_number() over (order by r2 desc)::int as rank, feature, round(slope, 4) as slope, round(intercept, 4) as intercept, round(r2, 9) as r2 from f""")
def rank_features(spark, sf_dir):
    out = fits.rank_features(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    return rounded(rounded(out, 4, "slope", "intercept"), 9, "r2")


@query("""
select l_orderkey, l_linenumber, l_partkey, round(100 + 20 * l_quantity, 6) as simple, round(50 + 18 * l_quantity - 7.5 * l_discount, 6) as ridge,
       round((100 + 20 * l_quantity + 50 + 18 * l_quantity - 7.5 * l_discount) / 2, 6) as estimate, 'estimated' as source from lineitem where l_linestatus = 'F'
union all select l_orderkey, l_linenumber, l_partkey, null, null, round(l_extendedprice, 6), 'measured' from lineitem where l_linestatus <> 'F'""")
def estimate_scores(spark, sf_dir):
    rows, keys = table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"]
    models = {"simple": (100, {"l_quantity": 20}), "ridge": (50, {"l_quantity": 18, "l_discount": -7.5})}
    estimated = fits.estimate_scores(rows.filter("l_linestatus = 'F'"), models).select(*keys, "simple", "ridge", "estimate", F.lit("estimated").alias("source"))
    none = F.lit(None).cast("double")
    measured = rows.filter("l_linestatus <> 'F'").select(
        *keys, none.alias("simple"), none.alias("ridge"), F.col("l_extendedprice").alias("estimate"), F.lit("measured").alias("source")
    )
    return rounded(estimated.unionByName(measured), 6, "simple", "ridge", "estimate")


@query("""
with v as (select l_suppkey, l_returnflag, sum(round(l_extendedprice * 100)::bigint) / count(*) as value from lineitem group by 1, 2)
select b.l_suppkey, o.l_returnflag as other_flag, round(b.value, 6) as base, round(o.value, 6) as other, round(o.value - b.value, 6) as change,
       round(100 * (o.value - b.value) / b.value, 6) as improvement_pct
from v b join v o on o.l_suppkey = b.l_suppkey and b.l_returnflag = 'N' and o.l_returnflag <> 'N'""")
def compare_pairs(spark, sf_dir):
    values = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
        (F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / F.count("*")).alias("value")
    )
    base = values.filter("l_returnflag = 'N'")
    others = [fits.compare_pairs(base, values.filter(F.col("l_returnflag") == f), ["l_suppkey"], "value").withColumn("other_flag", F.lit(f)) for f in "AR"]
    out = others[0].unionByName(others[1])
    return rounded(out, 6, "base", "other", "change", "improvement_pct")


# --- step series --------------------------------------------------------------------------------------------------

EMA_SQL = """
numbered as (select user_id, event_id, value, row_number() over (partition by user_id order by event_id) as n from events),
smoothed as (
  select user_id, event_id, value, 0.1::double * pow(0.9::double, n) * sum(value * pow(0.9::double, -n)) over (partition by user_id order by n rows unbounded preceding)
         / (1 - pow(0.9::double, n)) as ema from numbered)"""


def series(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")


REPEATED_EMA_SQL = EMA_SQL.replace("event_id, value, row_number()", "event_id // 50 as event_id, value, row_number()").replace(
    "order by event_id) as n", "order by event_id // 50, value) as n"
)


@query(f"with {REPEATED_EMA_SQL} select user_id, event_id as step, value, round(ema, 6) as ema from smoothed")
def debiased_ema(spark, sf_dir):
    """Steps repeat inside a run; every row counts."""
    rows = series(spark, sf_dir).select("user_id", F.floor(F.col("event_id") / 50).alias("step"), "value")
    return rounded(runs.debiased_ema(rows, "user_id", "step", "value", chunk=16), 6, "ema").select("user_id", "step", "value", "ema")


def stepped(spark, sf_dir):
    """Events with their step number inside the run, from 0."""
    rows = series(spark, sf_dir)
    return ordering.with_position(rows, ["event_id"], width_bucket(F.col("event_id"), 4096), "step", ["user_id"])


STEPS_SQL = "steps as (select user_id, event_id, event_type, value, row_number() over (partition by user_id order by event_id) - 1 as step from events)"


@query(f"""
with {STEPS_SQL},
timed as (select *, sum(case when step > 10 then value else 0 end) over (partition by user_id order by step rows unbounded preceding) as total from steps)
select user_id, step, floor(524288 / nullif(value, 0))::bigint as tokens_per_second, round(3e9 * 524288 / nullif(value, 0), 0) as flops_per_second,
       round(100 * (3e9 * 524288 / nullif(value, 0)) / 989e12, 6) as utilisation_pct, round(total, 6) as training_seconds,
       case when step > 10 then round((120 - step) * total / (step - 10), 9) end as eta_seconds from timed""")
def throughput_report(spark, sf_dir):
    rows = stepped(spark, sf_dir).select("user_id", "step", "value").withColumn("num_iterations", F.lit(120))
    out = runs.throughput_report(rows, "user_id", "step", "value", 524288, 3e9, 989e12).drop("value", "num_iterations")
    return rounded(rounded(rounded(out, 0, "flops_per_second"), 6, "utilisation_pct", "training_seconds"), 9, "eta_seconds")


@query("select user_id, event_id, value, min(value) over (partition by user_id order by event_id rows unbounded preceding) as best_so_far from events")
def running_best(spark, sf_dir):
    return runs.running_best(series(spark, sf_dir).drop("event_type"), "user_id", "event_id", "value")


@query("select user_id, min(value) as best, min_by(event_id, (value, event_id)) as best_step from events group by 1")
def best_step(spark, sf_dir):
    return runs.best_step(series(spark, sf_dir), "user_id", "event_id", "value")


@query(f"""
with {STEPS_SQL},
kinds as (select *, case when event_type in ('view', 'click') then 'evaluation' else 'training' end as kind, 40 + user_id % 30 as final from steps)
select user_id, min(step) filter (kind = 'evaluation') as first_step, max(step) filter (kind = 'evaluation') as last_step,
       min_by(value, step) filter (kind = 'evaluation') as first_value, max_by(value, step) filter (kind = 'evaluation') as last_value,
       coalesce(min(step) filter (kind = 'evaluation') = 0 and max(step) filter (kind = 'evaluation') = max(final)
                and bool_or(kind = 'training' and step = final), false) as complete from kinds group by 1""")
def evaluation_endpoints(spark, sf_dir):
    rows = stepped(spark, sf_dir).withColumn("kind", F.when(F.col("event_type").isin("view", "click"), "evaluation").otherwise("training"))
    return runs.evaluation_endpoints(rows, "user_id", "kind", "step", "value", 40 + F.col("user_id") % 30)


# --- devices and plans --------------------------------------------------------------------------------------------

DEVICE = """concat(case when p_partkey % 2 = 0 then 'NVIDIA ' else '' end, case p_partkey % 16
 when 0 then 'H100 PCIe' when 1 then 'H100 80GB HBM3' when 2 then 'GB200' when 3 then 'L40S' when 4 then 'A100-SXM4-80GB' when 5 then 'L4'
 when 6 then 'GeForce RTX 4090' when 7 then 'AMD Instinct MI300X' when 8 then 'Grace Blackwell' when 9 then 'H200 NVL' when 10 then 'A40'
 when 11 then 'H100 NVL' when 12 then 'MI250X' when 13 then 'B200' when 14 then 'H800 PCIe' else p_name end)"""


def device_sql(rows) -> str:
    values = ", ".join(f"({i}, {list(words)!r}, {value!r}::double)" for i, (words, value) in enumerate(rows))
    return f"""(select min_by(value, o) from (values {values}) t(o, words, value)
       where len(list_filter(words, lambda w: not contains(lower(device), w))) = 0)"""


@query(f"""
with parts as (select p_partkey, {DEVICE} as device from part)
select p_partkey, device, coalesce({device_sql(runs.PEAK_FLOPS)}, 'inf'::double) as peak_flops,
       coalesce({device_sql(runs.PEAK_BANDWIDTH)}, 'inf'::double) as peak_bandwidth from parts""")
def match_device(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(DEVICE).alias("device")).select(
        "p_partkey", "device", runs.match_device(F.col("device"), runs.PEAK_FLOPS).alias("peak_flops"),
        runs.match_device(F.col("device"), runs.PEAK_BANDWIDTH).alias("peak_bandwidth"),
    )


PLAN_FIELDS = {
    "o_orderkey": "o_orderkey", "scaling_params": "(o_orderkey % 3000 + 1) * 100003", "flops_per_token": "(o_orderkey % 3000 + 1) * 600018.0",
    "given_iterations": "case when o_custkey % 5 = 0 then 1000 + o_custkey else 0 end", "target_flops": "case when o_custkey % 3 = 0 then 1e15 * (1 + o_custkey) else 0 end",
}


@query("with runs as (select " + ", ".join(f"{e} as {n}" for n, e in PLAN_FIELDS.items()) + """ from orders),
sized as (select *, floor(10.5 * scaling_params)::bigint as target_tokens from runs),
batched as (select *, pow(2.0, round_even(log2(524288 * pow(target_tokens / (10.5 * 135266304), 0.383::double)), 0))::bigint as batch_size from sized),
planned as (
  select *, case when given_iterations > 0 then given_iterations when target_flops > 0 then round_even(target_flops / (flops_per_token * batch_size), 0)
                 else target_tokens // batch_size end::bigint as num_iterations from batched)
select o_orderkey, target_tokens, batch_size, num_iterations, num_iterations * batch_size as total_tokens, round(sqrt(batch_size / 524288), 9) as lr_scale,
       round(0.2 * sqrt(batch_size / 524288) * (10.5 * 135266304 / target_tokens), 6) as weight_decay from planned""")
def plan_horizon(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(*[F.expr(e).alias(n) for n, e in PLAN_FIELDS.items()])
    out = runs.plan_horizon(rows, 10.5, 135266304, 0.2)
    out = out.select("o_orderkey", "target_tokens", "batch_size", "num_iterations", "total_tokens", "lr_scale", "weight_decay")
    return rounded(rounded(out, 9, "lr_scale"), 6, "weight_decay")


@query("""
with steps as (select cast(pow(2, user_id % 4) as bigint) as batch_size, value from events),
sorted as (select batch_size, list(value order by value) as v, sum(value) as total from steps group by 1)
select batch_size, len(v) as steps, v[len(v) // 2 + 1] as tpot, round(batch_size * len(v) / total, 6) as tokens_per_second,
       round(100 * (1e9 + batch_size * 1e6) / v[len(v) // 2 + 1] / 3.35e12, 9) as bandwidth_pct,
       round(100 * (batch_size * 2e12) / v[len(v) // 2 + 1] / 989e12, 9) as compute_pct, len(v) <> 2500 as early_stop from sorted""")
def latency_report(spark, sf_dir):
    steps = table(spark, sf_dir, "events").select(F.pow(F.lit(2), F.col("user_id") % 4).cast("long").alias("batch_size"), "value")
    out = runs.latency_report(
        steps, "batch_size", "value", F.lit(2500), F.lit(1e9) + F.col("batch_size") * 1e6, F.col("batch_size") * 2e12, 3.35e12, 989e12
    )
    return rounded(rounded(out, 6, "tokens_per_second"), 9, "bandwidth_pct", "compute_pct")


ROOF_FIELDS = {
    "p_partkey": "p_partkey", "peak_bandwidth": "p_retailprice * 1e9", "weight_bytes": "(p_size + 1) * 1000000", "kv_read_bytes": "p_size * 1000",
    "memory_bytes": "cast(80000000000 as bigint)", "kv_bytes_per_token": "(p_size + 3) * 64", "seq_len": "2048",
}


@query("with cards as (select " + ", ".join(f"{e} as {n}" for n, e in ROOF_FIELDS.items()) + """ from part)
select p_partkey, round(peak_bandwidth / (weight_bytes + kv_read_bytes), 6) as token_ceiling,
       ((memory_bytes - weight_bytes) // (kv_bytes_per_token * seq_len))::bigint as max_rows from cards""")
def roofline(spark, sf_dir):
    cards = table(spark, sf_dir, "part").select(*[F.expr(e).alias(n) for n, e in ROOF_FIELDS.items()])
    return rounded(runs.roofline(cards).select("p_partkey", "token_ceiling", "max_rows"), 6, "token_ceiling")


BOARD_FIELDS = "o_custkey % 10 as board, o_orderkey, o_totalprice / 500000 as score, cast(o_orderkey * 7919 % 100003 as double) as seconds"


@query(f"""
with runs as (select {BOARD_FIELDS} from orders),
eligible as (select *, min(seconds) over (partition by board order by o_orderkey rows between unbounded preceding and 1 preceding) as previous_record from runs where score > 0.25)
select board, o_orderkey, score, seconds, previous_record, round((previous_record - seconds) / previous_record * 100, 6) as gain_pct
from eligible where previous_record is null or seconds < previous_record""")
def record_progression(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(*BOARD_FIELDS.split(", "))
    return rounded(runs.record_progression(rows, "board", "o_orderkey", "score", "seconds", 0.25), 6, "gain_pct")


@query("""
select l_suppkey, count(*) as runs, round(avg(l_discount * 3), 9) as mean_score, round(max(l_discount * 3) - min(l_discount * 3), 9) as spread,
       round(avg((l_discount * 3 > 0.256525)::int), 9) as share_above from lineitem group by 1""")
def repeat_spread(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_discount") * 3).alias("score"))
    return rounded(runs.repeat_spread(rows, ["l_suppkey"], "score", 0.256525), 9, "mean_score", "spread", "share_above")


STAGES_SQL = """
wide as (select lang, (doc_id % 3) * (doc_id % 3 + 1) as stage_no, 'stage' || (doc_id % 3) * (doc_id % 3 + 1) as stage, avg(quality) * 100 as quality, avg(toxic) * 100 as toxic from documents join labels using (doc_id) group by 1, 2, 3),
long as (select lang, stage_no, stage, 'quality' as metric, quality as score from wide union all select lang, stage_no, stage, 'toxic', toxic from wide),
deltas as (select *, score - lag(score) over (partition by lang, metric order by stage_no) as change from long)"""


def staged(spark, sf_dir):
    rows = labelled(spark, sf_dir).withColumn("stage_no", (F.col("doc_id") % 3) * (F.col("doc_id") % 3 + 1))
    wide = rows.groupBy("lang", "stage_no", F.concat(F.lit("stage"), F.col("stage_no").cast("string")).alias("stage")).agg(
        (F.avg("quality") * 100).alias("quality"), (F.avg("toxic") * 100).alias("toxic")
    )
    return runs.stage_deltas(wide, "stage_no", "stage", ["quality", "toxic"], ["lang"])


@query(f"with {STAGES_SQL} select lang, stage_no, stage, metric, round(score, 6) as score, round(change, 6) as change from deltas")
def stage_deltas(spark, sf_dir):
    return rounded(staged(spark, sf_dir), 6, "score", "change").select("lang", "stage_no", "stage", "metric", "score", "change")


@query(f"with {STAGES_SQL} select lang, stage, round(quality, 6) as quality, round(toxic, 6) as toxic from wide")
def stages_wide(spark, sf_dir):
    return rounded(runs.stages_wide(staged(spark, sf_dir), ["lang", "stage"], ["quality", "toxic"]), 6, "quality", "toxic")
