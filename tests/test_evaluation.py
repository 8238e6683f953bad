import math

import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions.text import byte_ids
from sparkcorpus.operators import prompts, rollouts, scoring


def mc_items(spark, n=12):
    rows = [(i, f"question {i}", [f"right {i}", "wrong", "rig"], i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "idx long, query string, choices array<string>, gold int")


def test_fewshot(spark):
    items = mc_items(spark)
    shots = {}
    for r in prompts.sample_fewshot(items.repartition(3), "idx", 4).orderBy("idx", "shot_no").collect():
        shots.setdefault(r.idx, []).append(r.shot_idx)
    assert all(len(set(s)) == 4 and i not in s and max(s) < 12 for i, s in shots.items()) and len(shots) == 12
    assert len({tuple(s) for s in shots.values()}) > 6
    everyone = prompts.sample_fewshot(items, "idx", 11)  # needs more draws than the first round makes
    assert everyone.groupBy("idx").agg(F.countDistinct("shot_idx").alias("n")).filter("n <> 11").count() == 0
    with pytest.raises(ValueError):
        prompts.sample_fewshot(items, "idx", 12)


def test_prompts(spark):
    items = prompts.attach_shots(mc_items(spark), "idx", prompts.sample_fewshot(mc_items(spark), "idx", 2), ["query", "choices", "gold"])
    row = prompts.render_mc_prompts(items, " A: ").filter("idx = 5").first()
    head = "".join(f"{s.query} A: {s.choices[s.gold]}\n\n" for s in row.shots)
    assert list(row.prompts) == [f"{head}question 5 A: {c}" for c in row.choices] and len(row.shots) == 2
    none = prompts.attach_shots(mc_items(spark), "idx", prompts.sample_fewshot(mc_items(spark), "idx", 2).limit(0), ["query", "choices", "gold"])
    assert prompts.render_mc_prompts(none, " ").filter("idx = 1").first().prompts[1] == "question 1 wrong"
    lm = spark.createDataFrame([(0, " ctx \n", " word", [])], "idx long, context string, continuation string, shots array<struct<shot_no:int,context:string,continuation:string>>")
    assert list(prompts.render_lm_prompts(lm, " ").first().prompts) == ["ctx", "ctx  word"]


def spans_of(spark, texts, kind):
    df = spark.createDataFrame([(0, texts)], "idx long, prompts array<string>")
    return prompts.answer_spans(prompts.encode_prompts(df, 256), kind)


def test_spans(spark):
    row = spans_of(spark, ["ab cat", "ab car", "ab c"], "multiple_choice").first()
    assert [(s.start, s.end) for s in row.spans] == [(5, 7), (5, 7), (5, 5)]
    row = spans_of(spark, ["xx tail", "yyy tail"], "schema").first()
    assert [(s.start, s.end) for s in row.spans] == [(3, 8), (4, 9)]
    row = spans_of(spark, ["same", "same"], "schema").first()
    assert [(s.start, s.end) for s in row.spans] == [(0, 5), (0, 5)]
    row = spans_of(spark, ["the", "the end"], "language_modeling").first()
    assert [(s.start, s.end) for s in row.spans] == [(4, 8)] and row.fault is None
    assert spans_of(spark, ["thy", "the end"], "language_modeling").first().fault == "not_a_prefix"
    assert spans_of(spark, ["the", "the"], "language_modeling").first().fault == "not_a_prefix"


def test_cropping(spark):
    cropped = prompts.crop_spans(spans_of(spark, ["ab cat", "ab cab"], "multiple_choice"), 4).collect()
    assert [(r.start, r.end, len(r.ids), r.fault) for r in cropped] == [(3, 4, 4, None), (3, 4, 4, None)]
    assert list(cropped[0].ids) == list(b" cat")
    cut = prompts.crop_spans(spans_of(spark, ["a long one", "b long one"], "schema"), 3).first()
    assert cut.fault == "span_cut_off"


def test_option_scores_take_the_first_minimum(spark):
    rows = [(0, o, ls, 2, 4, 1) for o, ls in enumerate([[9.0, 2.0, 2.0], [9.0, 1.0, 1.0], [0.0, 1.0, 1.0]])]
    rows += [(1, 0, [1.0, 5.0], 1, 3, 0), (1, 1, [None, 4.0], 1, 3, 0), (1, 2, [0.0], 1, 1, 0), (2, 0, [], 1, 3, 0)]
    options = spark.createDataFrame(rows, "idx long, option int, losses array<double>, start int, end int, gold int")
    scored = scoring.score_options(options, ["idx"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_min" in plan[plan.index("Exchange") :]  # a number per option moves, no token
    assert {r.idx: (r.predicted, r.best_loss, r.correct) for r in scored.collect()} == {0: (1, 1.0, True), 1: (0, 3.0, True)}


def test_alignment(spark):
    row = scoring.align_losses(spark.createDataFrame([([7, 8, 9], [1.0, 2.0, 3.0])], "ids array<int>, l array<double>"), "ids", "l").first()
    assert [tuple(a) for a in row.aligned] == [(8, 1.0), (9, 2.0), (None, None)]


def test_missing_answers_count_as_equal(spark):
    df = spark.createDataFrame([("none", "none"), ("#### 5", "none"), ("#### 1,000", "#### 1000"), ("#### 5", "it is 5")], "ref string, out string")
    rows = scoring.format_diagnostics(df, "ref", "out").collect()
    assert [r.correct for r in rows] == [True, False, True, False]
    assert [r.format_only_failure for r in rows] == [False, False, False, True]
    total = scoring.diagnostics_summary(scoring.format_diagnostics(df, "ref", "out")).first()
    assert (total.responses, total.correct, total.unparsed, total.format_only) == (4, 2, 3, 1)


def test_bits_per_byte(spark):
    lengths = spark.createDataFrame([(0, 1), (1, 3), (2, 0)], "token_id int, n_bytes int")
    losses = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 50.0), ("a", -1, 99.0), ("b", 2, 1.0)], "g string, target_id int, loss double")
    out = {r.g: (r.nats, r.n_bytes, r.bpb) for r in scoring.bits_per_byte(losses, lengths, ["g"]).collect()}
    assert out["a"] == (3.0, 4, pytest.approx(3.0 / (math.log(2) * 4)))
    assert out["b"][2] == float("inf")
    summary = {r.g: r for r in scoring.loss_summary(losses.union(spark.createDataFrame([("a", 0, float("nan"))])), lengths, ["g"]).collect()}
    assert summary["a"].bad_losses == 1 and summary["a"].mean_loss == pytest.approx(53 / 3) and summary["a"].n_bytes == 4


def test_composite_needs_every_task(spark):
    required = spark.createDataFrame([("x", 0.25, True), ("y", 0.0, False)], "label string, random_baseline double, categorical boolean")
    scores = spark.createDataFrame([(1, "x", 1.0), (1, "y", 0.5), (2, "x", 0.25)], "run int, label string, accuracy double")
    out = {r.run: (r.composite, r.composite_cat) for r in scoring.composite_score(scores, required, ["run"]).collect()}
    assert out == {1: (0.75, 1.0), 2: (None, 0.0)}


def test_pass_curve(spark):
    df = spark.createDataFrame([("a", 1, False), ("a", 2, True), ("b", 1, False), ("b", 2, False), ("c", 1, True)], "p string, n long, correct boolean")
    curve = {r.k: r.pass_rate for r in rollouts.pass_at_k(df, "p", "n", 3).collect()}
    assert curve == {1: pytest.approx(1 / 3), 2: pytest.approx(2 / 3), 3: pytest.approx(2 / 3)}


def test_truncation_and_letters(spark):
    df = spark.createDataFrame([([1, 260, 2],), ([256, 1],), ([1, 2],), ([3, 256, 260],)], "ids array<int>")
    rows = rollouts.truncate_completions(df, "ids").collect()
    assert [(list(r.kept), r.stop_reason) for r in rows] == [([1], "assistant_end"), ([], "bos"), ([1, 2], "max_new_tokens"), ([3], "bos")]
    pick = spark.createDataFrame([([0.1, 0.9, 0.9, 5.0], [0, 1, 2])], "s array<double>, a array<int>")
    assert scoring.choose_letter(pick, "s", "a").first().chosen == 1


def test_tool_spans(spark):
    ids = [9, 261, 1, 261, 2, 3, 262, 263, 4, 264, 262, 261, 5]
    mask = [1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 1, 1, 1]
    df = spark.createDataFrame([(0, ids, mask)], "i int, ids array<int>, mask array<int>")
    rows = rollouts.extract_tool_spans(df, ["i"], "ids", "mask").orderBy("start").collect()
    assert [(r.kind, r.start, r.end, list(r.span_ids), r.sampled, r.forced_tokens) for r in rows] == [
        ("python", 3, 6, [2, 3], 2, 3), ("output", 7, 9, [4], 0, 3),
    ]


def test_outcomes(spark):
    df = spark.createDataFrame(
        [(0, "", "", False), (1, "", "", False), (1, "", "Trace\n  x\nMemoryError\n", False), (0, "", "MemoryError", True)],
        "returncode int, stdout string, stderr string, timed_out boolean",
    )
    rows = rollouts.classify_outcomes(df).collect()
    assert [(r.success, r.error, r.timeout, r.memory_exceeded) for r in rows] == [
        (True, None, False, False), (False, "Execution failed", False, False), (False, "MemoryError", False, True),
        (False, "Execution timed out (process killed)", True, False),
    ]


def test_top_k(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0, 2.0],)], "s array<double>")
    first = lambda **kw: rollouts.topk_softmax(df, "s", **kw).first()
    assert [t.idx for t in first(k=3, temperature=1.0).top] == [1, 2, 3]
    assert [(t.idx, t.p) for t in first(k=None, temperature=0.0).top] == [(1, 1.0)]
    everything = first(k=0, temperature=2.0, key=F.lit("x"))
    assert len(everything.top) == 4 and sum(t.p for t in everything.top) == pytest.approx(1.0)
    assert everything.top[0].p / everything.top[3].p == pytest.approx(math.exp((3.0 - 1.0) / 2.0))
    many = rollouts.topk_softmax(spark.range(4000).withColumn("s", F.array(F.lit(0.0), F.lit(math.log(3.0)))), "s", None, 1.0, F.col("id").cast("string"))
    assert many.filter("picked = 1").count() / 4000 == pytest.approx(0.75, abs=0.03)
    with pytest.raises(ValueError):
        first(k=1, temperature=-1.0)


def test_rollout_targets(spark):
    df = spark.createDataFrame([(0, [1, 2, 3], [0, 0, 1]), (0, [4, 5], [0, 1])], "b int, ids array<int>, mask array<int>")
    rows = sorted((list(r.inputs), list(r.targets)) for r in rollouts.rollout_targets(df, ["b"], "ids", "mask", 256).collect())
    assert rows == [([1, 2], [-1, 3]), ([4, 5], [5, -1])]


def test_graders_can_be_added(spark):
    scoring.register_grader("exact", lambda df, a, c: df.withColumn("correct", F.col(a) == F.col(c)))
    df = spark.createDataFrame([("x", "x")], "a string, c string")
    assert scoring.grade("exact", df, "a", "c").first().correct
