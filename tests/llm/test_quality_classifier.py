"""Held-out accuracy of the classifier; odd rows and labels."""

import numpy as np
from pyspark.sql import functions as F

from sparkcorpus.llm import quality_classifier as qc
from sparkcorpus.llm.queries import op8_quality_classifier

DOCS, LABELS = "doc_id bigint, text string, lang string, source string, quality string", "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = labels.filter("doc_id % 4 = 0")
    models = qc.fit(docs, labels.filter("doc_id % 4 <> 0"), ["quality", "toxic"])
    scored = docs.join(unseen, "doc_id").select("quality", "toxic", qc.scores(models, "text", "source", "lang").alias("s"))
    rows = scored.select("quality", "toxic", F.col("s.quality").alias("q"), F.col("s.toxic").alias("t")).collect()
    accuracy = [np.mean([(r.q >= 0.5) == r.quality for r in rows]), np.mean([(r.t >= 0.5) == r.toxic for r in rows])]
    toxic = [r.t >= 0.5 for r in rows if r.toxic]
    clean = [r.t >= 0.5 for r in rows if not r.toxic]
    assert min(accuracy) > 0.97 and np.mean(toxic) > 0.9 and np.mean(clean) < 0.01, (accuracy, np.mean(toxic), np.mean(clean))


def test_views_teach_each_other(spark):
    """Few labels: words that labelled documents lack are learnt through the layout, which alone tells the class at first."""
    rng = np.random.default_rng(0)
    kinds = rng.integers(0, 2, 600)
    texts = [f"w{i % 8} w{rng.integers(9)}" if i < 60 else f"{'badword' if y else 'goodword'} w{rng.integers(9)}" for i, y in enumerate(kinds)]
    docs = spark.createDataFrame([(i, t, "en", "sour" if y else "sweet", "x") for i, (t, y) in enumerate(zip(texts, kinds))], DOCS)
    labels = spark.createDataFrame([(i, int(kinds[i]), None) for i in range(60)], LABELS)
    weight = lambda m, word: m.dense()[qc.traits(word)[0]]
    alone, taught = (qc.fit(docs, labels, ["quality", "toxic"], rounds=r)["quality"] for r in (0, 3))
    assert weight(alone, "badword") == weight(alone, "goodword") == 0
    assert weight(taught, "badword") > 0 > weight(taught, "goodword")
    got = docs.filter("doc_id >= 60").select("doc_id", qc.scores({"quality": taught}, "text", "source", "lang")["quality"].alias("p")).collect()
    assert np.mean([(r.p >= 0.5) == kinds[r.doc_id] for r in got]) > 0.95


def test_sums_of_a_round_equal_plain_sums(spark):
    """Pseudo-labels, counts, gradient and bound of one round against loops over documents."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta!!", "al"], rng.integers(0, 9))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t or None, "en", "s%d" % (i % 3), "x") for i, t in enumerate(texts)], DOCS).repartition(3)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(0, 80, 4)] + [(0, 1, None)], LABELS)
    views = qc.document_views(docs, labels, ["quality", "toxic"])
    columns = np.array(sorted({*qc.traits("alpha"), *qc.traits("beta")}))
    model = qc.Model(columns, rng.normal(size=len(columns)), 0.3, rng.normal(size=qc._SIZE), np.array([[0.1, 0.9], [-0.2, 0.7]]), np.zeros(3))
    want = {}
    add = lambda key, a, b=0.0: want.__setitem__(key, np.add(want.get(key, (0.0, 0.0)), (a, b)))
    sure = lambda logit: 1 if 1 / (1 + np.exp(-logit)) >= 0.7 else 0 if 1 / (1 + np.exp(-logit)) <= 0.3 else -1
    for r in views.collect():
        times = {}
        for word, n in zip(r.words, r.times):
            for t in qc.traits(word):
                times[t] = times.get(t, 0) + n
        found = [*times, *(t + qc.SPACE for t, n in times.items() if n >= 2)]
        x = np.zeros(qc._SIZE)
        x[: len(r.layout)] = np.clip(r.layout, -10, 10)
        x[len(r.layout) + r.source] = x[len(r.layout) + 64 + r.lang] = 1
        weights = dict(zip(model.columns.tolist(), model.weights))
        logits = model.offset + sum(weights.get(f, 0) for f in found), x @ model.layout
        logits = [a + b * np.clip(v, -15, 15) for v, (a, b) in zip(logits, model.calibration)]
        by_text, by_layout = ((-1 if r.held else r.quality) if r.quality is not None else sure(v) for v in logits)
        if by_layout >= 0:
            for f in [*found, 2 * qc.SPACE]:
                add(f, float(by_layout == 0), float(by_layout == 1))
        if by_text >= 0:
            p = 1 / (1 + np.exp(-x @ model.layout))
            for i in np.flatnonzero(x):
                add((0, int(i)), x[i] * (p - by_text))
                for j in np.flatnonzero(x):
                    add((1 + int(i), int(j)), x[i] * x[j] / 4)
    counts, sums = qc.round_sums(views, ["quality", "toxic"], [model, None], 0.7)
    got = {int(f): counts[0, :, f] for f in np.flatnonzero(counts[0].any(0))} | {(int(i), int(j)): (sums[0, i, j], 0) for i, j in zip(*np.nonzero(sums[0]))}
    assert not counts[1].any() and not sums[1].any()
    assert {k for k, v in want.items() if any(v)} >= set(got) and all(np.allclose(got.get(k, (0, 0)), v, atol=1e-9) for k, v in want.items())
    assert sum(r.quality is not None for r in views.collect()) == 20 and {r.id: r.quality for r in views.collect()}[0] == 1


def test_odd_rows(spark):
    rows = [(1, None, None, None, "x"), (None, "", "en", "a", "x"), (1, "word " * 9, "en", "a", None), (2, "é" * 50_000, "fr", None, "x")] * 2
    docs = spark.createDataFrame(rows, DOCS)
    cases = {(): 0.5, ((1, 1, None),): 1.0, ((1, 1, 0), (2, 1, 0), (None, 0, 0)): 1.0, ((7, 0, 1),): 0.5}
    for labels, share in cases.items():
        models = qc.fit(docs, spark.createDataFrame(list(labels), LABELS), ["quality", "toxic"])
        got = docs.select("*", qc.scores(models, "text", "source", "lang").alias("s")).collect()
        assert len(got) == len(rows) and all(abs(r.s.quality - share) < 1e-6 for r in got), labels
    assert docs.limit(0).select(qc.scores(models, "text", "source", "lang")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op8_quality_classifier(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == 1000 and all(0 <= r.quality_score <= 1 and 0 <= r.toxic_score <= 1 for r in got.values())
    assert np.mean([(got[x.doc_id].toxic == bool(x.toxic)) for x in labels]) > 0.97
    assert all(r.kept == (r.quality_score >= 0.5 and not r.toxic) for r in got.values())
