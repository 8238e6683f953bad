"""Targets, epochs and weighted choice against plain sums; odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkcorpus.llm import source_mixing as mix
from sparkcorpus.llm.common import numbered, sums_before, word_count


def plain_targets(sizes, weights, share, most):
    left = share * sum(sizes.values())
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target = {}
    while True:
        free = [s for s in sizes if s not in target]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]] if free else []
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1, None: 50}, {"x": 0, "y": 7}, {f"s{i}": (i * 37) % 91 for i in range(40)}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "_source string, source_size bigint")
    got = {r._source: r.target for r in mix.source_targets(rows, (5, 2, 1), 1.5, 2.0).collect()}
    assert got == pytest.approx(plain_targets(sizes, (5, 2, 1), 1.5, 2.0))


def test_mix(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        text = rng.choice([None, "", *([" ".join("w" * rng.randint(1, 30))] * 6)])
        rows.append((i, text, rng.choice(["hot"] * 5 + ["b", "c", None]), 1))
    rows += [rows[0], (None, "null id", "b", 1), (None, "null id", "b", 1), (None, "other", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    make = lambda: mix.mix(docs, word_count("text"), F.lit(1.0), (5, 2, 1), 1.5).collect()
    got = make()
    assert sorted(map(str, got)) == sorted(map(str, make())) and len(got) == len(rows)
    for source in {r.row.source for r in got}:
        mine = [r for r in got if r.row.source == source]
        assert mine[0].source_size == sum(r.size for r in mine)
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= max(r.size for r in mine)
        epochs = int(mine[0].target // mine[0].source_size)
        assert {r.copies for r in mine if r["size"]} <= {epochs, epochs + 1}
        assert all(r.copies == 0 for r in mine if not r["size"])
    assert mix.mix(docs.limit(0), word_count("text"), F.lit(1.0), (5, 2, 1), 1.5).count() == 0


def test_heavier_documents_come_first(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("one").alias("text"))
    quality = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = mix.mix(docs, word_count("text"), quality, (1,), 0.2)
    even, odd = [got.filter(f"row.doc_id % 2 = {i}").agg(F.sum("copies")).first()[0] for i in (0, 1)]
    assert even + odd == 800 and 2.5 < even / odd < 5
    assert got.agg(F.max("target")).first()[0] == 800


def test_global_order_helpers(spark):
    rows = [(rng.choice(["x", "y", None]), rng.randint(0, 50), i) for rng in [random.Random(1)] for i in range(300)]
    df = spark.createDataFrame(rows, "by string, k int, v bigint")
    got = [(r.by, r.k, r.v, r.before) for r in sums_before(df, "by", [F.col("k"), F.col("v")], "v", "before").collect()]
    want = []
    for by in ("x", "y", None):
        total = 0
        for b, k, v in sorted((r for r in rows if r[0] == by), key=lambda r: r[1:]):
            want.append((b, k, v, total))
            total += v
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sorted((r.v, r.at) for r in numbered(df, [F.col("v")], "at").collect()) == [(i, i) for i in range(300)]
