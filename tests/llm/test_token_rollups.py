"""Signed batches against a dictionary that is simply updated; repeats and broken-off batches."""

import random

from pyspark.sql import functions as F

from sparkcorpus.llm.token_rollups import TokenRollup
from sparkcorpus.session import fresh_path

CHANGES = "doc_id bigint, version string, op string, n_tokens bigint, source string, lang string, seq int, sign string"


def batches(seed):
    rng = random.Random(seed)
    for _ in range(4):
        yield [
            (
                rng.choice([None, *range(12)]), rng.choice(["v1", "v2", None]), rng.choice(["insert", "revise", "delete"]),
                rng.choice([None, 0, 5, 70]), rng.choice(["a", "b", None]), rng.choice(["en", None]), i, "x",
            )
            for i in range(rng.choice([0, 5, 40]))
        ]


def expected(state):
    totals = {}
    for (_, version), (n, source, lang) in state.items():
        docs, tokens = totals.get((source, lang, version), (0, 0))
        totals[source, lang, version] = docs + 1, tokens + (n or 0)
    return totals


def shown(rollup):
    return {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_batches(spark):
    for seed in range(2):
        rollup, state = TokenRollup(spark, fresh_path(spark, "rollup")), {}
        for number, batch in enumerate(batches(seed)):
            for doc, version, op, n, source, lang, *_ in batch:
                state.pop((doc, version), None)
                if op != "delete":
                    state[doc, version] = n, source, lang
            changes = spark.createDataFrame(batch, CHANGES)
            assert rollup.commit(f"b{number}", changes)
            assert shown(rollup) == expected(state)
            assert not rollup.commit(f"b{number}", changes)
            assert shown(rollup) == expected(state)
        rollup.compact()
        assert shown(rollup) == expected(state)
        assert {(r.doc_id and int(r.doc_id), r.version): (r.n_tokens, r.source, r.lang) for r in rollup.current().collect()} == {k: (n or 0, s, l) for k, (n, s, l) in state.items()}
        live = rollup.ledger().groupBy("doc_id", "version").agg(F.sum("sign").alias("n"))
        assert {r.n for r in live.collect()} <= {0, 1}


def test_broken_off_batch_is_written_anew(spark):
    rollup = TokenRollup(spark, fresh_path(spark, "rollup"))
    one = spark.createDataFrame([(1, "v", "insert", 3, "a", "en", 0, "")], CHANGES)
    counts = one.select(F.col("doc_id").cast("string"), "version", "source", "lang", "n_tokens")
    counts.select(F.lit("b").alias("batch"), "*", F.lit(1).cast("long").alias("sign")).write.parquet(f"{rollup.folder}/ledger/b")
    counts.withColumn("bucket", F.lit(3)).write.partitionBy("bucket").parquet(f"{rollup.folder}/current/no=1")
    assert shown(rollup) == {} and rollup.ledger().count() == 0
    assert rollup.commit("b", one)
    assert shown(TokenRollup(spark, rollup.folder)) == {("a", "en", "v"): (1, 3)}
    tie = spark.createDataFrame([(1, "v", "revise", 8, "a", "en", 0, "")] * 2 + [(1, "v", "revise", 9, "b", "en", 0, "")], CHANGES)
    assert rollup.commit("c", tie)
    assert shown(rollup) == {("b", "en", "v"): (1, 9)}


def test_a_batch_touches_its_buckets_alone(spark):
    rollup = TokenRollup(spark, fresh_path(spark, "rollup"))
    many = spark.range(5000).select(F.concat(F.lit("doc-"), F.col("id").cast("string")).alias("doc_id"), F.lit("v").alias("version"), F.lit("insert").alias("op"),
                                    F.lit(2).cast("long").alias("n_tokens"), F.lit("a").alias("source"), F.lit("en").alias("lang"), F.lit(0).alias("seq"))
    assert rollup.commit("all", many)
    assert rollup.commit("few", many.limit(3).withColumn("n_tokens", F.lit(7).cast("long")))
    touched = {r.batch: len(r.buckets) for r in rollup.commits().collect()}
    assert touched["all"] == 256 and touched["few"] <= 3
    assert shown(rollup) == {("a", "en", "v"): (5000, 10015)}
    assert spark.read.parquet(f"{rollup.folder}/current/no=2").count() < 200
