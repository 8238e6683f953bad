import random

import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions.keys import hex_bucket, shuffle_key, width_bucket
from sparkcorpus.operators import ordering, rollouts, sampling


def test_prefix_sums_per_group_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(9)}", i, rng.randrange(100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(5)
    out = ordering.prefix_sums(df, ["k"], width_bucket(F.col("k"), 64), {"before": F.col("v"), "n": F.lit(1).cast("long")}, ["g"])
    running, expected = {}, {}
    for g, k, v in rows:
        total, n = running.get(g, (0, 0))
        expected[(g, k)] = (total, n)
        running[g] = (total + v, n + 1)
    assert {(r.g, r.k): (r.before, r.n) for r in out.collect()} == expected


def test_shuffle_depends_on_seed_and_key_only(spark):
    df = spark.range(500).withColumnRenamed("id", "doc")
    one = {r.doc: r.shuffled_pos for r in ordering.seeded_shuffle(df, 42, "doc").collect()}
    two = {r.doc: r.shuffled_pos for r in ordering.seeded_shuffle(df.orderBy(F.desc("doc")).repartition(7), 42, "doc").collect()}
    other = {r.doc: r.shuffled_pos for r in ordering.seeded_shuffle(df, 43, "doc").collect()}
    assert one == two and one != other
    assert sorted(one.values()) == list(range(500))


def test_shuffled_layout_has_the_same_order(spark):
    df = spark.range(300).withColumnRenamed("id", "doc")
    order = [r.doc for r in ordering.seeded_shuffle(df, 7, "doc").orderBy("shuffled_pos").collect()]
    assert [r.doc for r in ordering.shuffled_layout(df, 7, "doc", 3).collect()] == order


@pytest.mark.parametrize("start, stop, step, want", [(0, None, 1, range(10)), (5, 10, 1, range(5, 10)), (0, 10, 3, [0, 3, 6, 9])])
def test_slices(spark, start, stop, step, want):
    df = spark.range(10).select(F.col("id").alias("i"), F.col("id").alias("pos"))
    rows = sorted((r.pos, r.i) for r in ordering.slice_rows(df, "pos", start, stop, step).collect())
    assert rows == list(enumerate(want))


def test_slice_arguments(spark):
    with pytest.raises(ValueError):
        ordering.slice_rows(spark.range(3), "id", 5, 2)


def test_first_n_per_group_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", (i * 7919) % 4001, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g string, o long, i long")
    got = {(r.g, r.o) for r in ordering.first_n_per_group(df, ["g"], ["o"], 12, spread="i").collect()}
    want = {(g, o) for g in {r[0] for r in rows} for o in sorted(r[1] for r in rows if r[0] == g)[:12]}
    assert got == want


def test_group_values_by_either_join(spark):
    rows = [("hot" if i % 2 else f"g{i % 50}" if i % 3 else None, float(i % 13)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, reward double")
    small = sorted(map(str, rollouts.advantages(df, ["g"]).collect()))
    assert len(small) == len(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, rollouts.advantages(df, ["g"]).collect())) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_groups_stay(spark):
    rows = [(None, 1, 5), (None, 2, 3), ("a", 1, 7), ("a", 3, 2)]
    df = spark.createDataFrame(rows, "g string, k long, v long")
    out = ordering.prefix_sums(df, ["k"], width_bucket(F.col("k"), 2), {"before": F.col("v")}, ["g"])
    assert {(r.g, r.k): r.before for r in out.collect()} == {(None, 1): 0, (None, 2): 5, ("a", 1): 0, ("a", 3): 7}
    low = ordering.running_min(df, ["k"], width_bucket(F.col("k"), 2), "v", "low", ["g"])
    assert {(r.g, r.k): r.low for r in low.collect()} == {(None, 1): 5, (None, 2): 3, ("a", 1): 7, ("a", 3): 2}


def test_running_min(spark):
    rng = random.Random(3)
    rows = [(f"r{rng.randrange(3)}", i, rng.random()) for i in range(800)]
    df = spark.createDataFrame(rows, "run string, step long, v double")
    got = {(r.run, r.step): r.low for r in ordering.running_min(df, ["step"], width_bucket(F.col("step"), 16), "v", "low", ["run"]).collect()}
    low, want = {}, {}
    for run, step, v in rows:
        low[run] = min(low.get(run, v), v)
        want[(run, step)] = low[run]
    assert got == want


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "pos long, text string").repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_char_budget_equals_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    texts = ["x" * rng.randrange(0, 30) for _ in range(60)]
    budget = rng.randrange(0, 1200)
    want, seen = [], 0
    for i, text in enumerate(texts):
        seen += len(text)
        want.append(i)
        if seen > budget:
            break
    kept = sampling.char_budget(corpus(spark, texts), ["pos"], width_bucket(F.col("pos"), 8), budget)
    assert sorted(r.pos for r in kept.collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_byte_budget_equals_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice("aé你🙂") for _ in range(rng.randrange(0, 12))) for _ in range(50)]
    target = rng.randrange(1, sum(len(t.encode()) for t in texts))
    want, used = [], 0
    for i, text in enumerate(texts):
        raw = text.encode()
        if not raw:
            continue
        cut = raw[: target - used].decode("utf-8", "ignore")
        if cut:
            want.append((i, cut))
        used += len(cut.encode())
        if used == target or cut != text:
            break
    kept = sampling.byte_budget(corpus(spark, texts), ["pos"], width_bucket(F.col("pos"), 8), target)
    assert sorted((r.pos, r.text) for r in kept.collect()) == want


def test_byte_budget_needs_enough_text(spark):
    texts = corpus(spark, ["ab", "", "你"])
    assert sampling.byte_budget(texts, ["pos"], F.lit(0), 8).count() == 2
    with pytest.raises(ValueError):
        sampling.byte_budget(texts, ["pos"], F.lit(0), 9)


def test_manifest_digest_ignores_layout_and_sees_changes(spark):
    df = corpus(spark, ["one", "two", "three", "four"]).withColumn("source", F.lit("s"))
    digest = lambda d: sampling.sample_manifest(d, "pos", "source", 10).first()["digest"]
    assert digest(df) == digest(df.repartition(1)) != digest(df.withColumn("text", F.upper("text")))


def test_buckets_follow_the_key(spark):
    df = spark.range(2000).withColumn("k", shuffle_key(1, "id"))
    buckets = [r.b for r in df.withColumn("b", hex_bucket(F.col("k"), 2)).orderBy("k").collect()]
    assert buckets == sorted(buckets) and max(buckets) <= 255


def test_buckets_follow_the_rows(spark):
    from sparkcorpus.functions.keys import key_digits

    for rows in (500, 2000):
        df = spark.range(rows)
        digits = key_digits(rows, 40)
        sizes = df.groupBy(hex_bucket(shuffle_key(7, "id"), digits)).count().agg(F.max("count")).first()[0]
        assert sizes <= 80
        wide, narrow = (ordering.seeded_shuffle(df, 7, "id", per_bucket=n).collect() for n in (40, 10**6))
        assert sorted(wide) == sorted(narrow)
        assert sorted(r.shuffled_pos for r in wide) == list(range(rows))
