import random

import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions import chat
from sparkcorpus.functions.chat import SPECIAL_TOKENS
from sparkcorpus.operators import conversations as conv, rendering, rollouts, tokenization as tok

ARGS = ("conv", "turn", "role", "text")


@pytest.fixture(scope="module")
def turns(spark):
    rng, rows = random.Random(2), []
    for c in range(40):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(1, 4) + (["user"] if c % 5 == 0 else [])
        if c % 11 == 0:
            roles.reverse()
        rows += [(c, t * 3, r, "".join(rng.choices("ab é你\n", k=rng.choice([0, 1, 7, 30, 300])))) for t, r in enumerate(roles)]
    rows += [(90, 0, "system", "alone"), (91, 0, "user", None), (91, 1, "assistant", "x"), (92, 0, "user", "q"), (92, 1, "assistant", None), (93, 0, "tool", "z")]
    return spark.createDataFrame(rows, "conv int, turn int, role string, text string").cache()


def records(turns):
    return conv.validate_conversations(conv.assemble_conversations(turns, *ARGS)).filter("render_reason is null")


def ids_of(df, key="conv"):
    return {r[key]: (list(r.ids), list(r["mask"]) if "mask" in df.columns else None) for r in df.collect()}


@pytest.mark.parametrize("most", [2, 40, 5000])
def test_heads_equal_rendering_of_records(turns, most):
    r = records(turns).select("conv", chat.rendered(chat.render_segments(F.col("messages")), most).alias("r")).select("conv", "r.*")
    assert ids_of(rendering.render_heads(rendering.place_turns(turns, *ARGS), most)) == ids_of(r)


def test_prompts_equal_prompts_of_records(turns):
    good = records(turns).filter("element_at(messages, -1).role = 'assistant'")
    want = ids_of(good.select("conv", chat.prompt_ids(F.col("messages"), 50).alias("ids")))
    assert ids_of(rendering.completion_prompts(rendering.place_turns(turns, *ARGS, last=False), 50)) == want
    every = conv.assemble_conversations(turns, *ARGS).filter(F.exists("messages", lambda m: m["role"].isin("user", "assistant")))
    every = every.select("conv", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.coalesce(m["content"], F.lit("")).alias("content"), m["parts"].alias("parts"))).alias("messages"))
    want = ids_of(every.select("conv", chat.prompt_ids(F.col("messages"), 0, strict=False).alias("ids")))
    got = {}
    for r in sorted(rendering.serving_prompts(rendering.place_turns(turns, *ARGS, strict=False), block=16).collect(), key=lambda r: r.start):
        assert len(r.ids) <= 16 and r.start == len(got.setdefault(r.conv, []))
        got[r.conv] += r.ids
    assert got == {c: ids for c, (ids, _) in want.items()}


def test_trained_ids_equal_encoded_segments(spark, turns):
    texts = rendering.body_turns(turns, *ARGS)
    ranks = tok.train_bpe(tok.pretoken_counts(texts), 256 + 12 + len(SPECIAL_TOKENS))
    size = ranks.count()
    segments = records(turns).select("conv", chat.render_segments(F.col("messages")).alias("segments"))
    want = tok.encode_segments(segments, ranks).select("conv", chat.rendered(F.col("segments"), 70, F.col("encoded"), size).alias("r")).select("conv", "r.*")
    assert ids_of(rendering.render_heads(rendering.place_turns(turns, *ARGS, ranks=ranks), 70, size)) == ids_of(want)


@pytest.mark.parametrize("block", [3, 100_000])
def test_truncation_equals_truncation_of_records(turns, block):
    whole = records(turns).select("conv", chat.rendered(chat.render_segments(F.col("messages")), 2**20)["ids"].alias("ids"))
    whole = whole.withColumn("ids", F.slice("ids", F.lit(2), F.size("ids")))
    want = {r.conv: (list(r.kept), r.stop_reason) for r in rollouts.truncate_completions(whole, "ids").collect()}
    got = {}
    out = rendering.truncate_blocks(rendering.token_blocks(rendering.place_turns(turns, *ARGS), block=block))
    for r in sorted(out.collect(), key=lambda r: r.start):
        kept, _ = got.get(r.conv, ([], None))
        got[r.conv] = (kept + list(r.kept), r.stop_reason)
    assert got == want


def test_request_rules_on_turns(spark, turns):
    long = spark.createDataFrame([(200, i, "user", "x" * 7000) for i in range(5)] + [(201, 0, "user", "x" * 8001), (202, 0, "bot", "y")] + [(203, i, "user", "z") for i in range(501)], turns.schema)
    rows = turns.union(long)
    params = [F.lit(v).alias(n) for n, v in (("temperature", 0.5), ("top_k", 10), ("max_tokens", 5))]
    built = conv.assemble_conversations(rows, *ARGS).select("conv", "messages", *params)
    want = {r.conv: r.reason for r in conv.validate_requests(built).collect()} | {300: "no_messages"}
    asked = rows.select("conv").distinct().union(spark.createDataFrame([(300,)], "conv int")).select(F.col("conv").alias("request_id"), *params)
    assert {r.request_id: r.reason for r in rendering.validate_request_turns(rows, asked, *ARGS).collect()} == want
    assert {want[c] for c in (200, 201, 202, 203)} == {"too_long", "long_message:0", "bad_role:0", "too_many_messages"}


def test_a_conversation_of_a_million_turns(spark):
    n = 1_000_000
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    rows = spark.range(n).select(F.lit(1).alias("conv"), F.col("id").alias("turn"), role.alias("role"), F.lit("word").alias("text"))
    total = rendering.serving_prompts(rendering.place_turns(rows, *ARGS, strict=False)).agg(F.sum(F.size("ids")), F.count("*"), F.max(F.size("ids"))).first()
    assert tuple(total) == (6 * n + 2, n + 2, 6)
    head = rendering.render_heads(rendering.place_turns(rows, *ARGS), 2048).first()
    assert len(head.ids) == 2048 and list(head.ids[:3]) == [256, 257, 119]
    parts = conv.assemble_parts(rows, *ARGS, turns_per_part=4096)
    assert parts.agg(F.count("*"), F.max(F.size("messages"))).first() == (245, 4096)
    asked = spark.createDataFrame([(1, 0.5, 5, 5)], "request_id int, temperature double, top_k int, max_tokens int")
    assert rendering.validate_request_turns(rows, asked, *ARGS).first().reason == "too_many_messages"
