import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions import chat, text as tx
from sparkcorpus.operators import conversations as conv
from sparkcorpus.operators import tokenization as tok

SPECIAL = {name[2:-2]: 256 + i for i, name in enumerate(chat.SPECIAL_TOKENS)}


def chats(spark, *lists):
    rows = [(i, [(r, c if isinstance(c, str) else None, None if isinstance(c, str) else c) for r, c in m]) for i, m in enumerate(lists)]
    return spark.createDataFrame(rows, f"conv_id long, messages array<{chat.MESSAGE_TYPE}>")


def render(spark, messages, max_tokens=2048):
    df = chats(spark, messages)
    row = df.select(chat.rendered(chat.render_segments(F.col("messages")), max_tokens).alias("r")).first().r
    return list(row.ids), list(row.mask)


def b(text):
    return list(text.encode())


def test_plain_chat_masks(spark):
    ids, mask = render(spark, [("user", "hi"), ("assistant", "yo é")])
    want = [256, 257, *b("hi"), 258, 259, *b("yo é"), 260]
    assert ids == want
    assert mask == [0] * 6 + [1] * (len(b("yo é")) + 1)


def test_system_is_merged(spark):
    merged = render(spark, [("system", "be brief"), ("user", "hi"), ("assistant", "ok")])
    assert merged == render(spark, [("user", "be brief\n\nhi"), ("assistant", "ok")])


def test_tool_parts(spark):
    parts = [("text", "a "), ("python", "1+1"), ("python_output", "2"), ("text", "!")]
    ids, mask = render(spark, [("user", "q"), ("assistant", parts)])
    tail = [259, *b("a "), 261, *b("1+1"), 262, 263, *b("2"), 264, *b("!"), 260]
    assert ids[4:] == tail
    assert mask[4:] == [0, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 1, 1]


def test_truncation_and_prompt(spark):
    messages = [("user", "x" * 50), ("assistant", "secret")]
    ids, mask = render(spark, messages, 32)
    assert len(ids) == len(mask) == 32
    df = chats(spark, messages)
    prompt = df.select(chat.prompt_ids(F.col("messages"), 2048).alias("p"), chat.prompt_ids(F.col("messages"), 10).alias("short")).first()
    assert prompt.p[-1] == SPECIAL["assistant_start"] and len(prompt.p) == 54 and len(prompt.short) == 11
    serving = df.select(chat.prompt_ids(F.col("messages"), 0, strict=False).alias("p")).first().p
    assert serving[-1] == 259 and serving[-2] == 260 and b("secret") == serving[-8:-2]


def test_rendering_with_a_trained_vocabulary(spark):
    docs = spark.createDataFrame([("hello hello hello world",)], "text string")
    ranks = tok.train_bpe(tok.pretoken_counts(docs), 256 + 9 + 10)
    size = ranks.count()
    df = chats(spark, [("user", "hello"), ("assistant", "world")]).withColumn("segments", chat.render_segments(F.col("messages")))
    out = tok.encode_segments(df, ranks).select(chat.rendered(F.col("segments"), 99, F.col("encoded"), size).alias("r")).first().r
    words = {r.word: list(r.ids) for r in tok.encode_words(spark.createDataFrame([("hello",), ("world",)], "word string"), ranks).collect()}
    assert list(out.ids) == [size, size + 1, *words["hello"], size + 2, size + 3, *words["world"], size + 4]
    assert list(out.mask) == [0] * (4 + len(words["hello"])) + [1] * (len(words["world"]) + 1)


CASES = [
    ([("user", "a"), ("assistant", "b")], None, None),
    ([("system", "s"), ("user", "a"), ("assistant", "b")], None, None),
    ([("user", "a")], "too_short", None),
    ([("system", "s"), ("user", "a")], "too_short", None),
    ([("system", "s"), ("assistant", "a"), ("user", "b")], "bad_alternation", "system_without_user"),
    ([("system", "s")], "too_short", "system_without_user"),
    ([("user", "a"), ("user", "b")], "bad_alternation", "bad_alternation"),
    ([("assistant", "a"), ("user", "b")], "bad_alternation", "bad_alternation"),
]


def test_validation_on_records_and_on_turns(spark):
    df = chats(spark, *[c[0] for c in CASES])
    nested = {r.conv_id: (r.chat_reason, r.render_reason) for r in conv.validate_conversations(df).collect()}
    turns = df.select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", "m.role", F.col("m.content").alias("text"))
    flat = {r.conv_id: (r.chat_reason, r.render_reason) for r in conv.validate_turns(turns, "conv_id", "turn", "role", "text").collect()}
    want = {i: c[1:] for i, c in enumerate(CASES)}
    assert nested == want and flat == want
    good, bad = conv.split_valid(conv.validate_conversations(df))
    assert good.count() == 2 and bad.count() == len(CASES) - 2


def test_heads_are_enough_for_truncated_rendering(spark):
    long = [("system", "s" * 400)] + [("user" if i % 2 == 0 else "assistant", f"turn {i} " * 3) for i in range(300)]
    broken = long[:200] + [("user", "x")]
    df = chats(spark, long, broken)
    turns = df.select("conv_id", F.posexplode("messages").alias("turn", "m")).select("conv_id", "turn", "m.role", F.col("m.content").alias("text"))
    for limit in (50, 700):
        heads = conv.renderable_heads(turns, "conv_id", "turn", "role", "text", limit, F.octet_length("text"))
        rows = heads.select("conv_id", F.size("messages").alias("n"), chat.rendered(chat.render_segments(F.col("messages")), limit).alias("r")).collect()
        assert [r.conv_id for r in rows] == [0] and rows[0].n < 60
        assert (list(rows[0].r.ids), list(rows[0].r.mask)) == render(spark, long, limit)


def test_math_parts_and_answers(spark):
    texts = ["a <<1+1=2>>2\n#### 1,234.5", "<<1=2=3>><<x>>", "plain", "t <<a>>", "#### -7 #### 8", "#### none"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    rows = df.select("i", tx.tool_parts(F.col("t")).alias("p"), tx.extract_answer(F.col("t")).alias("a"), tx.last_number(F.col("t")).alias("n")).collect()
    parts = [[(p.type, p.text) for p in r.p] for r in rows]
    assert parts[0] == [("text", "a "), ("python", "1+1"), ("python_output", "2"), ("text", "2\n#### 1,234.5")]
    assert parts[1] == [("python", "1=2"), ("python_output", "3"), ("python", "x"), ("python_output", ""), ("text", "")]
    assert parts[2] == [("text", "plain")] and parts[3][-1] == ("text", "")
    assert [r.a for r in rows] == ["1234.5", None, None, None, "-7", None]
    assert [r.n for r in rows] == ["1234.5", "3", None, None, "8", None]


def test_choice_prompt(spark):
    df = spark.createDataFrame([("Q?", ["A", "B"], ["one", "two"])], "q string, l array<string>, c array<string>")
    assert df.select(tx.choices_prompt(F.col("q"), F.col("l"), F.col("c"))).first()[0] == (
        "Multiple Choice question: Q?\n- one=A\n- two=B\n\nRespond only with the letter of the correct answer."
    )


def test_code_text(spark):
    prompt = "import a\n# c\n\n  from b import c\nX = 1\nimport d\n"
    done = "text\n```python\n x = 1 \n```\n```\ny\n```"
    df = spark.createDataFrame([(prompt, done, "f", "TEST"), ("def f():\n", "  bare \n", "f", "TEST")], "prompt string, completion string, entry_point string, test string")
    programs = [r.program for r in conv.assemble_programs(df).collect()]
    assert programs == ["import a\nfrom b import c\n\nx = 1\n\nTEST\ncheck(f)", "\n\nbare\n\nTEST\ncheck(f)"]


def test_adapters(spark):
    rows = spark.createDataFrame([("Q", ["a", "b", "c", "d"], 2, "s"), ("Q", ["a"], 0, "s"), ("Q", ["a", "b", "c", "d"], 7, "s")], "question string, choices array<string>, answer int, subject string")
    out = conv.adapt("indexed_choice", rows).collect()
    assert out[0].messages[1].content == "C" and [r.fault for r in out] == [None, "choice_count", "answer_index"]
    conv.register_adapter("upper", lambda df: df.withColumn("question", F.upper("question")))
    assert conv.adapt("upper", rows).first().question == "Q"


def test_mixture_keeps_every_copy(spark):
    a = spark.range(3).withColumnRenamed("id", "key")
    c = spark.range(5).withColumnRenamed("id", "key")
    mixed = conv.mix_datasets([("a", a, 1), ("c", c, 2)], "key")
    rows = sorted((r.pos, r.task, r.copy, r.key) for r in mixed.collect())
    assert [r[0] for r in rows] == list(range(13))
    assert len({r[1:] for r in rows}) == 13
    assert [r[1] for r in rows] != sorted(r[1] for r in rows)  # interleaved
    again = conv.mix_datasets([("c", c.repartition(4), 2), ("a", a, 1)], "key")
    assert sorted((r.pos, r.task, r.copy, r.key) for r in again.collect()) == rows
    sequence = conv.sequence_datasets([("a", a), ("c", c)], "key")
    assert sorted((r.pos, r.task, r.key) for r in sequence.collect())[3] == (3, "c", 0)


REQUESTS = [
    ([("user", "hi")], 1.0, 10, 10, None),
    ([], None, None, None, "no_messages"),
    ([("user", "x")] * 501, None, None, None, "too_many_messages"),
    ([("user", "ok"), ("user", "")], None, None, None, "empty_message:1"),
    ([("user", "x" * 8001), ("user", "")], None, None, None, "long_message:0"),
    ([("user", "x" * 8000)] * 5, None, None, None, "too_long"),
    ([("system", "x")], 9.0, None, None, "bad_role:0"),
    ([("user", "x")], 2.1, 300, None, "bad_temperature"),
    ([("user", "x")], 0.0, 201, 0, "bad_top_k"),
    ([("user", "x")], 2.0, 200, 4097, "bad_max_tokens"),
    ([("assistant", "x" * 8000)] * 4, None, None, None, None),
]


def test_request_rules_in_order(spark):
    rows = [(i, [(r, c, None) for r, c in m], t, k, n) for i, (m, t, k, n, _) in enumerate(REQUESTS)]
    df = spark.createDataFrame(rows, f"i int, messages array<{chat.MESSAGE_TYPE}>, temperature double, top_k int, max_tokens int")
    got = {r.i: r.reason for r in conv.validate_requests(df).collect()}
    assert got == {i: c[-1] for i, c in enumerate(REQUESTS)}


def test_chat_log(spark):
    head = "2026-01-02 03:04:05,678 - __main__ - \x1b[32mINFO\x1b[0m - "
    lines = [
        "Traceback", head + "=" * 20, head + "[USER]: first", "second line", 'INFO:     1.2.3.4 - "POST / HTTP/1.1" 200 OK', head + "-" * 20,
        head + "[ASSISTANT] (GPU 3): para one", "", "para two", head + "=" * 20, "noise after the rule",
        head + "=" * 20, head + "[USER]: again", "ERROR:   disk full", "INFO:    retry - twice", head + "-" * 20,
    ]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(lines)], "path string, line_no long, line string")
    rows = sorted((r.request_no, r.turn_no, r.role, r.worker, r.text, r.interleaved) for r in conv.parse_chat_log(df, lines_per_bucket=4).collect())
    assert rows == [
        (0, 0, "user", None, "first\nsecond line", False), (0, 1, "assistant", 3, "para one\n\npara two", False),
        (1, 0, "user", None, "again\nERROR:   disk full\nINFO:    retry - twice", True),
    ]


@pytest.mark.parametrize("expr, want", [
    ("12/60", "0.2"), ("1,000*2", "2000"), ("2**9", None), ("-(3+4)//2", "-4"), ("1/0", None), ("'hello'.count('l')", "2"),
    ("open('x').count('y')", None), ("a+1", None), ("().__class__", None), ("'a'.upper()", None), (" 1 + 1 ", "2"), ("'ab'.count('a'", None), ("", None),
])
def test_tool_values(spark, expr, want):
    assert conv._evaluate(expr) == want


def test_tool_audit(spark):
    answer = "x <<2*3=6>>6 <<2*3=7>>7 <<1,0*2=20>> <<z=1>> <<5>>"
    df = conv.adapt("math", spark.createDataFrame([("q", answer)], "question string, answer string"))
    rows = conv.audit_tool_calls(df, "messages", ["question"]).orderBy("part_no").collect()
    assert [r.status for r in rows] == ["match", "mismatch", "match", "not_allowed", "no_result"]
