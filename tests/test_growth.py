"""Steps whose cost must not outgrow their input: what they read, send and keep, on rows made here."""

import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions import text as tx
from sparkcorpus.functions.chat import special_id
from sparkcorpus.operators import rollouts, scoring
from sparkcorpus.operators import tokenization as tok
from sparkcorpus.plans import corpus as corpus_plans, evaluation, packing, tokens
from sparkcorpus.plans.registry import ORACLES
from sparkcorpus.streaming import streams
from tests.oracle import compare
from tests.test_plans import plan

TEXTS = ["aé🙂 b", "", None, "x" * 300, "two words", "\x00\x7f"]


@pytest.fixture
def set_conf(spark):
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def sf_dir(spark, tmp_path):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(900)]
    rows = [(i, " ".join(rng.choices(words, k=200)), "en" if i % 3 else "de", f"s{i % 4}", 0) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_running_totals_keep_their_state_in_few_parts(spark, tmp_path, set_conf):
    set_conf("spark.sql.shuffle.partitions", "16")
    for i in range(3):
        spark.createDataFrame([("a", "x"), ("b", "é" * i)], "source string, text string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    found = streams.stream_shard_totals(spark, f"{tmp_path}/in", "source string, text string", f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(map(tuple, found.collect())) == [("a", 3, 3, 3), ("b", 3, 3, 6)]
    parts = [p for p in os.listdir(f"{tmp_path}/state/state/0") if p.isdigit()]
    assert len(parts) == 4 and spark.conf.get("spark.sql.shuffle.partitions") == "16"


def test_audit_counts_tokens_in_the_same_pass(spark):
    ranks = tok.byte_ranks(spark)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    audit = tok.roundtrip_audit(tok.encode_corpus(df, ranks), tok.vocab_table(ranks), also=[F.sum(F.size("ids")).alias("n_tokens")])
    want = sum(len(t.encode()) for t in TEXTS if t is not None)
    assert tuple(audit.first()) == (len(TEXTS), 0, want, want)
    assert plan(audit).count("Scan") == 1


def _plain_spans(ids, mask):
    found = []
    for kind, (start, end) in {"python": ("python_start", "python_end"), "output": ("output_start", "output_end")}.items():
        start, end = special_id(start), special_id(end)
        marks = [(i, t) for i, t in enumerate(ids) if t in (start, end)]
        for (i, a), (j, z) in zip(marks, marks[1:]):
            if (a, z) == (start, end):
                found.append((kind, i, j, tuple(ids[i + 1 : j]), None if mask is None else sum(m == 1 for m in mask[i + 1 : j])))
    return found


def test_tool_spans_of_many_sequences(spark):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        ids = [rng.choice([1, 2, None, *range(259, 266)]) for _ in range(rng.randint(0, 14))]
        rows.append((i, ids, None if i % 9 == 0 else [rng.choice([0, 1, None]) for _ in ids]))
    df = spark.createDataFrame([*rows, (300, None, None)], "i int, ids array<int>, mask array<int>")
    found = rollouts.extract_tool_spans(df, ["i"], "ids", "mask")
    want = [(i, None if mask is None else mask.count(0), len(ids), *s) for i, ids, mask in rows for s in _plain_spans(ids, mask)]
    got = [(r.i, r.forced_tokens, r.n_tokens, r.kind, r.start, r.end, tuple(r.span_ids), r.sampled) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and got
    assert "lambda" not in plan(found).replace("<lambda>", "")


def _plain_parts(answer):
    parts = []
    for piece in re.split(r"(?=<<[^>]+>>)|(?<=>>)", answer):
        if re.fullmatch(r"<<[^>]+>>", piece):
            expr, sign, result = piece[2:-2].rpartition("=")
            parts += [("python", expr if sign else result), ("python_output", result if sign else "")]
        elif piece:
            parts.append(("text", piece))
    return parts if parts and parts[-1][0] == "text" else [*parts, ("text", "")]


def test_tool_parts_are_cut_once(spark):
    rng = random.Random(3)
    pieces = ["<<", ">>", "<", ">", "=", "a", "b=c", "\n", "é", "<<x=1>>", "<<y>>", "🙂"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", tx.tool_parts(F.col("t")).alias("p"))
    assert {r.i: [tuple(p) for p in r.p] for r in found.collect()} == {i: _plain_parts(t) for i, t in enumerate(texts)}
    assert plan(found).count("regexp_extract_all(") == 1 and "split(" not in plan(found)


def test_broken_losses_are_looked_up_in_place(spark, set_conf):
    set_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    losses = spark.createDataFrame([(0, 1.0), (9, 4.0), (1, float("nan")), (-1, 1.0)], "target_id int, loss double")
    found = scoring.error_losses(losses, spark.createDataFrame([(0, 1), (1, 1)], "token_id int, n_bytes int"))
    assert sorted((r.target_id, r.reason) for r in found.collect()) == [(1, "loss_not_finite"), (9, "unknown_target")]
    assert "BroadcastHashJoin" in plan(found) and "SortMergeJoin" not in plan(found)


def test_byte_ids_of_whole_columns(spark, sf_dir):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: r.ids for r in tok.encode_bytes(df).collect()}
    assert got == {i: None if t is None else list(t.encode()) for i, t in enumerate(TEXTS)}
    assert "split(" not in plan(evaluation.token_losses(spark, sf_dir)) and "split(" not in plan(packing.shift_targets(spark, sf_dir))


@pytest.mark.parametrize("texts", [TEXTS, ["", ""], [None, ""]])
def test_byte_totals_of_empty_texts(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    ok, message = compare(spark, con, str(tmp_path), tokens.encode_bytes, ORACLES["encode_bytes"])
    assert ok, message
    empty = [tuple(r) for r in tokens.encode_bytes(spark, str(tmp_path)).filter("n_tokens = 0").collect()]
    assert empty == [(i, 0, None, None, None) for i, t in enumerate(texts) if t == ""]


def test_decoding_holds_bounded_batches(spark, set_conf):
    set_conf("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    back = tok.decode_corpus(tok.encode_bytes(df), tok.vocab_table(tok.byte_ranks(spark)), text="back")
    assert all(r.back == r.text for r in back.collect())
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    assert plan(back.select("i", "back")).count("ArrowEvalPython") == 1  # ids stay in the worker
    with pytest.raises(Exception, match="KeyError"):
        tok.decode_corpus(spark.createDataFrame([([1, 999],)], "ids array<int>"), tok.byte_ranks(spark).withColumnRenamed("rank", "token_id")).collect()


def test_manifested_files_grow_in_number(spark, sf_dir, set_conf):
    set_conf("spark.sql.shuffle.partitions", "16")
    set_conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    set_conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    found = corpus_plans.read_manifested(spark, sf_dir)
    assert {r.lang: r.documents for r in found.collect()} == {"de": 20, "en": 40}
    assert len([f for f in found.inputFiles() if "/hub-" in f]) > 4


def test_compression_cuts_the_texts_once(spark, sf_dir, monkeypatch):
    calls, real = [], tok.pretoken_counts
    monkeypatch.setattr(tok, "pretoken_counts", lambda *a, **k: calls.append(a) or real(*a, **k))
    found = tokens.compression_by_histogram(spark, sf_dir)
    assert len(calls) == 1 and "/documents.parquet" not in "".join(found.inputFiles())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert {r.lang: r.n_bytes for r in found.collect()} == {r.lang: r.n for r in docs.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}


def test_weighted_sums(spark):
    df = spark.createDataFrame([(0, [3, 5]), (1, []), (2, None), (3, [1, None]), (4, [2**31 - 1, 7, 1])], "i int, ids array<int>")
    found = df.select("i", packing.weighted(F.col("ids")).alias("w"))
    assert {r.i: r.w for r in found.collect()} == {0: 13, 1: 0, 2: None, 3: None, 4: 2**31 - 1 + 17}
    assert "lambda" not in plan(found).replace("<lambda>", "")
