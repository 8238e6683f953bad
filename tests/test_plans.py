"""Physical plans: what is read, what is shuffled, what is broadcast."""

import ast
import inspect
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators import ordering, packing, prompts, sampling, scoring
from sparkcorpus.operators import tokenization as tok

DOCS = "/root/testdata/sf0.01/documents.parquet"


def plan(df) -> str:
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_budget_reaches_the_scan(spark):
    docs = spark.read.parquet(DOCS)
    text = plan(sampling.byte_budget(docs, ["doc_id"], width_bucket(F.col("doc_id"), 64), 100_000).select("doc_id", "text"))
    assert "Exchange" not in text and "Window" not in text
    assert re.search(r"PushedFilters: \[.*(LessThan|EqualTo).*doc_id", text)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_prefix_sums_never_sort_the_corpus_in_one_task(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", F.octet_length("text").alias("n"))
    text = plan(ordering.prefix_sums(docs, ["doc_id"], width_bucket(F.col("doc_id"), 64), {"before": F.col("n")}))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # the one single-partition step works on span totals, after two aggregations
    single = text.index("SinglePartition")
    assert text.count("SinglePartition") == 1 and text[single:].count("HashAggregate") >= 4


def test_token_counts_combine_before_the_shuffle(spark):
    text = plan(tok.pretoken_counts(spark.read.parquet(DOCS)))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_count" in text[exchange:] and text.count("Exchange") == 1
    assert "ReadSchema: struct<text:string>" in text


def test_encoding_and_rendering_do_not_shuffle(spark):
    docs = spark.read.parquet(DOCS)
    ranks = tok.byte_ranks(spark)
    assert "Exchange" not in plan(tok.encode_corpus(docs, ranks).select("doc_id", "ids"))
    prompted = spark.createDataFrame([(0, ["a", "b"])], "idx long, prompts array<string>")
    spans = prompts.crop_spans(prompts.answer_spans(prompts.encode_prompts(prompted, 256), "multiple_choice"), 9)
    assert "Exchange" not in plan(spans)


def test_only_lengths_enter_the_packer(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text", (F.octet_length("text") + 1).alias("n"))
    text = plan(packing.pack_bestfit_crop(packing.pack_groups(docs, "doc_id", 256), "doc_id", "doc_id", "n", 2049))
    exchange = text.index("Exchange hashpartitioning")
    assert "text#" not in text[text.index("FlatMapGroupsInPandas"):exchange]


def test_losses_are_summed_before_the_lookup(spark):
    losses = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0), ("a", 9, 4.0), ("a", 1, float("nan"))], "g string, target_id int, loss double")
    lengths = spark.createDataFrame([(0, 1), (1, 1)], "token_id int, n_bytes int")
    found = scoring.bits_per_byte(losses, lengths, ["g"])
    text = plan(found)
    assert "HashAggregate" in text[text.index("Join"):]
    row = found.first()
    assert (row.nats, row.n_bytes, row.unknown_targets, row.bad_losses) == (3.0, 2, 1, 1)
    assert sorted(r.reason for r in scoring.error_losses(losses, lengths).collect()) == ["loss_not_finite", "unknown_target"]


def test_no_query_builds_a_cross_product(spark):
    for name in ("pack_concat", "resume_from", "centered_scores", "pass_at_k", "sweep_grid", "power_law", "running_best", "throughput_report", "mix_datasets"):
        text = plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_registered_queries_have_sql():
    from sparkcorpus.plans.registry import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


def test_functions_stay_in_the_jvm():
    """Expression modules hold no Python UDF."""
    from sparkcorpus.functions import arrays, chat, keys, text

    for module in (arrays, chat, keys, text):
        names = {n.attr for n in ast.walk(ast.parse(inspect.getsource(module))) if isinstance(n, ast.Attribute)}
        assert not names & {"udf", "pandas_udf", "applyInPandas", "mapInPandas", "collect"}
