"""Repetition counts against a plain version; odd rows."""

import random

import pytest

from sparkcorpus.llm import quality_rules as rules
from sparkcorpus.llm.queries import op4_quality_rules
from tests.llm import plain

ODD = [
    None, "", " ", "\n\n", "one", "a\x1cb\x85c d " * 4, "same line\nsame line\nsame line", "x " * 5000,
    "the cat sat on the mat " * 3, "é ü 語 " * 6 + "#*$%&|<>", "a\rb\x0bc\x0cd\te", "w" * 100_000,
]


def random_texts(n):
    rng = random.Random(4)
    for _ in range(n):
        vocabulary = [f"w{i}é"[: rng.randint(1, 5)] for i in range(rng.choice([2, 5, 40, 400]))]
        yield rng.choice(["\n", " "]).join(" ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 12)))


@pytest.mark.parametrize("texts", [ODD, list(random_texts(400))])
def test_measure_equals_plain(texts):
    for text in texts:
        n, chars, symbols, lines, repeats, dup_chars, ngrams, failed, kept = rules.measure((text or "").encode())
        want = plain.repetition(text)
        assert (n, chars, symbols, lines, repeats, failed) == want[:6], text
        if repeats or not any(ngrams):
            assert ngrams == list(want[6].values()), text
        assert dup_chars == want[7]
        assert kept == plain.kept(text)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in op4_quality_rules(spark, sf).collect()}
    for d in docs:
        r, want = got[d.doc_id], plain.repetition(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (*want[:6], plain.kept(d.text))
    verdicts = [(r.base_failed, r.kept) for r in got.values()]
    assert verdicts.count((False, False)) and verdicts.count((False, True)) > 0.85 * len(docs)  # the shares decide on some


def test_operator_keeps_columns_and_rows(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(1, good, "a"), (1, good, "a"), (2, None, "b"), (3, "", "c"), (None, "again and again and " * 20, "d"), (4, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    kept = rules.reject_repetitive(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted([r for r in docs.collect() if r.text == good], key=str)
    assert rules.reject_repetitive(docs.limit(0)).count() == 0


def test_verdict_counts_characters():
    filler = [f"{i}" for i in range(100)]
    long = [f"{'x' * 60}{i}" for i in range(6)]
    text = " ".join(filler[:50] + long + filler[50:] + long)
    *_, failed, kept = rules.measure(text.encode())
    assert not failed and not kept
