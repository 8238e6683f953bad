"""Removal of repeated byte strings against a plain version; odd rows."""

import hashlib
import random

import pytest

from sparkcorpus.llm import suffix_dedup as suf
from sparkcorpus.llm.queries import op7_suffix_dedup
from tests.llm import plain


def documents(seed):
    rng = random.Random(seed)
    say = lambda n: "".join(rng.choices("abcdé 語", k=n))
    passages = [say(n) for n in (20, 45, 60, 90, 130)]
    texts = []
    for _ in range(40):
        parts = [rng.choice([say(rng.randint(0, 80)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 20) :]]) for _ in range(rng.randint(1, 5))]
        texts.append("".join(parts))
    changed = list(texts[0] * 3)
    for i in range(5, len(changed), 70):
        changed[i] = "#"
    return [*texts, texts[1], texts[1], None, "", "a" * 300, "a" * 40, "ab" * 100, texts[0] * 3, "".join(changed)]


def found(spark, texts, **options):
    rows = [(i % 7 or None, t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept int")
    got = {}
    for r in suf.remove_repeats(docs, **options).collect():
        assert tuple(r.row) == rows[r.row.kept]
        kept = (r.row.text or "").encode() if r.kept is None else bytes(r.kept)
        got[r.row.kept] = (r.n_bytes, r.n_removed, r.n_spans, kept)
    return [got[i] for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("length,span", [(40, 20), (40, 35), (12, 2)])
def test_remove_equals_plain(spark, seed, length, span):
    texts = documents(seed)
    assert found(spark, texts, length=length, span=span) == plain.repeats(texts, length)


def test_pieces(spark, monkeypatch):
    texts = documents(5)
    whole = [suf.parse((t or "").encode(), 40, 20) for t in texts]
    monkeypatch.setattr(suf, "PIECE", 50)
    assert [suf.parse((t or "").encode(), 40, 20) for t in texts] != whole
    assert found(spark, texts, length=40, span=20) == plain.repeats(texts, 40)


def test_every_window_has_one_phrase():
    for text in documents(9):
        data = (text or "").encode()
        covered = [i for a, b, *_ in suf.parse(data, 40, 20) for i in range(a, b + 1)]
        assert covered == list(range(max(0, len(data) - 39)))


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [None, "", "short"]) == [(0, 0, 0, b""), (0, 0, 0, b""), (5, 0, 0, b"short")]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {
        d.doc_id: (n, gone, spans, hashlib.sha256(kept).hexdigest())
        for d, (n, gone, spans, kept) in zip(docs, plain.repeats([d.text for d in docs]))
    }
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op7_suffix_dedup(spark, sf).collect()}
    assert got == want and any(v[1] for v in got.values())
