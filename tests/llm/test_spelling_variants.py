"""Word counts, links, forms and roots against brute force; odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from sparkcorpus.llm import spelling_variants as var
from sparkcorpus.llm.queries import op12_spelling_variants
from tests.llm import plain


def counts(rows, least_length=5, least_count=3):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = plain.ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_length and n >= least_count}


def variants(count):
    """word: (form, root, n, n_near, form_n), near words found by their common strings less one code point."""
    bucket = {}
    for w in count:
        for i in range(len(w)):
            bucket.setdefault((i, w[:i] + w[i + 1 :], len(w)), set()).add(w)
    near = {w: set() for w in count}
    for (_, rest, _), same in bucket.items():
        for w in same:
            near[w] |= same - {w}
            if rest in count:
                near[w].add(rest)
                near[rest].add(w)
    form = {}
    for w, ws in near.items():
        best = min(ws, key=lambda x: (-count[x], x.encode()), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), count[w], len(near[w]), count.get(form[w])) for w in count}


def got(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("crowd", [2, 256])
def test_groups(spark, crowd):
    rng = random.Random(crowd)
    letters = "abcdeéÿ"
    words = {"".join(rng.choices(letters[: rng.choice((2, 3, 7))], k=rng.randint(5, 9))) for _ in range(600)}
    words |= {"stem" * 3 + a + b for a in letters for b in letters} | {a + "stem" * 3 for a in letters} | {"a" * k for k in range(5, 60)}
    words |= {"long" * 3000, "long" * 3000 + "x", "aaaab", "baaaa", "aaba", "abaab"}
    count = {w: rng.choice((3, 3, 4, 6, 7, 12, 30, 100)) for w in words if len(w) >= 5}
    df = spark.createDataFrame(sorted(count.items()), "word string, n bigint")
    assert got(var.group_variants(df, crowd=crowd)) == variants(count)


def test_counts_of_odd_rows(spark):
    rows = [(None, "Colour COLOUR colour"), (1, None), (2, ""), (3, "×÷Àé123naïve_naïve-naïve"), (3, "×÷Àé123naïve_naïve-naïve"), (-4, "éÉééé " * 50)]
    rows += [(i, "spelling variants of every word " * 3) for i in range(200)]
    df = spark.createDataFrame([(a, t, "x", "y") for a, t in rows], "doc_id bigint, text string, word string, n string")
    assert {r.word: r.n for r in var.word_counts(df).collect()} == counts(rows)
    assert got(var.group_variants(var.word_counts(df.limit(0)))) == {}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = variants(counts(rows))
    assert got(op12_spelling_variants(spark, sf)) == want
    assert any(form is not None for form, *_ in want.values())
