"""Fingerprints, tiles and components against plain versions; odd rows."""

import random

import numpy as np
import pytest

from sparkcorpus.llm import simhash_dedup as sim
from sparkcorpus.llm.components import components
from sparkcorpus.llm.queries import op3_simhash_dedup
from tests.llm import plain

ODD = [None, "", " \n", "One", "one TWO", "one two three", "É ü é " * 50, "a\x1fb\x85c d e f", "x " * 3000]
near = lambda a, b: (a ^ b).bit_count() <= 3


def test_fingerprint():
    rng = random.Random(1)
    for text in [*ODD, *(" ".join(rng.choices(["A", "bé", "Cc", "d"], k=rng.randint(0, 60))) for _ in range(100))]:
        assert sim.fingerprint((text or "").encode()) == plain.fingerprint(text)


def flipped(rng, value, most):
    for _ in range(rng.randint(0, most)):
        value ^= 1 << rng.randrange(64)
    return value


@pytest.mark.parametrize("tile", [4, 64, 2048])
def test_links_equal_plain(spark, tile):
    rng = random.Random(tile)
    centres = [rng.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1]
    values = sorted({flipped(rng, rng.choice(centres), 5) for _ in range(500)})
    want = plain.linked(values, near)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = {r.node: r.root for r in sim.link_fingerprints(spark.createDataFrame([(v,) for v in signed], "fp bigint"), tile=tile).collect()}
    groups = {}
    for v, w in zip(signed, want):
        groups.setdefault(w, set()).add(found.get(v, v))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chain_star_and_pairs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200), (300, 301), (301, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    groups = [set(range(41)), set(range(100, 150)), {300, 301}]
    assert set(found) == set().union(*groups)
    assert all(len({found[n] for n in g}) == 1 for g in groups) and len(set(found.values())) == 3
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def documents():
    rng = random.Random(7)
    base = [" ".join(f"w{rng.randrange(300)}" for _ in range(200)) for _ in range(6)]
    texts = [*base, *base[:3], *(b + " tail" for b in base), *ODD, "", base[0].upper()]
    return [(None if i in (2, 20) else i % 18, t, "r", i) for i, t in enumerate(texts)]


def test_operator(spark):
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string, fp string, row int")
    prints = [plain.fingerprint(t) for _, t, _, _ in documents()]
    root = plain.linked(prints, near)
    ids = {}
    for (doc_id, *_), r in zip(documents(), root):
        ids.setdefault(r, []).append(doc_id)
    want = [(d[0], f"{p:016x}", min((x for x in ids[r] if x is not None), default=None)) for d, p, r in zip(documents(), prints, root)]
    got = [tuple(r) for r in sim.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)

    kept = sim.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(root[r.row] for r in rows) == sorted(set(root))
    for r in rows:
        assert r.doc_id == min((x for x in ids[root[r.row]] if x is not None), default=None)
    assert sim.keep_one(docs.limit(0)).count() == 0 and sim.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [plain.fingerprint(t) for _, t in docs]
    root = plain.linked(prints, near)
    want = [(d, f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, root)]
    got = sorted(tuple(r) for r in op3_simhash_dedup(spark, sf).collect())
    assert got == want and any(d != c for d, _, c in got)
