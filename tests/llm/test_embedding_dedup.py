"""Lattice decoding, links and components against brute force; odd rows."""

from itertools import product

import numpy as np
import pytest

from sparkcorpus.llm import embedding_dedup as emb
from sparkcorpus.llm.queries import op13_embedding_dedup
from tests.llm import plain


def brute(rows, cosine=0.9):
    """n_links, component_id, kept of (vec_id, vector) rows, and all links."""
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if u else None for (_, v), u in zip(rows, usable)]
    unit = [v if v is None else v / np.linalg.norm(v) for v in unit]

    def near(i, j):
        return usable[i] and usable[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine

    links = [[j for j in range(len(rows)) if j != i and near(i, j)] for i in range(len(rows))]
    root = plain.linked(list(range(len(rows))), near)
    ids = {}
    for (vec_id, _), r in zip(rows, root):
        ids.setdefault(r, []).append(vec_id)
    low = [min((x for x in ids[r] if x is not None), default=None) for r in root]
    return sorted([(r[0], len(x), c, r[0] is not None and r[0] == c) for r, x, c in zip(rows, links, low)], key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def test_decoding_finds_the_nearest_point():
    x = np.random.default_rng(0).uniform(-0.7, 0.7, (50, 8))
    whole = np.array([p for p in product((-2, -1, 0, 1, 2), repeat=8) if sum(p) % 2 == 0], np.int8)
    half = np.array([p for p in product((-3, -1, 1, 3), repeat=8) if sum(p) % 4 == 0], float) / 2
    for row, point in zip(x, emb.nearest_points(x)):
        best = min(((whole - row) ** 2).sum(1).min(), ((half - row) ** 2).sum(1).min())
        assert np.isclose(((point - row) ** 2).sum(), best)


def test_shortest_vectors():
    m = emb._shortest()
    assert m.shape == (8, 240) and np.allclose((m**2).sum(0), 2) and len({tuple(c) for c in m.T}) == 240
    assert np.allclose(emb.nearest_points(m.T), m.T)


def test_cells_do_not_depend_on_the_batch():
    unit = np.random.default_rng(1).normal(size=(100, 64))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    together = emb.cells(unit)
    assert all((emb.cells(unit[i : i + 7]) == together[i : i + 7]).all() for i in range(0, 100, 7))


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    x, z = rng.normal(size=(2, 4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    step = 1 + emb.PROBES
    for cosine, least in ((0.9, 0.95), (0.95, 0.995)):
        a, b = emb.cells(x), emb.cells(cosine * x + np.sqrt(1 - cosine**2) * z)
        meet = np.zeros(len(x), bool)
        for t in range(0, a.shape[1], step):
            meet |= (a[:, t : t + step, None] == b[:, None, t : t + step]).any((1, 2))
        assert meet.mean() > least


@pytest.mark.parametrize("tile", [8, 1024])
def test_operator(spark, tile):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 64))
    rows = [(i, (centres[i % 12] * rng.uniform(0.8, 3) + rng.normal(size=64) * 0.12).tolist()) for i in range(150)]
    rows += [(200 + i, (centres[0] + rng.normal(size=64) * 0.05).tolist()) for i in range(60)]
    rows += [(300 + i, rng.normal(size=64).tolist()) for i in range(40)]
    rows += [rows[3], (None, rows[3][1]), (999, rows[5][1]), (None, None), (400, None), (401, []), (402, [0.0] * 64), (403, [None] + [1.0] * 63)]
    rows += [(404, [float("nan")] + [1.0] * 63), (405, [float("inf")] + [1.0] * 63), (406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [-1.0, -2.0]), (409, [1e300] * 3), (410, [1e-300] * 3)]
    df = spark.createDataFrame([(a, v, "x", i) for i, (a, v) in enumerate(rows)], "vec_id bigint, embedding array<double>, node string, weight int")
    assert got(emb.near_duplicates(df, tile=tile)) == brute(rows)
    assert got(emb.near_duplicates(df.limit(0))) == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = got(op13_embedding_dedup(spark, sf))
    assert found == brute(rows)
