"""Nodes of the trie against brute force; long conversations, odd rows, fingerprints that meet."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkcorpus.llm import conversation_trie as trie
from sparkcorpus.llm.queries import op11_conversation_trie
from tests.llm import plain

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """Nodes by walking every rebuilt conversation. rows: (conv_id, turn, role, text)."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).hexdigest())
            turns.setdefault(conv, []).append((key, (role, text)))
    turns = {c: [t for _, t in sorted(found, key=lambda x: x[0])] for c, found in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / 20) * 20  # c - c % 20 where the remainder has the sign of c
        path = tuple(turns.get(base, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], set()).add(c)
        ends.setdefault(path, set()).add(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    found = {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        own = (len(members[path]) - 1) * len(plain.words(path[-1][1])) if path else 0
        leaves = sum(found[b][0] for b in below) if below else 1
        found[path] = leaves, own + sum(found[b][1] for b in below)
    return sorted(
        (
            (min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children.get(p, [])), *found[p],
             hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
            for p in members
        ),
        key=str,
    )


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def conversations():
    rng = random.Random(5)
    texts = ["hello there", "one two three", "", None, "a b c d", "x " * 20]
    rows = [(c, t, rng.choice(("user", "assistant")), rng.choice(texts)) for c in range(-45, 130) for t in range(rng.randint(1, 7)) if c % 13]
    rows += [(500 + c, t, "user", f"turn {t}") for c in range(120) for t in range(5)]
    rows += [(c, t, "user", f"long {t % 7}") for c in (700, 701, 702) for t in range(400 - c % 3)]
    rows += [(720, 2, None, None), (720, None, "user", "first"), (720, 2, "user", "tie b"), (720, 2, "user", "tie a"), (720, 2, "user", "tie a"), (None, 1, "user", "nobody")]
    rows += [(740, 1, "ab", "c"), (760, 1, "a", "bc"), (741, 1, "user", "x" * 300_000), (742, 1, "user", "x" * 300_000)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, range string, words int"


@pytest.mark.parametrize("ranges", [2, 16])
def test_trie(spark, ranges):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(ranges == 2).lower())
    try:
        found = trie.build(df)
        assert got(found) == brute(rows)
        stored = {(r.conv_id, r.depth): (r.ref_conv, r.ref_n) for r in found.collect()}
        assert stored[(min(r[0] for r in rows if r[0] is not None), 0)] == (None, None) and (500, 5) in stored.values()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got(trie.build(df.limit(0))) == []


def test_scan_goes_on_over_batches():
    rows = [(c, i + 1) for c, n in ((1, 5), (2, 1), (3, 12), (9, 3)) for i in range(n)]
    lanes = [[(7 * c + i + k) ** 5 % p for k, p in enumerate(trie.PRIMES)] for c, i in rows]
    schema = pa.schema([("conv_id", pa.int64()), ("range", pa.int32()), ("t0", pa.int64()), ("t1", pa.int64()), ("words", pa.int64()), ("lanes", pa.list_(pa.int64()))])
    batch = pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows]), pa.array([0] * len(rows), pa.int32()), *[pa.array([0] * len(rows))] * 3, pa.array(lanes)], schema=schema)
    want = []
    for (c, i), x in zip(rows, lanes):
        before = want[-1][2] if i > 1 else [0] * 4
        want.append((c, i, [(b + v * pow(r, i - 1, p)) % p for b, v, r, p in zip(before, x, trie.bases(0), trie.PRIMES)], before))
    for size in (1, 2, 5, 100):
        parts = [p for at in range(0, len(rows), size) for p in [batch.slice(at, size)]]
        found = [r for b in trie._scan(0)(iter(parts)) for r in b.to_pylist()]
        assert [(r["conv_id"], r["n"], [r[f"x{i}"] for i in range(4)], [r[f"y{i}"] for i in range(4)]) for r in found] == want
        assert [r["last"] for r in found] == [a != b for (a, _), (b, _) in zip(rows, [*rows[1:], (0, 0)])]


def test_other_numbers_if_fingerprints_meet(spark, monkeypatch):
    rows = [(c, t, "user", str((t if c % 2 else 3 - t) + 10 * (c % 3))) for c in range(30) for t in range(4)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    bases, lanes = trie.bases, trie._lanes
    monkeypatch.setattr(trie, "bases", lambda seed: [1] * 4 if seed == 0 else bases(seed))  # the order of turns does not count
    assert got(trie.build(df)) == brute(rows)
    with pytest.raises(RuntimeError):
        trie.build(df, seeds=1)
    monkeypatch.setattr(trie, "_lanes", lambda role, text, seed: F.array(*[F.lit(1).cast("long")] * 4) if seed == 1 else lanes(role, text, seed))
    assert got(trie.build(df)) == brute(rows)
    with pytest.raises(RuntimeError):
        trie.build(df, seeds=2)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert got(op11_conversation_trie(spark, sf)) == brute(rows)
