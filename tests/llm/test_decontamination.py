"""Word windows found by shift tables against a plain search; odd rows; items in blocks."""

import random

from pyspark.sql import functions as F

from sparkcorpus.llm import decontamination as dec
from sparkcorpus.llm.queries import op10_decontamination
from tests.llm import plain

DOCS, ITEMS = "doc_id bigint, text string, items string", "item_id bigint, text string, row string"


def random_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Été", "語"]
    say = lambda k: " ".join(rng.choices(vocabulary, k=k))
    items = [(i, say(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(8)]
    docs = [say(rng.randint(0, 40)) + "; " + rng.choice(items)[1].upper() + "!" + say(rng.randint(0, 9)) for _ in range(40)]
    return docs, items


def test_find_equals_plain():
    for seed in range(30):
        docs, items = random_case(seed)
        patterns = dec.Patterns([(str(i), t.encode()) for i, t in items])
        for text in [*docs, "", "###", "W0"]:
            spans, names = patterns.find(text.encode())
            covered = {j for a, b in spans for j in range(a, b)}
            want = plain.contamination(text, items)
            assert (len(dec.words_of(text.encode())), len(covered), len(names)) == want[:3], (seed, text)


def test_operator(spark):
    docs, items = random_case(3)
    items += [(None, " ".join(f"q{i}" for i in range(12))), (5, "z1 z2 z3"), (77, None), (77, "z1 z2 z3")]
    texts = [*docs, None, "", "a " + " ".join(f"q{i}" for i in range(12)), "z1 z2 z3", docs[0]]
    d = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], DOCS)
    b = spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS)
    for block_words in (dec.BLOCK_WORDS, 20):
        got = dec.contamination(d, b, block_words=block_words).select(
            "row.text", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items"), 256)
        )
        assert sorted(map(tuple, got.collect()), key=str) == sorted([(t, *plain.contamination(t, items)) for t in texts], key=str)
    kept = dec.remove_contaminated(d, b)
    assert kept.columns == d.columns
    clean = [t for t in texts if plain.contamination(t, items)[1] == 0]
    assert sorted((r.text for r in kept.collect()), key=str) == sorted(clean, key=str)
    assert dec.contamination(d, b.limit(0)).filter("n_hit > 0").count() == 0
    assert dec.contamination(d.limit(0), b).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r.doc_id: plain.contamination(r.text, items) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op10_decontamination(spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == want
    assert any(r.contaminated for r in got) and all(r.contaminated == (r.n_hit > 0) for r in got)
