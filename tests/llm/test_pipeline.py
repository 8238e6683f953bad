"""Each stage of the pipeline against a plain version, on planted and given documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm import plain

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def planted(benchmark):
    rng = random.Random(11)
    say = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    passage = say(120)
    base = say(200)
    texts = {
        "clean": [say(150) for _ in range(8)], "short": ["too short", "", None], "repetitive": ["again and again we say this " * 30],
        "copies": [base, base, base + " end"], "passages": [f"{say(60)} {passage} {say(60)}" for _ in range(3)],
        "leaks": [f"{say(60)} {benchmark} {say(60)}"],
    }
    rows = [(kind, t) for kind, ts in texts.items() for t in ts]
    docs = [(i, t, "en", f"src{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, (_, t) in enumerate(rows)]
    return docs, [kind for kind, _ in rows], passage


def staged(spark, docs, sf):
    """Each stage's input and output."""
    found = []
    for name, stage in pipeline.STAGES:
        out = pipeline.save(stage(spark, docs, sf), "test-stage")
        found.append((name, docs, out))
        docs = out
    return found


def check_stages(stages, benchmark):
    for name, before, after in stages:
        if name != "source_mixing":
            assert after.columns == before.columns
        was, now = before.collect(), after.collect()
        if name == "quality_rules":
            base = {r.doc_id for r in was if not plain.repetition(r.text)[5]}
            kept = {r.doc_id for r in now}
            assert kept <= base and len(base - kept) <= 0.01 * len(was)
        elif name == "simhash_dedup":
            was.sort(key=lambda r: r.doc_id)
            prints = [plain.fingerprint(r.text) for r in was]
            root = plain.linked(prints, lambda a, b: (a ^ b).bit_count() <= 3)
            assert sorted(r.doc_id for r in now) == [was[i].doc_id for i in sorted(set(root))]
        elif name == "suffix_dedup":
            want = {}
            for r, (_, gone, _, kept) in zip(was, plain.repeats([r.text for r in was], pipeline.PASSAGE_BYTES)):
                text = kept.decode("utf-8", "ignore") if gone else r.text
                if text:
                    want[r.doc_id] = (text, len(text) if gone else r.n_chars)
            assert {r.doc_id: (r.text, r.n_chars) for r in now} == want
        elif name == "decontamination":
            assert {r.doc_id for r in now} == {r.doc_id for r in was if not plain.contamination(r.text, benchmark)[1]}
        else:
            sizes, taken = {}, {}
            for r in was:
                sizes[r.source] = sizes.get(r.source, 0) + len(plain.words(r.text))
            for r in now:
                taken[r.source] = taken.get(r.source, 0) + len(plain.words(r.text))
            copies = {}
            for r in now:
                copies.setdefault(r.doc_id, []).append(r.mix_epoch)
            assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2 for c in copies.values())
            longest = max((len(plain.words(r.text)) for r in was), default=0)
            assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= longest * len(sizes)


@pytest.fixture(scope="module")
def benchmark(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]


def test_given_documents(spark, benchmark):
    stages = staged(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    check_stages(stages, benchmark)
    assert pipeline.run(spark, SF).count() == stages[-1][2].count() > 0


def test_planted_documents(spark, benchmark):
    rows, kinds, passage = planted(benchmark[0][1])
    docs = spark.createDataFrame(rows, COLUMNS)
    stages = staged(spark, docs, SF)
    check_stages(stages, benchmark)
    mixed_in = {r.doc_id: r.text for r in stages[-2][2].collect()}
    kept = [k for i, k in enumerate(kinds) if i in mixed_in]
    assert kept.count("clean") == 8 and kept.count("copies") == 1 and kept.count("passages") == 3
    assert not {"short", "repetitive", "leaks"} & set(kept)
    assert not any(passage in t for t in mixed_in.values())


def test_odd_tables(spark):
    extra = "row string, key string, kept int, fp bigint, doc_id bigint, text string, source string, n_chars int"
    odd = spark.createDataFrame([("a", "b", 1, 2, None, None, None, None)] * 3 + [("a", "b", 1, 2, 4, " ".join(map(str, range(50))), None, None)] * 2, extra)
    for docs in (odd, odd.limit(0), odd.drop("n_chars")):
        for name, before, after in staged(spark, docs, SF):
            assert [c for c in after.columns if c != "mix_epoch"] == docs.columns
        assert after.select("doc_id").distinct().count() == (1 if before.count() else 0)


def test_documents_with_repeated_rows_stay_once(spark):
    text = F.concat_ws(" ", *[F.lit(f"word{i}") for i in range(40)])
    docs = spark.range(6).select((F.col("id") % 1).alias("doc_id"), text.alias("text"))
    assert pipeline.drop_near_duplicates(spark, docs, SF).count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_cut_once(spark):
    """Each place of a Python function in a plan takes a worker of its own in every task."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert plan_of(pipeline.cut_repeats(spark, docs, SF)).count("ArrowEvalPython") == 1


def test_search_starts_no_other_workers(spark, monkeypatch):
    """Rows handed over by the driver go through workers of a second kind, beside those of the search."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: pytest.fail("rows from the driver"))
    assert 0 < pipeline.drop_contaminated(spark, docs, SF).count() < docs.count()
