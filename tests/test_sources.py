import glob
import hashlib
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkcorpus.operators import sampling
from sparkcorpus.session import fresh_path
from sparkcorpus.sources import corpus, reports
from sparkcorpus.streaming import streams


def docs(spark, n=700):
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.floor(F.col("id") / 256).cast("int").alias("shard"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")
    ).repartition(5)


def test_shard_files(spark):
    path = fresh_path(spark, "t-shards")
    corpus.write_shards(docs(spark), path, "shard", "doc_id", ["doc_id", "text"], group_rows=100)
    files = sorted(glob.glob(f"{path}/shard_dir=*/*.parquet"))
    assert len(files) == 3
    meta = pq.ParquetFile(files[0]).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [100, 100, 56]
    column = meta.row_group(0).column(1)
    assert column.compression == "ZSTD" and not column.is_stats_set and "RLE_DICTIONARY" not in column.encodings
    open(f"{path}/shard_dir=00000/part.parquet.tmp", "w").close()
    scan = {(r.shard, r.pos): r.doc_id for r in corpus.scan_corpus(spark, path, columns=["doc_id"]).collect()}
    assert scan == {(i // 256, i % 256): i for i in range(700)}


@pytest.mark.parametrize("seed", range(4))
def test_size_bounded_shards_equal_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 5, 50, rng.randrange(300)]) for _ in range(rng.randrange(50, 200))]
    block, threshold = rng.choice([4, 8]), rng.randrange(100, 1500)
    want, current, total = {}, [], 0
    for i, n in enumerate(sizes):
        current.append(i)
        total += n
        if total >= threshold and len(current) % block == 0:
            want |= {d: len(set(want.values())) for d in current}
            current, total = [], 0
    df = spark.createDataFrame(list(enumerate(sizes)), "pos long, n long").repartition(3)
    got = {r.pos: r.shard for r in corpus.assign_shards(df, "pos", F.col("n"), threshold, block).collect()}
    assert got == want
    tail = {r.pos: r.shard for r in corpus.assign_shards(df, "pos", F.col("n"), threshold, block, keep_tail=True).collect()}
    assert tail == want | {d: len(set(want.values())) for d in current}
    for keep in (False, True):  # the way of tables with more blocks than the driver holds
        jumped = corpus.assign_shards(df, "pos", F.col("n"), threshold, block, keep_tail=keep, most_blocks=0)
        assert {r.pos: r.shard for r in jumped.collect()} == (tail if keep else want)


def test_resume_follows_the_plain_loop(spark):
    workers, groups, shards = 3, 7, 3
    rows = [(s, g) for s in range(shards) for g in range(groups)]
    df = corpus.replay_epochs(spark.createDataFrame(rows, "shard int, group_no int"), 3)
    for worker, (epoch, shard, group) in [(0, (1, 0, 4)), (2, (2, 1, 6)), (1, (1, 2, 1))]:
        want = []
        first = (group // workers + 1) * workers + worker
        want += [(epoch, shard, g) for g in range(first, groups, workers)]
        want += [(epoch, s, g) for s in range(shard + 1, shards) for g in range(worker, groups, workers)]
        want += [(e, s, g) for e in range(epoch + 1, 4) for s in range(shards) for g in range(worker, groups, workers)]
        got = [(r.epoch, r.shard, r.group_no) for r in corpus.resume_from(df, worker, workers, epoch, shard, group).collect()]
        assert sorted(got) == sorted(want)


def test_manifest_must_exist(spark):
    path, manifest = fresh_path(spark, "t-data"), fresh_path(spark, "t-manifest")
    docs(spark, 20).write.parquet(path)
    with pytest.raises(Exception):
        corpus.read_manifested(spark, manifest)
    corpus.write_list_manifest(spark, path, manifest)
    docs(spark, 5).write.mode("append").parquet(path)  # files outside the manifest are not read
    found = corpus.read_manifested(spark, manifest)
    assert found.count() == 20 and found.columns == docs(spark, 1).columns
    listed = spark.read.json(manifest)
    gone = fresh_path(spark, "t-manifest")
    listed.union(listed.limit(1).withColumn("path", F.concat("path", F.lit(".gone")))).write.json(gone)
    with pytest.raises(FileNotFoundError):
        corpus.read_manifested(spark, gone)


def test_files_too_large_for_a_record_are_error_rows(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    (tmp_path / "b.bin").write_bytes(b"abcd")
    with open(tmp_path / "large.bin", "wb") as file:
        file.truncate(3_000_000_000)  # sparse: takes no room
    hashed = sampling.hash_files(spark, str(tmp_path))
    named = hashed.withColumn("path", F.regexp_extract("path", "([^/]+)$", 1))
    manifest = spark.createDataFrame([("a.bin", hashlib.sha256(b"abc").hexdigest()), ("b.bin", "0"), ("large.bin", "1"), ("c.bin", "2")], "path string, sha256 string")
    found = {r.path: r.status for r in sampling.audit_files(named, manifest).collect()}
    assert found == {"a.bin": "ok", "b.bin": "changed", "large.bin": "too_large", "c.bin": "missing"}


def test_evaluation_rows_stay_the_same(spark):
    folder = fresh_path(spark, "t-eval")
    rows = lambda n: spark.createDataFrame([(s, i, f"{n}") for s in ("train", "val") for i in range(50)], "split string, row_no int, text string")
    first = sampling.kept_eval_subset(rows(1), folder, "split", "row_no", 4, 10, 130)
    again = sampling.kept_eval_subset(rows(2), folder, "split", "row_no", 4, 10, 130)
    assert first.count() == again.count() == 24 and {r.text for r in again.collect()} == {"1"}
    assert {r.text for r in sampling.kept_eval_subset(rows(2), folder, "split", "row_no", 4, 10, 80).collect()} == {"2"}


def test_log_lines_over_several_blocks(spark):
    path = fresh_path(spark, "t-logs")
    rows = [(f"r{i % 3}", i, f"line {i}" + (" " * 40) + ("\r" if i % 5 == 0 else "")) for i in range(6000)]
    df = spark.createDataFrame(rows, "run string, i long, value string").repartition("run").sortWithinPartitions("run", "i")
    df.select("run", "value").write.partitionBy("run").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = reports.read_logs(spark, path)
        got = [(r.run, r.line_no, r.line.rstrip(" ")) for r in lines.withColumn("run", F.regexp_extract("path", "run=(r[0-9])", 1)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == sorted((f"r{i % 3}", i // 3, f"line {i}") for i in range(6000))


def test_score_report(spark):
    path = fresh_path(spark, "t-report")
    reports.write_score_report(spark.createDataFrame([("b", 0.5, 0.25), ("a", 1.0, 0.75)], "label string, accuracy double, centered double"), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0].startswith("Task".ljust(35) + ", Accuracy  , Centered") and lines[-1].startswith("CORE".ljust(35) + ", " + " " * 10 + ", 0.500000")
    rows = sorted((r.label, r.accuracy, r.centered) for r in reports.read_score_report(spark, path).collect() if r.accuracy is not None)
    assert rows == [("a", 1.0, 0.75), ("b", 0.5, 0.25)]


def test_session_folder(spark, monkeypatch):
    from sparkcorpus import session

    class Context:
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Session.sparkContext.setCheckpointDir("/shared")
    assert session.shared_dir(Session()) == "/shared"


def test_stream_keeps_late_steps(spark):
    path, out, state = fresh_path(spark, "t-metrics"), fresh_path(spark, "t-ema"), fresh_path(spark, "t-state")
    write = lambda rows: spark.createDataFrame(rows, "run long, step long, loss double").coalesce(1).write.mode("append").json(path)
    write([(1, 1, 1.0), (1, 3, 3.0)])
    write([(1, 2, 2.0), (1, 4, 4.0)])  # files out of order: one batch
    assert sorted(r.step for r in streams.stream_ema(spark, path, out, state).collect()) == [1, 2, 3, 4]
    write([(1, 2, 9.0), (1, 5, 5.0)])
    assert sorted(r.step for r in streams.stream_ema(spark, path, out, state).collect()) == [1, 2, 3, 4, 5]
    assert [tuple(r) for r in streams.late_steps(spark, out).collect()] == [(1, 2, 9.0, "behind_saved_step")]


def test_stream_ema_of_many_batches_equals_the_plain_loop(spark):
    path, out, state = fresh_path(spark, "t-metrics"), fresh_path(spark, "t-ema"), fresh_path(spark, "t-state")
    rng, want, s, n, best = random.Random(6), {}, {}, {}, {}
    for batch in range(3):
        rows = [(run, 1000 * batch + i, rng.uniform(1, 5)) for run in (1, 2, 3) if (run + batch) % 3 for i in range(700 if run == 1 else 5)]
        for run, step, loss in rows:
            s[run], n[run], best[run] = 0.9 * s.get(run, 0.0) + 0.1 * loss, n.get(run, 0) + 1, min(best.get(run, 99.0), loss)
            want[run, step] = (s[run] / (1 - 0.9 ** n[run]), best[run])
        rng.shuffle(rows)
        spark.createDataFrame(rows, "run long, step long, loss double").repartition(3).write.mode("append").json(path)
        found = {(r.run, r.step): (r.ema, r.best_so_far) for r in streams.stream_ema(spark, path, out, state).collect()}
    assert set(found) == set(want)
    assert all(found[k] == (pytest.approx(ema, rel=1e-9), low) for k, (ema, low) in want.items())


def test_stream_drops_repeated_steps_and_resumes(spark):
    path, out, state = fresh_path(spark, "t-metrics"), fresh_path(spark, "t-ema"), fresh_path(spark, "t-state")
    write = lambda rows: spark.createDataFrame(rows, "run long, step long, loss double").coalesce(1).write.mode("append").json(path)
    write([(1, 0, 4.0), (1, 1, 2.0)])
    assert streams.stream_ema(spark, path, out, state).count() == 2
    write([(1, 1, 99.0), (1, 2, 3.0)])  # step 1 was seen before
    rows = {r.step: (r.ema, r.best_so_far) for r in streams.stream_ema(spark, path, out, state).collect()}
    s = 0.9 * (0.9 * 0.4 + 0.1 * 2.0) + 0.1 * 3.0
    assert set(rows) == {0, 1, 2} and rows[2] == (pytest.approx(s / (1 - 0.9**3)), 2.0)
