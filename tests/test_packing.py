import random

import pytest
from pyspark.sql import functions as F

from sparkcorpus.functions.arrays import common_prefix_length, mask_padding, mask_targets, shift_inputs, shift_targets
from sparkcorpus.functions.keys import width_bucket
from sparkcorpus.operators import packing


def naive_best_fit(lengths, capacity, buffer_size, crop):
    """Literal reading of the rule: linear scans, strict comparisons, first one wins."""
    source, waiting, rows = list(enumerate(lengths)), [], []
    row, room = [], capacity
    while True:
        while len(waiting) < buffer_size and source:
            waiting.append(source.pop(0))
        if not waiting:
            break
        best = None
        for item in waiting:
            if item[1] <= room and (best is None or item[1] > best[1]):
                best = item
        if best is not None:
            waiting.remove(best)
            row.append(best)
            room -= best[1]
        elif crop:
            shortest = min(waiting, key=lambda item: item[1])
            waiting.remove(shortest)
            row.append((shortest[0], room))
            room = 0
        else:
            room = 0
        if room == 0:
            rows.append(row)
            row, room = [], capacity
    return rows + ([row] if row else [])


def rows_of(placed):
    rows = {}
    for r in placed.orderBy("row_no", "slot").collect():
        rows.setdefault(r.row_no, []).append((r.doc, r["take"]))
    return [rows[i] for i in sorted(rows)]


def lengths_frame(spark, lengths):
    df = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long").repartition(3)
    return packing.pack_groups(df, "doc_id", 1000)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_crop(spark, seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 2, 5, 9, 10, 11, 30, rng.randint(1, 40)]) for _ in range(150)]
    buffer = rng.choice([1, 4, 20])
    placed = packing.pack_bestfit_crop(lengths_frame(spark, lengths), "doc_id", "doc_id", "n", 25, buffer)
    assert rows_of(placed) == naive_best_fit(lengths, 25, buffer, True)
    sums = {r.row_no: (r.used, r.complete) for r in placed.groupBy("row_no").agg(F.sum("take").alias("used"), F.max("complete").alias("complete")).collect()}
    assert all((used == 25) == complete for used, complete in sums.values())
    report = packing.packing_report(placed, 25).first()
    assert report.placed + report.cropped + report.tail == report.tokens == sum(lengths)
    assert report.util_pct == 100.0 and report.pad_pct == 0.0


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_pad(spark, seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 30) for _ in range(120)]
    df = lengths_frame(spark, lengths)
    placed = packing.pack_bestfit_pad(df, "doc_id", "doc_id", "n", 25, 10)
    fitting = [(i, n) for i, n in enumerate(lengths) if n <= 25]
    want = [[(fitting[i][0], n) for i, n in row] for row in naive_best_fit([n for _, n in fitting], 25, 10, False)]
    assert rows_of(placed) == [row for row in want if row]
    assert packing.oversize(df, "n", 25).count() == len(lengths) - len(fitting)


def test_greedy_and_first_fit(spark):
    df = lengths_frame(spark, [6, 5, 9, 2, 12, 4])
    args = ("doc_id", "doc_id", "n", 10)
    assert rows_of(packing.pack_greedy(df, *args, crop=True)) == [[(0, 6), (1, 4)], [(2, 9), (3, 1)], [(4, 10)], [(5, 4)]]
    assert rows_of(packing.pack_greedy(df, *args, crop=False)) == [[(0, 6)], [(1, 5)], [(2, 9)], [(3, 2)], [(4, 10)], [(5, 4)]]
    assert rows_of(packing.pack_ffd(df, *args)) == [[(4, 10)], [(2, 9)], [(0, 6), (5, 4)], [(1, 5), (3, 2)]]


def test_streams_do_not_depend_on_layout(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, rng.randint(1, 50)) for i in range(500)], "doc_id long, n long")
    pack = lambda d: sorted(map(tuple, packing.pack_bestfit_crop(packing.pack_groups(d, "doc_id", 100), "doc_id", "doc_id", "n", 64).collect()))
    assert pack(df) == pack(df.orderBy(F.desc("n")).repartition(6))
    assert {r[0] for r in pack(df)} == {0, 1, 2, 3, 4}


def test_concat_and_fill(spark):
    rng = random.Random(2)
    docs = [[rng.randrange(100) for _ in range(rng.choice([0, 1, 3, 40]))] for _ in range(30)]
    tokens = spark.createDataFrame(list(enumerate(docs)), "doc long, ids array<int>")
    lengths = tokens.select(F.col("doc").alias("doc_id"), F.size("ids").alias("n"))
    placed = packing.pack_concat(lengths, "doc_id", ["doc_id"], width_bucket(F.col("doc_id"), 4), "n", 16)
    rows = packing.fill_rows(placed, tokens, ["row_no"], 16, start="start").orderBy("row_no").collect()
    flat = [t for d in docs for t in d]
    assert [list(r.row) for r in rows] == [flat[i : i + 16] for i in range(0, len(flat), 16)]


def test_masked_rows(spark):
    tokens = spark.createDataFrame([(1, [256, 5, 6, 7], [0, 0, 1, 1]), (2, [256, 8], [0, 1])], "doc long, ids array<int>, mask array<int>")
    df = packing.pack_groups(packing.supervised_only(tokens, "mask").withColumn("n", F.size("ids")), "doc", 10)
    placed = packing.pack_bestfit_pad(df, "doc", "doc", "n", 9)
    row = packing.fill_rows(placed, tokens, ["row_no"], 9, mask="mask", pad_id=256)
    row = row.select("*", shift_inputs(F.col("row")).alias("x"), mask_targets(shift_targets(F.col("row")), F.col("mask_row")).alias("y")).first()
    assert list(row.x) == [256, 5, 6, 7, 256, 8, 256, 256] and row.content_len == 6
    assert list(row.y) == [-1, 6, 7, -1, 8, -1, -1, -1]


def test_target_padding_and_prefix(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 9])], "a array<int>, b array<int>")
    out = df.select(mask_padding(F.col("a"), F.lit(3)), common_prefix_length(F.col("a"), F.col("b")), common_prefix_length(F.col("a"), F.col("a"))).first()
    assert list(out[0]) == [1, 2, -1, -1] and out[1] == 2 and out[2] == 4


def test_progress_and_audit(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "row_no long")
    out = [(r.batch_no, r.consumed, r.epoch) for r in packing.packing_progress(df, "row_no", 4, 5).orderBy("batch_no").collect()]
    assert out == [(0, 4, 1), (1, 8, 2), (2, 10, 3)]
    rows = spark.createDataFrame([(0, [1, -1]), (0, [-1, -1]), (1, [-1])], "batch long, y array<int>")
    audit = {r.batch: (r.supervised, r.fully_masked) for r in packing.supervision_audit(rows, "y", "batch").collect()}
    assert audit == {0: (1, False), 1: (0, True)}


def test_no_supervised_chat_vanishes(spark):
    """Each supervised chat is packed whole or an error row."""
    import __spark_entry__ as entry
    from sparkcorpus.plans.packing import CHAT_CAPACITY, rendered_chats

    sf, queries = "/root/testdata/sf0.01", entry.queries()
    chats = packing.supervised_only(rendered_chats(spark, sf), "mask").select("conv_id", F.size("ids").alias("n")).collect()
    errors = {r.doc: r.n_tokens for r in queries["oversize_chats"](spark, sf).filter("supervised").collect()}
    packed = {r.doc: r["take"] for r in queries["pack_chats"](spark, sf).collect()}
    assert errors and not errors.keys() & packed.keys() and min(errors.values()) > CHAT_CAPACITY
    assert errors | packed == {r.conv_id: r.n for r in chats}


@pytest.mark.parametrize(("name", "crop"), [("pack_bestfit_crop", True), ("pack_bestfit_pad", False)])
def test_queries_look_1000_documents_ahead_in_long_streams(spark, tmp_path, name, crop):
    """The registered queries against the literal rule: one stream, 1000 documents waiting."""
    import __spark_entry__ as entry

    rng = random.Random(7)
    lengths = [rng.choice([rng.randint(2, 200), rng.randint(2, 2400)]) for _ in range(1300)]
    spark.createDataFrame([(i, "x" * (n - 1)) for i, n in enumerate(lengths)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fitting = [(i, n) for i, n in enumerate(lengths) if crop or n <= 2049]
    want = [[(fitting[i][0], n) for i, n in row] for row in naive_best_fit([n for _, n in fitting], 2049, 1000, crop)]
    placed = entry.queries()[name](spark, str(tmp_path))
    assert {r.pack_group for r in placed.select("pack_group").distinct().collect()} == {0}
    assert rows_of(placed) == [row for row in want if row]


def test_chat_query_looks_100_chats_ahead(spark, tmp_path):
    import __spark_entry__ as entry

    rng = random.Random(8)
    sizes = [rng.randint(1, 3000) for _ in range(400)]
    turns = [t for i, n in enumerate(sizes) for t in ((i, 0, "user", "u"), (i, 1, "assistant", "a" * n))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    lengths = [1 + 3 + 2 + n for n in sizes]  # the start, the user's turn, and the answer between its two marks
    placed = entry.queries()["pack_chats"](spark, str(tmp_path))
    assert rows_of(placed) == [row for row in naive_best_fit(lengths, 4097, 100, False) if row]
