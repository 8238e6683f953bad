import random
import time
from collections import Counter

import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from sparkcorpus.functions import bpe
from sparkcorpus.functions.chat import SPECIAL_TOKENS
from sparkcorpus.functions.text import SPLIT_PATTERN, byte_ids, pretokens, utf8_prefix
from sparkcorpus.operators import tokenization as tok

CORPUS = [
    "the quick brown fox jumps over the lazy dog",
    "hello hello hello world, hello!",
    "numbers 0 1 22 333 4444 and naïve café 你好 🙂",
    "def add(a, b):\n    return a + b\n",
]
TRICKY = [
    "", " ", "  a  b", "a\n\n  b \r\n c", "don't WE'LL I'M x'sy", "ſ 'ſ", "1234567 ٣٤٥", "a  b", "x 　y ​ z",
    "tab\t\tb\x0bc\x1cd", "mixed 你好，世界!!!\n\n", "🙂🙂 é", "trailing   ", "\r\r\n x",
]


def test_pretokens_equal_the_regex_module(spark):
    rng = random.Random(5)
    texts = TRICKY + ["".join(rng.choice("ab 1'\n\r\ts!é你 🙂") for _ in range(40)) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", pretokens(F.col("t")).alias("w"))
    got = {r.i: r.w for r in df.collect()}
    for i, text in enumerate(texts):
        assert got[i] == regex.findall(SPLIT_PATTERN, text), repr(text)


def plain_bpe(words: dict[str, int], merges: int) -> list[tuple[int, int]]:
    """One merge at a time over lists of ids; ties go to the pair whose newer symbol is older."""
    table = [(list(w.encode()), n) for w, n in words.items()]
    learned = []
    for _ in range(merges):
        counts = Counter()
        for ids, n in table:
            for pair in zip(ids, ids[1:]):
                counts[pair] += n
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], max(p), p))
        new = 256 + len(learned)
        learned.append(best)
        for ids, _ in table:
            i = 0
            while i < len(ids) - 1:
                if (ids[i], ids[i + 1]) == best:
                    ids[i : i + 2] = [new]
                i += 1
    return learned


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.createDataFrame(list(enumerate(CORPUS * 8)), "pos long, text string")
    words = tok.pretoken_counts(docs)
    ranks = tok.train_bpe(words, 256 + 35 + len(SPECIAL_TOKENS)).cache()
    return words, ranks


def test_training_equals_plain_merging(trained):
    words, ranks = trained
    learned = [(r.left_rank, r.right_rank) for r in ranks.filter("rank >= 256").orderBy("rank").collect()]
    assert learned == plain_bpe({r.word: r.n for r in words.collect()}, 35)


@pytest.mark.parametrize("candidates", [1, 3, 10, 100])
def test_merges_planned_on_hot_segments_equal_plain_merging(candidates):
    rng, rounds, merges = random.Random(11), 0, 0
    for _ in range(500):
        words = {"".join(rng.choice("abcdef"[: rng.randint(1, 6)]) for _ in range(rng.randint(1, 9))): rng.randint(1, 5) for _ in range(rng.choice([3, 8, 20]))}
        want, table, got = plain_bpe(words, 12), [(w, n) for w, n in words.items()], []
        while len(got) < 12:
            counts = Counter()
            for w, n in table:
                for i in range(len(w) - 1):
                    counts[w[i : i + 2]] += n
            ranked = sorted(counts.items(), key=lambda e: bpe.order(*e))
            if not ranked:
                break
            hot = {p for p, _ in ranked[:candidates]}
            limit = bpe.order(*ranked[candidates]) if len(ranked) > candidates else None
            segments = Counter()
            for w, n in table:
                for part in bpe.hot_segments(w, hot):
                    segments[part] += n
            found = bpe.next_merges(segments.items(), limit, 256 + len(got), 12 - len(got))
            assert found
            rounds += 1
            done = {p: (i, bpe.symbol(256 + len(got) + i)) for i, p in enumerate(found)}
            table = [(bpe.merge_symbols(w, done), n) for w, n in table]
            got += [(ord(a), ord(b)) for a, b in found]
        merges += len(got)
        assert got == want
    assert candidates == 1 or merges > 1.5 * rounds


def test_merging_long_and_short_words_alike():
    rng = random.Random(3)
    done = {"ab": (0, "X"), "Xc": (1, "Y"), "aa": (2, "Z"), "ZZ": (3, "W")}
    for n in range(1, 200):
        word = "".join(rng.choices("abc", k=n))
        want = word
        for pair, (_, new) in done.items():
            want = want.replace(pair, new)
        assert bpe.merge_symbols(word, done) == want


def test_training_many_merges_in_small_rounds(spark):
    rng = random.Random(4)
    words = {"".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 10))): rng.choice([1, 1, 2, 3, 50]) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    want = plain_bpe(words, 512)
    assert len(want) == 512
    for options in ({}, {"most_segments": 1000}):
        ranks = tok.train_bpe(df, 256 + 512 + len(SPECIAL_TOKENS), **options)
        assert [(r.left_rank, r.right_rank) for r in ranks.filter("rank >= 256").orderBy("rank").collect()] == want


def test_encoding_long_words_is_not_quadratic(trained):
    ranks = {bytes(r.token_bytes): r["rank"] for r in trained[1].collect()}
    codec = tiktoken.Encoding("t", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for text in ("".join(rng.choices("the lo", k=3000)), "o" * 999, "hello" * 500, "ab"):
        assert bpe.encode_word(text.encode(), ranks) == codec.encode_ordinary(text)
    started = time.time()
    assert len(bpe.encode_word(b"hello wo" * 62_500, ranks)) < 500_000
    assert time.time() - started < 10


def test_encoding_equals_an_independent_codec(spark, trained):
    ranks = {bytes(r.token_bytes): r["rank"] for r in trained[1].collect()}
    codec = tiktoken.Encoding("t", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = CORPUS + TRICKY + ["unseen tokens: zqxjkv", "a <|bos|> in text is text"]
    df = tok.encode_corpus(spark.createDataFrame(list(enumerate(texts)), "i long, text string"), trained[1])
    for row in df.collect():
        assert list(row.ids) == codec.encode_ordinary(texts[row.i])


def test_vocabulary_and_round_trip(spark, trained):
    vocab = tok.vocab_table(trained[1])
    assert vocab.count() == 256 + 35 + 9
    specials = {r.token_id: r.token_bytes.decode() for r in vocab.filter("is_special").collect()}
    assert [specials[i] for i in sorted(specials)] == SPECIAL_TOKENS and min(specials) == 291
    lengths = {r.token_id: r.n_bytes for r in tok.token_bytes_table(vocab).collect()}
    assert lengths[0] == 1 and lengths[291] == 0 and max(lengths.values()) > 1
    df = spark.createDataFrame([(t,) for t in TRICKY + CORPUS], "text string")
    audit = tok.roundtrip_audit(tok.encode_corpus(df, trained[1]), vocab).first()
    assert audit.mismatches == 0 and audit.documents == len(TRICKY + CORPUS)


def test_histogram_counts_tokens_like_encoding(spark, trained):
    docs = spark.createDataFrame([(t,) for t in CORPUS + TRICKY], "text string")
    direct = tok.encode_corpus(docs, trained[1]).agg(F.sum(F.size("ids"))).first()[0]
    words = tok.encode_words(tok.pretoken_counts(docs), trained[1])
    assert words.agg(F.sum(F.size("ids") * F.col("n"))).first()[0] == direct


def test_decoding_invalid_bytes(spark):
    vocab = tok.vocab_table(tok.byte_ranks(spark))
    df = spark.createDataFrame([([104, 105, 0xE4],)], "ids array<int>")
    assert tok.decode_corpus(df, vocab).first().text == "hi�"


def test_byte_ids_and_specials(spark):
    df = spark.createDataFrame([("aé🙂",), ("",)], "t string")
    ids = df.select(byte_ids(F.col("t")).alias("i"), tok.with_specials(byte_ids(F.col("t")), 256, 260).alias("s")).collect()
    assert list(ids[0].i) == list("aé🙂".encode()) and ids[1].i == []
    assert ids[1].s == [256, 260]


@pytest.mark.parametrize("budget, want", [(0, ""), (1, "a"), (2, "ab"), (3, "ab"), (4, "ab"), (5, "ab你"), (9, "ab你")])
def test_utf8_prefix(spark, budget, want):
    assert spark.createDataFrame([("ab你",)], "t string").select(utf8_prefix(F.col("t"), F.lit(budget))).first()[0] == want


def test_vocabulary_bounds(spark):
    words = spark.createDataFrame([("ab", 1)], "word string, n long")
    with pytest.raises(ValueError):
        tok.train_bpe(words, 100)
    assert tok.train_bpe(words, 256 + 9 + 5).count() == 257  # one pair, then nothing is left to merge


def test_comparison_and_fertility(spark):
    report = spark.createDataFrame(
        [("base", "x", 100, 50, 2.0), ("ours", "x", 100, 40, 2.5), ("base", "y", 10, 5, 2.0), ("ours", "y", 10, 5, 2.0)],
        "tokenizer string, src string, n_bytes long, n_tokens long, bytes_per_token double",
    )
    rows = {r.src: (r.relative_diff, r.better) for r in tok.compare_tokenizers(report, ["src"], "base", "ours").collect()}
    assert rows == {"x": (20.0, "ours"), "y": (0.0, "tie")}
