"""Tokens: histogram, vocabulary training, encode, decode, audits and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkcorpus.functions import bpe
from sparkcorpus.functions.chat import SPECIAL_TOKENS
from sparkcorpus.functions.text import pretokens
from sparkcorpus.session import bound_batches, delete_path, fresh_path

# A vocabulary is a driver-side lookup table; a larger one than this is refused rather than broadcast.
MAX_VOCABULARY = 1_048_576
#: Hot pairs of the first round of training, when nearly every pair of bytes is frequent.
_FIRST_HOT = 64
#: Words whose ids a Python worker keeps from one batch to the next.
_KEPT_WORDS = 200_000


def pretoken_counts(df: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Distinct pre-tokens with their counts: the only corpus-sized step of vocabulary training. Counts are combined
    before the shuffle, so a frequent word moves once per task."""
    return df.select(*by, F.explode(pretokens(F.col(text))).alias("word")).groupBy(*by, "word").agg(F.count("*").alias("n"))


def byte_ranks(spark: SparkSession) -> DataFrame:
    return spark.range(256).select(
        F.col("id").cast("int").alias("rank"), F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token_bytes")
    )


def vocab_table(ranks: DataFrame) -> DataFrame:
    """Ordinary tokens by rank, then the special tokens."""
    spark = ranks.sparkSession
    specials = spark.createDataFrame(list(enumerate(SPECIAL_TOKENS)), "i int, token string")
    offset = ranks.agg(F.max("rank") + 1).scalar()
    return ranks.select(F.col("rank").alias("token_id"), "token_bytes", F.lit(False).alias("is_special")).unionByName(
        specials.select(
            (F.col("i") + offset).cast("int").alias("token_id"),
            F.encode("token", "UTF-8").alias("token_bytes"),
            F.lit(True).alias("is_special"),
        )
    )


def token_bytes_table(vocab: DataFrame) -> DataFrame:
    """Bytes per token, 0 for specials, counted on the raw bytes."""
    return vocab.select("token_id", F.when(F.col("is_special"), 0).otherwise(F.octet_length("token_bytes")).cast("int").alias("n_bytes"))


def _byte_lists(texts: pa.Array) -> pa.Array:
    """The UTF-8 bytes of each text as a list of ids, without a Python object for any of them."""
    raw = texts.cast(pa.binary())
    if not len(raw):
        return pa.array([], pa.list_(pa.int32()))
    _, offsets, data = raw.buffers()
    ends = np.frombuffer(offsets, np.int32)[raw.offset : raw.offset + len(raw) + 1]
    ids = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends - ends[0]), pa.array(ids), mask=texts.is_null() if texts.null_count else None)


def encode_bytes(df: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
    """One id per UTF-8 byte, as `functions.text.byte_ids` gives them, for whole columns of long texts. A null text has
    null ids."""
    bound_batches(df.sparkSession)
    return df.withColumn(ids, F.arrow_udf(lambda texts: _byte_lists(texts), "array<int>")(text))


def encode_segment_bytes(df: DataFrame, segments: str = "segments", encoded: str = "encoded") -> DataFrame:
    """Byte ids of the text of every chat segment, for `functions.chat.rendered`."""

    def encode(rows: pa.Array) -> pa.Array:
        offsets = rows.offsets.to_numpy()
        mask = rows.is_null() if rows.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), _byte_lists(rows.flatten()), mask=mask)

    texts = F.transform(segments, lambda s: F.coalesce(s["text"], F.lit("")))
    return df.withColumn(encoded, F.arrow_udf(lambda rows: encode(rows), "array<array<int>>")(texts))


def with_specials(ids: Column, prepend: int | None = None, append: int | None = None) -> Column:
    parts = [F.array(F.lit(prepend))] if prepend is not None else []
    parts.append(ids)
    if append is not None:
        parts.append(F.array(F.lit(append)))
    return F.concat(*parts)


def _map_strings(function, kind: str, column: str) -> Column:
    """A Python function of one string for each row, in Arrow batches."""
    return F.arrow_udf(lambda words: pa.array([function(w) for w in words.to_pylist()]), kind)(column)


def train_bpe(words: DataFrame, vocab_size: int, candidates: int = 2048, most_segments: int = 400_000) -> DataFrame:
    """Byte-pair vocabulary from (word, n): `rank, token_bytes` and the merged pair `left_rank, right_rank` (null for
    bytes), for vocab_size minus the specials.

    A symbol is one character, so a word is a short string and a merge a string replacement: left to right without
    overlap. A round counts the pairs of all distinct words and takes the first `candidates` of them as hot. The parts of
    words made of hot pairs only, added up over all words, are all it takes to know the next merges one by one, as long
    as these come before any other pair (`functions.bpe.next_merges`); so a round of two jobs gives some
    hundred merges, the same as one-by-one merging. Then the words take the new merges. Of all of this only the hot
    segments reach the driver: if they hold more than `most_segments` symbols, fewer pairs are hot. Ties go to the pair
    whose newer symbol is older."""
    spark = words.sparkSession
    ordinary = vocab_size - len(SPECIAL_TOKENS)
    if ordinary < 256:
        raise ValueError("the vocabulary must hold at least the 256 bytes")
    if vocab_size > MAX_VOCABULARY:
        raise ValueError(f"vocabulary above {MAX_VOCABULARY}")

    def written(table: DataFrame, schema: str) -> tuple[DataFrame, str]:
        path = fresh_path(spark, "bpe-words")
        table.write.parquet(path)
        return spark.read.schema(schema).parquet(path), path

    table = words.select(F.decode(F.encode("word", "UTF-8"), "ISO-8859-1").alias("w"), F.col("n").cast("long").alias("n"))
    table = table.filter(F.length("w") > 1).repartition(spark.sparkContext.defaultParallelism, "w")
    table, path = written(table, "w string, n long")
    pieces: list[bytes] = [bytes([b]) for b in range(256)]
    pairs_of: list[tuple[int | None, int | None]] = [(None, None)] * 256
    ids = {bpe.symbol(i): i for i in range(256)}
    newer = F.greatest(F.substring("pair", 1, 1), F.substring("pair", 2, 1))
    wanted = min(_FIRST_HOT, candidates)

    while len(pieces) < ordinary:
        pairs = table.select(F.explode(F.regexp_extract_all("w", F.lit(r"(?s)(?=(..))"), F.lit(1))).alias("pair"), "n")
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
        ranked = counts.orderBy(F.desc("n"), newer, "pair").limit(wanted + 1).collect()
        if not ranked:
            break
        while True:
            hot = {r["pair"] for r in ranked[:wanted]}
            limit = bpe.order(*ranked[wanted]) if len(ranked) > wanted else None
            parts = table.select(F.explode(_map_strings(lambda w, hot=hot: bpe.hot_segments(w, hot), "array<string>", "w")).alias("w"), "n")
            segments, at = written(parts.groupBy("w").agg(F.sum("n").alias("n")), "w string, n long")
            size = segments.agg(F.sum(F.length("w"))).first()[0]
            if size <= most_segments or wanted == 1:
                break
            delete_path(spark, at)
            wanted = max(1, wanted // 2)
        merges = bpe.next_merges([(r["w"], r["n"]) for r in segments.collect()], limit, len(pieces), ordinary - len(pieces))
        delete_path(spark, at)
        wanted = min(candidates, wanted * max(1, min(8, most_segments // max(1, size))))
        done = {}
        for pair in merges:
            a, b = pair
            done[pair] = len(done), bpe.symbol(len(pieces))
            ids[done[pair][1]] = len(pieces)
            pieces.append(pieces[ids[a]] + pieces[ids[b]])
            pairs_of.append((ids[a], ids[b]))
        if len(pieces) < ordinary:
            merged = table.select(_map_strings(lambda w, done=done: bpe.merge_symbols(w, done), "string", "w").alias("w"), "n")
            old = path
            table, path = written(merged.filter(F.length("w") > 1), "w string, n long")
            delete_path(spark, old)
    delete_path(spark, path)
    return spark.createDataFrame(
        [(i, bytearray(p), *pair) for i, (p, pair) in enumerate(zip(pieces, pairs_of))],
        "rank int, token_bytes binary, left_rank int, right_rank int",
    )


def _ranks_on_driver(ranks: DataFrame) -> dict[bytes, int]:
    rows = ranks.select("token_bytes", "rank").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary above {MAX_VOCABULARY}")
    return {bytes(r["token_bytes"]): r["rank"] for r in rows}


def _flat_ids(words: pa.Array, ranks: dict[bytes, int], seen: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and the number of ids of each. A distinct word is encoded once; `seen` keeps some."""
    distinct = words.dictionary_encode()
    known = []
    for word in distinct.dictionary.cast(pa.binary()).to_pylist():
        if word not in seen:
            if len(seen) >= _KEPT_WORDS:
                seen.clear()
            seen[word] = np.array(bpe.encode_word(word, ranks), np.int32)
        known.append(seen[word])
    lengths = np.fromiter(map(len, known), np.int64, len(known))
    starts = np.cumsum(lengths) - lengths
    at = distinct.indices.to_numpy()
    sizes = lengths[at]
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - sizes), sizes)
    return (np.concatenate(known) if known else np.empty(0, np.int32))[places], sizes


def _gathered(lists: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Offsets of the sums of `sizes` over each list."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    offsets = lists.offsets.to_numpy()
    return ends[offsets - offsets[0]]


def _encoder(df: DataFrame, ranks: DataFrame, nested: bool):
    """Arrow UDF from a list of words per row to its ids, or from a list of such lists. The bounded vocabulary is
    broadcast; words are looked up by batch, without a Python object for each occurrence."""
    shared = df.sparkSession.sparkContext.broadcast(_ranks_on_driver(ranks))

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[bytes, np.ndarray] = {}
        for rows in batches:
            lists = rows.flatten() if nested else rows
            ids, sizes = _flat_ids(lists.flatten(), shared.value, seen)
            inner = pa.ListArray.from_arrays(pa.array(_gathered(lists, sizes), pa.int32()), pa.array(ids))
            if not nested:
                yield inner if not rows.null_count else pa.ListArray.from_arrays(inner.offsets, inner.values, mask=rows.is_null())
                continue
            offsets = rows.offsets.to_numpy()
            yield pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), inner)

    encode.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(encode, "array<array<int>>" if nested else "array<int>")


def encode_corpus(df: DataFrame, ranks: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
    """Ordinary encoding: special strings inside a text stay ordinary text. Pre-tokens are cut in the JVM and a
    document never leaves its partition. A null text has null ids."""
    return df.withColumn(ids, _encoder(df, ranks, nested=False)(pretokens(F.col(text))))


def encode_segments(df: DataFrame, ranks: DataFrame, segments: str = "segments", encoded: str = "encoded") -> DataFrame:
    """Ids of the text of every chat segment, for `functions.chat.rendered`."""
    words = F.transform(segments, lambda s: F.coalesce(pretokens(s["text"]), F.array().cast("array<string>")))
    return df.withColumn(encoded, _encoder(df, ranks, nested=True)(words))


def encode_words(words: DataFrame, ranks: DataFrame) -> DataFrame:
    """Ids of distinct words; with the histogram this counts corpus tokens without encoding the corpus."""
    shared = words.sparkSession.sparkContext.broadcast(_ranks_on_driver(ranks))

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for word in batches:
            yield word.map(lambda w: bpe.encode_word(w.encode("utf-8"), shared.value))

    return words.withColumn("ids", encode("word"))


def count_tokens(words: DataFrame, vocabularies: dict[str, DataFrame]) -> DataFrame:
    """Distinct words to rows (word, tokenizer, n_tokens): one pass encodes a word in all vocabularies. Joined with a
    histogram it compares tokenizers on a corpus that none of them encodes."""
    tables = {name: _ranks_on_driver(ranks) for name, ranks in vocabularies.items()}
    if sum(map(len, tables.values())) > MAX_VOCABULARY:
        raise ValueError(f"vocabularies above {MAX_VOCABULARY} together")
    shared = words.sparkSession.sparkContext.broadcast(tables)
    sizes = _map_strings(lambda w: [len(bpe.encode_word(w.encode(), t)) if w else 0 for t in shared.value.values()], "array<long>", "word")
    names = F.array(*map(F.lit, tables))
    counted = words.select("word", F.explode(F.arrays_zip(names.alias("tokenizer"), sizes.alias("n_tokens"))).alias("t"))
    return counted.select("word", "t.tokenizer", "t.n_tokens")


def decode_corpus(df: DataFrame, vocab: DataFrame, ids: str = "ids", text: str = "text") -> DataFrame:
    """Ids to text; invalid byte sequences become the replacement character. Null ids have a null text. The bytes of a
    batch are gathered at once, without a Python object for each id."""
    rows = vocab.select("token_id", "token_bytes").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary above {MAX_VOCABULARY}")
    bound_batches(df.sparkSession)
    pieces = sorted({r["token_id"]: bytes(r["token_bytes"]) for r in rows}.items())
    table = np.array([i for i, _ in pieces], np.int64), pa.array([p for _, p in pieces], pa.binary())
    shared = df.sparkSession.sparkContext.broadcast(table)
    return df.withColumn(text, F.arrow_udf(lambda lists: _joined(lists, *shared.value), "string")(ids))


def _joined(lists: pa.Array, known: np.ndarray, pieces: pa.Array) -> pa.Array:
    """The text of each list of ids, whose bytes are the `pieces` of the sorted `known` ids."""
    ends = lists.offsets.to_numpy()
    ids = lists.values.slice(ends[0], ends[-1] - ends[0])
    if not len(ids):
        return pa.array([None if null else "" for null in lists.is_null().to_pylist()], pa.string())
    if ids.null_count or not len(known):
        raise KeyError("an id is null, or the vocabulary is empty")
    wanted = ids.to_numpy()
    at = np.minimum(known.searchsorted(wanted), len(known) - 1)
    if (lacking := known[at] != wanted).any():
        raise KeyError(int(wanted[lacking][0]))
    found = pieces.take(pa.array(at))
    _, offsets, data = found.buffers()
    offsets = np.frombuffer(offsets, np.int32)[found.offset : found.offset + len(found) + 1][ends - ends[0]]
    raw = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets.tobytes()), data])
    if lists.null_count:
        raw = pa.compute.if_else(lists.is_valid(), raw, None)
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:  # a text is no UTF-8
        return pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


def roundtrip_audit(
    df: DataFrame, vocab: DataFrame, ids: str = "ids", text: str = "text", by: Sequence[str] = (), also: Sequence[Column] = ()
) -> DataFrame:
    """Documents whose decoded ids differ from the text; `also` adds totals of the same rows, which so are encoded once."""
    back = decode_corpus(df, vocab, ids, "_back")
    return back.groupBy(*by).agg(
        F.count("*").alias("documents"),
        F.sum(F.when(F.col("_back").eqNullSafe(F.col(text)), 0).otherwise(1)).cast("long").alias("mismatches"),
        F.sum(F.octet_length("_back")).cast("long").alias("decoded_bytes"),
        *also,
    )


def compression_report(df: DataFrame, by: Sequence[str], n_bytes: Column, n_tokens: Column) -> DataFrame:
    sums = df.groupBy(*by).agg(F.sum(n_bytes).cast("long").alias("n_bytes"), F.sum(n_tokens).cast("long").alias("n_tokens"))
    ratio = F.when(F.col("n_tokens") > 0, F.col("n_bytes") / F.col("n_tokens"))
    return sums.withColumn("bytes_per_token", ratio)


def compare_tokenizers(report: DataFrame, by: Sequence[str], base: str, ours: str) -> DataFrame:
    """Report rows of two tokenizers side by side; positive difference means fewer tokens for `ours`."""
    side = lambda name, prefix: report.filter(F.col("tokenizer") == name).select(
        *by, F.col("n_bytes").alias(f"{prefix}_bytes"), F.col("n_tokens").alias(f"{prefix}_tokens"),
        F.col("bytes_per_token").alias(f"{prefix}_ratio"),
    )
    both = side(base, "base").join(side(ours, "ours"), list(by))
    better = (
        F.when(F.col("base_ratio") > F.col("ours_ratio"), base).when(F.col("ours_ratio") > F.col("base_ratio"), ours).otherwise("tie")
    )
    return both.withColumn(
        "relative_diff", (F.col("base_tokens") - F.col("ours_tokens")) / F.col("base_tokens") * 100
    ).withColumn("better", better)


def fertility_report(df: DataFrame, sample: str, group: str, chars: Column, n_bytes: Column, n_tokens: Column) -> DataFrame:
    """Tokens per character and characters per token, per sample and as one subtotal per group (sample is null)."""
    base = df.select(F.col(group).alias("grp"), F.col(sample).alias("sample"), chars.alias("c"), n_bytes.alias("b"), n_tokens.alias("t"))
    sums = base.rollup("grp", "sample").agg(
        F.sum("c").cast("long").alias("characters"),
        F.sum("b").cast("long").alias("n_bytes"),
        F.sum("t").cast("long").alias("n_tokens"),
        F.grouping_id().alias("level"),
    )
    return (
        sums.filter("level < 3").drop("level")
        .withColumn("tokens_per_char", F.when(F.col("characters") > 0, F.col("n_tokens") / F.col("characters")))
        .withColumn("chars_per_token", F.when(F.col("n_tokens") > 0, F.col("characters") / F.col("n_tokens")))
    )
