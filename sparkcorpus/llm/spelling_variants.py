"""Spelling variants by asymmetric q-chunks.

Words that differ by one inserted, deleted or replaced code point are near. Of two near words the longer one (either, if
they are equally long) contributes two disjoint chunks, its halves; the other contributes its positional grams of those
lengths. One edit changes one half at most, so the other half is a gram of the shorter word, moved by at most one
place: chunks and grams join on length, half and content, where grams are sent for the three places around the
chunk's only, and Levenshtein distance verifies every candidate.

A chunk that more than `crowd` words contribute would pair all its words. Such a chunk is replaced by finer ones: the
half that may hold the edit is halved again, and a key is then all of the word but one quarter, and so on; what stands
before the open part keeps its place, what stands behind it moves by the difference of lengths. At the last step one
code point is open, and as words there are equal but for one place, a key holds no more words than there are
letters. So no words are left out and candidates stay in proportion to the links.

Forms are followed to their roots by pointer doubling; counts at least double with each step, so a few rounds do.

Null texts have no words. Equal words are one, ties of the most frequent near word go to the smallest in code-point
order. A null id is written as nothing before the colon. Very long texts are cut in the JVM, very long words are keyed
by hashes. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import save

RUN = "[A-Za-zÀ-ÿ]+"
EVERY, LEAST_LENGTH, LEAST_COUNT, TIMES, CROWD = 97, 5, 3, 2, 256
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Words with the number `n` of their occurrences, after the slips of the pen that the hash of document and word
    decides. Counts combine before the shuffle."""
    runs = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), F.explode(runs).alias("_run"))
    h = F.crc32(F.encode(F.concat("_id", F.lit(":"), "_run"), "UTF-8"))
    found = found.select("_run", h.alias("_h"))
    at = (F.col("_h") % F.length("_run")).cast("int")
    slip = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    word = F.when(F.col("_h") % EVERY == 0, slip).otherwise(F.col("_run")).alias("word")
    return found.select(word).filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _part(word: Column, start: Column, end: Column) -> Column:
    """Code points from `start` to before `end`."""
    return F.substr(word, (start + 1).cast("int"), (end - start).cast("int"))


def _chunks(words: DataFrame) -> DataFrame:
    """Both halves of each word: `size` is its length, `low` and `high` bound the half that may hold an edit."""
    size = F.length("word")
    middle = (size / 2).cast("int")
    halves = F.array(
        F.struct(middle.alias("low"), size.alias("high"), _part(F.col("word"), F.lit(0), middle).alias("chunk")),
        F.struct(F.lit(0).alias("low"), middle.alias("high"), _part(F.col("word"), middle, size).alias("chunk")),
    )
    found = words.select("word", size.alias("size"), F.explode(halves).alias("c"))
    return found.select("word", "size", "c.low", "c.high", F.xxhash64("c.chunk").alias("key"))


def _grams(words: DataFrame) -> DataFrame:
    """The positional grams of each word that are a chunk's length long and within one place of it, for words as long
    or one longer: `size`, `low`, `high` and `key` as of the chunk."""
    longer = words.select("word", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size"))
    middle = (F.col("size") / 2).cast("int")
    ends = F.array(F.struct(F.lit(0).alias("at"), middle.alias("q"), middle.alias("low"), F.col("size").alias("high")),
                   F.struct(middle.alias("at"), (F.col("size") - middle).alias("q"), F.lit(0).alias("low"), middle.alias("high")))
    places = longer.select("word", "size", F.explode(ends).alias("c")).select("word", "size", "c.*", F.explode(F.array(*map(F.lit, (-1, 0, 1)))).alias("shift"))
    start = F.col("at") + F.col("shift")
    grams = places.filter((start >= 0) & (start + F.col("q") <= F.length("word")))
    key = F.xxhash64(_part(F.col("word"), start, start + F.col("q")))
    return grams.select("word", "size", "low", "high", key.alias("key"))


def _finer(side: DataFrame) -> DataFrame:
    """Each key's open part halved: the new key is all of the word but one half of it."""
    middle = ((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high").alias("high")))
    found = side.select("word", "size", F.explode(halves).alias("c")).select("word", "size", "c.*")
    moved = F.length("word") - F.col("size")
    rest = F.xxhash64(_part(F.col("word"), F.lit(0), F.col("low")), _part(F.col("word"), F.col("high") + moved, F.length("word")))
    return found.select("word", "size", "low", "high", rest.alias("key")).distinct()


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b) of near words, each once."""
    key = ["size", "low", "high", "key"]
    chunks, grams = _chunks(words.select("word")), _grams(words.select("word"))
    found = None
    while True:
        chunks, grams = save(chunks, "chunks"), save(grams, "grams")
        many = chunks.groupBy(key).agg(F.count("*").alias("n")).filter((F.col("n") > crowd) & (F.col("high") - F.col("low") > 1))
        many = save(many.select(key), "crowded-chunks")
        left = chunks.join(many, key, "left_anti").withColumnRenamed("word", "a")
        right = grams.join(many, key, "left_anti").withColumnRenamed("word", "b")
        pairs = left.join(right, key).filter((F.length("b") < F.col("size")) | (F.col("a") < F.col("b")))
        pairs = save(pairs.select("a", "b").filter(F.levenshtein("a", "b", 1) == 1).distinct(), "near-words")
        found = pairs if found is None else found.union(pairs)
        if many.isEmpty():
            return found.distinct()
        chunks, grams = _finer(chunks.join(many, key, "left_semi")), _finer(grams.join(many, key, "left_semi"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) of the words that have a form to (word, root)."""
    jumps = save(forms.select("word", F.col("form").alias("root")), "jumps")
    while True:
        further = jumps.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = jumps.join(further, F.col("root") == F.col("_at"), "left")
        jumps = save(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "jumps")
        if jumps.filter("moved").isEmpty():
            return jumps.select("word", "root")
        jumps = jumps.drop("moved")


def group_variants(words: DataFrame, times: int = TIMES, crowd: int = CROWD) -> DataFrame:
    """(word, n) to one row per word: `form`, the most frequent near word if it is at least `times` as frequent, `root`,
    where forms lead, `n_near` and `form_n`."""
    words = save(words.select("word", "n"), "words")
    pairs = save(near_words(words, crowd), "pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    counted = both.join(words.toDF("near", "near_n"), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(best, "word", "left")
    chosen = -F.col("best.less") >= times * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"))
    rows = save(rows, "forms")
    roots = _roots(rows.filter("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
