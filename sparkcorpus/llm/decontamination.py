"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

Test strings are windows of consecutive benchmark words. For each window length there is a shift table: how far the
search may move when a block of two words ends at the present position. A block that no window contains moves it by a
whole window; a block that ends a window has shift 0 and points to a bucket of windows, which are compared word by
word. Words outside the benchmark all have number 0, so foreign text is crossed in the longest steps.

The benchmark goes to the executors in blocks of at most `BLOCK_WORDS` words in expectation, one pass over the corpus
per block, so its size is not bounded by a task's memory. What a pass finds depends on the text alone and is keyed by
the text's md5: copies of a document are found once.

Nulls have no words. A benchmark item with fewer words than a window is one window; one without words never occurs. A
null item id counts as the empty name; items that share an id count once. Empty tables give documents without hits.
Other columns are not touched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import as_bytes, map_batches, save, whole_row

WINDOW = 10
BLOCK_WORDS = 2_000_000
_KEY = "_text_md5"
#: Upper case becomes lower case, every other ASCII character that is no letter or digit becomes a blank.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


class Patterns:
    """Shift tables and buckets of a block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        windows: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for i in range(len(ids) - length + 1 if ids else 0):
                windows[length][tuple(ids[i : i + length])].add(name)
        self.base = len(self.numbers) + 1
        self.groups = [(length, *self._tables(length, found)) for length, found in sorted(windows.items())]

    def _tables(self, length: int, windows: dict) -> tuple[dict, dict]:
        shifts: dict[int, int] = {}
        buckets: dict[int, dict] = defaultdict(dict)
        for words, names in windows.items():
            for end in range(min(1, length - 1), length):
                block = self._block(words, end)
                shifts[block] = min(shifts.get(block, length), length - 1 - end)
            buckets[self._block(words, length - 1)][words] = sorted(names)
        return shifts, dict(buckets)

    def _block(self, ids, end: int) -> int:
        return ids[end] + (ids[end - 1] * self.base if end else 0)

    def find(self, text: bytes) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans [start, stop) of all occurrences, and the names of the items that they belong to."""
        number = self.numbers.get
        ids = [number(w, 0) for w in words_of(text)]
        spans, names, base, n = [], set(), self.base, len(ids)
        for length, shifts, buckets in self.groups:
            default = max(1, length - 1)
            shift, end = shifts.get, length - 1
            while end < n:
                block = ids[end] + ids[end - 1] * base if length > 1 else ids[end]
                step = shift(block, default)
                if step:
                    end += step
                    continue
                start = end + 1 - length
                if found := buckets[block].get(tuple(ids[start : end + 1])):
                    spans.append((start, end + 1))
                    names.update(found)
                end += 1
        return spans, names


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of bounded size, by a hash of their rows."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("name"), F.col(text).alias("item"))
    total = items.agg(F.sum(word_count("item"))).first()[0] or 0
    n_blocks = -(-total // block_words)
    for block in range(n_blocks):
        mine = items.filter(F.pmod(F.xxhash64("name", "item"), F.lit(n_blocks)) == block)
        yield [(r.name, (r.item or "").encode()) for r in mine.toLocalIterator()]


def find_items(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per distinct text with an occurrence: `_text_md5`, `spans` (word spans, sorted), `items` (names)."""
    texts = docs.select(F.unhex(F.md5(F.col(text))).alias(_KEY), F.col(text).alias("_text"))
    columns = {_KEY: "binary", "spans": "array<struct<start:bigint,stop:bigint>>", "items": "array<string>"}
    schema = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    # not createDataFrame: rows from the driver pass through Python workers of another kind, which stay on the executors
    found = docs.sparkSession.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns.items()])
    for items in _blocks(benchmark, item_id, item_text, block_words):
        patterns = docs.sparkSession.sparkContext.broadcast(Patterns(items, window))

        def search(batch: pa.RecordBatch, patterns=patterns):
            kind = pa.schema([(_KEY, pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string()))])
            rows = []
            for key, content in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                spans, names = patterns.value.find(content)
                if spans:
                    rows.append({_KEY: key, "spans": [{"start": a, "stop": b} for a, b in spans], "items": sorted(names)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kind)

        found = found.unionByName(save(map_batches(texts, schema, search).dropDuplicates([_KEY]), "benchmark-hits"))
    together = found.groupBy(_KEY).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return save(together.select(_KEY, F.array_sort("spans").alias("spans"), F.array_sort(F.array_distinct("items")).alias("items")), "benchmark-texts")


def hit_words(spans: Column) -> Column:
    """Number of words that sorted spans cover."""
    start = F.struct(F.lit(0).cast("long").alias("covered"), F.lit(0).cast("long").alias("end"))

    def step(acc, span):
        stop = F.greatest(acc["end"], span["stop"])
        return F.struct((acc["covered"] + stop - F.greatest(acc["end"], F.least(span["start"], stop))).alias("covered"), stop.alias("end"))

    return F.aggregate(spans, start, step, lambda acc: acc["covered"])


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """Every row (or the columns to keep) as struct `row` with `n_words`, `n_hit` (words inside an occurrence) and `items` (sorted names)."""
    found = find_items(docs, benchmark, text, **options)
    rows = docs.select(whole_row(docs, keep), word_count(text).alias("n_words"), F.unhex(F.md5(F.col(text))).alias("_key"))
    joined = rows.join(found, F.col("_key") == F.col(_KEY), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "row", "n_words", F.coalesce(hit_words(F.col("spans")), F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without any occurrence, with their columns as they are."""
    found = find_items(docs, benchmark, text, **options).select(_KEY)
    rows = docs.select(whole_row(docs), F.unhex(F.md5(F.col(text))).alias("_key"))
    return rows.join(found, F.col("_key") == F.col(_KEY), "left_anti").select("row.*")
