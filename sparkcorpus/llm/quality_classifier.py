"""Quality classifier by co-training two views of a document.

The text view sees which words and word beginnings a document has, once or more often, the metadata view its source,
language, size and layout, no words. Each starts from labelled documents. In every round each view labels all unlabelled
documents where it is confident and hands those labels to the other view. At the end both views are calibrated on
labelled documents that neither has learnt from, a logistic combination of the two is fitted there, and it scores all
documents.

One pass reads the texts and writes what the views need of each document, a list of its words above all. Each round is
one pass over that table: Spark scores every document with the models at hand, and sums, over all labelled and
confidently labelled documents, the counts of traits by class for the text view and gradient and (a bound of) the
Hessian of the metadata view. Confidence is that of the view as calibrated on held-out documents. Those sums reach the driver, of a size that is fixed by `SPACE`; so do, once, the views of at most
`LABELLED` labelled rows (those of the lowest hash), on which the weights of the traits are refined and the views
calibrated. No unlabelled document reaches the driver. A trait is a number below `SPACE`, by a hash of the word or of
its beginning, or that number again for a trait that occurs twice or more. The text view uses the `WORDS` traits that
tell most: on the given tables some hundred do all the work. A trait that the labelled rows do not have keeps the
weight that its counts give.

Nothing but slim rows moves to find the labels: bitmaps of places tell each document's labels where it lies.

Nulls: a null text has no words, null source and language are values of their own, null labels are no labels. Of the
labels of an id the larger counts; documents that repeat an id have its labels each. A very long text is one row. Where
labels of only one class, or none, are there, the scores are the share of that class (0.5 if there are no labels). Other
columns pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkcorpus.llm.common import as_bytes, flag_places, located, map_batches, save
from sparkcorpus.llm.decontamination import FOLD

_BITS = 18
LABELLED, WORDS, SPACE = 6000, 1024, 1 << _BITS
#: Word beginnings of so many bytes count besides whole words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
ROUNDS, CONFIDENT, MIN_DOCUMENTS = 3, 0.98, 4
_HELD_OUT = 4
_HASHED, _PLAIN = 64, 11
_SIZE = _PLAIN + 2 * _HASHED
_ROWS = 1024
#: A word has up to seven traits that say the same: each takes a share of what the counts say.
_SHARE = 1 / (1 + len(BEGINNINGS))
_SIGNS = re.compile(rb"[#*$%&|<>!?=+_~^-]{2,4}")
_UPPER, _DIGIT, _SIGN = (bytes(range(a, b)) for a, b in ((65, 91), (48, 58), (33, 48)))


def words(text: bytes) -> Counter[str]:
    """The text view: how often each word occurs, and each run of signs."""
    found = Counter(text.translate(FOLD).decode("utf-8", "replace").split())
    found.update(x.decode() for x in _SIGNS.findall(text))
    return found


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, and powers of an odd base."""
    powers = np.full(size, 0x9E3779B97F4A7C15, np.uint64)
    powers[:1] = 1
    return np.random.default_rng(8).integers(0, 2**64, 256, np.uint64), np.multiply.accumulate(powers)


def _numbers(words: pa.Array) -> np.ndarray:
    """What each word says, itself and its beginnings, as numbers (-1 where it is too short). All hashes of a word are
    differences of one running sum over its bytes."""
    binary = words.cast(pa.binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset : binary.offset + len(binary) + 1].astype(np.int64)
    data = np.frombuffer(binary.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    values, powers = _powers(1 << int(sizes.max(initial=1)).bit_length())
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * powers[place], dtype=np.uint64)])
    found = np.full((len(words), 1 + len(BEGINNINGS)), -1, np.int32)
    for i, k in enumerate((None, *BEGINNINGS)):
        long = np.ones(len(words), bool) if k is None else sizes >= k
        at = starts[long]
        x = sums[at + (sizes[long] if k is None else k)] - sums[at] + np.uint64(k or 977)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        found[long, i] = (x >> np.uint64(64 - _BITS)).astype(np.int32)
    return found


def traits(word: str) -> list[int]:
    """The numbers of one word."""
    return [n for n in _numbers(pa.array([word]))[0].tolist() if n >= 0]


def _matrix(word_lists: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """`_pairs` of any number of rows, some hundred at a time."""
    parts = [(at, *_pairs(word_lists.slice(at, _ROWS), times.slice(at, _ROWS))) for at in range(0, len(word_lists), _ROWS)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate([(at + r).astype(np.int32) for at, r, _ in parts]), np.concatenate([c.astype(np.int32) for _, _, c in parts])


def _pairs(word_lists: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, trait), each once, of lists of words and of how often they occur; a trait that occurs twice or more in
    a row is there under its second number, too."""
    flat = word_lists.flatten().dictionary_encode()
    # a row, a trait and whether the word is said but once, in one number: what is said twice comes first
    row = np.repeat(np.arange(len(word_lists), dtype=np.int32) * np.int32(2 * SPACE), np.diff(word_lists.offsets.to_numpy()))
    row += times.flatten().to_numpy() < 2
    of_word = _numbers(flat.dictionary)[flat.indices.to_numpy()]
    pairs = (row[:, None] + 2 * of_word)[of_word >= 0]
    pairs.sort()
    at = np.flatnonzero(np.diff(pairs >> 1, prepend=np.int32(-1)))
    twice = (np.diff(at, append=len(pairs)) > 1) | (pairs[at] % 2 == 0)
    rows, columns = np.divmod(pairs[at] >> 1, SPACE)
    return np.concatenate([rows, rows[twice]]), np.concatenate([columns, columns[twice] + SPACE])


def _hashed(value: str | None) -> int:
    return zlib.crc32(repr(value).encode()) % _HASHED


def layout(text: bytes) -> list[float]:
    """Size and layout of a text."""
    tokens = text.split()
    n, size = len(tokens), max(1, len(text))
    share = lambda signs: (len(text) - len(text.translate(None, signs))) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    doubled = sum(a == b for a, b in zip(tokens, tokens[1:])) / max(1, n)
    return [
        1, np.log1p(n) / 5, np.log1p(len(lines)) / 5, size / max(1, n) / 10, 10 * share(_UPPER), 10 * share(_DIGIT), 10 * share(_SIGN),
        10 * share(b"#$%&*|<>"), len(set(tokens)) / max(1, n), 10 * doubled, len(set(lines)) / max(1, len(lines)),
    ]


def _dense(plain: pa.Array, source: pa.Array, lang: pa.Array) -> np.ndarray:
    """The metadata view: layout, and hashed source and language."""
    x = np.zeros((len(plain), _SIZE))
    x[:, :_PLAIN] = np.clip(plain.flatten().to_numpy().reshape(-1, _PLAIN), -10, 10)
    for i, value in enumerate((source, lang)):
        x[np.arange(len(x)), _PLAIN + i * _HASHED + value.to_numpy()] = 1
    return x


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, n: float, penalty: float) -> np.ndarray:
    ridge = penalty * n * 0.01
    return w - np.linalg.solve(hessian + (ridge + 1e-6) * np.eye(len(w)), gradient + ridge * w)


def _fit_dense(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps, each halved until it is a gain."""
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, np.where(y > 0.5, -1, 1) * (x @ w)).sum() + penalty * len(y) * 0.005 * (w @ w)
    for _ in range(12):
        p = _sigmoid(x @ w)
        new, now = _step(w, x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x, len(y), penalty), loss(w)
        for _ in range(20):
            if loss(new) <= now:
                break
            new = (w + new) / 2
        w = new
    return w


def _calibrated(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Offset and slope that turn a view's logit into that of the label. A view that is wrong more often than not
    knows nothing."""
    found = _fit_dense(np.stack([np.ones(len(logit)), np.clip(logit, -15, 15)], 1), y, 0.1)
    return found if found[1] > 0 else _fit_dense(np.stack([np.ones(len(logit)), np.zeros(len(logit))], 1), y, 0.1)


@dataclass
class Model:
    """A fitted label: traits and their weights, the weights of the metadata view, the calibration of both views
    (offset and slope each), and the weights of their combination."""

    columns: np.ndarray
    weights: np.ndarray
    offset: float
    layout: np.ndarray
    calibration: np.ndarray
    combined: np.ndarray

    def dense(self) -> np.ndarray:
        found = np.zeros(2 * SPACE)
        found[self.columns] = self.weights
        return found

    def score(self, text_logit, layout_logit):
        x = np.stack([np.ones_like(text_logit), np.clip(text_logit, -15, 15), np.clip(layout_logit, -15, 15)], -1)
        return _sigmoid(x @ self.combined)


def fit_text(counts: np.ndarray, n: np.ndarray, sample: tuple[np.ndarray, np.ndarray], y: np.ndarray, most: int = WORDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Traits, weights and offset of the text view. `counts` (trait, class) and `n` (class) count documents of each
    class; on the sample's documents (`y` 0 or 1) the weights are refined, away from what the counts say."""
    start = float(np.log(max(n[1], 1) / max(n[0], 1)))
    known = np.flatnonzero(counts.sum(1) >= MIN_DOCUMENTS)
    rate = (counts[known] + 0.5) / (n + 1)
    said = np.log(rate[:, 1] / rate[:, 0])
    order = np.argsort(-np.abs(said) * np.sqrt(counts[known].sum(1)), kind="stable")[:most]
    columns, prior = known[order], _SHARE * said[order]
    place = np.full(2 * SPACE, -1)
    place[columns] = np.arange(len(columns))
    used = place[sample[1]] >= 0
    rows, at = sample[0][used], place[sample[1][used]]
    w, offset, speed, speed0 = prior.copy(), start, np.full(len(columns), 1e-8), 1e-8
    for _ in range(150):  # full gradients with steps by their history
        error = _sigmoid(np.bincount(rows, w[at], len(y)) + offset) - y
        gradient, gradient0 = np.bincount(at, error[rows], len(columns)) + 0.1 * (w - prior), error.sum()
        speed += gradient**2
        speed0 += gradient0**2
        w -= 0.3 * gradient / np.sqrt(speed)
        offset -= 0.3 * gradient0 / np.sqrt(speed0)
    return columns, w, offset


def _packed(counts: np.ndarray, sums: np.ndarray) -> bytes:
    """Counts as whole numbers of four or eight bytes, and sums. The counts' first bytes come first, then their second
    bytes, and so on: most but the first are zero."""
    kind = "<i4" if counts.max() < 2**31 else "<i8"
    planes = counts.astype(kind).reshape(-1, 1).view(np.uint8).T
    return kind.encode() + zlib.compress(planes.tobytes() + sums.tobytes(), 1)


def _unpacked(packed: bytes, shapes: tuple) -> tuple[np.ndarray, np.ndarray]:
    data, kind, size = zlib.decompress(packed[3:]), np.dtype(packed[:3].decode()), int(np.prod(shapes[0]))
    planes = np.frombuffer(data, np.uint8, size * kind.itemsize).reshape(kind.itemsize, size)
    counts = np.ascontiguousarray(planes.T).view(kind).astype(float)
    return counts.reshape(shapes[0]), np.frombuffer(data, float, offset=size * kind.itemsize).reshape(shapes[1])


def round_sums(views: DataFrame, names: list[str], models: list[Model | None], confident: float = CONFIDENT) -> tuple[np.ndarray, np.ndarray]:
    """Over all documents that a view learns from, for each label: how many of class 0 and 1 have a trait, and in the last
    place how many there are; and the metadata view's gradient (first row) and a bound of its Hessian, with which a step
    never goes too far. Tasks' sums are added up in a tree."""
    shapes = (len(models), 2, 2 * SPACE + 1), (len(models), 1 + _SIZE, _SIZE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = [None if m is None else m.dense() for m in models]
        counts, sums = map(np.zeros, shapes)
        waiting = {(k, c): [] for k in range(len(models)) for c in (0, 1)}

        def count(least: int) -> None:
            for (k, c), found in waiting.items():
                if sum(map(len, found)) > least:
                    counts[k, c, :-1] += np.bincount(np.concatenate(found), minlength=2 * SPACE)
                    found.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                rows, columns = _pairs(batch.column("words"), batch.column("times"))
                x = _dense(batch.column("layout"), batch.column("source"), batch.column("lang"))
                held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
                for k, model in enumerate(models):
                    if model is None:
                        continue
                    label = batch.column(names[k]).fill_null(-1).to_numpy()
                    logits = np.bincount(rows, weights[k][columns], len(x)) + model.offset, x @ model.layout
                    given = []
                    for logit, (shift, slope) in zip(logits, model.calibration):
                        p = _sigmoid(shift + slope * np.clip(logit, -15, 15))
                        sure = np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1))
                        given.append(np.where(label < 0, sure, np.where(held, -1, label)))
                    for c in (0, 1):  # the text view learns from the metadata view's labels
                        mine = given[1] == c
                        waiting[k, c].append(columns[mine[rows]])
                        counts[k, c, -1] += mine.sum()
                    use = given[0] >= 0
                    sums[k, 0] += x[use].T @ (_sigmoid(x[use] @ model.layout) - given[0][use])
                    sums[k, 1:] += x[use].T @ x[use] / 4
                count(2_000_000)
        count(0)
        yield pa.RecordBatch.from_arrays([pa.array([_packed(counts, sums)], pa.binary())], names=["sums"])

    columns = ["words", "times", "layout", "source", "lang", "held", *names]
    tasks = views.select(*columns).mapInArrow(run, "sums binary").rdd.map(lambda r: bytes(r.sums))

    def added(a: bytes, b: bytes) -> bytes:
        return _packed(*(x + y for x, y in zip(_unpacked(a, shapes), _unpacked(b, shapes)))) if a and b else a or b

    total = tasks.treeAggregate(b"", added, added)
    return _unpacked(total, shapes) if total else tuple(map(np.zeros, shapes))


def document_views(docs: DataFrame, labels: DataFrame, names: list[str], doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", in_place: bool = False) -> DataFrame:
    """What the views see of each document, written to files: `id`, `words` and `times`, `layout`, `source` and `lang`
    as numbers, a hash `h`, `held` (is it held out if it is labelled?), and a column for each label."""
    string = lambda c, name: F.col(c).cast("string").alias(name)
    rows = located(docs, [F.col(doc_id).alias("id"), F.col(text).alias("text"), string(source, "source"), string(lang, "lang")], in_place)
    known = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(*[F.max(n).alias(n) for n in names])
    marked = save(rows.select("id", "_file", "_place").join(known, F.col("id") == F.col("_id")).drop("_id", "id"), "labelled-places")
    for n in names:
        rows = flag_places(rows, marked.filter(F.col(n).isNotNull()), f"_known_{n}")
        rows = flag_places(rows, marked.filter(F.col(n) >= 1), f"_one_{n}")
    given = [F.when(F.col(f"_known_{n}"), F.col(f"_one_{n}").cast("int")).alias(n) for n in names]
    rows = rows.select("text", "source", "lang", "id", F.xxhash64("id", "text").alias("h"), *given)

    def seen(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, sizes = [], []
        for content in as_bytes(batch.column(0)):
            found.append(words(content))
            sizes.append(layout(content))
        columns = [
            pa.array([list(f) for f in found], pa.list_(pa.string())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
            pa.array(sizes, pa.list_(pa.float64())), *[pa.array([_hashed(v) for v in batch.column(i).to_pylist()], pa.int64()) for i in (1, 2)],
        ]
        kept = batch.schema.names[3:]
        yield pa.RecordBatch.from_arrays([*columns, *[batch.column(c) for c in kept]], names=["words", "times", "layout", "source", "lang", *kept])

    kinds = dict(rows.dtypes)
    schema = "words array<string>, times array<int>, layout array<double>, source bigint, lang bigint, " + ", ".join(f"`{c}` {kinds[c]}" for c in ["id", "h", *names])
    return save(map_batches(rows, schema, seen, 1024).withColumn("held", F.pmod("h", F.lit(_HELD_OUT)) == 0), "views", "zstd")


def fit_views(views: DataFrame, names: list[str], labelled: int = LABELLED, rounds: int = ROUNDS, confident: float = CONFIDENT) -> dict[str, Model]:
    """Co-train a model for each label on `document_views`."""
    known = views.filter(F.coalesce(*names).isNotNull())
    last = known.select("h").orderBy("h").limit(labelled).agg(F.max("h")).first()[0]  # only hashes are sorted
    below = known.filter(F.col("h") < F.lit(last))
    some = below.union(known.filter(F.col("h") == F.lit(last)).limit(max(1, labelled - below.count())))
    sample = some.select("words", "times", "layout", "source", "lang", "held", *names).toArrow().combine_chunks()
    column = lambda c: sample.column(c).combine_chunks() if sample.num_rows else pa.array([], sample.schema.field(c).type)
    pairs = _matrix(column("words"), column("times"))
    x = _dense(column("layout"), column("source"), column("lang"))
    held = column("held").to_numpy(zero_copy_only=False).astype(bool)
    y = [column(n).fill_null(-1).to_numpy() for n in names]

    def part(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The traits of some documents of the sample, which are numbered anew."""
        number, inside = np.cumsum(mask) - 1, mask[pairs[0]]
        return number[pairs[0][inside]], pairs[1][inside]

    zeros, neutral, models = np.zeros(_SIZE), np.zeros((2, 2)), []
    empty = np.zeros(0, np.int64)
    constant, learn, train = [], [], []
    for label in y:
        share = label[label >= 0].mean() if (label >= 0).any() else 0.5
        constant.append(Model(empty, np.zeros(0), 0.0, zeros, neutral, np.array([float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))), 0.0, 0.0])))
        train.append((label >= 0) & ~held)
        learn.append(len({*label[train[-1]]}) == 2 and len({*label[(label >= 0) & held]}) == 2)

    def calibrated(k: int, of_text: tuple[np.ndarray, np.ndarray, float], of_layout: np.ndarray) -> Model:
        """Both views, calibrated and combined on the held-out documents."""
        out = (y[k] >= 0) & held
        kinds, (rows, columns) = y[k][out].astype(float), part(out)
        model = Model(*of_text, of_layout, neutral, np.zeros(3))
        logits = np.bincount(rows, model.dense()[columns], len(kinds)) + model.offset, x[out] @ of_layout
        model.calibration = np.stack([_calibrated(v, kinds) for v in logits])
        model.combined = _fit_dense(np.stack([np.ones(len(kinds)), *(np.clip(v, -15, 15) for v in logits)], -1), kinds, 0.1)
        return model

    for k, label in enumerate(y):
        if not learn[k]:
            models.append(None)
            continue
        mine = train[k]
        kinds = label[mine].astype(float)
        rows, columns = part(mine)
        counts = np.stack([np.bincount(columns[kinds[rows] == c], minlength=2 * SPACE) for c in (0, 1)], 1).astype(float)
        n = np.array([(kinds == c).sum() for c in (0, 1)], float)
        models.append(calibrated(k, fit_text(counts, n, (rows, columns), kinds), _fit_dense(x[mine], kinds)))
    for _ in range(rounds if any(learn) else 0):
        counted, summed = round_sums(views, names, models, confident)
        for k, model in enumerate(models):
            if model is None:
                continue
            counts, kinds = counted[k].T, y[k][train[k]].astype(float)
            of_layout = _step(model.layout, summed[k, 0], summed[k, 1:], counts[-1].sum(), 1e-2)
            models[k] = calibrated(k, fit_text(counts[:-1], counts[-1], part(train[k]), kinds), of_layout)
    return {n: constant[k] if model is None else model for k, (n, model) in enumerate(zip(names, models))}


def fit(docs: DataFrame, labels: DataFrame, names: list[str], doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", **options) -> dict[str, Model]:
    """Fit a model for each label column. Options as of `fit_views`."""
    return fit_views(document_views(docs, labels, names, doc_id, text, source, lang), names, **options)


def _scorer(models: dict[str, Model]):
    """A function of the columns of views that gives a struct of each label's probability."""
    dense: list[np.ndarray] = []

    def of(word_lists, times, plain, source, lang) -> pa.Array:
        if not dense:
            dense.extend(m.dense() for m in models.values())
        found = [[] for _ in models]
        for at in range(0, len(plain), _ROWS):
            part = [c.slice(at, _ROWS) for c in (word_lists, times, plain, source, lang)]
            rows, columns = _pairs(*part[:2])
            x = _dense(*part[2:])
            for k, m in enumerate(models.values()):
                found[k].append(m.score(np.bincount(rows, dense[k][columns], len(x)) + m.offset, x @ m.layout))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(f) if f else np.zeros(0)) for f in found], names=list(models))

    return of


def view_scores(models: dict[str, Model]) -> Column:
    """Struct of each label's probability, for rows of `document_views`."""
    of = _scorer(models)

    def run(word_lists: pa.Array, times: pa.Array, plain: pa.Array, source: pa.Array, lang: pa.Array) -> pa.Array:
        return of(word_lists, times, plain, source, lang)

    return F.arrow_udf(run, ", ".join(f"{n} double" for n in models))("words", "times", "layout", "source", "lang")


def scores(models: dict[str, Model], text: str | Column, source: str | Column, lang: str | Column) -> Column:
    """Struct of each label's probability, for any texts."""
    of = _scorer(models)

    def run(texts: pa.Array, sources: pa.Array, langs: pa.Array) -> pa.Array:
        found, sizes = [], []
        for content in as_bytes(texts):
            found.append(words(content))
            sizes.append(layout(content))
        numbers = [pa.array([_hashed(v) for v in c.to_pylist()], pa.int64()) for c in (sources, langs)]
        return of(pa.array([list(f) for f in found], pa.list_(pa.string())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.float64())), *numbers)

    return F.arrow_udf(run, ", ".join(f"{n} double" for n in models))(text, source, lang)
