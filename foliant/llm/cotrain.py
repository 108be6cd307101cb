"""Quality classifier by co-training of two views.

The text view sees words, beginnings of words and style of the text, the metadata view columns beside
it. Both start from the same bounded sample of labelled rows; in each round each
labels, of all unlabelled documents of the table, those of which it is surest, for
the other to learn from. At the end each view is calibrated on labelled documents
kept apart, and the calibrated odds are combined.

The texts are turned into features once, and the features written; a round is one
pass over them, from which each task gives its surest few. What the driver holds
is bounded by the parameters, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliant.llm.words import NOT_ALPHANUMERIC, mix, portions, signed, text_buffer, word_hashes
from foliant.session import written

FILTER_BITS = 22
FIGURES = 14
ROWS = 1024
#: Groups in which picks of the tasks meet before all do.
GROUPS = 1000
#: Bytes of text that a task turns into numbers at once.
PORTION = 1 << 20
STEM = 6
#: How often a term must occur, a column each. A short word is its stem too, so it counts twice.
LEVELS = (1, 3, 6)
_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_BREAK = _BYTE == 10
_SIGN = NOT_ALPHANUMERIC & (_BYTE > 32)


@dataclass(frozen=True)
class CoTraining:
    """labelled: documents of the sample, about. words: of the text view,
    each with at least gain, twice the log likelihood ratio, of association with
    the labels. bins: of a style figure. rounds, surest: of the exchange, documents
    that a view may label per round and class. confidence: least probability of a pseudo-label. threshold, highest: a document
    of lower score than the cut is rejected; the cut lies between them, as high as
    the calibration documents allow if no more than a share of lost of the good ones
    may lie below it."""

    labelled: int = 12_000
    words: int = 512
    gain: float = 14.0
    bins: int = 10
    rounds: int = 3
    surest: int = 300
    confidence: float = 0.95
    ridge: float = 0.5
    threshold: float = 0.2
    highest: float = 0.5
    lost: float = 0.01


@dataclass
class View:
    """A logistic model with its calibration: odds = scale * (x . weights) + shift."""

    weights: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        w = self.weights[:-1].astype(np.float32)
        parts = [x[i : i + ROWS].astype(np.float32) @ w for i in range(0, len(x), ROWS)]
        return np.concatenate([np.zeros(0, np.float32), *parts]) + self.weights[-1]

    def odds(self, x: np.ndarray) -> np.ndarray:
        return self.scale * self.raw(x) + self.shift


@dataclass
class Model:
    words: np.ndarray
    edges: np.ndarray  # style figures x inner bin edges
    text: View | None = None
    meta: View | None = None
    prior: float = 0.0
    cut: float = CoTraining.threshold
    columns: list[str] = field(default_factory=list)


# Features.


def _stems(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the first bytes of each word; a word of no more than STEM bytes is its own stem."""
    if not len(words):
        return words
    word = ~NOT_ALPHANUMERIC[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inside = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inside] |= word[inside]
    ends[inside - 1] |= word[inside - 1]
    first = np.flatnonzero(begins)
    long = np.flatnonzero(np.flatnonzero(ends) + 1 - first > STEM)
    key = np.zeros(len(long), np.uint64)
    for k in range(STEM):
        key = key << np.uint64(8) | data[first[long] + k].astype(np.uint64)
    stems = words.copy()
    stems[long] = mix(~key)
    return stems


def _text(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and stems, their bounds by text, and style figures of texts."""
    data, offsets = text_buffer(column)
    lower = text_buffer(pc.utf8_lower(pc.fill_null(column, "")))
    words, bounds = word_hashes(*lower, blanks=NOT_ALPHANUMERIC)

    def per_text(of_byte: np.ndarray) -> np.ndarray:
        out, some = np.zeros(len(offsets) - 1, np.int64), offsets[1:] > offsets[:-1]
        if some.any():
            out[some] = np.add.reduceat(of_byte, offsets[:-1][some], dtype=np.int64)
        return out

    def count(kind: np.ndarray) -> np.ndarray:
        return per_text(kind[data])

    def pairs(kind: np.ndarray) -> np.ndarray:
        """Bytes of a kind that follow one of it."""
        of = kind[data]
        return per_text(np.concatenate([[False], of[1:] & of[:-1]])) if len(of) else count(kind)

    size = np.maximum(np.diff(offsets), 1)
    n = np.diff(bounds)
    some = np.maximum(n, 1)
    letters = np.maximum(count(_LETTER), 1)
    sign_pairs, upper_pairs, bars = pairs(_SIGN), pairs(_UPPER), count(_BYTE == ord("|"))
    same = np.concatenate([[0], np.cumsum(np.concatenate([words[1:] == words[:-1], [False]]) if len(words) else [], dtype=np.int64)])
    distinct = np.array([len(np.unique(words[bounds[i] : bounds[i + 1]])) for i in range(len(n))], np.int64).reshape(len(n))
    repeats = same[bounds[1:]] - same[bounds[:-1]]
    figures = [
        letters / size,
        count(_UPPER) / letters,
        count(_DIGIT) / size,
        count(_SIGN) / some,
        count(_BREAK) / some,
        bars / some,
        letters / some,
        distinct / some,
        repeats / some,
        *(np.log2(1 + x) for x in (sign_pairs, upper_pairs, bars, repeats)),
        np.log2(some),
    ]
    terms = np.stack([words, _stems(*lower, words)], axis=1).ravel()
    return terms, 2 * bounds, np.stack(figures, axis=1)


class Finder:
    """Which of a few terms each text holds: a column per term and level of how often."""

    def __init__(self, words: np.ndarray):
        self.order = np.argsort(words)
        self.sorted = words[self.order]
        self.present = np.zeros(1 << FILTER_BITS, bool)
        self.present[words >> np.uint64(64 - FILTER_BITS)] = True

    def __call__(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        shape = len(bounds) - 1, len(self.sorted)
        counts = np.zeros(shape, np.int64)
        near = np.flatnonzero(self.present[words >> np.uint64(64 - FILTER_BITS)])
        if len(near):
            spot = np.minimum(np.searchsorted(self.sorted, words[near]), len(self.sorted) - 1)
            hit = self.sorted[spot] == words[near]
            place = (np.searchsorted(bounds, near[hit], "right") - 1) * shape[1] + self.order[spot[hit]]
            counts = np.bincount(place, minlength=shape[0] * shape[1]).reshape(shape)
        return np.concatenate([counts >= level for level in LEVELS], axis=1)


def _binned(style: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A column per bin of every style figure."""
    bins = edges.shape[1] + 1
    out = np.zeros((len(style), style.shape[1], bins), bool)
    for j in range(style.shape[1]):
        out[np.arange(len(style)), j, np.searchsorted(edges[j], style[:, j], "right")] = True
    return out.reshape(len(style), style.shape[1] * bins)


META_BINS = 256


def meta_bins(docs: DataFrame, columns: Sequence[str]) -> Column:
    """An array with a bin number per metadata column; a null has a bin of its own, numbers go by powers of two."""
    kinds = dict(docs.dtypes)
    bins = []
    for i, name in enumerate(columns):
        c = F.col(name)
        numeric = kinds[name] in ("bigint", "int", "double", "float", "smallint", "tinyint") or kinds[name].startswith("decimal")
        value = F.floor(F.log2(F.abs(c.cast("double")) + 1)) if numeric else c.cast("string")
        bin = F.pmod(F.xxhash64(value), F.lit(META_BINS - 1)) + 1
        bins.append((F.when(c.isNull(), 0).otherwise(bin) + i * META_BINS).cast("int"))
    return F.array(*bins) if bins else F.array().cast("array<int>")


def _meta(bins: list[list[int]], columns: int) -> np.ndarray:
    out = np.zeros((len(bins), columns * META_BINS), bool)
    for i, row in enumerate(bins):
        out[i, row] = True
    return out


# Fitting.


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float, start: View | None = None) -> View:
    """Logistic regression by Newton steps; the last weight is the constant."""
    used = np.append(np.flatnonzero(x.any(axis=0)), x.shape[1])
    weights = np.zeros(x.shape[1] + 1) if start is None else start.weights.copy()
    w = weights[used]
    for _ in range(12):
        curve, slope = ridge * np.eye(len(used)), ridge * w
        for i in range(0, len(x), ROWS):  # numbers of a few rows at a time: the driver holds the table as bits
            part = np.ones((len(x[i : i + ROWS]), len(used)), np.float32)
            part[:, :-1] = x[i : i + ROWS, used[:-1]]
            chance = sigmoid(part @ w.astype(np.float32))
            slope += part.T @ (chance - y[i : i + ROWS]).astype(np.float32)
            curve += (part * np.maximum(chance * (1 - chance), 1e-4).astype(np.float32)[:, None]).T @ part
        step = np.linalg.solve(curve, slope)
        w = w - step
        if np.abs(step).max() < 1e-2:
            break
    weights[used] = w
    return View(weights)


def _calibrate(view: View, x: np.ndarray, y: np.ndarray) -> None:
    """Platt scaling with smoothed targets, on documents that the view has not learned from."""
    raw = view.raw(x)
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0.5, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(a * raw + b)
        v = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - target) * raw).sum() + (a - 1), (p - target).sum()])
        h = np.array([[(v * raw * raw).sum() + 1, (v * raw).sum()], [(v * raw).sum(), v.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-6:
            break
    view.scale, view.shift = max(a, 0.0), b


Picks = list[tuple[int, np.ndarray, np.ndarray, float]]  # print, features of both views, label


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, surest: Callable[[Sequence[View], Sequence[set]], Sequence[Picks]], p: CoTraining) -> tuple[View, View]:
    """Two views from rows with labels y and the unlabelled ones that the views label for each other.

    surest(views, taken): for each view the documents it is surest of, without those
    whose prints are taken, because the other view has them already.
    """
    rows: list[list[np.ndarray]] = [[text], [meta]]
    labels: list[list[np.ndarray]] = [[y], [y]]
    taken: list[set] = [set(), set()]
    fitted: list[View | None] = [None, None]
    for turn in range(p.rounds + 1):
        for i in (0, 1):
            fitted[i] = fit(np.concatenate(rows[i]), np.concatenate(labels[i]), p.ridge, fitted[i])
        if turn == p.rounds:
            break
        for i, picks in enumerate(surest(fitted, (taken[1], taken[0]))):
            other = 1 - i
            if picks:
                rows[other].append(np.stack([pick[1 + other] for pick in picks]))
                labels[other].append(np.array([pick[3] for pick in picks]))
                taken[other].update(pick[0] for pick in picks)
    return fitted[0], fitted[1]


def best_picks(views: Sequence[View], taken: Sequence[set], prints: np.ndarray, x: Sequence[np.ndarray], p: CoTraining) -> Iterator[tuple[int, float, float, int]]:
    """(view, label, certainty, place) of the surest of these documents, one per print."""
    prints, first = np.unique(prints, return_index=True)
    for i, view in enumerate(views):
        open_ = first[~np.isin(prints, np.fromiter(taken[i], np.int64, len(taken[i])))]
        chance = sigmoid(view.raw(x[i][open_]).astype(float))
        for label, certainty in ((1.0, chance), (0.0, 1 - chance)):
            order = np.argsort(-certainty, kind="stable")[: p.surest]
            for k in order[certainty[order] >= p.confidence].tolist():
                yield i, label, float(certainty[k]), int(open_[k])


# Jobs.


COUNTS = [f"{kind}{level}" for level in LEVELS for kind in ("good", "bad")]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many good and bad documents of a task hold each term as often as each level."""
    for batch in (b.slice(i, j - i) for b in batches for i, j in portions(b.column(0), PORTION)):
        words, bounds, _ = _text(batch.column(0))
        good = np.array(batch.column(1).to_pylist(), bool)
        sets = [np.unique(words[bounds[i] : bounds[i + 1]], return_counts=True) for i in range(len(good))]
        if sets:
            of_word, places = np.unique(np.concatenate([s for s, _ in sets]), return_inverse=True)
            often = np.concatenate([n for _, n in sets])
            is_good = np.repeat(good, [len(s) for s, _ in sets])
            counts = [np.bincount(places[(often >= level) & (is_good == kind)], minlength=len(of_word)) for level in LEVELS for kind in (True, False)]
            yield pa.RecordBatch.from_arrays([pa.array(signed(of_word)), *map(pa.array, counts)], ["word", *COUNTS])


FEATURES = "bins array<int>, words array<int>, style array<double>"


def _featurizer(words: np.ndarray):
    """Features of texts, in place of the first column; the last column is bins."""

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(words)
        for batch in (b.slice(i, j - i) for b in batches for i, j in portions(b.column(0), PORTION)):
            hashes, bounds, style = _text(batch.column(0))
            found = find(hashes, bounds)
            row, column = np.nonzero(found)
            held = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(found) + 1)).astype(np.int32)), pa.array(column.astype(np.int32)))
            ends = (np.arange(len(style) + 1) * FIGURES).astype(np.int32)
            columns = [*batch.columns[1:], held, pa.ListArray.from_arrays(pa.array(ends), pa.array(style.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[1:], "words", "style"])

    return featurize


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row and the value of every element of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(column)), sizes), pc.list_flatten(column).to_numpy(zero_copy_only=False)


def matrices(bins: pa.Array, words: pa.Array, style: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Both views' features of written rows, a column each."""
    held = np.zeros((len(words), len(LEVELS) * len(model.words)), bool)
    held[_flat(words)] = True
    meta = np.zeros((len(bins), len(model.columns) * META_BINS), bool)
    meta[_flat(bins)] = True
    figures = _flat(style)[1].reshape(len(style), FIGURES)
    return np.concatenate([held, _binned(figures, model.edges)], axis=1), meta


PICKED = f"view int, label double, certainty double, print bigint, {FEATURES}"


def _picker(model: Model, views: Sequence[View], taken: Sequence[set], p: CoTraining):
    """Each task's surest documents of each view and class."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, float], list] = {}
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            prints, features = batch.column(0).to_numpy(), batch.columns[1:4]
            x = matrices(*features, model)
            for view, label, certainty, at in best_picks(views, taken, prints, x, p):
                held = best.setdefault((view, label), [])
                if len(held) < p.surest or certainty > held[-1][0]:
                    held.append((certainty, int(prints[at]), [c[at].as_py() for c in features]))
            for key, held in best.items():
                firsts = {print_: (-certainty, print_, row) for certainty, print_, row in held}
                best[key] = [(-c, k, row) for c, k, row in sorted(firsts.values(), key=lambda v: v[:2])[: p.surest]]
        rows = [(view, label, c, k, *row) for (view, label), held in best.items() for c, k, row in held]
        if rows:
            kinds = pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())
            names = ["view", "label", "certainty", "print", "bins", "words", "style"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return pick


def _surest(pool: DataFrame, model: Model, p: CoTraining):
    """``surest`` of ``co_train`` over all rows of a written table of features."""

    def surest(views: Sequence[View], taken: Sequence[set]) -> list[Picks]:
        listed = pool.mapInArrow(_picker(model, list(views), list(taken), p), PICKED)
        # A task lists few; the best of these are found per print, per group of prints, and over all.
        best = listed.withColumn("group", F.pmod(F.xxhash64("print"), F.lit(GROUPS)))
        for keys, most in ((["group", "print"], 1), (["group"], p.surest), ([], p.surest)):
            window = W.partitionBy("view", "label", *keys).orderBy(F.desc("certainty"), "print")
            best = best.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)
        found = best.orderBy("view", "label", "rank").toArrow()
        x = matrices(*(found.column(c) for c in ("bins", "words", "style")), model)
        rows = zip(found.column("view").to_pylist(), found.column("print").to_pylist(), *x, found.column("label").to_pylist())
        picks: list[Picks] = [[], []]
        for view, *row in rows:
            picks[view].append(tuple(row))
        return picks

    return surest


def learn(
    docs: DataFrame, labels: DataFrame, p: CoTraining = CoTraining(), id: str = "doc_id", text: str = "text", meta: Sequence[str] = ("source", "lang", "n_chars")
) -> Model:
    """Fit both views. labels: (id, good boolean); null ids and labels are left out,
    several labels of one id are decided by the majority, ties as bad.

    The labelled sample takes ids by their hashes, as many as the parameters say,
    and of several rows of one id a single one, by hash. All rows without a label,
    those without an id too, can be labelled by the views; rows of equal features
    count once. If the sample has not both classes, or a table is empty, the model
    rejects nothing.
    """
    columns = [c for c in meta if c in docs.columns]
    model = Model(np.zeros(0, np.uint64), np.zeros((FIGURES, p.bins - 1)), cut=p.threshold, columns=columns)
    given = labels.where(F.col(id).isNotNull() & F.col("good").isNotNull()).groupBy(F.col(id).cast("bigint").alias("doc_id"))
    given = written(given.agg((F.avg(F.col("good").cast("int")) > 0.5).alias("good")), "labels")
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    known = given.count()
    if not known:
        return model
    rows = docs.select(F.col(text).alias("text"), F.col(id).cast("bigint").alias("doc_id"), meta_bins(docs, columns).alias("bins"))
    # The list of ids is bounded by the parameters, and so is what it takes: a row per id.
    chosen = written(given.where(hashed < min(1.0, p.labelled / known) * (1 << 30)), "sampled")
    labelled = rows.join(F.broadcast(chosen), "doc_id").withColumn("at", F.xxhash64("text", "bins"))
    first = written(labelled.groupBy("doc_id").agg(F.min("at").alias("at")), "firsts")
    sample = written(labelled.join(F.broadcast(first), ["doc_id", "at"]).dropDuplicates(["doc_id"]).select("text", "doc_id", "good", "bins"), "sample")
    apart = F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(5)) == 0
    taught = sample.where(~apart)
    g, b = taught.agg(F.count_if("good"), F.count_if(~F.col("good"))).first()
    if not g or not b:
        return model
    counts = taught.select("text", "good").mapInArrow(_frequencies, ", ".join(["word bigint", *(f"{c} bigint" for c in COUNTS)]))
    counts = counts.groupBy("word").agg(*[F.sum(c).alias(c) for c in COUNTS])

    def gain(level: int) -> Column:
        good, bad = F.col(f"good{level}"), F.col(f"bad{level}")
        part = lambda c, share: F.when(c > 0, c * F.ln(c / ((good + bad) * share))).otherwise(0.0)
        return 2 * (part(good, g / (g + b)) + part(bad, b / (g + b)))

    counts = counts.withColumn("gain", F.greatest(*[gain(level) for level in LEVELS])).where(F.col("gain") >= p.gain)
    best = counts.orderBy(F.desc("gain"), "word").limit(p.words)
    model.words = np.array(sorted(r["word"] for r in best.collect()), np.int64).view(np.uint64)
    featurize = _featurizer(model.words)
    got = sample.select("text", "doc_id", "good", apart.alias("apart"), "bins").mapInArrow(featurize, f"doc_id bigint, good boolean, apart boolean, {FEATURES}")
    got = got.toArrow().sort_by("doc_id")
    figures = _flat(got.column("style"))[1].reshape(got.num_rows, FIGURES)
    model.edges = np.quantile(figures, np.linspace(0, 1, p.bins + 1)[1:-1], axis=0).T
    x = matrices(got.column("bins"), got.column("words"), got.column("style"), model)
    tested = np.array(got.column("apart").to_pylist(), bool)
    y = np.array(got.column("good").to_pylist(), float)
    del got, figures
    # Rows whose id has a label are left out; the list of labels is broadcast only if it is short.
    others = rows.mapInArrow(featurize, f"doc_id bigint, {FEATURES}").join(given.select("doc_id"), "doc_id", "left_anti")
    pool = written(others.select(F.xxhash64("bins", "words", "style").alias("print"), "bins", "words", "style"), "features")
    model.text, model.meta = co_train(x[0][~tested], x[1][~tested], y[~tested], _surest(pool, model, p), p)
    if tested.any():
        for view, features in zip((model.text, model.meta), x):
            _calibrate(view, features[tested], y[tested])
    share = (y.sum() + 1) / (len(y) + 2)
    model.prior = float(np.log(share / (1 - share)))
    if tested.any():
        odds = sum(view.odds(features[tested]) for view, features in zip((model.text, model.meta), x)) - model.prior
        model.cut = _cut(sigmoid(odds[y[tested] > 0.5]), p)
    return model


def _cut(good: np.ndarray, p: CoTraining) -> float:
    """The cut that the scores of good documents, which no view has learned from, allow."""
    if not len(good):
        return p.threshold
    return float(np.clip(np.sort(good)[int(p.lost * len(good))], p.threshold, p.highest))


def chances(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct<text_score, meta_score, score> of the rows of docs, as ``scored`` describes it."""

    @F.arrow_udf("text_score double, meta_score double, score double")
    def score(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        find = Finder(model.words)
        for texts, bins in columns:
            odds = np.zeros((3, len(texts)))
            for i, j in portions(texts, PORTION) if model.text is not None else ():
                hashes, bounds, style = _text(texts.slice(i, j - i))
                odds[0, i:j] = model.text.odds(np.concatenate([find(hashes, bounds), _binned(style, model.edges)], axis=1))
                odds[1, i:j] = model.meta.odds(_meta(bins.slice(i, j - i).to_pylist(), len(model.columns)))
                odds[2, i:j] = odds[0, i:j] + odds[1, i:j] - model.prior
            yield pa.StructArray.from_arrays([pa.array(sigmoid(v)) for v in odds], ["text_score", "meta_score", "score"])

    return score(F.col(text), meta_bins(docs, model.columns))


def rejection(chance: Column, model: Model) -> Column:
    return chance["score"] < model.cut


def scored(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, text_score, meta_score, score, rejected: calibrated chances
    that the document is good, by text, by metadata, by both.

    A null text counts as empty. Without a fitted model all scores are 0.5 and
    nothing is rejected. An empty table gives no rows. Rows stay apart, so repeated rows and null ids need no
    care; columns other than id, text and the model's metadata are not read.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), chances(docs, model, text).alias("c"))
    return rows.select("doc_id", "c.*", rejection(F.col("c"), model).alias("rejected"))
