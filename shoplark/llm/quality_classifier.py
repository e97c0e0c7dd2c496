"""Quality classifier by co-training.

Two views of a document, its text (which words it has, and its shape) and its page metadata (language, source,
length), each get a logistic model for each target: good quality, and toxic. In each round both views score all
documents outside of the labelled sample; confident verdicts of one view become pseudo-labels for the other. Both are
then calibrated on labelled documents that no model has seen and combined by their log-odds; the combination scores
all documents.

The models are fitted on the driver on bounded, documented draws: labelled_rows of the labelled documents (by a hash
of the id, labels of rare classes first) and, for each target and view, pseudo_rows of all confident documents (by a
hash of the row, both classes at the rate of the labels). Only the words that tell the labelled classes apart best
reach it, so bytes are bounded too. All documents are scored, from their whole texts.

A target without two classes among its labels has no model: every document is then good, or not toxic. Null and empty
texts have no words but are scored by their shape and metadata; null metadata is a value of its own; repeated labels
of a document count once (as bad or toxic if any says so); of different rows under one labelled id one is learnt from;
repeated documents are scored each; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import hold_memory, stored, text_slices
from .decontaminate import split_words

SHAPE = ("log_words", "mean_word", "symbols", "upper", "digits", "calls", "bars", "newlines", "repeated_lines", "distinct")
SYMBOL_BYTES, UPPER_BYTES, DIGIT_BYTES = b"#*$%&<>~^=+_", bytes(range(0x41, 0x5B)), b"0123456789"
#: Numbers that words and metadata are hashed to.
SPACE = 1 << 24


def word_number(word: bytes) -> int:
    return zlib.crc32(word) & (SPACE - 1)


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = word_number(word)
        return n


def shape(text: bytes, words: list[bytes], distinct: int) -> list[float]:
    n = max(1, len(text))
    share = lambda chars: (n - len(text.translate(None, chars))) / n if text else 0.0
    lines = [x for x in text.split(b"\n") if x]
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / max(1, len(words)),
        share(SYMBOL_BYTES),
        share(UPPER_BYTES),
        share(DIGIT_BYTES),
        share(b"!?"),
        share(b"|"),
        share(b"\n"),
        1 - len(set(lines)) / max(1, len(lines)),
        distinct / max(1, len(words)),
    ]


def metadata_numbers(lang: str | None, source: str | None, chars: int | None) -> list[int]:
    size = "-" if chars is None else str(max(0, int(chars)).bit_length())
    names = (f"lang={lang}", f"source={source}", f"size={size}", f"lang={lang} size={size}")
    return [word_number(x.encode()) for x in names]


@dataclass
class Rows:
    """Sparse rows of distinct numbers, and dense columns."""

    owner: np.ndarray
    number: np.ndarray
    dense: np.ndarray

    def __add__(self, other: Rows) -> Rows:
        return Rows(np.concatenate([self.owner, other.owner + len(self.dense)]), np.concatenate([self.number, other.number]), np.concatenate([self.dense, other.dense]))

    def take(self, rows: np.ndarray) -> Rows:
        new = np.full(len(self.dense), -1)
        new[rows] = np.arange(len(rows))
        keep = new[self.owner] >= 0
        return Rows(new[self.owner[keep]], self.number[keep], self.dense[rows])


@dataclass
class Logistic:
    """A logistic model over chosen numbers and standardised dense columns."""

    numbers: np.ndarray
    weights: np.ndarray
    dense_weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bias: float

    def margin(self, rows: Rows) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.numbers, rows.number), max(0, len(self.numbers) - 1))
        out = (rows.dense - self.mean) / self.scale @ self.dense_weights + self.bias
        if len(self.numbers):
            hit = self.numbers[at] == rows.number
            out += np.bincount(rows.owner[hit], self.weights[at[hit]], len(out))
        return out


def chosen_numbers(rows: Rows, y: np.ndarray, most: int, least: int) -> np.ndarray:
    """The numbers that tell the classes apart best (chi-square) among those of enough rows."""
    distinct, at = np.unique(rows.number, return_inverse=True)
    seen = np.bincount(at, minlength=len(distinct)).astype(float)
    good = np.bincount(at, y[rows.owner], len(distinct))
    n, p = len(y), y.mean()
    chi = n * (good - seen * p) ** 2 / np.maximum(seen * p * (1 - p) * np.maximum(n - seen, 1), 1e-9)
    chi[(seen < least) | (chi < 4)] = -1
    order = np.argsort(-chi, kind="stable")[:most]
    return np.sort(distinct[order[chi[order] > 0]])


def fit_logistic(rows: Rows, y: np.ndarray, weight: np.ndarray, *, most: int, least: int = 4, ridge: float = 1.0, steps: int = 200) -> Logistic:
    """Full-batch accelerated descent; the step follows from the curvature's bound of each column."""
    numbers = chosen_numbers(rows, y, most, least)
    at = np.minimum(np.searchsorted(numbers, rows.number), max(0, len(numbers) - 1))
    hit = numbers[at] == rows.number if len(numbers) else np.zeros(len(rows.number), bool)
    owner, column = rows.owner[hit], at[hit]
    mean, scale = (rows.dense.mean(0), np.maximum(rows.dense.std(0), 1e-6)) if len(y) else (np.zeros(rows.dense.shape[1]), np.ones(rows.dense.shape[1]))
    dense = (rows.dense - mean) / scale
    k, d = len(numbers), dense.shape[1]
    w = np.zeros(k + d + 1)
    moment, square = np.zeros_like(w), np.zeros_like(w)
    decay = np.concatenate([np.full(k, ridge), np.full(d, ridge), [0.0]])
    total = weight.sum()
    for step in range(1, steps + 1):
        margin = dense @ w[k : k + d] + w[-1]
        if k:
            margin += np.bincount(owner, w[column], len(y))
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        g = np.concatenate([np.bincount(column, error[owner], k) if k else np.zeros(0), error @ dense, [error.sum()]])
        g = (g + decay * w) / total
        moment = 0.9 * moment + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        w -= 0.1 * (1 - step / (steps + 1)) * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Logistic(numbers, w[:k], w[k : k + d], mean, scale, float(w[-1]))


@dataclass
class Head:
    """One target: both views and how their log-odds are combined."""

    text: Logistic
    meta: Logistic
    mix: Logistic
    pseudo: list[tuple[int, int]] = field(default_factory=list)

    def margin(self, text: Rows, meta: Rows) -> np.ndarray:
        return self.mix.margin(combined(self.text.margin(text), self.meta.margin(meta)))


def combined(a: np.ndarray, b: np.ndarray) -> Rows:
    none = np.zeros(0, np.int64)
    return Rows(none, none, np.stack([np.clip(a, -20, 20), np.clip(b, -20, 20)], 1))


def dealt(y: np.ndarray, known: np.ndarray, folds: int) -> np.ndarray:
    """A fold for each known row; each class is dealt out evenly."""
    out = np.zeros(len(known), np.int64)
    for c in np.unique(y[known]):
        of = np.flatnonzero(y[known] == c)
        out[of] = np.arange(len(of)) % folds
    return out


#: What one view is given by the other: rows of its own kind and their pseudo-labels.
Given = dict[str, tuple[Rows, np.ndarray]]


class Trainer:
    """One target: y is 1, 0, or -1 for rows without a label; weight is of the labelled rows.

    A fifth of each class is held back for calibration. Where that leaves a class with less than least_held rows,
    calibration is on margins by models of other folds (with the pseudo-labels of all), and the models are of all
    labelled rows; a class of a single row leaves no fold without it, so margins are then those of the models themselves.
    """

    def __init__(self, text: Rows, meta: Rows, y: np.ndarray, weight: np.ndarray | None = None, *, pseudo_weight: float = 0.5, words: int = 4000, least_held: int = 5) -> None:
        self.views, self.y, self.words, self.pseudo_weight = {"text": text, "meta": meta}, y, words, pseudo_weight
        self.known = known = np.flatnonzero(y >= 0)
        self.usable = len(np.unique(y[known])) > 1
        self.given: Given = {}
        self.pseudo: list[tuple[int, int]] = []
        if not self.usable:
            return
        self.weight = np.ones(len(y)) if weight is None else weight / weight[known].mean()
        self.rare = int(np.unique(y[known], return_counts=True)[1].min())
        self.apart = self.rare >= 5 * least_held
        self.fold = dealt(y, known, 5 if self.apart else min(5, max(2, self.rare)))
        self.train = known[self.fold < 4] if self.apart else known
        self.rate = float(np.average(y[self.train], weights=self.weight[self.train]))
        self.models = self.taught(self.train)

    def taught(self, train: np.ndarray) -> dict[str, Logistic]:
        models = {}
        for name, view in self.views.items():
            rows, target, weight = view.take(train), self.y[train].astype(float), self.weight[train]
            if name in self.given:
                more, labels = self.given[name]
                rows, target = rows + more, np.concatenate([target, labels])
                weight = np.concatenate([weight, np.full(len(labels), self.pseudo_weight)])
            models[name] = fit_logistic(rows, target, weight, most=self.words)
        return models

    def learn(self, given: Given) -> None:
        """The next round, with what the views were given."""
        self.given = given
        self.pseudo.append((len(given["text"][1]), len(given["meta"][1])))
        self.models = self.taught(self.train)

    def head(self) -> Head | None:
        if not self.usable:
            return None
        margins = lambda models, at: combined(*(models[n].margin(v.take(at)) for n, v in self.views.items()))
        held = self.known[self.fold == 4] if self.apart else self.known
        seen = margins(self.models, held)
        if not self.apart and self.rare > 1:
            for k in np.unique(self.fold):
                seen.dense[self.fold == k] = margins(self.taught(self.known[self.fold != k]), self.known[self.fold == k]).dense
        mix = fit_logistic(seen, self.y[held].astype(float), self.weight[held], most=0, ridge=0.5, steps=400)
        return Head(self.models["text"], self.models["meta"], mix, self.pseudo)


def verdicts(model: Logistic, rows: Rows, confident: float) -> np.ndarray:
    """1 or 0 where the model is confident, else -1."""
    p = 1 / (1 + np.exp(-np.clip(model.margin(rows), -30, 30)))
    return np.where(p >= confident, 1, np.where(p <= 1 - confident, 0, -1))


def co_train(text: Rows, meta: Rows, y: np.ndarray, weight: np.ndarray | None = None, *, rounds: int = 3, confident: float = 0.97) -> Head | None:
    """One target with all rows in memory: those without a label are what the views exchange."""
    trainer, pool = Trainer(text, meta, y, weight), np.flatnonzero(y < 0)
    for _ in range(rounds - 1 if trainer.usable and len(pool) else 0):
        given: Given = {}
        for name, other in (("text", "meta"), ("meta", "text")):
            said = verdicts(trainer.models[name], trainer.views[name].take(pool), confident)
            given[other] = (trainer.views[other].take(pool[said >= 0]), said[said >= 0].astype(float))
        trainer.learn(given)
    return trainer.head()


@dataclass
class Classifier:
    """good and toxic heads; thresholds on their probabilities."""

    good: Head | None
    toxic: Head | None
    least_good: float
    most_toxic: float

    def probabilities(self, text: Rows, meta: Rows) -> tuple[np.ndarray, np.ndarray]:
        n = len(text.dense)
        p = lambda head, none: 1 / (1 + np.exp(-np.clip(head.margin(text, meta), -30, 30))) if head else np.full(n, none)
        return p(self.good, 1.0), p(self.toxic, 0.0)


class Views:
    """Both views of texts; the numbers of words are kept by the worker."""

    def __init__(self, words: int = 200_000) -> None:
        self.memo, self.words = WordNumbers(), words

    def of(self, texts: list[bytes], langs: list, sources: list, chars: list) -> tuple[Rows, Rows]:
        if len(self.memo) > self.words:
            self.memo.clear()
        owners, numbers, dense = [], [], []
        for i, text in enumerate(texts):
            words = split_words(text)
            distinct = set(words)
            numbers.append(np.fromiter(map(self.memo.__getitem__, distinct), np.int64, len(distinct)))
            owners.append(np.full(len(distinct), i))
            dense.append(shape(text, words, len(distinct)))
        meta = [metadata_numbers(*x) for x in zip(langs, sources, chars)]
        n = len(texts)
        of_text = Rows(np.concatenate(owners) if n else np.zeros(0, np.int64), np.concatenate(numbers) if n else np.zeros(0, np.int64), np.array(dense, float).reshape(n, len(SHAPE)))
        flat = np.fromiter(chain.from_iterable(meta), np.int64)
        return of_text, Rows(np.repeat(np.arange(n), 4), flat, np.zeros((n, 0)))


_views = Views()


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str, chars_col: str) -> list:
    return [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(chars_col).cast("long").alias("chars")]


def _view_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Rows, Rows]]:
    hold_memory("views", _views.memo.clear)
    for rows, texts in text_slices(batches, "text"):
        yield rows, *_views.of(texts, *(rows.column(x).to_pylist() for x in ("lang", "source", "chars")))


def _lists(rows: Rows) -> pa.Array:
    sizes = np.bincount(rows.owner, minlength=len(rows.dense))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(rows.number, pa.int64()))


FEATURES = "words array<bigint>, shape array<double>, meta array<bigint>"
TARGETS, VIEWS = ("good", "toxic"), ("text", "meta")


def _features(text: Rows, meta: Rows) -> list[pa.Array]:
    shapes = pa.ListArray.from_arrays(pa.array(np.arange(len(text.dense) + 1) * len(SHAPE), pa.int32()), pa.array(text.dense.reshape(-1)))
    return [_lists(text), shapes, _lists(meta)]


def _of_table(found: pa.Table) -> tuple[Rows, Rows]:
    n = found.num_rows
    column = lambda x: found.column(x).combine_chunks()
    spread = lambda a: np.repeat(np.arange(n), np.diff(a.offsets.to_numpy()))
    words, meta = column("words"), column("meta")
    return Rows(spread(words), words.flatten().to_numpy(), column("shape").flatten().to_numpy().reshape(n, len(SHAPE))), Rows(spread(meta), meta.flatten().to_numpy(), np.zeros((n, 0)))


def _sampled(rows: DataFrame, names: list[str], schema: str, numbers: np.ndarray | None = None) -> DataFrame:
    """The columns names and features of rows, each key once a task; with numbers, only those words."""
    sent = rows.sparkSession.sparkContext.broadcast(numbers)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for rows, text, meta in _view_rows(_once(batches, met)):
            if sent.value is not None:
                keep = np.isin(text.number, sent.value)
                text = Rows(text.owner[keep], text.number[keep], text.dense)
            yield pa.RecordBatch.from_arrays([*(rows.column(x) for x in names), *_features(text, meta)], names=[*names, "words", "shape", "meta"])

    return rows.mapInArrow(step, f"{schema}, {FEATURES}")


def _once(batches: Iterator[pa.RecordBatch], met: set[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fresh = []
        for key in batch.column("key").to_pylist():
            fresh.append(key not in met)
            met.add(key)
        yield batch.filter(pa.array(fresh, pa.bool_()))


def _only(rows: DataFrame, numbers: np.ndarray) -> DataFrame:
    """rows with those words alone."""
    sent, at = rows.sparkSession.sparkContext.broadcast(numbers), rows.columns.index("words")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words")
            flat, sizes = words.flatten().to_numpy(), np.diff(words.offsets.to_numpy())
            keep = np.isin(flat, sent.value)
            kept = Rows(np.repeat(np.arange(len(words)), sizes)[keep], flat[keep], np.zeros((len(words), 0)))
            yield batch.set_column(at, "words", _lists(kept))

    return rows.mapInArrow(step, rows.schema)


def telling_numbers(labelled: DataFrame, most: int) -> np.ndarray:
    """The words that tell the classes of either target apart best, of those in four labelled documents or more."""
    each = labelled.select(F.explode("words").alias("number"), "quality", "toxic")
    found = [np.zeros(0, np.int64)]
    for target in ("quality", "toxic"):
        n, p = labelled.agg(F.count(target), F.avg(target)).first()
        if not n or p in (0, 1):
            continue
        counts = each.where(F.col(target).isNotNull()).groupBy("number").agg(F.count("*").alias("seen"), F.sum(target).alias("hit")).where("seen >= 4")
        seen, hit = F.col("seen"), F.col("hit")
        chi = n * F.pow(hit - seen * p, F.lit(2)) / F.greatest(seen * p * (1 - p) * F.greatest(n - seen, F.lit(1)), F.lit(1e-9))
        best = counts.select("number", chi.alias("chi")).orderBy(F.desc("chi"), "number").limit(most).select("number").collect()
        found.append(np.array([r.number for r in best], np.int64))
    return np.unique(np.concatenate(found))


def labelled_sample(labels: DataFrame, labelled_rows: int) -> DataFrame:
    """doc_id, quality, toxic and weight of about labelled_rows documents.

    Each combination of labels has an equal part, and what small ones do not fill goes to the others, so that all labels
    of a rare class are drawn; rows are weighted by how many they stand for.
    """
    clean = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null")
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30))
    known = clean.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality is not null or toxic is not null")
    kind = F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("quality", "toxic")))
    sizes = {r.kind: r.n for r in known.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).collect()}
    left, cuts = labelled_rows, {}
    for i, (name, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left // (len(sizes) - i))
        cuts[name] = _cut(take, n)
        left -= take
    drawn = F.create_map(*(F.lit(x) for c in cuts.items() for x in c))[kind] if cuts else F.lit(0)
    return known.withColumn("cut", drawn.cast("long")).where(place < F.col("cut")).withColumn("weight", F.try_divide(F.lit(float(1 << 30)), F.col("cut"))).drop("cut")


def _cut(rows: int, of: int) -> int:
    return min(1 << 30, (rows << 30) // max(1, of))


def exchanged(rows: DataFrame, trainers: dict[str, Trainer], numbers: np.ndarray, turn: int, pseudo_rows: int, confident: float) -> dict[str, Given]:
    """What each target's views are given after all rows were scored by both: pseudo_rows confident ones at most, drawn
    by hash from all of them."""
    spark = rows.sparkSession
    models = {t: x.models for t, x in trainers.items()}
    sent = spark.sparkContext.broadcast(models)
    pairs = [(t, v) for t in trainers for v in VIEWS]
    codes = ", ".join(f"{t}_{v} int" for t, v in pairs)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, text, meta in _view_rows(batches):
            said = [verdicts(sent.value[t][v], text if v == "text" else meta, confident) for t, v in pairs]
            sure = np.flatnonzero(np.max(said, 0) >= 0)
            yield pa.RecordBatch.from_arrays([rows.column("key").take(pa.array(sure)), *(pa.array(x[sure], pa.int32()) for x in said)], names=["key", *(f"{t}_{v}" for t, v in pairs)])

    votes = stored(rows.mapInArrow(step, f"key long, {codes}"), "votes")
    counts = votes.agg(*(F.count_if(F.col(f"{t}_{v}") == c).alias(f"{t}_{v}_{c}") for t, v in pairs for c in (0, 1))).first()
    chosen = []
    for k, (t, v) in enumerate(pairs):
        want = {1: round(pseudo_rows * trainers[t].rate), 0: round(pseudo_rows * (1 - trainers[t].rate))}
        place = F.pmod(F.xxhash64("key", F.lit(100 * turn + k)), F.lit(1 << 30))
        hit = [(F.col(f"{t}_{v}") == c) & (place < _cut(want[c], counts[f"{t}_{v}_{c}"])) for c in (0, 1)]
        chosen.append(F.when(hit[0] | hit[1], F.col(f"{t}_{v}")).alias(f"{t}_{v}"))
    drawn = votes.select("key", *chosen).where(F.coalesce(*(f"{t}_{v}" for t, v in pairs)).isNotNull()).dropDuplicates(["key"])
    drawn = stored(drawn, "drawn")  # about pseudo_rows a target and view, so it is sent to all tasks
    sample = _sampled(rows.join(F.broadcast(drawn), "key"), ["key", *(f"{t}_{v}" for t, v in pairs)], f"key long, {codes}", numbers)
    found = sample.dropDuplicates(["key"]).toArrow().sort_by("key")
    views = dict(zip(VIEWS, _of_table(found)))
    out: dict[str, Given] = {}
    for t in trainers:
        out[t] = {}
        for v, other in (("text", "meta"), ("meta", "text")):
            label = found.column(f"{t}_{v}").combine_chunks().fill_null(-1).to_numpy()
            out[t][other] = (views[other].take(np.flatnonzero(label >= 0)), label[label >= 0].astype(float))
    return out


def train_classifier(
    docs: DataFrame,
    labels: DataFrame,
    *,
    labelled_rows: int = 8000,
    pseudo_rows: int = 2000,
    words: int = 4000,
    rounds: int = 3,
    confident: float = 0.97,
    least_good: float = 0.5,
    most_toxic: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    chars_col: str = "n_chars",
) -> Classifier:
    """Fits both heads. All documents are scored in each round but the last; what reaches the driver is about
    labelled_rows and, a round, four times pseudo_rows documents, as at most four times words numbers each."""
    names = ["doc_id", "text", "lang", "source", "chars"]
    rows = docs.select(*_columns(docs, id_col, text_col, lang_col, source_col, chars_col)).withColumn("key", F.xxhash64(*names))
    known = stored(labelled_sample(labels, labelled_rows), "known")
    columns = ["key", "doc_id", "quality", "toxic", "weight"]
    met = _sampled(rows.join(F.broadcast(known), "doc_id"), columns, "key long, doc_id long, quality int, toxic int, weight double")
    one = met.groupBy("doc_id").agg(F.min_by(F.struct(*met.columns), "key").alias("one")).select("one.*")
    labelled = stored(one, "labelled")
    numbers = telling_numbers(labelled, 2 * words)
    found = _only(labelled, numbers).toArrow().sort_by("doc_id")
    text, meta = _of_table(found)
    column = lambda x, none: found.column(x).combine_chunks().fill_null(none).to_numpy()
    weight = column("weight", 1.0)
    trainers = {t: Trainer(text, meta, column(c, -1), weight, words=words) for t, c in zip(TARGETS, ("quality", "toxic"))}
    learning = {t: x for t, x in trainers.items() if x.usable}
    pool = rows.join(F.broadcast(known.select("doc_id")), "doc_id", "left_anti")
    for turn in range(rounds - 1 if learning else 0):
        for t, given in exchanged(pool, learning, numbers, turn, pseudo_rows, confident).items():
            learning[t].learn(given)
    return Classifier(trainers["good"].head(), trainers["toxic"].head(), least_good, most_toxic)


def classify(docs: DataFrame, model: Classifier, *, carry: bool = False, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", chars_col: str = "n_chars") -> DataFrame:
    """doc_id, p_good, p_toxic, kept of every document; carry adds the whole document as a struct named row. No shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = _columns(docs, id_col, text_col, lang_col, source_col, chars_col)
    rows = docs.select(*columns, *[F.struct("*").alias("row")] * carry)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for rows, text, meta in _view_rows(batches):
            good, toxic = model.probabilities(text, meta)
            kept = (good >= model.least_good) & (toxic < model.most_toxic)
            whole = [rows.column("row")] if carry else []
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(good), pa.array(toxic), pa.array(kept), *whole], names=schema.fieldNames())

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("p_good", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    schema = T.StructType(fields + [T.StructField("row", docs.schema)] * carry)
    return rows.mapInArrow(step, schema)
