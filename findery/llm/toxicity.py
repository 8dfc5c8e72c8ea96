"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word (letters, digits and all beyond ASCII; A-Z folded) is hashed to three rows of an embedding table, by its whole and
by its first four and five bytes, and embedded as their sum. Filters of several widths run
over the words of the whole text, the largest response of each filter is kept, and a logistic layer scores these. Training
follows the gradient of the log loss (Adagrad, mini-batches); only the places that won the pooling take part, so a step
touches few rows of the table. A fixed part of the labelled training rows is set aside: some of it chooses the round, and
all of it calibrates the score (Platt) and sets the rejection threshold of each language, from a histogram of its scores.

Bounds, all parameters: the rows the network is fitted on are at most ``per_class`` of each class for training and
``calibration`` rows in their natural proportions for choosing the round (by hash of the id); one row of each id counts. All
rounds are one task that reads the stored sample a mini-batch at a time and returns the model, which has a fixed size; it reaches
the driver and is sent to the tasks once, texts never reach the driver. Scoring is one pass over the table without a shuffle, a bounded slice at a time.

Defined results: a null or empty text pools to zeros and gets the score of that; a null language uses the threshold of all
languages, as does one with fewer than ``LEAST`` rows set aside of either class; without training rows of both classes
every score is the share of toxic ones (0 without any); labels that are null are ignored, of repeated labels the largest
counts; repeated rows get equal scores; the input's other columns never enter a score.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findery.llm.common import id_crc, read_table, slices, span_hashes, stored, words_of

ROWS = 1 << 18
DIM = 8
PREFIXES = (4, 5)
WIDTHS = (1, 2, 3)
FILTERS = 8
PER_CLASS = 2000
CALIBRATION = 3000
EPOCHS = 6
LEAST_STEPS = 800
ROUNDS = 8
BATCH = 32
SLICE_BYTES = 2 << 20
BATCH_BYTES = 8 << 20
LEAST = 20
PRECISION = 0.99
BINS = 64
SURE = 0.9


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]
    dense: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.5
    sent: Broadcast | None = None  # the weights, once they are sent to the tasks

    def pooled(self, rows: np.ndarray, bounds: np.ndarray, places: bool = False):
        """(pooled responses per text, winning places or None, the words' embeddings)."""
        texts, n = len(bounds) - 1, len(rows)
        words = self.table[rows[:, 0]]
        for k in range(1, rows.shape[1]):
            words += self.table[rows[:, k]]
        owner = np.repeat(np.arange(texts), np.diff(bounds))
        full = np.flatnonzero(np.diff(bounds) > 0)
        out = np.zeros((texts, FILTERS * len(self.filters)), dtype=np.float32)
        won = np.full(out.shape, -1, dtype=np.int64) if places else None
        if not n:
            return out, won, words
        for k, weights in enumerate(self.filters):
            answer = words @ weights[0]
            for offset in range(1, len(weights)):
                step = words[offset:] @ weights[offset]
                step[owner[offset:] != owner[:-offset]] = 0
                answer[: n - offset] += step
            at = slice(k * FILTERS, (k + 1) * FILTERS)
            out[full, at] = np.maximum.reduceat(answer, bounds[:-1][full], axis=0)
            if places:
                for text in full:
                    won[text, at] = bounds[text] + answer[bounds[text] : bounds[text + 1]].argmax(axis=0)
        return out, won, words

    def shared(self, spark: SparkSession) -> Broadcast:
        """The weights for tasks, sent once; the driver keeps no copy of its own."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(Model(self.table, self.filters, self.dense, self.bias))
            self.table, self.filters, self.dense = np.zeros((1, DIM), np.float32), [], np.zeros(0)
        return self.sent

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": None}

    def logits(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.pooled(rows, bounds)[0].astype(np.float64) @ self.dense + self.bias



def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def embedded_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows, bounds): for each word its three rows of the table."""
    data, starts, ends, bounds = words_of(texts, bare=True)
    mask = np.uint64(ROWS - 1)
    rows = [span_hashes(data, starts, np.minimum(ends, starts + n)) >> np.uint64(8 * k) & mask for k, n in enumerate((1 << 40, *PREFIXES))]
    return np.stack(rows, axis=1).astype(np.int32), bounds


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return (np.concatenate(texts) if texts else np.zeros((0, 1 + len(PREFIXES)), np.int32)), bounds


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray | float = 1.0) -> tuple[float, float]:
    """Slope and shift of a one-variable logistic regression of rows that count ``n`` times (Newton steps, slightly regularised)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        w = n * (p * (1 - p) + 1e-9)
        g = np.array([(n * (p - y) * x).sum() + 1e-3 * (a - 1), (n * (p - y)).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(a), float(b)


def fit(sample: DataFrame, size: int, seed: int = 7) -> Model:
    """Train on the balanced rows of the sample (part 0, ``size`` rows), and choose the round by those in natural proportions (part 1).

    One task reads the stored sample in the order of its use, round by round, and holds a mini-batch of it, the model and the
    best one so far; the driver gets the model it chose.
    """
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // size))
    rounds = min(epochs, ROUNDS)
    each = -(-epochs // rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(seed)
        model = Model(
            random.normal(0, 0.05, (ROWS, DIM)).astype(np.float32),
            [random.normal(0, 0.4, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
            random.normal(0, 0.3, FILTERS * len(WIDTHS)), 0.0,
        )
        sums = [np.full(ROWS, 1e-3), [np.full(f.shape, 1e-3) for f in model.filters], np.full(len(model.dense), 1e-3)]
        best, kept = np.inf, None
        texts: list[np.ndarray] = []
        labels: list[int] = []
        held, logits, answers, now = 0, [], [], (1, 0)

        def learn() -> None:
            nonlocal held
            if texts:
                _step(model, texts, np.array(labels, dtype=np.float64), sums, 0.1)
                texts.clear()
                labels.clear()
            held = 0

        def compare() -> None:
            nonlocal best, kept
            order = np.lexsort((answers, logits))
            logit, y = np.array(logits)[order], np.array(answers, dtype=np.float64)[order]
            slope, shift = _logistic(logit, y)
            p = np.clip(_sigmoid(slope * logit + shift), 1e-9, 1 - 1e-9)
            loss = -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
            if loss < best - 1e-4:
                best, kept = loss, pickle.dumps(model)
            logits.clear()
            answers.clear()

        for batch in batches:
            steps = zip(batch.column("round").to_pylist(), batch.column("part").to_pylist(), strict=True)
            for step, words, label in zip(steps, _words(batch.column("words")), batch.column("label").to_pylist(), strict=True):
                if step != now:
                    learn() if now[1] == 0 else compare()
                    now = step
                if step[1]:
                    logits.append(model.logits(*_joined([words]))[0])
                    answers.append(label)
                    continue
                texts.append(words)
                labels.append(label)
                held += words.nbytes
                if len(texts) == BATCH or held > BATCH_BYTES:
                    learn()
        compare()
        yield pa.RecordBatch.from_arrays([pa.array([kept], type=pa.binary())], names=["model"])

    turns = F.when(F.col("part") == 0, F.lit(each)).otherwise(F.lit(1))
    uses = sample.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds)))).withColumn("epoch", F.explode(F.sequence(F.lit(1), turns)))
    ordered = uses.coalesce(1).sortWithinPartitions("round", "part", "epoch", "place").select("round", "part", "label", "words")
    return pickle.loads(ordered.mapInArrow(run, "model binary").first().model)  # of a fixed size


def _words(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(w.as_buffer()), dtype=np.int32).reshape(-1, 1 + len(PREFIXES)) for w in column]


def _step(model: Model, texts: list[np.ndarray], y: np.ndarray, sums: list, rate: float) -> None:
    hashed, bounds = _joined(texts)
    pooled, won, words = model.pooled(hashed, bounds, places=True)
    error = (_sigmoid(pooled @ model.dense + model.bias) - y) / len(texts)
    up = (error[:, None] * model.dense).astype(np.float32)
    gradient = pooled.T.astype(np.float64) @ error
    sums[2] += gradient**2
    model.dense -= rate * gradient / np.sqrt(sums[2])
    model.bias -= rate * float(error.sum())
    text_of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    rows, changes = [], []
    for k, weights in enumerate(model.filters):
        change = np.zeros_like(weights)
        for f in range(FILTERS):
            column = k * FILTERS + f
            texts_with = np.flatnonzero(won[:, column] >= 0)
            for offset in range(len(weights)):
                place = won[texts_with, column] + offset
                inside = place < len(hashed)
                inside[inside] &= text_of[place[inside]] == texts_with[inside]
                place, g = place[inside], up[texts_with[inside], column]
                change[offset, :, f] += g @ words[place]
                delta = g[:, None] * weights[offset, :, f]
                rows += [hashed[place, k] for k in range(hashed.shape[1])]
                changes += [delta] * hashed.shape[1]
        sums[1][k] += change.astype(np.float64) ** 2
        model.filters[k] = (weights - rate * change / np.sqrt(sums[1][k])).astype(np.float32)
    if not rows:
        return
    touched, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    total = np.zeros((len(touched), DIM), dtype=np.float64)
    np.add.at(total, inverse, np.concatenate(changes))
    sums[0][touched] += (total**2).sum(axis=1)
    model.table[touched] -= (rate * total / np.sqrt(sums[0][touched])[:, None]).astype(np.float32)


def _threshold(scores: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> float:
    """The lowest score from which on the rows are toxic with precision ``PRECISION``; ``SURE`` if fewer than ``LEAST`` of
    them are toxic, 1 if none reaches it. Each score stands for ``n`` rows, ``toxic`` of them toxic."""
    if toxic.sum() < LEAST:
        return SURE
    order = np.argsort(-scores, kind="stable")
    s, good, all_ = scores[order], np.cumsum(toxic[order]), np.cumsum(n[order])
    last = np.append(s[1:] != s[:-1], True)
    fine = np.flatnonzero(last & (good >= PRECISION * all_))
    return float(s[fine[-1]]) if len(fine) else 1.0


def _word_rows(df: DataFrame) -> DataFrame:
    """(place, part, label, words): the table rows of the words of a table with the doc's ``text``, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            rows, bounds = embedded_rows(batch.column("text"))
            packed = [zlib.compress(rows[a:b].tobytes(), 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("place"), batch.column("part"), batch.column("label"), pa.array(packed, type=pa.binary())],
                names=["place", "part", "label", "words"],
            )

    return df.select("place", "part", "label", "text").mapInArrow(run, "place long, part int, label int, words binary")


def _one_row(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row of docs (id, text, lang) for each id of ids, with the columns of ids: the one with the least hash of its text."""
    found = docs.join(ids, "id")
    return found.groupBy(*ids.columns).agg(F.min_by(F.struct("text", "lang"), F.struct(F.xxhash64("text"), "lang")).alias("doc")).select(*ids.columns, "doc.*")


def histogram(docs: DataFrame, held: DataFrame, model: Model) -> DataFrame:
    """(lang, bin, n, toxic, least) of the logits of all rows of docs (id, text, lang) with an id in held (id, label).

    An id counts once. ``bin`` is the logit in steps of 1 / ``BINS``, ``least`` the smallest one in it.
    """
    shared = model.shared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            logits = shared.value.logits(*embedded_rows(batch.column("text")))
            columns = [batch.column("id").cast(pa.string()), batch.column("lang"), batch.column("label"), pa.array(logits)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "lang", "label", "logit"])

    rows = docs.join(held.select("id", "label"), "id").select("id", "lang", "label", "text").mapInArrow(run, "id string, lang string, label int, logit double")
    once = rows.groupBy("id", "label").agg(F.min(F.struct("logit", "lang")).alias("doc")).select("label", "doc.*")
    return once.groupBy("lang", F.floor(F.col("logit") * BINS).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("label").alias("toxic"), F.min("logit").alias("least")
    )


def calibrate(model: Model, bins: DataFrame) -> None:
    """Sets slope, shift and thresholds from all rows of the histogram."""
    sums = [F.sum("n").alias("n"), F.sum("toxic").alias("toxic"), F.min("least").alias("least")]
    own = bins.groupBy("lang").agg(F.sum("n").alias("of"), F.sum("toxic").alias("bad")).filter(f"lang IS NOT NULL AND least(bad, of - bad) >= {LEAST}")
    table = bins.groupBy("bin").agg(*sums).orderBy("bin").toArrow()  # a row per bin of logits
    least, toxic, n = (table.column(c).to_numpy().astype(np.float64) for c in ("least", "toxic", "n"))
    model.slope, model.shift = _logistic(np.tile(least + 0.5 / BINS, 2), np.repeat([1.0, 0.0], len(n)), np.concatenate([toxic, n - toxic]))
    of = lambda least, toxic, n: _threshold(_sigmoid(model.slope * least + model.shift), toxic, n)
    model.threshold = of(least, toxic, n)
    tables: dict = {}
    for r in bins.join(own.select("lang"), "lang").orderBy("lang", "bin").collect():  # a row per bin and language
        tables.setdefault(r.lang, []).append((r.least, r.toxic, r.n))
    model.thresholds = {lang: of(*np.array(rows, dtype=np.float64).T) for lang, rows in tables.items()}


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", label_col: str = "toxic", per_class: int = PER_CLASS, calibration: int = CALIBRATION,
) -> Model:
    """``usable`` is a condition on the label table's id: only these rows are learnt from."""
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & usable)
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("id"))
    )
    held = known.filter(F.pmod("place", F.lit(4)) == 0)
    rest = known.filter(F.pmod("place", F.lit(4)) != 0)
    chosen = held.orderBy("place", "id").limit(calibration).withColumn("part", F.lit(1))
    for value in (0, 1):
        chosen = chosen.unionByName(
            rest.filter(F.col("label") == value).orderBy("place", "id").limit(per_class).withColumn("part", F.lit(0))
        )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    # At most 2 * per_class + calibration rows, in an order that mixes the classes.
    sample = stored(_word_rows(_one_row(texts, F.broadcast(chosen))).repartition(8, "place").sortWithinPartitions("place"))
    sizes = {(r.part, r.label): r["count"] for r in sample.groupBy("part", "label").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 4:
        share = (sizes.get((0, 1), 0) + sizes.get((1, 1), 0)) / max(total, 1)
        model = Model(np.zeros((2, DIM), np.float32), [], np.zeros(0), 0.0, constant=float(share))
        model.threshold = 1.0
        return model
    model = fit(sample, sizes[0, 0] + sizes[0, 1])
    calibrate(model, stored(histogram(texts, held, model)))
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of the table and ``out``; a column of that name is replaced."""
    kept = docs.drop(out)
    if model.constant is not None:
        return kept.withColumn(out, F.lit(model.constant))
    shared, slope, shift = model.shared(docs.sparkSession), model.slope, model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            values = _sigmoid(slope * shared.value.logits(*embedded_rows(batch.column(text_col))) + shift)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, type=pa.float64())], names=[*batch.schema.names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.DoubleType())]))


def threshold(model: Model, lang: Column) -> Column:
    """The language's rejection threshold."""
    value = F.lit(model.threshold)
    for name, own in sorted(model.thresholds.items()):
        value = F.when(lang == name, F.lit(own)).otherwise(value)
    return value


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    model = train(docs, labels, F.pmod(id_crc("doc_id"), F.lit(4)) != 2)
    scored = score(docs.select("doc_id", "lang", "text"), model)
    return scored.select(
        "doc_id", (F.pmod(id_crc("doc_id"), F.lit(4)) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        (F.col("score") >= threshold(model, F.col("lang"))).alias("rejected"),
    )
