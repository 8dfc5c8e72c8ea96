"""Quality: random Fourier features of document statistics, ridge regression, isotonic calibration.

The statistics of a whole text (lengths, shares of character classes, repetition of words, word runs and lines) are
standardised over all documents and mapped to cosine features whose inner products approximate a Gaussian kernel. Each
task sums the normal equations of its labelled rows; the sums, of fixed size, are added up and solved. Raw scores of a
part of the labelled rows that the regression has not seen are counted in fixed bins; pool-adjacent-violators over the
bins gives the calibrated score.

All labelled rows that may be learnt from are used. The texts are read once, for the statistics; what reaches the driver
(sums, bins) has a fixed size.

Defined results: a null or empty text has statistics of zero and gets the score of these; null labels are ignored, of
repeated labels the largest counts; repeated rows get equal scores; without usable labels every score is 0.5, with too few
to calibrate the raw score cut to [0, 1]; other columns never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import _OTHER, id_crc, mixed, read_table, slices, span_hashes, stored, text_bytes, word_bounds

FEATURES = 256
LENGTH_SCALE = 2.5
RIDGE = 1e-4
BINS = 2048
SUM_TASKS = 16
SLICE_BYTES = 4 << 20
CLIP = 6.0

STATISTICS = (
    "bytes words word_length long_words short_words letters upper digits blanks newlines beyond_ascii symbols bars marks "
    "sentence_ends lines line_length repeated_lines closed_lines distinct_words distinct_runs top_word bare_words"
).split()

_CLASSES = np.zeros((9, 256), dtype=np.float32)
for _row, _codes in enumerate(
    (
        [*range(65, 91), *range(97, 123)], [*range(65, 91)], [*range(48, 58)], [32, 9], [10, 13], [*range(128, 256)],
        [*b"#$%&*@^~<>{}[]\\_=+/"], [*b"|"], [*b",;:\"'()!?-"],
    )
):
    _CLASSES[_row, _codes] = 1


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    size = np.diff(offsets).astype(np.float64)
    full = np.flatnonzero(size > 0)
    if not len(full):
        return out
    starts, ends, owner = word_bounds(data, offsets)
    hashes = span_hashes(data, starts, ends)
    bounds = np.searchsorted(owner, np.arange(n + 1))
    count = np.diff(bounds).astype(np.float64)
    lengths = (ends - starts).astype(np.float64)
    some = lambda values: np.bincount(owner, weights=values, minlength=n) / np.maximum(count, 1)
    share = lambda row: np.add.reduceat(_CLASSES[row][data], offsets[:-1][full]) / size[full]
    newline = np.zeros(256, dtype=bool)
    newline[[10, 13]] = True
    line_from, line_to, line_owner = word_bounds(data, offsets, newline)
    line_hashes = span_hashes(data, line_from, line_to)
    line_bounds = np.searchsorted(line_owner, np.arange(n + 1))
    lines = np.diff(line_bounds).astype(np.float64)
    closed = np.isin(data[line_to - 1], [*b".!?"]).astype(np.float64)
    bare = _OTHER[data]
    alone = np.zeros(len(starts), dtype=bool)
    if len(starts):
        total = np.concatenate([[0], np.cumsum(bare)])
        alone = total[ends] == total[starts]
    out[:, 0] = np.log1p(size)
    out[:, 1] = np.log1p(count)
    out[:, 2] = some(lengths)
    out[:, 3] = some(lengths > 14)
    out[:, 4] = some(lengths < 3)
    for column, row in enumerate(range(9), start=5):
        out[full, column] = share(row)
    out[:, 14] = some(np.isin(data[ends - 1], [*b".!?"])) if len(starts) else 0
    out[:, 15] = np.log1p(lines)
    out[:, 16] = np.log1p(count / np.maximum(lines, 1))
    out[:, 18] = np.bincount(line_owner, weights=closed, minlength=n) / np.maximum(lines, 1)
    out[:, 22] = some(alone)
    for text in full:
        words = hashes[bounds[text] : bounds[text + 1]]
        own = line_hashes[line_bounds[text] : line_bounds[text + 1]]
        if len(own):
            out[text, 17] = 1 - len(np.unique(own)) / len(own)
        if len(words):
            _, times = np.unique(words, return_counts=True)
            out[text, 19] = len(times) / len(words)
            out[text, 21] = times.max() / len(words)
            run = mixed(words[:-2] + np.uint64(3) * words[1:-1] + np.uint64(7) * words[2:]) if len(words) > 2 else words[:1]
            out[text, 20] = len(np.unique(run)) / len(run)
    return out


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, stats) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            rows = statistics(batch.column("text"))
            flat = pa.array(rows.ravel(), type=pa.float64())
            width = len(STATISTICS)
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, type=pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), stats], names=["id", "stats"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id long, stats array<double>")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None
    constant: float = 0.5

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(x @ self.waves + self.phases)
        return np.concatenate([waves, np.ones((len(x), 1))], axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.constant)
        raw = self.raw(stats)
        return np.clip(np.interp(raw, *self.knots) if self.knots else raw, 0.0, 1.0)


def _stats(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _summed(rows: DataFrame) -> np.ndarray:
    """The sum of the vectors of a binary column ``part``, by a few tasks that hold one vector each, then the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column("part"):
                vector = np.frombuffer(part.as_buffer(), dtype=np.float64)
                total = vector.copy() if total is None else total + vector
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["part"])

    parts = [np.frombuffer(r.part, dtype=np.float64) for r in rows.repartition(SUM_TASKS).mapInArrow(run, "part binary").collect()]
    return sum(parts) if parts else np.zeros(0)


def isotonic(x: np.ndarray, positive: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order: (bin centre of a pool, its rate)."""
    pools: list[list[float]] = []
    for at, good, n in zip(x, positive, count, strict=True):
        pools.append([at * n, good, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def train(stats: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", label_col: str = "quality", seed: int = 11) -> Model:
    """``stats`` is what ``described`` gives; ``usable`` is a condition on the label table's id."""
    random = np.random.default_rng(seed)
    width = len(STATISTICS)
    moments = stats.agg(
        *[f(F.element_at("stats", k + 1)).alias(f"{name}{k}") for k in range(width) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    mean = np.array([moments[f"m{k}"] or 0.0 for k in range(width)])
    scale = np.array([moments[f"s{k}"] or 0.0 for k in range(width)])
    scale[scale < 1e-9] = 1.0
    model = Model(mean, scale, random.normal(0, 1 / LENGTH_SCALE, (width, FEATURES)), random.uniform(0, 2 * np.pi, FEATURES))
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & usable)
        .groupBy(F.col(id_col).cast("long").alias("id"))
        .agg(F.max(label_col).cast("double").alias("label"))
    )
    rows = stored(
        stats.join(known, "id").select("stats", "label", (F.pmod(F.xxhash64("id"), F.lit(4)) == 0).alias("held"))
    )
    size = FEATURES + 1

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, right, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            z = model.features(_stats(batch.column("stats")))
            square += z.T @ z
            right += z.T @ batch.column("label").to_numpy(zero_copy_only=False)
            n += len(z)
        if n:
            vector = np.concatenate([square.ravel(), right, [n]])
            yield pa.RecordBatch.from_arrays([pa.array([vector.tobytes()], type=pa.binary())], names=["part"])

    total = _summed(rows.filter("NOT held").select("stats", "label").mapInArrow(equations, "part binary"))
    if not len(total):
        return model
    square, right, n = total[: size * size].reshape(size, size), total[size * size : -1], total[-1]
    weights = np.linalg.solve(square + (RIDGE * n + 1e-6) * np.eye(size), right)
    model.weights = weights

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip((model.raw(_stats(batch.column("stats"))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["bin", "label"])

    bins = (
        rows.filter("held").select("stats", "label").mapInArrow(binned, "bin long, label double")
        .groupBy("bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy("bin").collect()
    )  # at most BINS rows
    if bins:
        centre = np.array([(r.bin + 0.5) / BINS * 2 - 0.5 for r in bins])
        x, y = isotonic(centre, np.array([r.good for r in bins]), np.array([float(r.n) for r in bins]))
        # Interpolated between the pools' centres, so that the order of the documents is not lost within a pool.
        model.knots = (np.concatenate([[x[0] - 1], x, [x[-1] + 1]]), np.concatenate([[y[0] - 1e-3], y, [y[-1] + 1e-3]])) if len(x) else None
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(id, score) of every row of ``described``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = shared.value.scores(_stats(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(values)], names=["id", "score"])

    return stats.mapInArrow(run, "id long, score double")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    stats = stored(described(read_table(spark, folder, "documents")))
    model = train(stats, read_table(spark, folder, "labels"), F.pmod(id_crc("doc_id"), F.lit(5)) != 0)
    return score(stats, model).select(
        F.col("id").alias("doc_id"), (F.pmod(id_crc("id"), F.lit(5)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
