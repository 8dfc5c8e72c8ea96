"""Exact top-k by inner product over vectors grouped by length.

The vectors are sorted by length into buckets of bounded size. A query knows a lower bound of its k-th best score (from the
longest bucket at first, then from what it finds); divided by the query's and the bucket's largest length it is the cosine
that a vector of the bucket must reach. Above 1 the bucket is left out. Otherwise the bucket takes the way with fewer
candidates: the vectors that are long enough (length pruning), or those whose unit components in the query's largest
coordinates lie in the interval which that cosine allows (coordinate pruning). All candidates are verified by products.

Scores are exact at any length: products that a double cannot hold exactly are summed as long integers, those that a long
cannot hold as Python's integers. A product that does not fit a long counts as the largest long of its sign.

Defined results: vectors that are null or empty or hold null or non-finite components take no part; zero vectors take part with
score 0; equal vectors, repeated rows and ties are exact, ties go to the smaller id; vectors of another dimension than the query are no
candidates; a query with fewer candidates than k gets all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findery.llm import vectors as vs
from findery.llm.common import read_table, stored

BUCKET_ROWS = 4096
FOCUS = 3
SLACK = 1e-9
EXACT = 2.0**53  # integers below it are exact in a double
LARGEST = 2**63 - 1


def buckets(classes: DataFrame, keep: int, rows: int = BUCKET_ROWS) -> DataFrame:
    """(dim, shard, ids, vecs): classes (rep, ids, vec) sorted by length, longest first, in blocks of at most ``rows``."""
    count = classes.count()
    sized = classes.withColumn("dim", F.size("vec")).withColumn(
        "square", F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    )
    spread = sized.repartitionByRange(max(1, -(-count // rows)), "dim", F.desc("square"), "rep").sortWithinPartitions(
        "dim", F.desc("square"), "rep"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        held = 0

        def block(table: pa.Table) -> Iterator[pa.RecordBatch]:
            dims = table.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                part = table.slice(start, end - start)
                vecs = vs.matrix(part.column("vec"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(dims[start])], type=pa.int32()), pa.array([float((vecs[0] ** 2).sum())]),
                        pa.array([int(part.column("rep")[0].as_py())], type=pa.int64()),
                        pa.array([vs.id_rows(part.column("ids"), keep).tobytes()], type=pa.binary()),
                        pa.array([vecs.tobytes()], type=pa.binary()),
                    ],
                    names=["dim", "square", "rep", "ids", "vecs"],
                )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows - held)
                rest, held, at = [*rest, part], held + part.num_rows, at + part.num_rows
                if held == rows:
                    yield from block(pa.Table.from_batches(rest))
                    rest, held = [], 0
        if held:
            yield from block(pa.Table.from_batches(rest))

    # One row per block: the blocks are few, and numbered from the longest on.
    made = stored(spread.drop("square").mapInArrow(run, "dim int, square double, rep long, ids binary, vecs binary"))
    number = F.row_number().over(Window.partitionBy("dim").orderBy(F.desc("square"), "rep")) - 1
    numbers = made.select("dim", "rep", number.cast("long").alias("shard"))
    return made.join(numbers, ["dim", "rep"]).select("dim", "shard", "ids", "vecs")


class Bucket:
    """One block of the index with the sorted coordinates that pruning reads."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray):
        self.ids, self.vecs = ids, vecs
        with np.errstate(over="ignore"):  # an infinite length prunes nothing
            self.lengths = np.sqrt((vecs**2).sum(axis=1))
        unit = vecs / np.maximum(self.lengths, 1e-300)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.take_along_axis(unit, self.order, axis=0)
        self.unit = unit

    def _products(self, rows: np.ndarray | slice, query: np.ndarray, length: float) -> np.ndarray:
        if length * self.lengths[0] < EXACT:  # then every partial sum is exact in a double
            return (self.vecs[rows] @ query).astype(np.int64)
        vecs = self.vecs[rows]
        with np.errstate(invalid="ignore"):  # a component beyond a long meets zeros only, or is treated below
            out = vecs.astype(np.int64) @ query.astype(np.int64)
            far = np.flatnonzero(~(length * self.lengths[rows] < 2.0**62))
        if len(far):
            whole = [int(x) for x in query]
            for k in far.tolist():
                product = sum(a * int(x) for a, x in zip(whole, vecs[k], strict=True))
                out[k] = min(max(product, -LARGEST), LARGEST)
        return out

    def candidates(self, query: np.ndarray, length: float, bound: float) -> np.ndarray | slice | None:
        """Rows that may reach the bound; None if the bucket is left out."""
        if bound <= 0:
            return slice(None)
        reach = length * self.lengths[0]
        cosine = bound / reach * (1 - SLACK) if reach else np.inf
        if cosine > 1:
            return None
        long_enough = int(np.searchsorted(-self.lengths, -(bound / length) * (1 - SLACK), side="right"))
        unit = query / length
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        spread = np.sqrt(np.maximum(0, (1 - cosine**2) * (1 - unit[focus] ** 2)))
        # Above a coordinate of the size of the cosine the interval runs on to the end of the unit sphere.
        low = np.where(unit[focus] < -cosine, -1.0, unit[focus] * cosine - spread) - SLACK
        high = np.where(unit[focus] > cosine, 1.0, unit[focus] * cosine + spread) + SLACK
        from_, to = (
            np.array([np.searchsorted(self.sorted[:, f], v, side=side) for f, v in zip(focus, values, strict=True)])
            for values, side in ((low, "left"), (high, "right"))
        )
        least = int((to - from_).argmin())
        if to[least] - from_[least] >= long_enough:
            return slice(0, long_enough)
        rows = self.order[from_[least] : to[least], focus[least]]
        rows = rows[rows < long_enough]
        for k in range(len(focus)):
            if k != least:
                value = self.unit[rows, focus[k]]
                rows = rows[(value >= low[k]) & (value <= high[k])]
        return rows

    def top(self, query: np.ndarray, own: int, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            length = float(np.sqrt((query**2).sum()))
        if not np.isfinite(bound):
            head = slice(0, 8 * k)
            _, scores = vs.best(self._products(head, query, length), self.ids[head], own, k)
            bound = float(scores[-1]) if len(scores) == k else -np.inf
        rows = self.candidates(query, length, bound)
        if rows is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return vs.best(self._products(rows, query, length), self.ids[rows], own, k)


def _search(k: int):
    def search(pair: dict) -> list[tuple]:
        dim = pair["dim"].as_py()
        bucket = Bucket(vs.of_bytes(pair["ids"], k + 1, np.int64), vs.of_bytes(pair["vecs"], dim))
        bounds = vs.of_bytes(pair["bound"], 1)[:, 0]
        out = []
        for own, query, bound in zip(vs.of_bytes(pair["q_ids"], 1, np.int64)[:, 0], vs.of_bytes(pair["q_vecs"], dim), bounds, strict=True):
            ids, scores = bucket.top(query, int(own), float(bound), k)
            if len(ids):
                out.append((np.full(len(ids), own), ids, scores))
        return out

    return search


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score) for tables (id, vec) whose components are integers in doubles."""
    index = stored(buckets(stored(vs.classes(vectors, k + 1)), k + 1))
    unknown = queries.withColumn("bound", F.lit(float("-inf")))
    first = vs.answered(vs.paired(vs.query_blocks(unknown, ["bound"]), index.filter("shard = 0")), _search(k), "long")
    bounds = vs.ranked(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("bound"))
    known = queries.join(bounds, "id", "left").select("id", "vec", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))
    return vs.ranked(vs.answered(vs.paired(vs.query_blocks(stored(known), ["bound"]), index), _search(k), "long"), k)


def _whole(x: Column) -> Column:
    """floor(256 * x) in a double; numbers that have no fraction stay, one whose 256-fold is no finite double is the largest."""
    y = F.greatest(F.least(F.lit(256.0) * x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max))
    return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)


def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    plain = vs.usable(read_table(spark, folder, "embeddings"), "vec_id", "embedding")
    vectors = stored(plain.select("id", F.transform("vec", _whole).alias("vec")))
    return top_k(vectors, vectors.filter(F.pmod("id", F.lit(50)) == 0))


OP2_SQL = """
WITH usable AS MATERIALIZED (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""
