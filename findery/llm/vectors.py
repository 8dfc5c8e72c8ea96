"""What vector searches share: usable vectors, equal vectors as one, packed blocks, and pairs of blocks.

A search compares every block of queries with every block of the index, a task at a time; a block is one row whose arrays
are bytes. Blocks have a bounded number of vectors, so a task's memory is bounded, whatever the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_ROWS = 1024


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) with double components; without null vectors and such with null or non-finite components; each row once."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
        .filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
        .filter(finite)
        .distinct()
    )


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """(rep, ids, vec): equal vectors as one row with their ``keep`` smallest ids; no search of fewer results needs more.

    The limit holds before the shuffle too, so a vector that very many rows share sends few of them.
    """
    order = Window.partitionBy("vec").orderBy("id")
    return (
        vectors.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= keep)
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "ids", "vec")
    )


def matrix(column: pa.Array | pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """Lists of equal length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def id_rows(column: pa.Array | pa.ChunkedArray, keep: int) -> np.ndarray:
    """Ids per class, filled up with the largest long."""
    out = np.full((len(column), keep), np.iinfo(np.int64).max)
    for k, ids in enumerate(column.to_pylist()):
        out[k, : len(ids)] = ids
    return out


def of_bytes(value: pa.Scalar, width: int, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=dtype).reshape(-1, width)


def query_blocks(queries: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(dim, block, q_ids, q_vecs, extra as bytes): queries (id, vec, extra doubles) in blocks of about ``QUERY_ROWS``."""
    extra = extra or []
    blocks = max(1, -(-queries.count() // QUERY_ROWS))

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return table
        more = [pa.array([table.column(c).to_numpy().astype(np.float64).tobytes()], type=pa.binary()) for c in extra]
        return pa.table(
            [
                pa.array([table.column("dim")[0].as_py()], type=pa.int32()), pa.array([table.column("block")[0].as_py()], type=pa.int64()),
                pa.array([table.column("id").to_numpy().astype(np.int64).tobytes()], type=pa.binary()),
                pa.array([matrix(table.column("vec")).tobytes()], type=pa.binary()), *more,
            ],
            names=["dim", "block", "q_ids", "q_vecs", *extra],
        )

    fields = "".join(f", {c} binary" for c in extra)
    placed = queries.withColumn("dim", F.size("vec")).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return placed.groupBy("dim", "block").applyInArrow(run, f"dim int, block long, q_ids binary, q_vecs binary{fields}")


def paired(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """Every query block with every index block of its dimension; index (dim, shard, …) has shards 0, 1, … per dimension.

    Blocks are copied to the numbers of the shards, and both meet on the number: an ordinary join of equal keys.
    """
    counts = index.groupBy("dim").agg(F.max("shard").alias("last"))
    spread = blocks.join(F.broadcast(counts), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).drop("last")
    return spread.join(index, ["dim", "shard"])


def best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the ``k`` best of classes with these scores and ids, without the query's own; ties to smaller ids."""
    order = np.lexsort((ids[:, 0], -scores))[: k + 1]
    flat, value = ids[order].ravel(), np.repeat(scores[order], ids.shape[1])
    fine = (flat != np.iinfo(np.int64).max) & (flat != own)
    flat, value = flat[fine], value[fine]
    order = np.lexsort((flat, -value))[:k]
    return flat[order], value[order]


def answered(pairs: DataFrame, search: Callable[[dict], list[tuple]], score_type: str) -> DataFrame:
    """(query_id, vec_id, score): what ``search`` finds in each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.float64() if score_type == "double" else pa.int64()
        for batch in batches:
            for k in range(batch.num_rows):
                found = search({name: batch.column(name)[k] for name in batch.schema.names})
                if found:
                    q, v, s = (np.concatenate(part) for part in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q, type=pa.int64()), pa.array(v, type=pa.int64()), pa.array(s.astype(kind.to_pandas_dtype()), type=kind)],
                        names=["query_id", "vec_id", "score"],
                    )

    return pairs.mapInArrow(run, f"query_id long, vec_id long, score {score_type}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; an id counts once."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
