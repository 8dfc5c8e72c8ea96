"""Streams: standing search over arriving queries, and index maintenance by arriving records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from findery.plans.index import TextIndex
from findery.plans.store import IndexStore
from findery.runtime import cut


def standing_search(
    queries: DataFrame,
    index: TextIndex,
    search: Callable[[TextIndex, DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Answer each micro-batch of ``queries`` against one snapshot of an index.

    The answers of a micro-batch go to ``output/answered=<batch>``; a repeated batch overwrites its own
    folder, so replays leave no duplicates. A query without hits is answered by one row with ``total_hits`` 0.
    """

    def answer(batch: DataFrame, batch_id: int) -> None:
        found = cut(search(index, batch))
        silent = batch.select("query_id").distinct().join(found.select("query_id").distinct(), "query_id", "left_anti")
        silent = silent.withColumn("total_hits", F.lit(0).cast("long"))
        found.unionByName(silent, allowMissingColumns=True).write.mode("overwrite").parquet(f"{output}/answered={batch_id}")

    return (
        queries.writeStream.foreachBatch(answer)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def maintain_index(
    records: DataFrame, store: IndexStore, seq: str, name: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Add or replace arriving records; each micro-batch publishes one index version.

    The version records ``name`` and the batch number, so a replayed batch is recognised and skipped.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, seq, stream=name, stream_batch=batch_id)

    return (
        records.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
