"""Session helpers: the shared folder, cutting lineage, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when it was measured to be below both bounds.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only on a local master, where all executors share the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="findery-")
    context.setCheckpointDir(folder)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write a small intermediate table to the shared folder once, so that later steps reread it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame, *aggregates: Column) -> tuple:
    """Measure a table in one job: do its rows and text bytes stay below the broadcast bounds? And further aggregates."""
    fixed = 16 * len(df.columns)
    width = F.lit(fixed).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            width = width + 32 * F.greatest(F.size(field.name), F.lit(0))
    rows, size, *more = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0)), *aggregates).first()
    return rows <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES, *more


def fits_broadcast(df: DataFrame) -> bool:
    return measured(df)[0]


def any_of(conditions: Sequence[Column]) -> Column:
    """Is one of them true? A balanced tree, so that hundreds of them nest only a few levels deep."""
    parts = list(conditions) or [F.lit(False)]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) & ~1 :]
    return parts[0]


def ranges(values: Sequence[int], most: int) -> list[tuple[int, int]]:
    """At most ``most`` ranges that hold sorted numbers; the widest gaps stay between them."""
    gaps = sorted(range(1, len(values)), key=lambda i: values[i - 1] - values[i])[: most - 1]
    starts = [0, *sorted(i for i in gaps if values[i] - values[i - 1] > 1)]
    return [(values[a], values[b - 1]) for a, b in zip(starts, [*starts[1:], len(values)], strict=True)] if values else []


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast a measured small table; otherwise leave the join to shuffle and AQE skew handling."""
    return F.broadcast(df) if fits_broadcast(df) else df
