"""Combining inputs and writing tables as text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from findery.sources import workbook


def read_delimited(spark: SparkSession, path: str, *, header: bool = True, multi_line: bool = False) -> DataFrame:
    """A folder of delimited files as one table of text columns (``_c0…`` without a header)."""
    return spark.read.csv(path, header=header, inferSchema=False, multiLine=multi_line, escape='"')


def read_workbooks(spark: SparkSession, path: str, *, sheet: str = "Sheet1", header: bool = True) -> DataFrame:
    """A folder of workbooks as one table of text columns."""
    workbook.register(spark)
    return spark.read.format("workbook").option("sheetName", sheet).option("header", header).load(path)


def positional_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all inputs, combined by column position under the names of the first."""
    widths = {len(f.columns) for f in frames}
    if len(widths) != 1:
        raise ValueError(f"inputs have different column counts: {[len(f.columns) for f in frames]}")
    return reduce(DataFrame.union, frames)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all inputs, combined by column name; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, a missing value as ``''``."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def export_text(df: DataFrame, path: str, *, header: bool = True) -> int:
    """Write delimited text files; returns the rows written, the header counted once."""
    rows = Observation()
    (
        as_text(df)
        .observe(rows, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .csv(path, header=header, escape='"', emptyValue="", nullValue="")
    )
    return rows.get["rows"] + (1 if header else 0)


def export_workbooks(df: DataFrame, path: str, *, sheet: str = "Sheet1", header: bool = True) -> int:
    """Write one workbook per partition; returns the rows written, the header counted once."""
    workbook.register(df.sparkSession)
    rows = Observation()
    (
        as_text(df)
        .observe(rows, F.count("*").alias("rows"))
        .write.format("workbook")
        .option("sheetName", sheet)
        .option("header", header)
        .mode("overwrite")
        .save(path)
    )
    return rows.get["rows"] + (1 if header else 0)
