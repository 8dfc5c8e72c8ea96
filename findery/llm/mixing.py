"""Mixing sources to target weights: golden-ratio points schedule equal-token blocks of shuffled sources.

``mix`` shares a budget of words over the sources by weight (no source above ``repeat`` times its size, the excess shared
anew), lays every source out as ``repeat`` shuffled passes over its documents, cuts that stream into blocks of equal
words, and walks a low-discrepancy sequence through the cumulative targets: slot t goes to the source whose interval
holds frac((t + 1) * golden ratio), and the n-th slot of a source takes its n-th block.

Everything is DataFrame operations. No task holds a whole source or schedule: running totals go over bounded parts.
The only window without a key runs over one row per source.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source of its own, sorted last;
repeated rows are separate documents; an empty table gives empty tables; other columns of the input are ignored. The
order of a source is by md5 of id and text, then id and size, so reruns agree, and rows that share an id, or have none, are
spread like others. Rows of size 0 change nothing and lie anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findery.llm.common import WORD, read_table, running, stored

GOLDEN = 0.6180339887498949
SLOTS = 1 << 17
BLOCK_WORDS = 1024
PART_ROWS = 512
CELLS = 1024


@dataclass
class Mix:
    documents: DataFrame  # row, doc_id, source, sid, size, source_size, target, before
    schedule: DataFrame  # slot, sid, block
    pieces: DataFrame  # row, doc_id, sid, copy, block, slot, start, words


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeat: int) -> DataFrame:
    """(source, source_size, n) -> the same with sid, target, low and high: the source's interval of [0, 1).

    ``level`` is the words per unit of weight at which the budget is used up with every source cut at its limit: over the
    sources sorted by limit / weight, the largest of (budget - limits before) / (weights from here on).
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_limit = Window.orderBy("ratio", "sid")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights))) + 1))
        .withColumn("limit", F.lit(float(repeat)) * F.col("source_size"))
        .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    level = (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    filled = ranked.withColumn("level", level).withColumn(
        "target", F.least("limit", F.col("weight") * F.max("level").over(everything))
    )
    by_sid = Window.orderBy("sid")
    total = F.sum("target").over(everything)
    high = F.sum("target").over(by_sid.rowsBetween(Window.unboundedPreceding, 0))
    low = F.coalesce(F.sum("target").over(by_sid.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return filled.select(
        "source", "sid", "source_size", "n", "target", total.alias("total"),
        F.when(total > 0, low / total).otherwise(0.0).alias("low"),
        F.when(total > 0, high / total).otherwise(0.0).alias("high"),
    )


def _sized(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, doc_id, source, size, place): what the schedule needs of a document."""
    name, text = F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(
        row.alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"), F.md5(F.concat(name, F.lit("\n"), text)).alias("place"),
    )
    return sized.withColumn("place", F.when(F.col("size") > 0, F.col("place")).otherwise(F.md5(F.col("row").cast("string"))))


def _fraction(place: Column) -> Column:
    return F.conv(F.substring(place, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _part(position: Column, rows: Column) -> Column:
    """The number of a row's part, if rows of the group are spread evenly over the position in [0, 1)."""
    size = F.greatest(F.lit(float(PART_ROWS)), F.sqrt(rows))
    return F.floor(position * F.ceil(rows / size))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    repeat: int = 2,
    slots: int = SLOTS,
    block_words: int = BLOCK_WORDS,
    row_col: str | None = None,
) -> Mix:
    """Schedule ``share`` times all words; see the module's text. ``row_col`` names a unique key, if the rows have one.

    A block has total / ``slots`` words, from 1 to ``block_words``.
    """
    spark = docs.sparkSession
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    sized = stored(_sized(docs, row, id_col, text_col, source_col))
    sources = stored(
        targets(
            sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), weights, share, repeat
        )
    )
    budget = sources.agg(F.max("total")).first()[0] or 0.0
    block = int(max(1, min(block_words, budget // slots)))
    n_slots = int(-(-budget // block))

    located = sized.join(
        sources.select(F.col("source").alias("_source"), "sid", "source_size", "target", "n"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).withColumn("part", _part(_fraction(F.col("place")), F.col("n").cast("double")))
    documents = running(located, ["sid"], "part", ["place", "doc_id", "size", "row"], "size", "before").select(
        "row", "doc_id", "source", "sid", "size", "source_size", "target", "before"
    )

    schedule = _schedule(spark, sources, n_slots)
    start = F.col("before") + F.col("copy") * F.col("source_size")
    pieces = (
        documents.filter("size > 0")
        .withColumn("copy", F.explode(F.array(*map(F.lit, range(repeat)))))
        .withColumn("first", start)
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))))
        .join(schedule, ["sid", "block"])
        .withColumn("start", F.greatest(F.lit(0), F.col("block") * block - F.col("first")))
        .withColumn("words", F.least("size", (F.col("block") + 1) * block - F.col("first")) - F.col("start"))
        .select("row", "doc_id", "sid", "copy", "block", "slot", "start", "words")
    )
    return Mix(documents, schedule, pieces)


def _schedule(spark: SparkSession, sources: DataFrame, n_slots: int) -> DataFrame:
    """(slot, sid, block): the points are matched to the sources' intervals by cells of [0, 1), not by comparing all."""
    cells = sources.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1))))
    ).withColumn("top", F.col("high") >= 1 - 1e-9)
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    points = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point))
    met = (
        points.withColumn("cell", F.floor(F.col("point") * CELLS))
        .join(cells.select("cell", "sid", "low", "high", "top"), "cell")
        .filter("low <= point AND (point < high OR top)")
        .withColumn("share", (F.col("high") - F.col("low")) * n_slots)
        .withColumn("one", F.lit(1))
        .withColumn("part", _part(F.col("slot") / F.lit(float(max(n_slots, 1))), F.col("share")))
    )
    return running(met, ["sid"], "part", ["slot"], "one", "block").select("slot", "sid", "block")


def taken_words(mixed: Mix) -> DataFrame:
    """Per document row the words that the mix takes of it, repeats counted."""
    taken = mixed.pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return mixed.documents.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return taken_words(mix(read_table(spark, folder, "documents")))


OP8_SQL = rf"""
WITH sized AS MATERIALIZED (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')) AS place
    FROM documents),
ranked AS (
    SELECT source, source_size, [5, 2, 1][(sid % 3) + 1] AS weight, sid, 2.0::DOUBLE * source_size AS lim,
        1.5::DOUBLE * sum(source_size) OVER () AS budget
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
        FROM sized GROUP BY source)),
levels AS (
    SELECT *, (budget - coalesce(sum(lim) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM ranked WINDOW before AS (ORDER BY lim / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT source, sid, source_size, CAST(least(lim, weight * max(level) OVER ()) AS DOUBLE) AS target FROM levels),
sources AS MATERIALIZED (
    SELECT *, coalesce(sum(target) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(target) OVER () AS low,
        sum(target) OVER (ORDER BY sid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(target) OVER () AS high
    FROM filled),
sizes AS (SELECT sum(target) AS budget, greatest(1, least({BLOCK_WORDS}, floor(sum(target) / {SLOTS}))) AS block FROM sources),
points AS (
    SELECT range AS slot, (range + 1) * {GOLDEN}::DOUBLE - floor((range + 1) * {GOLDEN}::DOUBLE) AS point
    FROM range((SELECT CAST(ceil(budget / block) AS BIGINT) FROM sizes))),
taken_blocks AS (
    SELECT sid, count(*) AS blocks FROM points, sources
    WHERE low <= point AND (point < high OR high >= 1 - 1e-9) GROUP BY sid),
laid AS (
    SELECT d.doc_id, d.size, s.source_size, s.target, s.sid,
        sum(d.size) OVER (PARTITION BY s.sid ORDER BY place, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
    FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
    CAST(least(size, greatest(0, coalesce(blocks, 0) * block - before))
        + least(size, greatest(0, coalesce(blocks, 0) * block - source_size - before)) AS BIGINT) AS taken
FROM laid LEFT JOIN taken_blocks USING (sid), sizes
"""
