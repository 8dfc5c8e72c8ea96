"""From raw documents to packed sequences: toxic documents go, one document of each group of near duplicates stays, personal
data is replaced, sources are mixed to their target weights, and what is taken is packed.

Each stage takes (spark, docs, sf_dir) and returns a table with the columns of ``docs``; the last returns pieces of
sequences. Documents keep their text but for personal data and, at the end of what a source gives to the mix, a last
document that is taken in part; a document that the mix takes twice is two rows. Null and empty texts are never toxic or
duplicates, hold no personal data, and take no words, so the mix leaves them out. Empty tables pass through. The tables that
a stage learns from or compares are removed from the shared folder before its result is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm import mixing, neardup, packing, pii, toxicity
from findery.llm.common import WORD, read_table, scratch, stored
from findery.runtime import broadcast_if_small

ORACLE_SQL = None


def _fresh(name: str, docs: DataFrame) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name += "_"
    return name


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's rejection threshold; learnt from all labelled documents."""
    with scratch(spark):
        model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), F.lit(True))
    out = _fresh("toxicity", docs)
    scored = toxicity.score(docs, model, out=out)
    empty = F.coalesce(F.length(F.trim("text")), F.lit(0)) == 0
    return scored.filter(empty | (F.col(out) < toxicity.threshold(model, F.col("lang")))).drop(out)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each component of documents whose sets of 5-word shingles are similar to 0.8 or more.

    Of rows with one id one stays; rows without an id all stay.
    """
    key, extra = _fresh("_id", docs), _fresh("_again", docs)
    with scratch(spark) as kept_table:
        found = stored(neardup.near_duplicates(docs, size=5, percent=80))
        dropped = kept_table(found.filter("id <> component").select(F.col("id").alias(key)).distinct())
        again = kept_table(found.filter("id IS NOT NULL").groupBy(F.col("id").alias(extra)).count().filter("count > 1").select(extra))
    same = F.col("doc_id").cast("long")
    kept = docs.join(broadcast_if_small(dropped), same == F.col(key), "left_anti")
    once = kept.join(broadcast_if_small(again), same == F.col(extra), "left_anti")
    first = kept.join(broadcast_if_small(again), same == F.col(extra), "left_semi").dropDuplicates(["doc_id"])
    return once.unionByName(first)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with scratch(spark):
        clean = pii.redact(docs)
    return _measured(clean)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per pass over a document that the schedule takes words of."""
    row, n, part = (_fresh(name, docs) for name in ("_row", "_words", "_size"))
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    mixed = mixing.mix(numbered, row_col=row)
    # Blocks of a source are taken from its first on, so the words taken of one pass are the document's first ones.
    taken = (
        mixed.pieces.groupBy("row", "copy").agg(F.sum("words").alias(n))
        .join(mixed.documents.select("row", F.col("size").alias(part)), "row")
        .select(F.col("row").alias(row), n, part)
    )
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col(n).cast("int")), " ")
    rows = numbered.join(taken, row).withColumn("text", F.when(F.col(n) < F.col(part), cut).otherwise(F.col("text")))
    return _measured(rows.select(*docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` made to agree with the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
