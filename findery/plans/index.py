"""Building, extending and updating an inverted index as DataFrames.

Layout. Every document belongs to one *shard*, a hash of its key, and all its postings stay in that
shard. Matching, scoring and the first top-k of a search therefore need no shuffle, and a term that
occurs in a third of all documents is spread evenly over all shards. Within a shard, postings are
grouped by *bucket*, a hash of the term, so that a search reads only the buckets of its terms, and sorted
by *block*, another hash of it, so that of a bucket's file it reads only the pages of its terms' blocks.

Term statistics and the document count are additive rows: adding documents appends counts, replacing
them also appends the negated counts of the old versions, and a reader sums what it needs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.functions.analysis import Analyzer, words
from findery.operators.binding import drop_empty, require_fields
from findery.operators.tokens import analyze, by_table, explode_tokens, postings_in_rows, postings_of, term_stats
from findery.runtime import broadcast_if_small

DOC = ("shard", "batch", "doc_id")
# The sequence number of the update that a stored row comes from; null if it came by build or append.
SEQ = "_seq"
# Text per shard (the work of one task), and per shard and term bucket (one file of postings). The postings of a shard are
# sorted by one task, and take some 15 times the text in that; they must fit its memory, or all of them are spilled (with 32 MB
# they were, in executors of 1.8 GB heap with two tasks).
SHARD_BYTES = 8 * 1024**2
FILE_BYTES = 128 * 1024**2
MAX_BUCKETS = 64

# Terms of a bucket stand in this many blocks, by hash. Postings are sorted by block, so that a search for few terms skips the
# pages of all other blocks.
BLOCKS = 1 << 16

POSTING_COLUMNS = ("block", "field", "term", "doc_id", "tf", "length", "positions", "shard", "batch", "bucket")


@dataclass(frozen=True)
class Layout:
    """How many shards documents are spread over, and how many term buckets each has."""

    shards: int
    buckets: int
    labels: tuple[int, ...] = field(repr=False)

    @staticmethod
    def of(spark: SparkSession, shards: int | None = None, buckets: int = 1) -> Layout:
        shards = shards or spark.sparkContext.defaultParallelism
        return Layout(shards, buckets, _shard_labels(spark, shards))

    @staticmethod
    def sized(records: DataFrame, fields: Sequence[str], shards: int | None, buckets: int | None) -> Layout:
        """A layout for these records: one pass over the fields measures their text, unless both numbers
        are given. Shards are kept small enough for a task, buckets large enough for a file."""
        spark = records.sparkSession
        if shards is None or buckets is None:
            width = sum((F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n in fields), F.lit(0).cast("long"))
            size = records.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
            shards = shards or max(spark.sparkContext.defaultParallelism, math.ceil(size / SHARD_BYTES))
            buckets = buckets or min(max(round(size / shards / FILE_BYTES), 1), MAX_BUCKETS)
        return Layout.of(spark, shards, buckets)

    def shard(self, key: Column) -> Column:
        labels = F.array(*[F.lit(x) for x in self.labels])
        return F.element_at(labels, F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int") + 1)

    def bucket(self, name: Column, term: Column) -> Column:
        return F.pmod(F.xxhash64(name, term), F.lit(self.buckets)).cast("int")

    @staticmethod
    def block(name: Column, term: Column) -> Column:
        """Taken from other bits of the hash than the bucket."""
        return F.pmod(F.shiftright(F.xxhash64(name, term), 32), F.lit(BLOCKS)).cast("int")

    def placed(self, terms: DataFrame) -> DataFrame:
        """Terms (field, term, …) with their bucket and block."""
        name, term = F.col("field"), F.col("term")
        return terms.withColumns({"bucket": self.bucket(name, term), "block": self.block(name, term)})


@cache
def _shard_labels(spark: SparkSession, shards: int) -> tuple[int, ...]:
    """Shard numbers that Spark's own hash sends to a partition each.

    Spark places a row in partition ``pmod(hash(shard), n)``. Plain numbers 0..n-1 would collide and
    leave a third of the partitions empty, so one number per partition is looked up once.
    """
    found = (
        spark.range(64 * shards)
        .select(F.col("id").cast("int").alias("label"))
        .groupBy(F.pmod(F.hash("label"), F.lit(shards)).alias("partition"))
        .agg(F.min("label").alias("label"))
        .orderBy("partition")
        .collect()
    )
    if len(found) != shards:
        raise ValueError(f"no balanced placement for {shards} shards")
    return tuple(r["label"] for r in found)


@dataclass(frozen=True)
class TextIndex:
    """One consistent snapshot of an index."""

    stored: DataFrame  # shard, batch, doc_id and the stored fields
    postings: DataFrame  # see POSTING_COLUMNS
    terms: DataFrame  # bucket, field, term, df, total_tf; additive rows
    corpus: DataFrame  # docs; additive rows
    removed: DataFrame | None  # shard, batch, doc_id of replaced document versions
    key: str
    fields: tuple[str, ...]
    layout: Layout
    analyzers: Mapping[str, Analyzer] = field(default_factory=dict)
    analyzer: Analyzer = words
    summed: bool = False  # ``terms`` has one row per term, because nothing was added or replaced

    def documents(self) -> DataFrame:
        """The live documents with their stored fields."""
        return without_removed(self.stored, self.removed)

    def live_postings(self) -> DataFrame:
        return without_removed(self.postings, self.removed)

    def term_stats(self) -> DataFrame:
        """Document and total frequency of every live term."""
        if self.summed:
            return self.terms.select("field", "term", "df", "total_tf")
        return (
            self.terms.groupBy("field", "term")
            .agg(F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf"))
            .filter("df > 0")
        )

    @cached_property
    def doc_count(self) -> int:
        return self.corpus.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]


def without_removed(rows: DataFrame, removed: DataFrame | None) -> DataFrame:
    if removed is None:
        return rows
    return rows.join(broadcast_if_small(removed.select(*DOC)), list(DOC), "left_anti")


def sharded(records: DataFrame, key: str, fields: Sequence[str], layout: Layout, batch: int) -> DataFrame:
    """Records with their document columns, placed by shard: the one shuffle of an index build."""
    require_fields(records, [key, *fields])
    return (
        drop_empty(records, [c for c in records.columns if c != SEQ])
        .withColumns(
            {"doc_id": F.col(f"`{key}`"), "shard": layout.shard(F.col(f"`{key}`")), "batch": F.lit(batch).cast("long")}
        )
        .repartition(layout.shards, "shard")
    )


def make_postings(
    docs: DataFrame, fields: Sequence[str], layout: Layout, analyzers: Mapping[str, Analyzer], analyzer: Analyzer,
    distinct: bool = False,
) -> DataFrame:
    """Postings of documents that are already placed by shard; no further shuffle, but for the tokens of table analyzers.

    Fields are unfolded with ``inline`` here, which keeps the placement (``unpivot`` does not). Where no two rows have
    one id (``distinct``), the postings of a row are made of that row alone, without a grouping of all tokens.
    """
    pairs = [F.struct(F.lit(n).alias("field"), F.col(f"`{n}`").cast("string").alias("text")) for n in fields]
    texts = docs.select(*DOC, F.inline(F.array(*pairs)))
    keys = [*DOC, "field", "length"]
    tokens = analyze(texts, analyzers, analyzer)
    if by_table(analyzers, analyzer):
        tokens = tokens.repartition(layout.shards, "shard")
    tokens = tokens.withColumn("length", F.size(F.array_compact("tokens")))
    if distinct:
        return layout.placed(postings_in_rows(tokens, keys)).select(*POSTING_COLUMNS)
    return layout.placed(postings_of(explode_tokens(tokens, keys), keys)).select(*POSTING_COLUMNS)


def make_terms(postings: DataFrame) -> DataFrame:
    return term_stats(postings, ("bucket", "field", "term"))


def negated(terms: DataFrame) -> DataFrame:
    return terms.withColumns({"df": -F.col("df"), "total_tf": -F.col("total_tf")})


def latest_per_key(updates: DataFrame, key: str, seq: str) -> DataFrame:
    """The update with the greatest sequence number of each key, combined before the shuffle; its number is kept as ``SEQ``."""
    names = updates.columns
    order = F.struct(F.col(seq), *[F.col(f"`{n}`") for n in names if n != seq])
    row = F.struct(*[F.col(f"`{n}`") for n in names])
    return (
        updates.groupBy(F.col(f"`{key}`").alias("_key"))
        .agg(F.max_by(row, order).alias("row"))
        .select(*[F.col("row").getField(n).alias(n) for n in names if n != seq], F.col("row").getField(seq).cast("long").alias(SEQ))
    )


def newer_than_live(index: TextIndex, latest: DataFrame) -> DataFrame:
    """The updates (key, …, ``SEQ``) that are newer than the live version of their key; a version without a number is older."""
    if SEQ not in index.stored.columns:
        return latest
    key = F.col(f"`{index.key}`")
    keys = broadcast_if_small(latest.select(key.alias("doc_id"), index.layout.shard(key).alias("shard"), F.col(SEQ).alias("_new")))
    stale = index.documents().select("shard", "doc_id", SEQ).join(keys, ["shard", "doc_id"]).filter(F.col(SEQ) >= F.col("_new"))
    return latest.join(broadcast_if_small(stale.select(F.col("doc_id").alias("_stale"))), key == F.col("_stale"), "left_anti")


def replaced_versions(index: TextIndex, keys: DataFrame) -> DataFrame:
    """Live document versions whose key is in ``keys(doc_id)``."""
    keys = keys.select("doc_id").withColumn("shard", index.layout.shard(F.col("doc_id"))).distinct()
    return index.documents().select(*DOC).join(broadcast_if_small(keys), ["shard", "doc_id"], "left_semi").select(*DOC)


def postings_of_versions(index: TextIndex, versions: DataFrame) -> DataFrame:
    return index.postings.join(broadcast_if_small(versions), list(DOC), "left_semi")


def build(
    records: DataFrame,
    key: str,
    fields: Sequence[str],
    *,
    stored: Sequence[str] | None = None,
    analyzers: Mapping[str, Analyzer] | None = None,
    analyzer: Analyzer = words,
    layout: Layout | None = None,
    batch: int = 0,
) -> TextIndex:
    """An index over ``fields`` of a table whose ``key`` is unique.

    The result is lazy; ``IndexStore`` writes an index once and serves many searches from it.
    """
    layout = layout or Layout.of(records.sparkSession)
    docs = sharded(records, key, fields, layout, batch)
    postings = make_postings(docs, fields, layout, analyzers or {}, analyzer)
    names = [n for n in (stored or records.columns) if n not in (*DOC, SEQ)]
    seq = F.col(SEQ) if SEQ in records.columns else F.lit(None).cast("long").alias(SEQ)
    kept = docs.select(*DOC, *[F.col(f"`{n}`") for n in names], seq)
    return TextIndex(
        stored=kept,
        postings=postings,
        terms=make_terms(postings),
        corpus=kept.agg(F.count("*").alias("docs")),
        removed=None,
        key=key,
        fields=tuple(fields),
        layout=layout,
        analyzers=analyzers or {},
        analyzer=analyzer,
        summed=True,
    )


def _joined(index: TextIndex, added: TextIndex) -> TextIndex:
    return replace(
        index,
        stored=index.stored.unionByName(added.stored, allowMissingColumns=True),
        postings=index.postings.unionByName(added.postings),
        terms=index.terms.unionByName(added.terms),
        corpus=index.corpus.unionByName(added.corpus),
        summed=False,
    )


def _added(index: TextIndex, records: DataFrame, batch: int) -> TextIndex:
    return build(
        records,
        index.key,
        index.fields,
        analyzers=index.analyzers,
        analyzer=index.analyzer,
        layout=index.layout,
        batch=batch,
    )


def append(index: TextIndex, records: DataFrame, *, batch: int) -> TextIndex:
    """Add records with new keys; nothing already indexed is read again."""
    return _joined(index, _added(index, records, batch))


def upsert(index: TextIndex, updates: DataFrame, seq: str, *, batch: int) -> TextIndex:
    """Add records, replacing those with the same key; the greatest ``seq`` of a key wins, also over earlier calls."""
    latest = newer_than_live(index, latest_per_key(updates, index.key, seq))
    added = _added(index, latest, batch)
    gone = replaced_versions(index, added.stored)
    joined = _joined(index, added)
    return replace(
        joined,
        terms=joined.terms.unionByName(negated(make_terms(postings_of_versions(index, gone)))),
        corpus=joined.corpus.unionByName(gone.agg((-F.count("*")).alias("docs"))),
        removed=gone if index.removed is None else index.removed.unionByName(gone),
    )
