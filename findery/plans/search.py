"""Batch search: a table of queries against an index.

Every kind of query becomes rows of a clause table ``(query_id, clause_id, kind, fields, text, occur,
slop, operator)``. Clauses become weighted terms, terms meet the postings, and the hits are combined
to one score per query and document. All of that after the postings scan happens inside the shards
of the index; only the best k documents of each shard are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findery.functions import scoring
from findery.operators.expand import fuzzy_terms, wildcard_terms
from findery.operators.phrase import phrase_freq
from findery.operators.tokens import analyze, explode_tokens
from findery.plans.index import DOC, SEQ, TextIndex, without_removed
from findery.plans.ranking import Entries, by_clauses, by_entries, by_phrases, clauses_of, entries_of, listed_entries, phrases_of
from findery.runtime import any_of, broadcast_if_small, cut, fits_broadcast, measured, ranges

KINDS = ("terms", "term", "prefix", "wildcard", "fuzzy", "phrase")
_CLAUSE = ("query_id", "clause_id")
# What scoring needs to know of a clause: the query words it has (0 if it is not a keyword clause), how
# many of them a document must hold, and, in a boolean query, its role and the other clauses.
_ALONE = ("query_id", "units", "required")
_AMONG_OTHERS = (*_ALONE, "clause_id", "role", "n_clauses", "n_must")
_ROLES = {"should": 0, "must": 1, "must_not": 2}
_CONSTANT = ("prefix", "wildcard")
# Conditions pushed to the files: on blocks of terms, and on ids of stored rows. Each posting read is compared with the ranges of
# blocks once more, in one method; Java does not compile methods above 8,000 bytes (64 ranges take 10,067, 32 take 5,331).
PUSHED_BLOCKS = 32
PUSHED_IDS = 2_048
# Boolean queries are scored in blocks up to so many clauses (a document has a cell for each) and entries of lists of them.
MOST_CLAUSES = 1 << 15
MOST_ENTRIES = 2_000_000


def make_clauses(
    queries: DataFrame,
    kind: str,
    fields: Sequence[str],
    *,
    operator: str = "or",
    slop: int = 0,
    normalize: bool = False,
) -> DataFrame:
    """One clause per row of ``queries(query_id, text)``."""
    text = F.lower("text") if normalize else F.col("text")
    return queries.select(
        "query_id",
        F.lit(0).cast("long").alias("clause_id"),
        F.lit(kind).alias("kind"),
        F.array(*[F.lit(f) for f in fields]).alias("fields"),
        text.alias("text"),
        F.lit("should").alias("occur"),
        F.lit(slop).alias("slop"),
        F.lit(operator).alias("operator"),
    )


def _terms_of(index: TextIndex, clauses: DataFrame, many_fields: bool) -> DataFrame:
    """Analyzed keyword clauses. Equal words are one unit that counts several times.

    Over one field the text is analyzed as a whole, and a unit is a term. Over several fields the text is split at blanks
    first, and a unit is such a word in all fields: each analyzes it in its own way, perhaps to several terms.
    """
    counted = (F.count("*").alias("mult"), F.min("pos").alias("unit"))
    if many_fields:
        split = F.posexplode(F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0))).alias("pos", "text")
        texts = clauses.select(*_CLAUSE, "fields", split).select(*_CLAUSE, "pos", F.explode("fields").alias("field"), "text")
        tokens = explode_tokens(
            analyze(texts, index.analyzers, index.analyzer).withColumnRenamed("pos", "unit"), [*_CLAUSE, "field", "unit"]
        ).select(*_CLAUSE, "field", F.col("unit").alias("pos"), "term")
        units = (
            tokens.distinct().groupBy(*_CLAUSE, "pos")
            .agg(F.sort_array(F.collect_list(F.struct("field", "term"))).alias("word"))
            .groupBy(*_CLAUSE, "word")
            .agg(*counted)
            .select(*_CLAUSE, "unit", "mult", "word", F.posexplode("word").alias("n", "t"))
            .withColumn("own", F.col("t.field"))
            .select(
                *_CLAUSE, "unit", "mult", (F.col("n") == 0).alias("lead"), "t.field", "t.term",
                F.size(F.filter(F.col("word.field"), lambda f: f == F.col("own"))).alias("parts"),
            )
        )
    else:
        texts = clauses.select(*_CLAUSE, F.explode("fields").alias("field"), "text")
        tokens = explode_tokens(analyze(texts, index.analyzers, index.analyzer), [*_CLAUSE, "field"])
        units = tokens.groupBy(*_CLAUSE, "field", "term").agg(*counted).withColumns({"lead": F.lit(True), "parts": F.lit(1)})
    return units.select(
        *_CLAUSE, "unit", "mult", "lead", "parts", "field", "term", F.lit(1.0).alias("boost"), F.lit(False).alias("constant")
    )


def _single(rows: DataFrame, boost, constant: bool) -> DataFrame:
    return rows.select(
        *_CLAUSE, F.lit(0).alias("unit"), F.lit(1).cast("long").alias("mult"), F.lit(True).alias("lead"),
        F.lit(1).alias("parts"), "field", "term", boost.alias("boost"), F.lit(constant).alias("constant"),
    )


def _vocabulary_matches(index: TextIndex, kind: str, clauses: DataFrame) -> DataFrame:
    """Clauses expanded to terms; equal patterns of many queries are expanded once."""
    texts = clauses.select(*_CLAUSE, F.explode("fields").alias("field"), F.col("text").alias("pattern"))
    patterns = texts.select("field", "pattern").distinct()
    boost = F.lit(1.0)
    if kind == "fuzzy":
        keywords = patterns.withColumn("keyword", F.col("pattern"))
        found = fuzzy_terms(keywords, index.terms)
        boost = F.col("boost")
    else:
        found = wildcard_terms(patterns, index.terms, prefix_only=kind == "prefix")
    live = found.select("field", "pattern", "term", "df", boost.alias("boost"))
    if not index.summed:
        live = live.groupBy("field", "pattern", "term", "boost").agg(F.sum("df").alias("df")).filter("df > 0")
    return _single(texts.join(live, ["field", "pattern"]), F.col("boost"), constant=kind != "fuzzy")


def _query_terms(index: TextIndex, clauses: DataFrame, kinds: Sequence[str], many_fields: bool) -> DataFrame:
    parts = []
    for kind in kinds:
        rows = clauses.filter(F.col("kind") == kind)
        if kind == "terms":
            parts.append(_terms_of(index, rows, many_fields))
        elif kind == "term":
            raw = rows.select(*_CLAUSE, F.explode("fields").alias("field"), F.col("text").alias("term"))
            parts.append(_single(raw, F.lit(1.0), constant=False))
        elif kind in ("prefix", "wildcard", "fuzzy"):
            parts.append(_vocabulary_matches(index, kind, rows))
    return reduce(DataFrame.unionByName, parts)


def _phrase_terms(index: TextIndex, clauses: DataFrame) -> DataFrame:
    """The words of phrase clauses with their places, counted from the first word."""
    texts = clauses.filter(F.col("kind") == "phrase").select(*_CLAUSE, F.explode("fields").alias("field"), "text", "slop")
    tokens = explode_tokens(analyze(texts, index.analyzers, index.analyzer), [*_CLAUSE, "field", "slop"])
    per_phrase = tokens.groupBy(*_CLAUSE, "field", "slop").agg(
        F.count("*").cast("int").alias("slots"),
        F.min("pos").alias("first"),
        F.collect_list(F.struct("pos", "term")).alias("words"),
    ).withColumn("repeats", F.size(F.array_distinct("words.term")) < F.col("slots"))
    return per_phrase.select(*_CLAUSE, "field", "slop", "slots", "first", "repeats", F.inline("words")).select(
        *_CLAUSE, "field", "slop", "slots", "repeats", (F.col("pos") - F.col("first")).alias("slot"), "term"
    )


def _with_idf(index: TextIndex, terms: DataFrame, small: bool) -> DataFrame:
    """Add the idf of each query term that is weighted by it; an unseen term has df 0."""
    wanted = terms.filter(~F.col("constant") & (F.length("term") > 0)).select("bucket", "field", "term").distinct()
    found = index.terms.join(F.broadcast(wanted) if small else wanted, ["bucket", "field", "term"])
    found = found.select("field", "term", "df")
    if not index.summed:
        found = found.groupBy("field", "term").agg(F.sum("df").alias("df"))
    # At most one row per wanted term, so the same bound holds.
    joined = terms.join(F.broadcast(found) if small else found, ["field", "term"], "left")
    docs = F.lit(float(index.doc_count))
    return joined.withColumn("idf", scoring.idf(docs, F.coalesce("df", F.lit(0)))).drop("df")


def _context(clauses: DataFrame, sums: DataFrame) -> DataFrame:
    """Per clause: its role and words, and the norm of its query. Clauses that match nothing count."""
    counted = F.col("occur") != "must_not"
    own = F.when(F.col("kind").isin(*_CONSTANT), F.lit(1.0)).otherwise(F.coalesce("weight_sq", F.lit(0.0)))
    role = F.when(F.col("occur") == "must", _ROLES["must"]).when(~counted, _ROLES["must_not"]).otherwise(_ROLES["should"])
    units = F.when(F.col("kind") == "terms", F.coalesce("units", F.lit(0))).otherwise(F.lit(0)).cast("int")
    joined = clauses.join(sums, list(_CLAUSE), "left").select(
        *_CLAUSE,
        role.alias("role"),
        units.alias("units"),
        F.when(F.col("operator") == "and", units).otherwise(F.lit(0)).alias("required"),
        F.when(counted, own).otherwise(F.lit(0.0)).alias("weight_sq"),
    )
    per_query = joined.groupBy("query_id").agg(
        F.count(F.when(F.col("role") != _ROLES["must_not"], 1)).cast("int").alias("n_clauses"),
        F.count(F.when(F.col("role") == _ROLES["must"], 1)).cast("int").alias("n_must"),
        scoring.query_norm(F.sum("weight_sq")).alias("query_norm"),
    )
    return joined.drop("weight_sq").join(per_query, "query_id")


def _build_side(terms: DataFrame, small: bool) -> DataFrame:
    """Query terms as the small side of the join with the postings, cut off from how they were made.

    The filter makes Spark prune the buckets that none of the terms falls into.
    """
    terms = cut(terms).filter(F.length("term") > 0)
    return F.broadcast(terms) if small else terms


def _blocks() -> Column:
    """The blocks of query terms: at most as many numbers as there are blocks."""
    return F.sort_array(F.collect_set("block"))


def _in_blocks(index: TextIndex, blocks: Sequence[int]) -> DataFrame:
    """The postings in the blocks of the query terms. The condition is pushed to the files, which skip pages by it; more than
    ``PUSHED_BLOCKS`` blocks are covered by as many ranges."""
    block = F.col("block")
    wanted = [block == a if a == b else block.between(a, b) for a, b in ranges(blocks, PUSHED_BLOCKS)]
    return index.postings.filter(any_of(wanted))


def _term_hits(
    postings: DataFrame, weighted: DataFrame, kinds: Sequence[str], clause: Sequence[str], many_fields: bool
) -> DataFrame:
    """Clause scores of the documents that hold the weighted terms."""
    norm = scoring.tf(F.col("tf")) * scoring.length_norm(F.col("length"))
    matches = postings.select(
        "field", "term", "doc_id", "tf", "length", "shard", "batch", "bucket"
    ).join(weighted, ["bucket", "field", "term"])
    constant = F.col("constant")
    if all(k in _CONSTANT for k in kinds):
        total = F.max("weight")
    elif any(k in _CONSTANT for k in kinds):
        total = F.coalesce(F.sum(F.when(~constant, F.col("weight") * norm)), F.max(F.when(constant, F.col("weight"))))
    else:
        total = F.sum(F.col("weight") * norm)
    if "terms" not in kinds:
        return matches.groupBy(*clause, *DOC).agg(total.alias("contrib"))
    if many_fields:
        # A query word found in several fields is one matched word; where every word is required, some field must hold
        # all terms that it makes of the word.
        per_unit = (
            matches.groupBy(*clause, "unit", "mult", "constant", "field", "parts", *DOC)
            .agg(total.alias("in_field"), F.count("*").alias("found"))
            .groupBy(*clause, "unit", "mult", "constant", *DOC)
            .agg(
                F.when(F.col("constant"), F.max("in_field")).otherwise(F.sum("in_field")).alias("contrib"),
                F.max(F.col("found") >= F.col("parts")).alias("whole"),
            )
        )
        per_clause = per_unit.groupBy(*clause, *DOC).agg(
            F.sum("contrib").alias("contrib"), F.sum("mult").alias("matched"),
            F.sum(F.when(F.col("whole"), F.col("mult")).otherwise(0)).alias("complete"),
        )
    else:
        per_clause = matches.groupBy(*clause, *DOC).agg(total.alias("contrib"), F.sum("mult").alias("matched"))
        per_clause = per_clause.withColumn("complete", F.col("matched"))
    inner = F.when(F.col("units") > 0, scoring.coord(F.col("matched"), F.col("units"))).otherwise(F.lit(1.0))
    return per_clause.filter("complete >= required").select(*clause, *DOC, (F.col("contrib") * inner).alias("contrib"))


def _phrase_hits(postings: DataFrame, phrases: DataFrame, clause: Sequence[str], max_slop: int, repeats: bool) -> DataFrame:
    scale = F.col("weight") * scoring.length_norm(F.col("length"))
    matches = (
        postings.select("field", "term", "doc_id", "length", "positions", "shard", "batch", "bucket")
        .join(phrases, ["bucket", "field", "term"])
        .select(*clause, "field", *DOC, scale.alias("scale"), "slots", "slop", "repeats", "slot", "positions")
    )
    found = phrase_freq(matches, [*clause, "field", *DOC, "scale"], max_slop, repeats)
    # A document with the phrase in several fields is one match of the clause.
    return found.groupBy(*clause, *DOC).agg(F.sum(F.col("scale") * scoring.tf(F.col("freq"))).alias("contrib"))


def _weighted_terms(index: TextIndex, clauses: DataFrame, kinds: Sequence[str], many_fields: bool) -> tuple:
    """The clauses' terms with their idf, whether they are small, their blocks, and each clause's sum of squared weights."""
    terms = cut(index.layout.placed(_query_terms(index, clauses, kinds, many_fields)))
    small, blocks = measured(terms, _blocks())
    if all(k in _CONSTANT for k in kinds):
        weighted = terms.withColumn("idf", F.lit(0.0))
    else:
        weighted = cut(_with_idf(index, terms, small))
    square = F.pow(F.col("idf") * F.col("boost"), F.lit(2))
    sums = weighted.groupBy(*_CLAUSE).agg(
        F.sum(F.when(~F.col("constant"), F.col("mult") * square)).alias("weight_sq"),
        F.sum(F.when(F.col("lead"), F.col("mult"))).alias("units"),
    )
    return weighted, small, blocks, sums


def _weighted_phrases(index: TextIndex, clauses: DataFrame) -> tuple:
    """The words of the clauses' phrases with their idf, whether they are small, their blocks, whether a phrase repeats a word,
    and each clause's sum of squared weights."""
    words = _phrase_terms(index, clauses).withColumn("constant", F.lit(False))
    words = cut(index.layout.placed(words))
    small, blocks, repeats = measured(words, _blocks(), F.coalesce(F.bool_or("repeats"), F.lit(False)))
    phrases = cut(_with_idf(index, words, small))
    # Each field has a phrase of its own.
    idf_sum = phrases.groupBy(*_CLAUSE, "field").agg(F.sum("idf").alias("idf_sum"))
    sums = idf_sum.groupBy(*_CLAUSE).agg(
        F.sum(F.pow("idf_sum", F.lit(2))).alias("weight_sq"), F.lit(0).cast("long").alias("units")
    )
    return phrases.join(idf_sum, [*_CLAUSE, "field"]), small, blocks, repeats, sums


def _scaled_terms(weighted: DataFrame, context: DataFrame, clause: Sequence[str]) -> DataFrame:
    weight = F.when(F.col("constant"), F.col("boost")).otherwise(F.pow("idf", F.lit(2)) * F.col("boost") * F.col("mult"))
    needed = ("bucket", "field", "term", "unit", "mult", "parts", "constant")
    return weighted.join(context, list(_CLAUSE)).select(*clause, *needed, (weight * F.col("query_norm")).alias("weight"))


def _scaled_phrases(phrases: DataFrame, context: DataFrame, clause: Sequence[str]) -> DataFrame:
    needed = ("bucket", "field", "term", "slot", "slots", "slop", "repeats", "idf")
    return phrases.join(context, list(_CLAUSE)).select(
        *clause, *needed, (F.pow("idf_sum", F.lit(2)) * F.col("query_norm")).alias("weight")
    )


def score_clauses(
    index: TextIndex,
    clauses: DataFrame,
    kinds: Sequence[str],
    *,
    many_clauses: bool,
    many_fields: bool,
    max_slop: int = 0,
) -> DataFrame:
    """``(query_id, shard, batch, doc_id, score)`` of every matching document."""
    return _score_prepared(index, _prepared(index, clauses, kinds, many_fields), kinds, many_clauses, many_fields, max_slop)


def _prepared(index: TextIndex, clauses: DataFrame, kinds: Sequence[str], many_fields: bool) -> tuple:
    """The weighted terms and phrases of clauses of these kinds (None if there are none of a kind), and what scoring needs to
    know of each clause."""
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown clause kinds {sorted(unknown)}")
    term_kinds = [k for k in kinds if k != "phrase"]
    sums, of_terms, of_phrases = [], None, None
    if term_kinds:
        *of_terms, own = _weighted_terms(index, clauses, term_kinds, many_fields)
        sums.append(own)
    if "phrase" in kinds:
        *of_phrases, own = _weighted_phrases(index, clauses)
        sums.append(own)
    return of_terms, of_phrases, _context(clauses, sums[0] if len(sums) == 1 else sums[0].unionByName(sums[1]))


def _score_prepared(
    index: TextIndex, prepared: tuple, kinds: Sequence[str], many_clauses: bool, many_fields: bool, max_slop: int
) -> DataFrame:
    of_terms, of_phrases, context = prepared
    clause = _AMONG_OTHERS if many_clauses else _ALONE
    term_kinds = [k for k in kinds if k != "phrase"]
    hits = []
    if of_terms is not None:
        weighted, terms_small, term_blocks = of_terms
        scaled = _scaled_terms(weighted, context, clause)
        index_part = _in_blocks(index, term_blocks)
        hits.append(_term_hits(index_part, _build_side(scaled, terms_small), term_kinds, clause, many_fields))
    if of_phrases is not None:
        phrases, words_small, word_blocks, repeats = of_phrases
        scaled = _scaled_phrases(phrases, context, clause)
        index_part = _in_blocks(index, word_blocks)
        hits.append(_phrase_hits(index_part, _build_side(scaled, words_small), clause, max_slop, repeats))
    # A union keeps the placement by shard only where that column was named anew in each input.
    hits = [h.withColumnRenamed("shard", "home") for h in hits]
    clause_hits = reduce(DataFrame.unionByName, hits)
    if many_clauses:
        role = F.col("role")
        counted = role != _ROLES["must_not"]
        per_doc = clause_hits.groupBy("query_id", "n_clauses", "n_must", "home", "batch", "doc_id").agg(
            F.sum(F.when(counted, F.col("contrib"))).alias("contrib"),
            F.count(F.when(counted, 1)).alias("matched"),
            F.count(F.when(role == _ROLES["must"], 1)).alias("must"),
            F.count(F.when(~counted, 1)).alias("banned"),
        )
        scored = per_doc.filter("banned = 0 and must = n_must and matched > 0").withColumn(
            "score", F.col("contrib") * scoring.coord(F.col("matched"), F.col("n_clauses"))
        )
    else:
        scored = clause_hits.withColumn("score", F.col("contrib"))
    scored = scored.withColumnRenamed("home", "shard").select(
        "query_id", *DOC, scoring.rounded(F.col("score")).alias("score")
    )
    return without_removed(scored, index.removed)


def top_hits(scored: DataFrame, k: int, *, total: bool = True) -> DataFrame:
    """The best k documents of each query with their rank and, with ``total``, the number of all matches.

    Each shard ranks and counts its own hits in place; the shuffle carries k rows per query and
    shard. Ties are broken by ``doc_id``. Without the number of matches a hit beyond the k-th is dropped while the
    shard's hits are ranked, and again while those of a query are.
    """
    best_first = [F.desc("score"), F.asc("doc_id")]
    in_shard = Window.partitionBy("query_id", "shard").orderBy(*best_first)
    placed = scored.withColumn("place", F.row_number().over(in_shard))
    of_query = Window.partitionBy("query_id").orderBy(*best_first)
    rank = F.row_number().over(of_query)
    if not total:
        ranked = placed.filter(F.col("place") <= k).drop("place").withColumn("rank", rank).filter(F.col("rank") <= k)
        return ranked.select("query_id", *DOC, "score", F.col("rank").cast("long").alias("rank"))
    everything = in_shard.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = placed.withColumn("shard_hits", F.count("*").over(everything)).filter(F.col("place") <= max(k, 1))
    all_of_query = of_query.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        local.withColumn("rank", rank.cast("long"))
        .withColumn("total_hits", F.sum(F.when(F.col("place") == 1, F.col("shard_hits"))).over(all_of_query))
        .filter(F.col("rank") <= k)
        .select("query_id", *DOC, "score", "rank", "total_hits")
    )


def _search(
    index: TextIndex, clauses: DataFrame, kind: str, k: int, fields: Sequence[str], total: bool, max_slop: int = 0
) -> DataFrame:
    """One clause per query. Queries of equal text are answered once."""
    clauses = cut(clauses)
    rows, ids, texts = clauses.agg(F.count("*"), F.count_distinct("query_id"), F.count_distinct("text")).first()
    if rows == ids and texts < rows:
        first = clauses.groupBy("text").agg(F.min("query_id").alias("first"))
        asked = clauses.join(broadcast_if_small(cut(first)), clauses["text"].eqNullSafe(first["text"])).select(
            clauses["*"], "first"
        )
        asked = cut(asked)
        answered = _top(index, asked.filter("query_id = first").drop("first"), kind, k, len(fields) > 1, total, max_slop)
        names = answered.columns
        answered = answered.withColumnRenamed("query_id", "first")
        return answered.join(broadcast_if_small(asked.select("first", "query_id")), "first").select(*names)
    return _top(index, clauses, kind, k, len(fields) > 1, total, max_slop)


def _top(
    index: TextIndex, clauses: DataFrame, kind: str, k: int, many_fields: bool, total: bool, max_slop: int
) -> DataFrame:
    """The best k documents of each query, scored and counted within the shards by ``plans.ranking``.

    Where the query side is not small, postings meet it by a shuffle: as lists of the queries of each term, or, for keyword
    and phrase queries, a row per query and posting.
    """
    if kind == "phrase":
        weighted, small, blocks, _, sums = _weighted_phrases(index, clauses)
        scaled = _scaled_phrases(weighted, _context(clauses, sums), _ALONE)
    else:
        weighted, small, blocks, sums = _weighted_terms(index, clauses, [kind], many_fields)
        scaled = _scaled_terms(weighted, _context(clauses, sums), _ALONE)
    columns = ["tf", "length"] if kind != "phrase" else ["length", "positions"]
    postings = _in_blocks(index, blocks).select("bucket", "field", "term", *DOC, *columns)
    spark = scaled.sparkSession
    if small:
        scaled = cut(scaled)
        names = ["bucket", "field", "term"]
        numbered = cut(scaled.select(*names).distinct().withColumn("term_no", F.monotonically_increasing_id()))
        # As large as the broadcast below, whose bounds were measured. The filter there makes Spark prune the buckets that
        # none of the terms falls into.
        rows = scaled.join(F.broadcast(numbered), names).drop("bucket", "term").toArrow()
        known = phrases_of(rows, max_slop) if kind == "phrase" else entries_of(rows, many_fields, kind == "terms", kind in _CONSTANT)
        met = postings.join(F.broadcast(numbered.filter(F.length("term") > 0)), names).select(*DOC, "term_no", *columns)
        order = ["term_no"] if kind != "phrase" else ["length", "term_no"]
    elif kind in _CONSTANT and (shared := _shared(index, postings, scaled)) is not None:
        met, known = shared
        order = ["term_no"]
    elif kind in ("term", "prefix", "wildcard", "fuzzy") and fits_broadcast(clauses):
        met, known = _listed(index, postings, scaled, kind in _CONSTANT)
        order = ["length"]
    else:
        scored = score_clauses(index, clauses, [kind], many_clauses=False, many_fields=many_fields, max_slop=max_slop)
        return top_hits(scored, k, total=total)
    met = without_removed(met, index.removed)
    placed = met.withColumn("place", F.row_number().over(Window.partitionBy(*DOC).orderBy(*order)))
    run = (by_phrases if kind == "phrase" else by_entries)(spark.sparkContext.broadcast(known), max(k, 1))
    return _best(placed.mapInArrow(run, _hits_schema(index, clauses)), k, total)


def _hits_schema(index: TextIndex, clauses: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", clauses.schema["query_id"].dataType), T.StructField("shard", T.IntegerType()),
        T.StructField("batch", T.LongType()), T.StructField("doc_id", index.postings.schema["doc_id"].dataType),
        T.StructField("score", T.DoubleType()), T.StructField("shard_hits", T.LongType()),
    ])


def _shared(index: TextIndex, postings: DataFrame, scaled: DataFrame) -> tuple[DataFrame, Entries] | None:
    """Postings with the number of the list of queries that their term matches, which terms share, and the queries of each list;
    None where the lists are too many for each task to know. The terms are broadcast where they are small."""
    names = ["bucket", "field", "term"]
    own = F.sort_array(F.collect_list(F.struct("query_id", "weight")))
    lists = cut(scaled.filter(F.length("term") > 0).groupBy(*names).agg(own.alias("own")))
    distinct = cut(lists.select("own").distinct().withColumn("term_no", F.monotonically_increasing_id()))
    small, size = measured(distinct, F.coalesce(F.sum(F.size("own")), F.lit(0)))
    if not small or size > MOST_ENTRIES:
        return None
    rows = distinct.select("term_no", F.inline("own")).withColumn("mult", F.lit(1).cast("long")).toArrow()
    asked = cut(lists.join(F.broadcast(distinct), "own").select(*names, "term_no"))
    in_place = fits_broadcast(asked)
    met = postings.join(F.broadcast(asked) if in_place else asked, names).drop(*names)
    return met if in_place else met.repartition(index.layout.shards, "shard"), entries_of(rows, False, False, True)


def _listed(index: TextIndex, postings: DataFrame, scaled: DataFrame, constant: bool) -> tuple[DataFrame, Entries]:
    """Postings with the queries of their terms as a list, joined by a shuffle and placed by shard again, and the queries."""
    # A row per query.
    named = scaled.groupBy("query_id").agg(F.max("weight").alias("best"))
    named = cut(named.withColumn("query", F.row_number().over(Window.orderBy("query_id")) - 1))
    rows = named.orderBy("query").toArrow()
    ids, best = rows.column("query_id").combine_chunks(), rows.column("best").to_numpy()
    one = F.struct("query") if constant else F.struct("query", "weight")
    lists = scaled.filter(F.length("term") > 0).join(F.broadcast(named), "query_id").groupBy("bucket", "field", "term").agg(F.collect_list(one).alias("own"))
    carried = ["query"] if constant else ["query", "weight"]
    lists = lists.select("bucket", "field", "term", *[F.col("own").getField(c).alias(c) for c in carried])
    met = postings.join(lists, ["bucket", "field", "term"]).drop("bucket", "field", "term")
    return met.repartition(index.layout.shards, "shard"), listed_entries(ids, best if constant else None)


def _best(hits: DataFrame, k: int, total: bool) -> DataFrame:
    """The best k of each query from the best ones of each shard (``shard_hits``: the number of all, in one row of each)."""
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("doc_id"))
    rank = F.row_number().over(of_query)
    if not total:
        ranked = hits.withColumn("rank", rank).filter(F.col("rank") <= k)
        return ranked.select("query_id", *DOC, "score", F.col("rank").cast("long").alias("rank"))
    all_of_query = of_query.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        hits.withColumn("rank", rank.cast("long")).withColumn("total_hits", F.sum("shard_hits").over(all_of_query))
        .filter(F.col("rank") <= k)
        .select("query_id", *DOC, "score", "rank", "total_hits")
    )


def _fields(index: TextIndex, fields: Sequence[str] | str | None) -> list[str]:
    names = list(index.fields) if fields is None else [fields] if isinstance(fields, str) else list(fields)
    missing = set(names) - set(index.fields)
    if missing:
        raise ValueError(f"not indexed: {sorted(missing)}")
    return names


def search_keywords(
    index: TextIndex, queries: DataFrame, k: int = 3, *, fields: Sequence[str] | str | None = None, operator: str = "or",
    total: bool = True,
) -> DataFrame:
    """Keyword search over one, several or (by default) all indexed fields.

    With ``operator="and"`` a document must hold every query word, in any of the fields. Like all searches it is cheaper
    without the ``total`` number of hits.
    """
    names = _fields(index, fields)
    return _search(index, make_clauses(queries, "terms", names, operator=operator), "terms", k, names, total)


def search_term(
    index: TextIndex, queries: DataFrame, field: str, k: int = 3, *, normalize: bool = False, total: bool = True
) -> DataFrame:
    """The keyword as one term, not analyzed (``normalize`` lower-cases it)."""
    return _search(index, make_clauses(queries, "term", _fields(index, field), normalize=normalize), "term", k, [field], total)


def search_prefix(
    index: TextIndex, queries: DataFrame, field: str, k: int = 3, *, normalize: bool = False, total: bool = True
) -> DataFrame:
    return _search(index, make_clauses(queries, "prefix", _fields(index, field), normalize=normalize), "prefix", k, [field], total)


def search_wildcard(
    index: TextIndex, queries: DataFrame, field: str, k: int = 3, *, normalize: bool = False, total: bool = True
) -> DataFrame:
    """Terms matching a pattern: ``*`` any text, ``?`` one character."""
    return _search(index, make_clauses(queries, "wildcard", _fields(index, field), normalize=normalize), "wildcard", k, [field], total)


def search_fuzzy(
    index: TextIndex, queries: DataFrame, field: str, k: int = 3, *, normalize: bool = False, total: bool = True
) -> DataFrame:
    """Terms within edit distance of the keyword (similarity above one half)."""
    return _search(index, make_clauses(queries, "fuzzy", _fields(index, field), normalize=normalize), "fuzzy", k, [field], total)


def search_phrase(index: TextIndex, queries: DataFrame, field: str, k: int = 3, *, slop: int = 0, total: bool = True) -> DataFrame:
    """The query words in order, with at most ``slop`` places of disorder."""
    return _search(index, make_clauses(queries, "phrase", _fields(index, field), slop=slop), "phrase", k, [field], total, slop)


def search_boolean(index: TextIndex, clauses: DataFrame, k: int = 3, *, total: bool = True) -> DataFrame:
    """Boolean combinations.

    ``clauses`` has query_id, clause_id, kind, text, occur (should, must, must_not), and optionally
    field (null: all indexed fields), slop and operator.
    """
    full = cut(_full_clauses(index, clauses))
    kinds = {r["kind"]: r["slop"] for r in full.groupBy("kind").agg(F.max("slop").alias("slop")).limit(len(KINDS) + 1).collect()}
    max_slop = max(kinds.values(), default=0)
    prepared = _prepared(index, full, list(kinds), True)
    ranked = _boolean_in_blocks(index, full, prepared, k)
    if ranked is not None:
        return _best(ranked, k, total)
    return top_hits(_score_prepared(index, prepared, list(kinds), True, True, max_slop), k, total=total)


def _boolean_in_blocks(index: TextIndex, clauses: DataFrame, prepared: tuple, k: int) -> DataFrame | None:
    """The best documents of each boolean query, scored and counted within the shards by ``plans.ranking``, a row per posting and
    never a posting and a clause.

    Terms that the same clauses ask for in the same way share a list of entries, and postings carry its number. None where clauses
    share an id, or they, the lists or the phrases are too many for each task to know; those are joined with the postings.
    """
    of_terms, of_phrases, context = prepared
    rows, ids = clauses.agg(F.count("*"), F.count_distinct(*_CLAUSE)).first()
    if not 0 < rows == ids <= MOST_CLAUSES or (of_phrases is not None and not of_phrases[1]):
        return None
    spark, names, fields = index.postings.sparkSession, ["bucket", "field", "term"], list(index.fields)
    # A row per clause, of which there are no more than the bound.
    named = cut(context.withColumn("clause", (F.row_number().over(Window.orderBy(*_CLAUSE)) - 1).cast("long")))
    numbers = F.broadcast(named.select(*_CLAUSE, "clause", "query_norm"))
    columns = ["list_no", "idf2", "tf", "length", "word_no", "positions"]
    none = {"list_no": F.lit(-1).cast("long"), "idf2": F.lit(0.0), "tf": F.lit(0), "word_no": F.lit(-1).cast("long"), "positions": F.array().cast("array<int>")}
    met, in_place = [], True
    entries = spark.createDataFrame(
        [], "list_no long, field string, clause long, unit int, mult long, parts int, constant boolean, factor double"
    ).toArrow()
    if of_terms is not None:
        weighted, _, blocks = of_terms
        factor = F.when(F.col("constant"), F.col("boost")).otherwise(F.col("boost") * F.col("mult")) * F.col("query_norm")
        own = F.struct("clause", F.col("unit").cast("int").alias("unit"), "mult", "parts", "constant", factor.alias("factor"))
        lists = cut(
            weighted.filter(F.length("term") > 0).join(numbers, list(_CLAUSE)).groupBy(*names)
            .agg(F.sort_array(F.collect_list(own)).alias("own"), F.max(F.when(~F.col("constant"), F.pow("idf", F.lit(2)))).alias("idf2"))
        )
        distinct = cut(lists.select("field", "own").distinct().withColumn("list_no", F.monotonically_increasing_id()))
        small, size = measured(distinct, F.coalesce(F.sum(F.size("own")), F.lit(0)))
        if not small or size > MOST_ENTRIES:
            return None
        entries = distinct.select("list_no", "field", F.inline("own")).toArrow()
        asked = cut(lists.join(F.broadcast(distinct), ["field", "own"]).select(*names, F.coalesce("idf2", F.lit(0.0)).alias("idf2"), "list_no"))
        in_place = fits_broadcast(asked)
        found = _in_blocks(index, blocks).select(*names, *DOC, "tf", "length").join(F.broadcast(asked) if in_place else asked, names)
        met.append(found.select(*DOC, *[none[c].alias(c) if c in ("word_no", "positions") else F.col(c) for c in columns]))
    phrases = []
    if of_phrases is not None:
        weighted, _, blocks, _ = of_phrases
        number = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field")).cast("long") - 1
        scaled = cut(
            weighted.join(numbers, list(_CLAUSE)).select(
                *names, (F.col("clause") * len(fields) + number).alias("query_id"), "slop", "slot", "slots", "repeats", "idf",
                (F.pow("idf_sum", F.lit(2)) * F.col("query_norm")).alias("weight"),
            )
        )
        words = cut(scaled.filter(F.length("term") > 0).select(*names).distinct().withColumn("word_no", F.monotonically_increasing_id()))
        table = scaled.join(F.broadcast(words), names).drop("bucket", "term").withColumnRenamed("word_no", "term_no").toArrow()
        for slop in sorted(set(table.column("slop").to_pylist())):
            phrases.append(phrases_of(table.filter(pc.equal(table.column("slop"), slop)), slop))
        found = _in_blocks(index, blocks).select(*names, *DOC, "length", "positions").join(F.broadcast(words), names)
        met.append(found.select(*DOC, *[none[c].alias(c) if c in ("list_no", "idf2", "tf") else F.col(c) for c in columns]))
    # A union keeps the placement by shard only where that column was named anew in each input.
    union = reduce(DataFrame.unionByName, [m.withColumnRenamed("shard", "home") for m in met]).withColumnRenamed("home", "shard")
    union = union if in_place else union.repartition(index.layout.shards, "shard")
    union = without_removed(union, index.removed)
    placed = union.withColumn("place", F.row_number().over(Window.partitionBy(*DOC).orderBy("length")))
    known = clauses_of(named.orderBy("clause").toArrow(), entries, tuple(phrases), len(fields))
    run = by_clauses(spark.sparkContext.broadcast(known), max(k, 1))
    return placed.mapInArrow(run, _hits_schema(index, clauses))


def _full_clauses(index: TextIndex, clauses: DataFrame) -> DataFrame:
    given = set(clauses.columns)
    every = F.array(*[F.lit(f) for f in index.fields])
    fields = F.when(F.col("field").isNotNull(), F.array("field")).otherwise(every) if "field" in given else every
    return clauses.select(
        *_CLAUSE,
        "kind",
        fields.alias("fields"),
        "text",
        "occur",
        (F.coalesce("slop", F.lit(0)) if "slop" in given else F.lit(0)).cast("int").alias("slop"),
        (F.coalesce("operator", F.lit("or")) if "operator" in given else F.lit("or")).alias("operator"),
    )


def total_hits(queries: DataFrame, top: DataFrame) -> DataFrame:
    """The number of matches of every query, 0 for those without any."""
    found = top.filter("rank = 1").select("query_id", "total_hits")
    return queries.select("query_id").join(found, "query_id", "left").select(
        "query_id", F.coalesce("total_hits", F.lit(0)).cast("long").alias("total_hits")
    )


def attach_stored(index: TextIndex, top: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Stored fields of the hits, read from the shards that hold one."""
    names = list(fields) if fields is not None else [c for c in index.stored.columns if c not in (*DOC, SEQ)]
    top = cut(top)
    wanted = index.stored.filter(_with_ids(top)).select(*DOC, *[F.col(f"`{n}`") for n in names])
    return wanted.join(broadcast_if_small(top), list(DOC))


def _with_ids(top: DataFrame) -> Column:
    """A condition on stored rows that the hits' rows meet: their shards, batches and ids, or, where there are more than
    ``PUSHED_IDS`` ids, the span of each shard's ids. Stored rows are sorted by id within a shard, so the files skip pages by it."""
    ids = top.select(*DOC).distinct()
    span = ids.groupBy("shard", "batch").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n"))
    # At most one row per shard and batch of the index.
    spans = span.collect()
    own: dict[tuple, list] = {(r["shard"], r["batch"]): [] for r in spans}
    if sum(r["n"] for r in spans) <= PUSHED_IDS:
        for r in ids.collect():
            own[r["shard"], r["batch"]].append(r["doc_id"])
    doc, parts = F.col("doc_id"), []
    for r in spans:
        exact = own[r["shard"], r["batch"]]
        inside = any_of([doc == F.lit(i) for i in sorted(exact)]) if exact else doc.between(F.lit(r["least"]), F.lit(r["most"]))
        parts.append((F.col("shard") == r["shard"]) & (F.col("batch") == r["batch"]) & inside)
    return any_of(parts) & F.col("batch").isin(sorted({r["batch"] for r in spans}))
