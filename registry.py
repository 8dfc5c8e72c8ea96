"""The registered queries: each runs an operator over whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import findery as fy
from findery.functions import analysis as an
from findery.operators import binding as bd
from findery.operators import tokens as tk
from findery.operators.segment import segment, segmenting
from findery.runtime import shared_folder
from findery.sources import tables as tb
from findery.streaming.standing import maintain_index, standing_search

STOP_WORDS = ["the", "of", "and", "la", "le", "de", "der", "und"]
CODES = ["BY-NC", "CC BY", "2.0", "4.0"]
TOKEN_LIMIT = 1_000
LETTERS = "abcdefghijklmnopqrstuvwxyz "
HAN_LETTERS = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"
TOP = 3

_indexes: dict[tuple, fy.TextIndex] = {}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder for one table of this session."""
    number = _folder.count = getattr(_folder, "count", 0) + 1
    return f"{shared_folder(spark)}/findery/{spark.sparkContext.applicationId}/{name}-{number}"


def _store(
    spark: SparkSession, folder: str, name: str, table: str, key: str, fields: list[str], **options
) -> fy.TextIndex:
    """The index over a table, written once per session and folder."""
    slot = (spark.sparkContext.applicationId, folder, name)
    if slot not in _indexes:
        store = fy.IndexStore(spark, _folder(spark, name), **options)
        store.replace(_read(spark, folder, table), key, fields)
        _indexes[slot] = store.open()
    return _indexes[slot]


def _documents(spark: SparkSession, folder: str) -> fy.TextIndex:
    return _store(spark, folder, "documents", "documents", "doc_id", ["text", "source", "lang"])


def _ascii_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def _benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of every benchmark text as a query of its own, in its own case."""
    words = F.regexp_extract_all("text", F.lit(f"({an.WORD_CHAR}+)"), F.lit(1))
    return _benchmark(spark, folder).select("query_id", F.posexplode(words).alias("pos", "text")).select(
        (F.col("query_id") * 10_000 + F.col("pos")).alias("query_id"), "text"
    )


def _word_windows(spark: SparkSession, folder: str, size: int) -> DataFrame:
    """Every run of ``size`` neighbouring words of the benchmark texts as a query."""
    words = _benchmark(spark, folder).select("query_id", an.words(F.col("text")).alias("w")).filter(F.size("w") >= size)
    starts = F.sequence(F.lit(0), F.size("w") - size)
    windows = F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, size), " "))
    return words.select("query_id", F.posexplode(windows).alias("pos", "text")).select(
        (F.col("query_id") * 10_000 + F.col("pos")).alias("query_id"), "text"
    )


def _ranked(top: DataFrame) -> DataFrame:
    return top.select("query_id", "doc_id", "score", "rank", "total_hits")


# -- analysis -----------------------------------------------------------------------------------


def tokens(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", an.words(F.col("text")).alias("tokens"))
    return tk.explode_tokens(docs, ["doc_id"])


def tokens_nostop(spark, folder):
    analyzer = an.without_stop_words(an.words, STOP_WORDS)
    docs = _read(spark, folder, "documents").select("doc_id", analyzer(F.col("text")).alias("tokens"))
    return tk.explode_tokens(docs, ["doc_id"])


def tokens_nostop_table(spark, folder):
    """Stop words from a table: all words of the benchmark texts."""
    stop = _benchmark(spark, folder).select(F.explode(an.words(F.col("text"))).alias("term"))
    return tk.remove_stop_words(tokens(spark, folder), stop).select("doc_id", "pos", "term")


def tokens_keep_codes(spark, folder):
    analyzer = an.keeping_codes(CODES)
    docs = _read(spark, folder, "documents").select("doc_id", analyzer(F.col("text")).alias("tokens"))
    return tk.explode_tokens(docs, ["doc_id"])


def _part_texts(spark, folder):
    return _read(spark, folder, "part").select("p_partkey", F.concat_ws(" / ", "p_brand", "p_name", "p_type").alias("text"))


def tokens_keep_codes_table(spark, folder):
    """Codes from a table: the brands of all parts."""
    brands = _read(spark, folder, "part").select(F.col("p_brand").alias("word"))
    found = segment(_part_texts(spark, folder), ["p_partkey"], "text", brands)
    return tk.explode_tokens(found, ["p_partkey"])


def _han(text: Column) -> Column:
    return F.translate(F.lower(text), LETTERS, HAN_LETTERS)


def segment_han(spark, folder):
    """Unspaced text: the conversations with a Han character for every Latin letter and no blanks,
    against the words of the benchmark texts written the same way."""
    talks = _read(spark, folder, "conversations").select("conv_id", "turn", _han(F.col("text")).alias("text"))
    words = _benchmark(spark, folder).select(F.explode(_ascii_words(F.col("text"))).alias("word"))
    found = segment(talks, ["conv_id", "turn"], "text", words.select(_han(F.col("word")).alias("word")))
    return tk.explode_tokens(found, ["conv_id", "turn"])


def search_segmented(spark, folder):
    """Unspaced text indexed and searched by the same dictionary: the Han-written conversations and benchmark texts."""
    talks = _read(spark, folder, "conversations").select(
        (F.col("conv_id") * 1_000 + F.col("turn")).alias("doc_id"), _han(F.col("text")).alias("text")
    )
    words = _benchmark(spark, folder).select(F.explode(_ascii_words(F.col("text"))).alias("word"))
    by_dictionary = segmenting(words.select(_han(F.col("word")).alias("word")))
    store = fy.IndexStore(spark, _folder(spark, "segmented"), analyzers={"text": by_dictionary})
    store.replace(talks, "doc_id", ["text"])
    queries = _benchmark(spark, folder).withColumn("text", _han(F.col("text")))
    return _ranked(fy.search_keywords(store.open(), queries, TOP, fields="text"))


def bigrams_han(spark, folder):
    docs = _read(spark, folder, "documents").select("doc_id", an.han_bigrams(_han(F.col("text"))).alias("tokens"))
    return tk.explode_tokens(docs, ["doc_id"])


def normalize_queries(spark, folder):
    return _benchmark(spark, folder).select("query_id", an.normalized(F.col("text")).alias("normalized"))


def _per_field_analyzers():
    return {"source": an.whole, "text": an.without_stop_words(an.words, STOP_WORDS)}


def analyze_per_field(spark, folder):
    long = bd.to_fields(_read(spark, folder, "documents"), ["doc_id"], ["text", "source", "lang"])
    return tk.explode_tokens(tk.analyze(long, _per_field_analyzers()), ["doc_id", "field"])


def token_limit(spark, folder):
    """The field limit as an operator, counted after stop words; the whole text is analyzed."""
    plain = an.without_stop_words(an.words, STOP_WORDS)
    docs = _read(spark, folder, "documents").select(
        "doc_id",
        F.size(F.array_compact(plain(F.col("text")))).cast("long").alias("all_tokens"),
        an.limited(plain, TOKEN_LIMIT)(F.col("text")).alias("tokens"),
    )
    return docs.select("doc_id", "all_tokens", F.size(F.array_compact("tokens")).cast("long").alias("kept_tokens"),
                       F.size("tokens").cast("long").alias("kept_places"))


# -- index --------------------------------------------------------------------------------------


def postings(spark, folder):
    index = _documents(spark, folder)
    return index.postings.select("field", "term", "doc_id", F.col("tf").cast("long").alias("tf"),
                                 F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


def term_stats(spark, folder):
    return _documents(spark, folder).term_stats()


def field_norms(spark, folder):
    lengths = tk.field_lengths(_documents(spark, folder).postings, ["shard", "field", "doc_id"])
    return lengths.select("field", "doc_id", "length", F.round("norm", 9).alias("norm"))


def corpus_size(spark, folder):
    return _documents(spark, folder).corpus.agg(F.sum("docs").alias("docs"))


def index_append(spark, folder):
    """The English documents are added to an index of the others."""
    docs = _read(spark, folder, "documents")
    store = fy.IndexStore(spark, _folder(spark, "append"))
    store.replace(docs.filter("lang <> 'en'"), "doc_id", ["text", "lang"])
    store.append(docs.filter("lang = 'en'"))
    index = store.open()
    return index.term_stats().withColumn("docs", F.lit(index.doc_count).cast("long"))


def index_snapshot(spark, folder):
    """A reader that pinned the first version does not see what was added or replaced later."""
    docs = _read(spark, folder, "documents")
    store = fy.IndexStore(spark, _folder(spark, "snapshot"))
    first = store.replace(docs.filter("lang <> 'en'"), "doc_id", ["text"])
    last = store.replace(docs, "doc_id", ["text"])
    compacted = store.compact()
    frames = []
    for name, version in (("first", first), ("last", last), ("compacted", compacted)):
        index = store.open(version)
        frames.append(index.term_stats().agg(F.count("*").alias("terms"), F.sum("df").alias("postings"),
                                             F.sum("total_tf").alias("tokens"))
                      .select(F.lit(name).alias("version"), F.lit(index.doc_count).cast("long").alias("docs"), "*"))
    return frames[0].union(frames[1]).union(frames[2])


def _updates(spark, folder):
    """Two changes to each labelled document, of which the second one counts."""
    labelled = _read(spark, folder, "documents").join(_read(spark, folder, "labels"), "doc_id")
    first = labelled.withColumns({"text": F.lit("superseded change"), "seq": F.lit(1).cast("long")})
    second = labelled.withColumns({
        "text": F.concat(F.lit("reviewed "), F.when(F.col("toxic") == 1, "withheld").otherwise(F.col("text"))),
        "seq": F.lit(2).cast("long"),
    })
    return first.unionByName(second).select("doc_id", "text", "lang", "source", "n_chars", "seq")


def _upserted(spark, folder):
    slot = (spark.sparkContext.applicationId, folder, "upserted")
    if slot not in _indexes:
        store = fy.IndexStore(spark, _folder(spark, "upsert"))
        store.replace(_read(spark, folder, "documents"), "doc_id", ["text"])
        store.upsert(_updates(spark, folder), "seq")
        _indexes[slot] = store.open()
    return _indexes[slot]


def index_upsert(spark, folder):
    index = _upserted(spark, folder)
    return index.term_stats().withColumn("docs", F.lit(index.doc_count).cast("long"))


def search_after_upsert(spark, folder):
    queries = _benchmark(spark, folder).withColumn("text", F.concat("text", F.lit(" reviewed withheld superseded")))
    return _ranked(fy.search_keywords(_upserted(spark, folder), queries, TOP))


# -- search -------------------------------------------------------------------------------------


def search_or_top3(spark, folder):
    return _ranked(fy.search_keywords(_documents(spark, folder), _benchmark(spark, folder), TOP, fields="text"))


def search_total_hits(spark, folder):
    """Counts of all queries, among them some that match nothing or have no word at all."""
    queries = _benchmark(spark, folder)
    nothing = queries.select((-F.col("query_id") - 1).alias("query_id"), F.regexp_replace("text", f"{an.WORD_CHAR}+", "--").alias("text"))
    queries = queries.unionByName(nothing)
    return fy.total_hits(queries, fy.search_keywords(_documents(spark, folder), queries, 1, fields="text"))


def search_and(spark, folder):
    return _ranked(fy.search_keywords(_documents(spark, folder), _word_windows(spark, folder, 3), TOP, fields="text", operator="and"))


def _field_queries(spark, folder):
    number = (F.col("query_id") % 20).cast("string")
    return _benchmark(spark, folder).withColumn("text", F.concat("text", F.lit(" en fr src"), number))


def search_multifield(spark, folder):
    return _ranked(fy.search_keywords(_documents(spark, folder), _field_queries(spark, folder), TOP))


def search_multifield_and(spark, folder):
    queries = _word_windows(spark, folder, 2).withColumn("text", F.concat("text", F.lit(" en")))
    return _ranked(fy.search_keywords(_documents(spark, folder), queries, TOP, operator="and"))


def search_parts(spark, folder):
    """Short fields: every pair of a part name and type, looked for in name, brand and type of all parts."""
    index = _store(spark, folder, "parts", "part", "p_partkey", ["p_name", "p_brand", "p_type"])
    queries = _read(spark, folder, "part").groupBy(F.concat_ws(" ", "p_name", "p_type").alias("text")).agg(
        F.min("p_partkey").alias("query_id")
    )
    return _ranked(fy.search_keywords(index, queries, TOP))


def search_per_field(spark, folder):
    index = _store(spark, folder, "per_field", "documents", "doc_id", ["text", "source", "lang"], analyzers=_per_field_analyzers())
    queries = _benchmark(spark, folder)
    source = F.concat(F.lit("src"), (F.col("query_id") % 20).cast("string"))
    sources = queries.select((F.col("query_id") + 100_000).alias("query_id"), source.alias("text"))
    mixed = queries.withColumn("text", F.concat("text", F.lit(" fr "), source))
    return _ranked(fy.search_keywords(index, mixed.unionByName(sources), TOP))


def search_per_field_and(spark, folder):
    """Pairs of words and a source, all required, over fields with analyzers of their own (one of them by pairs)."""
    analyzers = {**_per_field_analyzers(), "lang": an.han_bigrams}
    index = _store(spark, folder, "per_field_pairs", "documents", "doc_id", ["text", "source", "lang"], analyzers=analyzers)
    source = F.concat(F.lit(" src"), (F.col("query_id") % 20).cast("string"))
    queries = _word_windows(spark, folder, 2).withColumn("text", F.concat("text", source))
    return _ranked(fy.search_keywords(index, queries, TOP, operator="and"))


def search_term(spark, folder):
    return _ranked(fy.search_term(_documents(spark, folder), _benchmark_words(spark, folder), "text", TOP))


def search_prefix(spark, folder):
    queries = _benchmark_words(spark, folder).withColumn("text", F.left("text", F.lit(4)))
    return _ranked(fy.search_prefix(_documents(spark, folder), queries, "text", TOP, normalize=True))


def search_wildcard(spark, folder):
    text = F.col("text")
    third = F.col("query_id") % 4
    pattern = (
        F.when(third == 0, F.concat(F.left(text, F.lit(2)), F.lit("*"), F.right(text, F.lit(2))))
        .when(third == 1, F.concat(F.lit("*"), F.right(text, F.lit(4))))
        .when(third == 2, F.concat(F.lit("?"), F.substr(text, F.lit(2), F.lit(20)), F.lit("*")))
        .otherwise(F.concat(F.lit("*"), F.substr(text, F.lit(2), F.lit(3)), F.lit("?")))
    )
    queries = _benchmark_words(spark, folder).withColumn("text", pattern)
    return _ranked(fy.search_wildcard(_documents(spark, folder), queries, "text", TOP, normalize=True))


def _ascii_documents(spark, folder):
    return _store(spark, folder, "ascii", "documents", "doc_id", ["text"], analyzer=_ascii_words)


def search_fuzzy(spark, folder):
    """Over terms of ASCII letters and digits, for which all engines count edits alike."""
    queries = _benchmark(spark, folder).select("query_id", F.posexplode(_ascii_words(F.col("text"))).alias("pos", "text"))
    queries = queries.select((F.col("query_id") * 10_000 + F.col("pos")).alias("query_id"), "text")
    return _ranked(fy.search_fuzzy(_ascii_documents(spark, folder), queries, "text", TOP))


def search_phrase(spark, folder):
    return _ranked(fy.search_phrase(_documents(spark, folder), _word_windows(spark, folder, 2), "text", TOP))


def search_phrase_slop(spark, folder):
    return _ranked(fy.search_phrase(_documents(spark, folder), _word_windows(spark, folder, 3), "text", TOP, slop=2))


def _clause(queries, clause_id, kind, field, text, occur, slop=0):
    return queries.select(
        "query_id", F.lit(clause_id).cast("long").alias("clause_id"), F.lit(kind).alias("kind"), F.lit(field).alias("field"),
        text.alias("text"), F.lit(occur).alias("occur"), F.lit(slop).alias("slop"),
    )


def search_boolean(spark, folder):
    """Per benchmark text: its words in any field, its first word as term, wildcard, prefix and near
    match, its second and third as a phrase in any field, in documents that are not French and lack its
    first two words as a phrase."""
    queries = _benchmark(spark, folder).withColumn("w", _ascii_words(F.col("text")))
    first = F.get("w", F.lit(0))
    clauses = [
        _clause(queries, 1, "terms", None, F.col("text"), "should"),
        _clause(queries, 2, "term", "text", first, "should"),
        _clause(queries, 3, "wildcard", "text", F.concat(first, F.lit("*")), "should"),
        _clause(queries, 4, "prefix", "text", F.left(first, F.lit(3)), "must"),
        _clause(queries, 5, "fuzzy", "text", first, "should"),
        _clause(queries, 6, "term", "lang", F.lit("fr"), "must_not"),
        _clause(queries, 7, "phrase", "text", F.array_join(F.slice("w", 1, 2), " "), "must_not", 1),
        _clause(queries, 8, "phrase", None, F.array_join(F.slice("w", 2, 2), " "), "should"),
    ]
    return _search_clauses(spark, folder, clauses)


def _search_clauses(spark, folder, clauses):
    table = clauses[0]
    for clause in clauses[1:]:
        table = table.unionByName(clause)
    index = _store(spark, folder, "ascii_fields", "documents", "doc_id", ["text", "source", "lang"], analyzer=_ascii_words)
    return _ranked(fy.search_boolean(index, table, TOP))


def search_boolean_phrase(spark, folder):
    """Per benchmark text: its first two words as a phrase in any field, required, and the next pair, which adds to the score."""
    queries = _benchmark(spark, folder).withColumn("w", _ascii_words(F.col("text")))
    clauses = [
        _clause(queries, 1, "phrase", None, F.array_join(F.slice("w", 1, 2), " "), "must"),
        _clause(queries, 2, "phrase", None, F.array_join(F.slice("w", 2, 2), " "), "should"),
    ]
    return _search_clauses(spark, folder, clauses)


def hits_hydrated(spark, folder):
    index = _documents(spark, folder)
    top = fy.search_keywords(index, _benchmark(spark, folder), TOP, fields="text")
    hits = fy.attach_stored(index, top, ["lang", "source", "text"])
    return hits.select("query_id", "rank", "score", "doc_id", bd.rendered(["lang", "source", "text"]).alias("shown"))


# -- tables -------------------------------------------------------------------------------------

ORDER = T.StructType([
    bd.role_field("O_OrderKey", T.LongType(), store=True),
    bd.role_field("O_OrderStatus", T.StringType(), store=True, index=True),
    bd.role_field("O_OrderPriority", T.StringType(), store=True, index=True),
    bd.role_field("O_TotalPrice", T.DoubleType()),
    bd.role_field("O_Clerk", T.StringType()),
    bd.role_field("O_Lines", T.IntegerType()),
])


def _order_texts(spark, folder):
    orders = _read(spark, folder, "orders")
    return orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])


def bind_model(spark, folder):
    return bd.bind(_order_texts(spark, folder), ORDER)


def bind_rejects(spark, folder):
    """Permissive binding to a number: every third order has its letter as status and is rejected, the others a digit."""
    target = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.IntegerType())])
    key = F.col("o_orderkey").cast("long")
    status = F.when(key % 3 == 0, F.col("o_orderstatus")).otherwise((key % 7).cast("string"))
    good, bad = bd.bind_permissive(_order_texts(spark, folder).withColumn("o_orderstatus", status), target)
    return bad.select("o_orderkey", "o_orderstatus", F.array_join("bad_fields", ",").alias("bad_fields")).unionByName(
        good.select(F.col("o_orderkey").cast("string"), F.col("o_orderstatus").cast("string"), F.lit("").alias("bad_fields"))
    )


def role_projection(spark, folder):
    return bd.project_roles(bind_model(spark, folder))


def field_rows(spark, folder):
    bound = bind_model(spark, folder)
    key = bd.key_field(bound.schema)
    return bd.to_fields(bound, [key], bd.indexed_fields(bound.schema))


def skip_empty(spark, folder):
    """Part names and brands, blanked for some parts; parts without either are left out."""
    parts = _read(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("p_name"),
        F.when(F.col("p_type") != "SMALL", F.col("p_brand")).alias("p_brand"),
    )
    return bd.drop_empty(parts, ["p_name", "p_brand"])


def positional_union(spark, folder):
    nations = _read(spark, folder, "nation").select("n_nationkey", "n_name")
    suppliers = _read(spark, folder, "supplier").select(F.col("s_suppkey").cast("int"), "s_name")
    return tb.positional_union([nations, suppliers])


def export_text(spark, folder):
    """Parts written as delimited text and read back, with the number of rows written."""
    path = _folder(spark, "export")
    written = tb.export_text(_read(spark, folder, "part"), path)
    return tb.read_delimited(spark, path).withColumn("written", F.lit(written).cast("long"))


def workbook_tables(spark, folder):
    """Parts written as workbooks, one per partition, and read back."""
    path = _folder(spark, "workbooks")
    written = tb.export_workbooks(_read(spark, folder, "part").repartition(4, "p_partkey"), path, sheet="Parts")
    return tb.read_workbooks(spark, path, sheet="Parts").withColumn("written", F.lit(written).cast("long"))


def workbook_no_header(spark, folder):
    """Part keys, names and brands written as workbooks and read as sheets without a header, less the names' rows."""
    path = _folder(spark, "plain-workbooks")
    parts = _read(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    tb.export_workbooks(parts.repartition(2, "p_partkey"), path, sheet="Parts")
    return tb.read_workbooks(spark, path, sheet="Parts", header=False).filter("_c0 <> 'p_partkey'")


# -- streams ------------------------------------------------------------------------------------


def stream_search(spark, folder):
    schema = _read(spark, folder, "benchmark").schema
    arriving = spark.readStream.schema(schema).parquet(f"{folder}/benchmark.parquet*")
    wordless = F.struct((-F.col("item_id") - 1).alias("query_id"), F.regexp_replace("text", f"{an.WORD_CHAR}+", "--").alias("text"))
    queries = arriving.select(F.inline(F.array(F.struct(F.col("item_id").alias("query_id"), "text"), wordless)))
    output = _folder(spark, "answers")
    run = standing_search(
        queries, _documents(spark, folder), lambda index, batch: fy.search_keywords(index, batch, TOP, fields="text"),
        output, _folder(spark, "answers-progress"),
    )
    run.awaitTermination()
    return _ranked(spark.read.parquet(output))


def upsert_out_of_order(spark, folder):
    """The second changes arrive before the first ones, which then change nothing."""
    store = fy.IndexStore(spark, _folder(spark, "out-of-order"))
    store.replace(_read(spark, folder, "documents"), "doc_id", ["text"])
    for seq in (2, 1):
        store.upsert(_updates(spark, folder).filter(F.col("seq") == seq), "seq")
    index = store.open()
    return index.term_stats().withColumn("docs", F.lit(index.doc_count).cast("long"))


def stream_upsert(spark, folder):
    """Label changes, first and second ones, arrive file by file and replace documents of an index."""
    changes = _folder(spark, "changes")
    updates = _updates(spark, folder)
    updates.repartition(3, "seq", "lang").write.parquet(changes)
    store = fy.IndexStore(spark, _folder(spark, "stream"))
    store.replace(_read(spark, folder, "documents"), "doc_id", ["text"])
    arriving = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 1).parquet(changes)
    run = maintain_index(arriving, store, "seq", "labels", _folder(spark, "stream-progress"))
    run.awaitTermination()
    index = store.open()
    return index.term_stats().withColumn("docs", F.lit(index.doc_count).cast("long"))


NAMES = (
    "tokens tokens_nostop tokens_nostop_table tokens_keep_codes tokens_keep_codes_table segment_han bigrams_han "
    "normalize_queries analyze_per_field token_limit postings term_stats field_norms corpus_size index_append "
    "index_snapshot index_upsert search_after_upsert search_or_top3 search_total_hits search_and search_multifield "
    "search_multifield_and search_parts search_per_field search_per_field_and search_term search_prefix search_wildcard search_fuzzy "
    "search_phrase search_phrase_slop search_boolean search_boolean_phrase search_segmented hits_hydrated bind_model bind_rejects role_projection field_rows "
    "skip_empty positional_union export_text workbook_tables workbook_no_header stream_search stream_upsert upsert_out_of_order"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: globals()[name] for name in NAMES}
