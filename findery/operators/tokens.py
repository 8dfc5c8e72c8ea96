"""Token tables and the statistics over them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findery.functions.analysis import Analyzer, per_field, words
from findery.functions.hashing import xxhash64
from findery.runtime import broadcast_if_small

# Postings are made of so many tokens at once, or of one row, and given to Spark in batches of so many.
RUN_TOKENS = 1 << 20
RUN_ROWS = 1 << 15


def analyze(
    df: DataFrame, analyzers: Mapping[str, Analyzer] | None = None, default: Analyzer = words, keep: Sequence[str] = ()
) -> DataFrame:
    """``(…, field, text)`` to ``(…, field, tokens)``, each field with its own analyzer.

    An analyzer is a function of a text column, or a *table analyzer* with a method ``tokens(df, keys)`` that turns rows
    ``(*keys, text)`` into ``(*keys, tokens)``; there the other columns must identify a row.
    """
    analyzers = analyzers or {}
    kept = [c for c in df.columns if c != "text" or c in keep]
    if not by_table(analyzers, default):
        return df.select(*kept, per_field(F.col("field"), F.col("text"), analyzers, default).alias("tokens"))
    field, parts = F.col("field"), []
    plain = {name: a for name, a in analyzers.items() if not is_table_analyzer(a)}
    tables: dict[int, tuple] = {}
    for name, a in analyzers.items():
        if is_table_analyzer(a):
            tables.setdefault(id(a), (a, []))[1].append(name)
    if not is_table_analyzer(default):
        rest = df.filter(~field.isin([n for _, names in tables.values() for n in names]))
        parts.append(rest.select(*kept, per_field(field, F.col("text"), plain, default).alias("tokens")))
    else:
        if plain:
            parts.append(df.filter(field.isin(list(plain))).select(*kept, per_field(field, F.col("text"), plain, words).alias("tokens")))
        parts.append(default.tokens(df.filter(~field.isin(list(analyzers))), kept))
    parts += [a.tokens(df.filter(field.isin(names)), kept) for a, names in tables.values()]
    return reduce(DataFrame.unionByName, parts)


def is_table_analyzer(analyzer: object) -> bool:
    return hasattr(analyzer, "tokens")


def by_table(analyzers: Mapping[str, Analyzer], default: Analyzer) -> bool:
    """Is any of these a table analyzer? Its tokens lose the placement that the rows had."""
    return any(is_table_analyzer(a) for a in (*analyzers.values(), default))


def explode_tokens(df: DataFrame, keys: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """One row per token that was not dropped: ``(*keys, pos, term)``, positions from 0."""
    return df.select(*keys, F.posexplode(tokens).alias("pos", "term")).filter(F.col("term").isNotNull())


def remove_stop_words(tokens: DataFrame, stop: DataFrame, word: str = "term") -> DataFrame:
    """Drop the listed terms of a token table; for lists too long for an analyzer."""
    listed = stop.select(F.col(word).alias("term")).distinct()
    return tokens.join(broadcast_if_small(listed), "term", "left_anti")


def postings_of(tokens: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Frequency and sorted positions of each term of each document field."""
    return tokens.groupBy(*keys, "term").agg(
        F.count("*").cast("int").alias("tf"),
        F.sort_array(F.collect_list("pos")).alias("positions"),
    )


def postings_in_rows(df: DataFrame, keys: Sequence[str], tokens: str = "tokens") -> DataFrame:
    """``postings_of`` where each row of ``(*keys, tokens)`` is all that its keys have, so no tokens are grouped across rows.

    Postings come in runs of one field, sorted by the hash of field and term that an index sorts them by, then by term and row.
    That is no promise, but a sort of rows that come so is little more than a merge of the runs.
    """
    names = [f.name for f in df.select(*keys).schema.fields]
    schema = T.StructType([
        *[T.StructField(n, f.dataType) for n, f in zip(names, df.select(*keys).schema.fields, strict=True)],
        T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType()),
        T.StructField("positions", T.ArrayType(T.IntegerType(), False)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                # So many rows as fill a run, but one at least.
                before = ends[at - 1] if at else 0
                end = max(int(np.searchsorted(ends, before + RUN_TOKENS - size, side="right")), at + 1)
                held.append(batch.slice(at, end - at))
                size, at = size + int(ends[min(end, batch.num_rows) - 1] - before), end
                if size >= RUN_TOKENS or at < batch.num_rows:
                    yield from _run_of(pa.Table.from_batches(held), names)
                    held, size = [], 0
        if held:
            yield from _run_of(pa.Table.from_batches(held), names)

    return df.select(*keys, F.col(tokens).alias("tokens")).mapInArrow(run, schema)


def _run_of(table: pa.Table, names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    if "field" not in names:
        yield from _postings_of_rows(table, names, None)
        return
    field = table.column("field")
    for name in pc.unique(field).to_pylist():
        own = pc.equal(field, name) if name is not None else pc.is_null(field)
        yield from _postings_of_rows(table.filter(own).combine_chunks(), names, name or "")


def _postings_of_rows(table: pa.Table, names: Sequence[str], field: str | None) -> Iterator[pa.RecordBatch]:
    lists = table.column("tokens").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pos = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
    coded = lists.flatten().dictionary_encode()
    terms, code = coded.dictionary, coded.indices
    if code.null_count:
        there = code.is_valid().to_numpy(zero_copy_only=False)
        row, pos, code = row[there], pos[there], code.drop_null()
    if not len(row):
        return
    place = np.empty(len(terms), dtype=np.int64)
    place[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    seed = None if field is None else np.repeat(xxhash64(pa.array([field])), len(terms))
    block = (xxhash64(terms, seed) >> np.uint64(32)) & np.uint64(0xFFFF)
    by_place = np.lexsort((place, block))
    number = np.empty(len(terms), dtype=np.int64)
    number[by_place] = np.arange(len(terms))
    key = number[code.to_numpy()] * len(sizes) + row
    order = np.argsort(key, kind="stable")
    key, pos = key[order], pos[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    ends = np.append(first[1:], len(key))
    term, owner = by_place[key[first] // len(sizes)], key[first] % len(sizes)
    for at in range(0, len(first), RUN_ROWS):
        part = slice(at, at + RUN_ROWS)
        start, stop = first[part], ends[part]
        rows = pa.array(owner[part])
        bounds = np.append(start, stop[-1]) - start[0]
        yield pa.RecordBatch.from_arrays(
            [
                *[_taken(table.column(n), rows) for n in names], terms.take(pa.array(term[part])), pa.array((stop - start).astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(pos[start[0] : stop[-1]])),
            ],
            names=[*names, "term", "tf", "positions"],
        )


def _taken(column: pa.ChunkedArray, rows: pa.Array) -> pa.Array:
    taken = column.take(rows)
    return taken.combine_chunks() if taken.num_chunks != 1 else taken.chunk(0)


def term_stats(postings: DataFrame, keys: Sequence[str] = ("field", "term")) -> DataFrame:
    """Documents holding a term, and its occurrences in all of them."""
    return postings.groupBy(*keys).agg(F.count("*").alias("df"), F.sum("tf").alias("total_tf"))


def field_lengths(postings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tokens per document field, and the length norm."""
    return postings.groupBy(*keys).agg(F.sum("tf").alias("length")).withColumn(
        "norm", 1 / F.sqrt(F.col("length").cast("double"))
    )
