"""Phrase collocations: Misra-Gries summaries find what may be frequent, a second pass counts it exactly.

Texts are cut at punctuation and line ends into pieces and these at blanks into words, A-Z folded. Everything is per language.

First pass: the phrases of up to ``longest`` words become 64-bit hashes, whose high half deals them to hash partitions of about
``PART_MASS`` occurrences each. The summaries of small slices (their counts) meet in the partition's task and are merged one
after another: counters are added, and where there are more than the capacity, the first count beyond it is taken off all
of them. The capacity is the partition's mass divided by the least frequency, so less than that is taken off in all, and every
phrase that is frequent enough survives. What survives is marked in a bit table of a fixed size (``BITS``, 16 MB), the only thing
that is sent to all tasks; phrases that share a hash or a bit with a survivor pass too.

Second pass: the phrases that the table lets through are counted by their words and summed, which is exact and drops the
others. If more survive than the table can tell apart, more phrases are counted in vain and the result stays the same.

Each partial phrase of a candidate is looked up among the counts: those holding more than 2 ** -16 of all occurrences, at
most 2 ** 16 for each phrase length, by a broadcast, the others by a join whose keys are therefore not hot. Counts are
added before each shuffle. Nothing of a language meets in one task but its best rows.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count each; other columns are
ignored; an empty table gives an empty result. Products are decimals of 38 digits, exact for frequencies below 10 ** 16.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findery.llm.common import _LOWER, mixed, read_table, slices, span_hashes, stored, text_bytes, word_bounds
from findery.runtime import broadcast_if_small

LONGEST = 3
LEAST = 10
WITHIN = 50  # percent of a phrase's occurrences that a longer one must hold to replace it
BEST = 2000
UNKNOWN = "und"
PART_MASS = 1 << 23
MOST_PARTS = 1 << 20
BITS = 1 << 27
SLICE_BYTES = 4 << 20
HOT = 1 << 16

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATOR = _BREAK.copy()
_SEPARATOR[[0x20, 0x09]] = True
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


class _Phrases:
    """The phrases of a slice of texts: for each length the numbers of their first words and their hashes."""

    def __init__(self, texts: pa.Array, langs: pa.Array, longest: int):
        data, offsets = text_bytes(texts)
        data = _LOWER[data]
        self.starts, self.ends, self.owner = word_bounds(data, offsets, _SEPARATOR)
        self.raw = data.tobytes()
        piece = np.cumsum(_BREAK[data])[self.starts]
        together = (self.owner[1:] == self.owner[:-1]) & (piece[1:] == piece[:-1])
        # Words with exactly one blank between them.
        self.tight = (self.ends[:-1] + 1 == self.starts[1:]) & (data[self.ends[:-1]] == 0x20)
        names, places = text_bytes(langs)
        lang = span_hashes(np.append(names, np.uint8(0)), places[:-1], places[1:])  # an empty name may stand at the end
        words = span_hashes(data, self.starts, self.ends)
        self.first, self.keys = [np.arange(len(words))], [mixed(words * _STEP + lang[self.owner])]
        for size in range(2, longest + 1):
            at = self.first[-1]
            inside = at + size - 1 < len(words)
            inside[inside] = together[at[inside] + size - 2]
            self.first.append(at[inside])
            self.keys.append(mixed(self.keys[-1][inside] * _STEP + words[at[inside] + size - 1]))

    def text(self, first: int, size: int) -> str:
        span = self.raw[self.starts[first] : self.ends[first + size - 1]]
        return (span if self.tight[first : first + size - 1].all() else b" ".join(span.split())).decode()


def _parts(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> _HALF) * np.uint64(parts)) >> _HALF


def _counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts (1 each by default)."""
    if counts is not None:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    else:
        keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


class Summary:
    """A Misra-Gries summary of weighted keys; ``taken`` is what was taken off every counter."""

    def __init__(self, capacity: int):
        self.capacity, self.taken = max(capacity, 1), 0
        self.keys, self.counts = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._size += len(keys)
        if self._size > max(self.capacity, 1 << 18):
            self.merge()

    def merge(self) -> None:
        if not self._waiting:
            return
        parts = [(self.keys, self.counts), *self._waiting]
        self._waiting, self._size = [], 0
        self.keys, self.counts = _counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        if len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            self.taken += off
            self.counts = self.counts - off
            left = self.counts > 0
            self.keys, self.counts = self.keys[left], self.counts[left]

    def frequent(self, least: int) -> np.ndarray:
        """All keys that may have a count of ``least``."""
        self.merge()
        return self.keys[self.counts + self.taken >= least]


def survivors(docs: DataFrame, longest: int, least: int) -> np.ndarray:
    """The bit table of hashes that may be frequent, a row per hash partition; ``docs(lang, text)``."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = 1 << max(size * longest // 6 // PART_MASS, 1).bit_length()  # about six bytes a word
    parts = min(max(parts, 16), MOST_PARTS)
    width = BITS // parts
    shift = np.uint32(32 - (width.bit_length() - 1))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            keys, counts = _counted(np.concatenate(_Phrases(batch.column("text"), batch.column("lang"), longest).keys))
            part = _parts(keys, parts)
            low = (keys & _LOW).astype(np.uint32)
            bounds = np.searchsorted(part, np.arange(parts + 1))
            rows: list[tuple[int, int, int, bytes, bytes]] = []
            for p in np.flatnonzero(np.diff(bounds)).tolist():
                a, b = bounds[p], bounds[p + 1]
                rows.append((p, 0, int(counts[a:b].sum()), b"", b""))
                rows.append((p, 1, 0, low[a:b].tobytes(), counts[a:b].astype("<u4").tobytes()))
            if rows:
                types = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                    names=["part", "kind", "mass", "keys", "counts"],
                )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, None

        def done() -> pa.RecordBatch:
            table = np.zeros(width, dtype=bool)
            table[summary.frequent(least) >> shift] = True
            return pa.RecordBatch.from_arrays(
                [pa.array([part], type=pa.int64()), pa.array([np.packbits(table).tobytes()], type=pa.binary())], names=["part", "bits"]
            )

        for batch in batches:
            for own, kind, weight, keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != part:
                    if summary is not None:
                        yield done()
                    part, mass, summary = own, 0, None
                if kind == 0:  # a partition's masses come before its summaries
                    mass += weight
                    continue
                summary = summary or Summary(mass // least)
                summary.add(np.frombuffer(keys, dtype=np.uint32), np.frombuffer(counts, dtype="<u4").astype(np.int64))
        if summary is not None:
            yield done()

    dealt = (
        docs.mapInArrow(summaries, "part long, kind int, mass long, keys binary, counts binary")
        .repartition(parts, "part").sortWithinPartitions("part", "kind")
    )
    table = np.zeros((parts, width // 8), dtype=np.uint8)
    for row in dealt.mapInArrow(merged, "part long, bits binary").collect():  # BITS / 8 bytes in all
        table[row.part] = np.frombuffer(row.bits, dtype=np.uint8)
    return table


def counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """``(lang, size, phrase, f)`` of all phrases of up to ``longest`` words that occur at least ``least`` times, and a row of size 0
    with the number of all words for each language; ``docs(lang, text)``, no null language."""
    shared = docs.sparkSession.sparkContext.broadcast(survivors(docs, longest, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        parts, width = table.shape[0], table.shape[1] * 8
        shift = np.uint64(32 - (width.bit_length() - 1))
        flat = table.reshape(-1)
        for batch in slices(batches, "text", SLICE_BYTES):
            langs = batch.column("lang").to_pylist()
            found = _Phrases(batch.column("text"), batch.column("lang"), longest)
            totals: Counter = Counter()
            for text, n in enumerate(np.bincount(found.owner, minlength=len(langs)).tolist()):
                totals[langs[text]] += n
            rows = [(lang, 0, "", n) for lang, n in totals.items() if n]
            for size, (first, keys) in enumerate(zip(found.first, found.keys, strict=True), start=1):
                place = _parts(keys, parts) * np.uint64(width) + ((keys & _LOW) >> shift)
                passed = np.flatnonzero((flat[place >> np.uint64(3)] >> (np.uint8(7) - (place & np.uint64(7)).astype(np.uint8))) & np.uint8(1))
                order = passed[np.argsort(keys[passed], kind="stable")]
                sorted_ = keys[order]
                new = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(order) else np.zeros(0, dtype=np.int64)
                n = np.diff(np.append(new, len(order))).tolist()
                at = first[order[new]].tolist()
                owners = found.owner[at].tolist() if at else []
                rows += [(langs[o], size, found.text(a, size), k) for o, a, k in zip(owners, at, n, strict=True)]
            if rows:
                types = (pa.string(), pa.int32(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["lang", "size", "phrase", "f"]
                )

    summed = docs.mapInArrow(run, "lang string, size int, phrase string, f long").groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    out = stored(summed.filter((F.col("size") == 0) | (F.col("f") >= least)))
    shared.destroy()
    return out


def _looked_up(rows: DataFrame, table: DataFrame, hot: Column, key: str, out: str) -> DataFrame:
    """Adds the frequency of the phrase ``key``, which is always there."""
    named = table.select("lang", F.col("phrase").alias(key), F.col("f").alias(out), hot.alias("_hot"))
    often = F.broadcast(named.filter("_hot").drop("_hot"))
    near = rows.join(often, ["lang", key])
    far = rows.join(often, ["lang", key], "left_anti").join(named.filter("NOT _hot").drop("_hot"), ["lang", key])
    return near.unionByName(far)


def scored(table: DataFrame, longest: int = LONGEST, within: int = WITHIN) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the candidates that no longer one replaces; ``table`` as :func:`counts` gives it."""
    total = table.filter("size = 0").agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    hot = F.col("f") * HOT >= total
    known = table.filter("size > 0")
    words = F.split("phrase", " ")
    candidates = known.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("w"))

    def part(begin: Column, size: Column) -> Column:
        return F.array_join(F.slice("w", begin, size), " ")

    # A phrase of this size or more that lies in a longer one, with the longest one's frequency.
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: part(i, n)),
        )
    )
    longer = (
        candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    )
    kept = (
        candidates.join(longer, ["lang", "phrase"], "left")
        .filter(F.col("_longer").isNull() | (100 * F.col("_longer") < within * F.col("a")))
    )
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("_left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("_right")
    )
    both = _looked_up(_looked_up(cuts, known, hot, "_left", "l"), known, hot, "_right", "r")
    both = both.withColumn("score", F.expr(
        "(1000000 * (CAST(a AS DECIMAL(19, 0)) * CAST(a AS DECIMAL(19, 0)))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))"
    ))
    lowest = both.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    sizes = table.filter("size = 0").select("lang", F.col("f").alias("n"))
    return lowest.join(broadcast_if_small(sizes), "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def best(rows: DataFrame, limit: int = BEST) -> DataFrame:
    """The first rows of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit).withColumn("rank", F.col("rank").cast("long"))


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = LONGEST, least: int = LEAST, within: int = WITHIN) -> DataFrame:
    """All collocations of a table, as :func:`scored` describes them."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    return scored(counts(texts, longest, least), longest, within)


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    found = best(mine(read_table(spark, folder, "documents")))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP13_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
  SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM t
), g AS (
  SELECT lang, 1 AS size, unnest(w) AS phrase FROM p
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM p
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM p
), f AS (
  SELECT lang, size, phrase, CAST(count(*) AS HUGEINT) AS a FROM g GROUP BY ALL
), totals AS (
  SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang
), c AS (
  SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 10
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE size = 3
    UNION ALL
    SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE size = 3
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN longer ON c.lang = longer.lang AND c.phrase = longer.phrase
  WHERE longer.a IS NULL OR 100 * longer.a < 50 * c.a
), cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS first, array_to_string(w[2:], ' ') AS rest FROM kept
  UNION ALL
  SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE size = 3
), s AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r, (1000000 * cuts.a * cuts.a) // (x.a * y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest
), lowest AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT lowest.*, totals.n, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest JOIN totals ON totals.lang = lowest.lang
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
