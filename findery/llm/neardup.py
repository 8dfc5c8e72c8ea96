"""Near duplicates by HyperMinHash sketches, banded registers, and a check on the full sets.

Each distinct shingle of a document falls into one of ``bands * rows`` buckets; a bucket keeps the smallest hash as its
number of leading zeros and ``MANTISSA`` bits after them. Equal shingle sets form one class, and one member stands for it.
For bands an empty register takes the value of a filled one, the first in a fixed random order of its own, so that the bands
of a short text hold several of its shingles and not one that very many texts share. Documents whose registers agree in a
whole band are candidates. A pair's similarity is estimated from the agreeing
registers, less the expected chance agreements; a pair that is not ``SIGMAS`` standard errors below the threshold is
confirmed on the full sets.

Links are searched without listing the pairs of a group. First every member of a bucket is compared with the smallest
one, then those outside the bucket's largest component with one of its members, another in each bucket. Only buckets whose
members are then still in several components are searched on, for pairs across components. Those of more than ``BLOCK``
members are first divided by every further band, and members that agree in a second one meet. Last, what such a bucket then
still holds in several components meets as a whole, for pairs that share no other band. All that is larger than ``BLOCK`` is
compared in blocks of two chunks of about ``BLOCK`` members (chunks are dealt by hash); the largest component of a bucket meets
the others only, and in buckets of more than ``SMALL`` a pair must also pass an upper bound of its similarity, from 16 bits of
every shingle, which are made for members of such buckets only. So components equal those of all links that a band can find: with 42 bands of 6, a pair at 0.85 shares none with
a probability of 3e-9, one at 0.8 with 3e-6.

Nothing reaches the driver but counts. Hot classes, buckets and components are summed before shuffles, and what remains
are joins that Spark can split. Registers are shuffled once, with their classes, and again for members of pairs only; of a bucket
only the key is, but for members that share one.

Defined results: a null or empty text has no shingles and no links; a text with fewer words than a shingle is one shingle;
rows with equal ids count as one document for links; a row without an id is linked with nothing and has no component;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import hashed_words, mixed, read_table, slices, stored
from findery.runtime import broadcast_if_small

BANDS = 42
ROWS = 6
MANTISSA = 10
VALUE_BITS = 48
SIGMAS = 6.0
BLOCK = 2048
ALONE = -2  # in place of a second band: pairs that share no other
SMALL = 32
CHANCE = 0.169919487159739  # of agreement by chance per register, times 2 ** -MANTISSA, for sets of equal size
_ODD = [np.uint64(2 * pow(0x5DEECE66D, k, 1 << 62) + 1) for k in range(1, 17)]


def shingle_hashes(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of ``size`` words."""
    words, bounds = hashed_words(texts)
    grams = np.zeros(len(words), dtype=np.uint64)
    for k in range(size):
        grams[: len(words) - k] += words[k:] * _ODD[k]
    grams = mixed(grams)
    out = []
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        if end - start >= size:
            out.append(np.unique(grams[start : end - size + 1]))
        elif end > start:
            whole = reduce(lambda total, kw: total + kw[1] * _ODD[kw[0]], enumerate(words[start:end, None]), np.zeros(1, np.uint64))
            out.append(mixed(whole + np.uint64(end - start)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def registers(sets: list[np.ndarray], count: int) -> np.ndarray:
    """One row of compressed registers per set; 0 is an empty bucket."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    smallest = np.full(len(sets) * count, np.uint64(1 << VALUE_BITS))
    bucket = (hashes >> np.uint64(VALUE_BITS)) % np.uint64(count)
    np.minimum.at(smallest, owner * count + bucket.astype(np.int64), hashes & np.uint64((1 << VALUE_BITS) - 1))
    fraction, exponent = np.frexp(smallest.astype(np.float64))
    code = ((VALUE_BITS - exponent.astype(np.int64)) << MANTISSA) + np.maximum((2 * fraction - 1) * (1 << MANTISSA), 0).astype(np.int64) + 1
    code[smallest == np.uint64(1 << VALUE_BITS)] = 0
    return code.astype(np.uint16).reshape(len(sets), count)


@cache
def _turns(count: int) -> np.ndarray:
    """Row i: the order in which an empty register i looks at the others, least first."""
    return (mixed(np.arange(count * count, dtype=np.uint64) + _ODD[1]) >> np.uint64(32)).astype(np.uint32).reshape(count, count)


def densified(codes: np.ndarray) -> np.ndarray:
    """Rows of registers whose empty ones hold the value of the row's filled register that comes first in their order."""
    out = codes.copy()
    turns = _turns(codes.shape[1])
    some = codes != 0
    for row in np.flatnonzero(some.any(axis=1) & ~some.all(axis=1)):
        filled, empty = np.flatnonzero(some[row]), np.flatnonzero(~some[row])
        out[row, empty] = codes[row, filled[turns[empty[:, None], filled].argmin(axis=1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(similarity, registers used) of rows of registers, corrected for chance agreements."""
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    agree = ((a == b) & (a != 0)).sum(axis=-1) / np.maximum(used, 1)
    ratio = size_a / np.maximum(size_b, 1)
    chance = CHANCE * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((agree - chance) / (1 - chance), 0, 1), used


def _plausible(a, b, size_a, size_b, percent: int) -> np.ndarray:
    similarity, used = estimate(a, b, size_a, size_b)
    t = percent / 100
    return similarity >= t - SIGMAS * np.sqrt(t * (1 - t) / np.maximum(used, 1))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), -1)


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, count: int) -> DataFrame:
    """(id, n, one, two, registers): set size, two fingerprints of the set, compressed registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_hashes(batch.column("text"), size)
            codes = registers(sets, count)
            one = [int(s.sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            two = [int(np.bitwise_xor.reduce(mixed(s + _ODD[0])).astype(np.int64)) if len(s) else 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), pa.array([len(s) for s in sets], type=pa.int64()), pa.array(one, type=pa.int64()),
                    pa.array(two, type=pa.int64()), pa.array([row.tobytes() for row in codes], type=pa.binary()),
                ],
                names=["id", "n", "one", "two", "registers"],
            )

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, "id long, n long, one long, two long, registers binary")


def shingled(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, size: int, kind: type, out: str) -> DataFrame:
    """(id, ``out``): the shingle hashes of the documents in ``ids``, as numbers of a kind (its lowest bits), one row per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [s.astype(kind).tobytes() for s in shingle_hashes(batch.column("text"), size)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, type=pa.binary())], names=["id", out])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return plain.join(broadcast_if_small(ids), "id", "left_semi").mapInArrow(run, f"id long, {out} binary").dropDuplicates(["id"])


def banded(reps: DataFrame, rows: int) -> DataFrame:
    """(key, band, id, n): a row per band of each document with shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                codes = densified(_matrix(part.column("registers")))
                bands = codes.reshape(len(codes), -1, rows).astype(np.uint64)
                key = np.zeros(bands.shape[:2], dtype=np.uint64) + np.arange(bands.shape[1], dtype=np.uint64)
                for k in range(rows):
                    key = mixed(key * _ODD[k] + bands[:, :, k])
                row, band = np.nonzero(bands.any(axis=2))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[row, band].astype(np.int64)), pa.array(band.astype(np.int32)),
                        part.column("id").take(pa.array(row)), part.column("n").take(pa.array(row)),
                    ],
                    names=["key", "band", "id", "n"],
                )

    return reps.select("id", "n", "registers").mapInArrow(run, "key long, band int, id long, n long")


def _sizes_fit(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their registers do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            good = _plausible(_matrix(batch.column("r_a")), _matrix(batch.column("r_b")), *size, percent)
            keep = batch.select(["a", "b"]).filter(pa.array(good))
            if keep.num_rows:
                yield keep

    pairs = stored(pairs)
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    needed = reps.join(broadcast_if_small(ids), "id", "left_semi")
    side = lambda name: needed.select(F.col("id").alias(name), F.col("n").alias(f"n_{name}"), F.col("registers").alias(f"r_{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; sets are made for the documents of the pairs only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, two in zip(batch.column("s_a"), batch.column("s_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (one, two))
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = batch.select(["a", "b"]).filter(pa.array(good, type=pa.bool_()))
            if keep.num_rows:
                yield keep

    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    needed = stored(shingled(docs, ids, id_col, text_col, size, np.uint64, "shingles"))
    side = lambda name: needed.select(F.col("id").alias(name), F.col("shingles").alias(f"s_{name}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in edges (a, b): alternating large and small stars until nothing changes.

    The smallest neighbour of an id is an aggregate joined back to its edges, so an id with very many edges is no single
    group; the rounds grow with the logarithm of the longest path.
    """

    def size_of(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = size_of(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        large = stored(large.filter("a <> b"))
        lower = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(lower, "a")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(lower.select("a", F.col("least").alias("b")))
        current = stored(small.filter("a <> b").distinct())
        now = size_of(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def _first_labels(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest linked id, or that one's smallest. Not yet whole components, but never more than those."""
    least = edges.select(F.col("b").alias("id"), "a").groupBy("id").agg(F.min("a").alias("component"))
    further = least.select(F.col("id").alias("component"), F.col("component").alias("further"))
    jumped = least.join(further, "component", "left").select("id", F.coalesce("further", "component").alias("component"))
    return jumped.union(edges.select(F.col("a").alias("id")).distinct().join(least, "id", "left_anti").select("id", F.col("id").alias("component")))


def _placed(members: DataFrame) -> DataFrame:
    """members (key, band, id, n, component, cnt, top, most) with the blocks (kind, x, y) each is compared in.

    ``top`` is the bucket's largest component and ``most`` its size. Blocks: 'w' a whole small bucket, 't' a chunk x of the
    largest component and a chunk y of the others, 'o' the chunks x and y of the others.
    """
    others = F.col("cnt") - F.col("most")
    chunks = lambda n: F.ceil(n / BLOCK).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    whole = F.array(F.struct(F.lit("w").alias("kind"), F.lit(0).alias("x"), F.lit(0).alias("y")))
    block = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    own = mine(F.greatest(chunks(F.when(F.col("component") == F.col("top"), F.col("most")).otherwise(others)), F.lit(1)))
    with_top = F.transform(F.sequence(F.lit(0), chunks(F.col("most")) - 1), lambda c: block("t", c, F.col("own")))
    of_top = F.transform(F.sequence(F.lit(0), F.greatest(chunks(others), F.lit(1)) - 1), lambda c: block("t", F.col("own"), c))
    among = F.transform(
        F.sequence(F.lit(0), F.greatest(chunks(others), F.lit(1)) - 1),
        lambda c: block("o", F.least(c, F.col("own")), F.greatest(c, F.col("own"))),
    )
    places = (
        F.when(F.col("cnt") <= BLOCK, whole).when(F.col("component") == F.col("top"), of_top).otherwise(F.concat(with_top, among))
    )
    return (
        members.withColumn("own", own).withColumn("place", F.explode(places))
        .select(*members.columns, "place.*", "own", (F.col("component") == F.col("top")).alias("of_top")).drop("top", "most")
    )


def _in_parts(labelled: DataFrame) -> DataFrame:
    """The members (key, id, component, …) of buckets in several components, with the largest one (top) and its size (most)."""
    parts = (
        labelled.groupBy("key", "component").agg(F.count("*").alias("held"))
        .groupBy("key").agg(F.max(F.struct("held", "component")).alias("top"), F.count("*").alias("parts"), F.sum("held").alias("cnt"))
        .filter("parts > 1").select("key", F.col("top.component").alias("top"), F.col("top.held").alias("most"), "cnt")
    )
    return labelled.drop("cnt").join(parts, "key")


def _divided_again(members: DataFrame, all_members: DataFrame) -> DataFrame:
    """Members (key, band, second, id, n, component, cnt, top, most): buckets of more than ``BLOCK`` are divided by each later
    band (second), whose members agree in both; ``second`` is -1 in the others."""
    whole = members.filter(F.col("cnt") <= BLOCK).withColumn("second", F.lit(-1))
    later = all_members.select("id", F.col("key").alias("other"), F.col("band").alias("second"))
    twice = (
        members.filter(F.col("cnt") > BLOCK).drop("top", "most").join(later, "id").filter("second > band")
        .withColumn("key", F.xxhash64("key", "other")).drop("other")
    )
    return whole.unionByName(_in_parts(stored(twice)))


def _across(members: DataFrame, reps: DataFrame, rows: int, percent: int, codes_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Plausible pairs (a, b) of different components within a bucket; a pair is reported by the first band it shares, in
    divided buckets by the first two. ``codes_of`` gives (id, codes), 16 bits per shingle, of the documents in a table (id)."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Whole groups; rows come sorted, and the last group of a batch waits for the next one."""
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            rest = table
            code = [table.column(c).to_numpy(zero_copy_only=False) for c in ("key", "kind", "x", "y")]
            change = np.flatnonzero(reduce(np.logical_or, [c[1:] != c[:-1] for c in code])) + 1
            starts = [0, *change.tolist()]
            for start, end in zip(starts[:-1], starts[1:], strict=True):
                yield table.slice(start, end - start)
            rest = table.slice(starts[-1]).combine_chunks()
        if rest is not None and rest.num_rows:
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            ids, n, component, own_block = (group.column(c).to_numpy() for c in ("id", "n", "component", "own"))
            band, second, kind = (group.column(c)[0].as_py() for c in ("band", "second", "kind"))
            x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
            of_top = group.column("of_top").to_numpy(zero_copy_only=False)
            codes = _matrix(group.column("registers").combine_chunks())
            bands = densified(codes).reshape(len(codes), -1, rows)
            short = [s and np.frombuffer(s, dtype=np.uint16) for s in group.column("codes").to_pylist()]
            held = np.zeros(1 << 16, dtype=bool)
            found = []
            for i in range(len(ids) - 1):
                later = np.arange(i + 1, len(ids))
                later = later[(component[later] != component[i]) & (100 * np.minimum(n[later], n[i]) >= percent * np.maximum(n[later], n[i]))]
                if kind == "t":
                    later = later[of_top[later] != of_top[i]]
                elif kind == "o" and x != y:
                    later = later[own_block[later] != own_block[i]]
                if not len(later):
                    continue
                alike = (bands[later] == bands[i]).all(axis=2)
                reported = alike[:, band] & ~alike[:, :band].any(axis=1)
                if second >= 0:
                    reported &= alike[:, second] & ~alike[:, band + 1 : second].any(axis=1)
                elif second == ALONE:
                    reported &= alike.sum(axis=1) == 1
                later = later[reported]
                later = later[_plausible(codes[later], codes[i], n[later], n[i], percent)]
                if short[i] is not None and len(later):
                    held[short[i]] = True
                    # Shingles of j whose 16 bits occur in i: at least those that both have.
                    both = np.array([held[short[j]].sum() for j in later])
                    held[short[i]] = False
                    later = later[100 * both >= percent * (n[i] + n[later] - both)]
                found += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in later]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])

    members = stored(members)
    ids = stored(members.groupBy("id").agg(F.max("cnt").alias("most")))
    needed = reps.join(broadcast_if_small(ids.select("id")), "id", "left_semi").select("id", "registers")
    codes = codes_of(stored(ids.filter(F.col("most") > SMALL).select("id")))
    with_codes = (
        _placed(members).join(needed.join(codes, "id", "left"), "id")
        .withColumn("codes", F.when(F.col("cnt") > SMALL, F.col("codes"))).drop("cnt")
    )
    return (
        with_codes.repartition(F.col("key"), F.col("kind"), F.col("x"), F.col("y"))
        .sortWithinPartitions("key", "kind", "x", "y", "id")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 85,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """(id, n, component) of every row; ids are linked if 100 * intersection >= ``percent`` * union of their sets."""
    sketch = stored(sketches(docs, id_col, text_col, size, bands * rows))
    # Equal sets have equal registers.
    classes = stored(
        sketch.filter("n > 0 AND id IS NOT NULL").groupBy("one", "two", "n")
        .agg(F.min("id").alias("rep"), F.first("registers").alias("registers"))
    )
    reps = classes.select(F.col("rep").alias("id"), "n", "registers")
    several = stored(reps.groupBy("id").count().filter("count > 1").select("id"))
    if not several.isEmpty():  # one set of an id that has several
        others = broadcast_if_small(several)
        chosen = reps.join(others, "id", "left_semi").dropDuplicates(["id"])
        reps = stored(reps.join(others, "id", "left_anti").unionByName(chosen))
    members = stored(banded(reps, rows))
    shared = members.groupBy("key").agg(F.count("*").alias("cnt")).filter("cnt > 1")
    together = stored(members.join(shared, "key"))
    first = (
        together.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"))
        .select("key", F.col("first.id").alias("a"), F.col("first.n").alias("n_a"))
    )
    stars = (
        together.join(first, "key").filter((F.col("id") != F.col("a")) & _sizes_fit("n", "n_a", percent))
        .select("a", F.col("id").alias("b")).distinct()
    )
    stars = stored(_estimated(stars, reps, percent))
    edges = stored(_confirmed(stars, docs, id_col, text_col, size, percent))
    labels = stored(_first_labels(edges))

    # Buckets that still hold several components; those of two members have been compared already.
    open_ = together.filter("cnt > 2")
    codes_of = lambda ids: shingled(docs, ids, id_col, text_col, size, np.uint16, "codes")

    def divided(labels: DataFrame) -> DataFrame:
        """The members of such buckets, with their component, and the largest one of the bucket."""
        labelled = stored(open_.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id")))
        return stored(_in_parts(labelled))

    left = divided(labels)
    delegates = (
        left.filter("component = top").groupBy("key").agg(F.min(F.struct(F.xxhash64("id", "key"), "id", "n")).alias("one"))
        .select("key", F.col("one.id").alias("other"), F.col("one.n").alias("n_other"))
    )
    tries = (
        left.filter("component <> top AND cnt > 3").join(delegates, "key").filter(_sizes_fit("n", "n_other", percent))
        .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    )
    tries = stored(_estimated(tries, reps, percent))
    edges = stored(edges.union(_confirmed(tries, docs, id_col, text_col, size, percent)))
    labels = stored(components(edges))

    def linked(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        more = stored(_confirmed(pairs, docs, id_col, text_col, size, percent))
        if more.isEmpty():
            return labels
        return stored(components(labels.select(F.col("component").alias("a"), F.col("id").alias("b")).union(more)))

    labels = linked(labels, stored(_across(_divided_again(divided(labels), members), reps, rows, percent, codes_of)))
    # Pairs that share the crowded bucket alone, of what is then still in several components.
    crowded = divided(labels).filter(F.col("cnt") > BLOCK).withColumn("second", F.lit(ALONE))
    if not crowded.isEmpty():
        labels = linked(labels, stored(_across(crowded, reps, rows, percent, codes_of)))

    named = classes.drop("registers").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "one", "two", "n", F.coalesce("component", "rep").alias("component")
    )
    return sketch.join(named, ["one", "two", "n"], "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


OP7_SQL = rf"""
WITH RECURSIVE worded AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM worded),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * inter >= 85 * (x.n + y.n - inter)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other),
named AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN named ON named.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
