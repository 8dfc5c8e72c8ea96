"""Periodic runs of words: suffix automaton with link-cut access.

A run is a maximal stretch of words with smallest period q that is at least ``max(LEAST, EXPONENT * q)`` words long. For each
appended word the path from its state to the root of the suffix links is accessed in a link-cut tree: every node of the path
is coloured with the place of that word, so a node's colour is where its strings last ended. The path comes in segments of one
colour. A segment whose longest string has n words and whose colour is d words back is a square if d <= n: the n + d words that
end here have period d. The nearest earlier end gives the smallest period, a longest string cannot be extended to the left, and
the square is a whole run where the next word differs from the one d words before it.

Every word of every text goes through an automaton of its text. A task holds a few texts at a time and the automaton of one of
them, at most two states a word; there is no shuffle, and a lost task is simply run again.

Defined results: a null or empty text has no words, no runs and the empty collapsed text; ids may be null or repeat, each row is
answered on its own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import compress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import read_table, slices

LEAST = 6
EXPONENT = 4
SLICE_BYTES = 4 << 20

Rewrite = Callable[[int | None, int], Sequence[int] | None]
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


# --- the automaton and its link-cut tree -----------------------------------------------------------------------------


def automaton(words: Sequence) -> tuple[list[int], list[int], list[int]]:
    """(suffix links, longest lengths, state of each prefix); state 0 is the root."""
    steps: list[dict] = [{}]
    links, lengths, prefixes = [-1], [0], []
    last = 0
    for word in words:
        state = len(links)
        steps.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = state
            at = links[at]
        if at >= 0:
            to = steps[at][word]
            if lengths[at] + 1 == lengths[to]:
                links[state] = to
            else:
                copy = len(links)
                steps.append(steps[to].copy())
                links.append(links[to])
                lengths.append(lengths[at] + 1)
                while at >= 0 and steps[at].get(word) == to:
                    steps[at][word] = copy
                    at = links[at]
                links[to] = links[state] = copy
        prefixes.append(state)
        last = state
    return links, lengths, prefixes


class Paths:
    """A link-cut tree over the suffix links, the root (0) left out. The nodes of a preferred path have one colour, which stands
    at the root of the path's splay tree; -1 is none yet."""

    def __init__(self, links: list[int]):
        n = len(links)
        self.up = [max(link, 0) for link in links]
        self.left, self.right, self.colour = [0] * n, [0] * n, [-1] * n

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            child = left[y] = right[x]
            right[x] = y
        else:
            child = right[y] = left[x]
            left[x] = y
        if child:
            up[child] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            top = y
            if z and (left[z] == y or right[z] == y):
                top = z
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            self.colour[x] = self.colour[top]
            self._rotate(x)

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Colours the path from the node to the root; gives the (colour, lowest node) of the segments it had before."""
        segments, below = [], 0
        while node:
            self._splay(node)
            old, cut = self.colour[node], self.right[node]
            if cut:
                self.colour[cut] = old
            if old >= 0:
                segments.append((old, node))
            self.right[node] = below
            below, node = node, self.up[node]
        if below:
            self.colour[below] = colour
        return segments


def runs(words: Sequence, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    links, lengths, prefixes = automaton(words)
    paths, n, found = Paths(links), len(words), []
    for at, state in enumerate(prefixes):
        for end, node in paths.access(state, at):
            period, length = at - end, lengths[node] + at - end
            if length >= exponent * period and length >= least and (at + 1 == n or words[at + 1] != words[at + 1 - period]):
                found.append((at - length + 1, length, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def without_repeats(words: Sequence, found: Sequence[tuple[int, int, int]]) -> Sequence:
    """The words that no run holds after its first period."""
    if not found:
        return words
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in found:
        kept[start + period : start + length] = bytes(length - period)
    return list(compress(words, kept))


# --- the operator ----------------------------------------------------------------------------------------------------


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """Runs of each text and the text without their repetitions, as in ``SCHEMA``.

    Words are what stands between ASCII white space; of a run the first period stays in ``collapsed``, whose words are joined by
    one space. ``rewrite(id, words)`` may give the places of the words that a text is taken to have instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            keys = batch.column("doc_id")
            sizes, found, collapsed = [], [], []
            for key, text in zip(keys.to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = (text or "").encode().split()  # bytes are split at ASCII white space only
                places = None if rewrite is None else rewrite(key, len(words))
                if places is not None:
                    words = [words[i] for i in places]
                own = runs(words)
                sizes.append(len(words))
                found.append(own)
                collapsed.append(b" ".join(without_repeats(words, own)))
            yield pa.RecordBatch.from_arrays(
                [
                    keys, pa.array(sizes, type=pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in found], type=pa.list_(RUN)),
                    pa.array(collapsed, type=pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def planted(key: int | None, n: int) -> list[int] | None:
    """The places of the words of a document with a planted repetition; none for most ids and for null."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [i if i < a else a + (i - a) % p for i in range(n)]


def listed(found: Column) -> Column:
    """Runs as text: ``start,length,period`` and a line feed each."""
    return F.array_join(F.transform(found, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find(read_table(spark, folder, "documents"), rewrite=planted)
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("first", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("first.start").alias("start"),
        (-F.col("first.n")).alias("length"), F.col("first.period").alias("period"),
        F.floor(-1000 * F.col("first.n") / F.col("first.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed(F.col("runs")), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
