"""Longest-match segmentation against a dictionary table.

One operator serves unspaced Han text and multi-part codes: the text is cut into units (a Han
character, or a word, with the separators that follow it), and neighbouring units are joined into one
token when the dictionary lists them. Matching is greedy from the left, longest entry first.

The dictionary stays a table, of whatever size. Its entries are keyed by their first characters, and only the
lengths known there are tried: places of a text meet these heads first, and what they begin meets the entries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findery.functions.analysis import HAN, NON_HAN_WORD_CHAR, WORD_CHAR
from findery.runtime import broadcast_if_small, cut

_UNIT = f"((?:{HAN}|{NON_HAN_WORD_CHAR}+)(?:(?!{WORD_CHAR})[\\s\\S])*)"
_TRAILING = f"(?:(?!{WORD_CHAR})[\\s\\S])+$"
_BLOCK = 256
# The characters of an entry that its place in a text is looked up by, before the whole entry is.
_HEAD = 4


def units(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_UNIT), F.lit(1))


def _trimmed(unit: Column) -> Column:
    return F.regexp_replace(unit, _TRAILING, "")


def _greedy(matches: Column) -> Column:
    """From matches sorted by place, keep those that start at or after the end of the last kept one.

    The fold runs block by block, so that the growing result is copied once per block, not per match.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(matches) / _BLOCK).cast("int") - 1),
        lambda b: F.slice(matches, b * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def step(state: Column, match: Column) -> Column:
        return F.when(
            match["at"] >= state["free"],
            F.struct((match["at"] + match["n"]).alias("free"), F.concat(state["kept"], F.array(match)).alias("kept")),
        ).otherwise(state)

    def block_step(done: Column, block: Column) -> Column:
        free = F.element_at(done, -1)["free"]
        start = F.struct(free.alias("free"), F.slice(block, 1, 0).alias("kept"))
        return F.concat(done, F.array(F.aggregate(block, start, step)))

    nothing = F.array(F.struct(F.lit(0).alias("free"), F.slice(matches, 1, 0).alias("kept")))
    return F.flatten(F.transform(F.aggregate(blocks, nothing, block_step), lambda s: s["kept"]))


def _entries(dictionary: DataFrame, word: str) -> DataFrame:
    """The dictionary words of more than one unit, written like the text they are looked up in."""
    leading = f"^(?:(?!{WORD_CHAR})[\\s\\S])+"
    return (
        dictionary.select(F.regexp_replace(_trimmed(F.lower(F.col(word))), leading, "").alias("entry"))
        .withColumn("n", F.size(units(F.col("entry"))))
        .filter("n > 1")
        .distinct()
    )


def segment(df: DataFrame, keys: Sequence[str], text: str, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Tokens of each text: ``(*keys, tokens array<string>)``; ``keys`` identify a row."""
    return Segmenter(dictionary, word).tokens(df, keys, text)


class Segmenter:
    """A table analyzer (see ``operators.tokens.analyze``): segments by a dictionary, in indexes and searches alike.

    The dictionary is prepared once, in the shared folder. Its two tables are broadcast where they were measured to be
    small, and joined by a shuffle beyond that; the steps are the same.
    """

    def __init__(self, dictionary: DataFrame, word: str = "word"):
        entry = F.col("entry")
        entries = _entries(dictionary, word).withColumns(
            {"size": F.length(entry), "open": F.regexp_like(entry, F.lit(f"{NON_HAN_WORD_CHAR}$"))}
        )
        self._entries = cut(entries.withColumn("head", F.left(entry, F.lit(_HEAD))))
        self._heads = cut(self._entries.groupBy("head").agg(F.sort_array(F.collect_set("size")).alias("sizes")))
        widths = F.sort_array(F.collect_set(F.length("head")))
        self._longest, self._widths = self._entries.agg(F.coalesce(F.max("n"), F.lit(1)), widths).first()

    def tokens(self, df: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
        """``(*keys, tokens)``; one shuffle by ``keys`` serves all steps that look at whole texts."""
        keys, longest = list(keys), self._longest
        rows = df.select(*keys, units(F.col(text)).alias("_units")).repartition(*keys)
        if longest == 1:
            return rows.select(*keys, F.transform("_units", _trimmed).alias("tokens"))

        # An entry that ends in the middle of a word is none.
        after = F.substr(F.col("ahead"), F.col("size") + 1, F.lit(1))
        whole = ~F.col("open") | ~F.regexp_like(after, F.lit(NON_HAN_WORD_CHAR))
        matches = (
            self._begun(rows, keys).join(broadcast_if_small(self._entries.drop("head")), "entry")
            .filter(whole)
            .groupBy(*keys, "at")
            .agg(F.max("n").alias("n"))
            .groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("_matches"))
        )
        kept = matches.select(*keys, _greedy(F.col("_matches")).alias("_kept"))

        def piece(match: Column, i: Column) -> Column:
            before = F.try_element_at("_kept", F.when(i > 0, i).otherwise(F.size("_kept") + 1))
            free = F.coalesce(before["at"] + before["n"], F.lit(0))
            singles = F.slice("_units", free + 1, match["at"] - free)
            return F.concat(singles, F.array(F.array_join(F.slice("_units", match["at"] + 1, match["n"]), "")))

        last = F.element_at("_kept", -1)
        rest = F.slice("_units", last["at"] + last["n"] + 1, F.size("_units"))
        joined = F.when(F.col("_kept").isNull(), F.col("_units")).otherwise(
            F.concat(F.flatten(F.transform("_kept", piece)), rest)
        )
        return rows.join(kept, keys, "left").select(*keys, F.transform(joined, _trimmed).alias("tokens"))

    def _begun(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """What the places of the texts ``(*keys, _units)`` may begin: ``(*keys, at, ahead, entry)``, a row per length known for
        the characters there."""

        def start(unit: Column, at: Column) -> Column:
            return F.struct(at.alias("at"), F.array_join(F.slice("_units", at + 1, self._longest), "").alias("ahead"))

        return (
            rows.select(*keys, F.explode(F.transform("_units", start)).alias("_s"))
            .select(*keys, "_s.*", F.explode(F.array(*[F.lit(w) for w in self._widths])).alias("width"))
            .select(*keys, "at", "ahead", F.left("ahead", F.col("width")).alias("head"))
            .join(broadcast_if_small(self._heads), "head")
            .select(*keys, "at", "ahead", F.explode("sizes").alias("size"))
            .select(*keys, "at", "ahead", F.left("ahead", F.col("size")).alias("entry"))
        )


segmenting = Segmenter
