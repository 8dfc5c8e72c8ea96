"""Phrase matching with slop over term positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from findery.functions.scoring import sloppy_freq


_BITS = 63


def exact_phrase_freq(matches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``phrase_freq`` where no phrase has a slop: the positions of all words, each counted back by its slot, are intersected.

    One grouping by ``keys``, no row per position. The shortest list comes first, so that the rest is looked up in it.
    """
    keys = [*keys, "slots", "slop", "repeats"]
    places = F.transform("positions", lambda p: p - F.col("slot"))
    whole = matches.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.size("positions").alias("n"), places.alias("at")))).alias("words"))
    lists = F.col("words.at")
    common = F.aggregate(F.slice(lists, F.lit(2), F.size(lists)), F.get(lists, F.lit(0)), F.array_intersect)
    return whole.filter(F.size("words") == F.col("slots")).select(*keys, F.size(common).cast("double").alias("freq")).filter("freq > 0")


def phrase_freq(matches: DataFrame, keys: Sequence[str], max_slop: int, repeats: bool = True) -> DataFrame:
    """How often each phrase occurs in each document, as ``freq``.

    ``matches(*keys, slots, slop, repeats, slot, positions)`` has one row per phrase word found in a document;
    ``slot`` is the place of the word after the first one and ``slots`` their number; ``repeats`` says that
    a word stands in the phrase more than once, which must then be met at different positions. A match takes
    one position per slot; its spread is the largest minus the smallest position, each counted back
    by its slot. Every position of the first word counts once, with the smallest spread it can reach,
    as ``1 / (1 + spread)``, if that is within the slop.

    Instead of joining positions with each other, every position is put into the windows of slop + 1
    places that cover it, so the work is linear in the positions. The smallest spread is reached in
    the window that starts at the smallest position of the match. The positions of the first word in
    a window are kept as bits. All steps group by ``keys`` and more, so they run in place.

    For a phrase with a repeated word the positions in a window are kept too. Given the first word's
    position, the other slots take the smallest one that is still free, in the order of the slots; as the
    slots' ranges begin and end in that order, this finds a choice if there is any. With ``repeats`` false no phrase has one.
    """
    if max_slop == 0:
        return exact_phrase_freq(matches, keys)
    keys = [*keys, "slots", "slop", "repeats"]
    complete = matches.withColumn("found", F.count("*").over(Window.partitionBy(*keys))).filter("found = slots")
    placed = complete.select(*keys, "slot", F.explode("positions").alias("at")).withColumn("at", F.col("at") - F.col("slot"))
    windows = placed.withColumn("window", F.explode(F.sequence(F.col("at") - F.col("slop"), F.col("at"))))

    offset = F.col("at") - F.col("window")
    words = range(max_slop // _BITS + 1)

    def bits(word: int):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (offset - word * _BITS).cast("int"))
        here = (F.col("slot") == 0) & offset.between(word * _BITS, word * _BITS + _BITS - 1)
        return F.coalesce(F.bit_or(F.when(here, bit)), F.lit(0).cast("long")).alias(f"bits{word}")

    place = F.when(F.col("repeats"), F.col("at") + F.col("slot"))
    places = [F.sort_array(F.collect_set(place)).alias("places")] if repeats else []
    per_slot = windows.groupBy(*keys, "window", "slot").agg(F.min("at").alias("least"), *places, *[bits(w) for w in words])
    others = []
    if repeats:
        other = F.when(F.col("repeats") & (F.col("slot") > 0), F.struct("slot", "places"))
        others = [F.sort_array(F.collect_list(other)).alias("others")]
    per_window = (
        per_slot.groupBy(*keys, "window")
        .agg(
            F.count("*").alias("filled"),
            F.max(F.when(F.col("slot") > 0, F.col("least"))).alias("farthest"),
            *others,
            *[F.max(f"bits{w}").alias(f"bits{w}") for w in words],
        )
        .filter("filled = slots")
    )

    def set_places(word: int):
        def set_place(i):
            return F.when(F.getbit(F.col(f"bits{word}"), i) == 1, F.col("window") + word * _BITS + i)

        return F.transform(F.sequence(F.lit(0), F.lit(min(max_slop - word * _BITS, _BITS - 1))), set_place)

    starts = F.array_compact(F.concat(*[set_places(w) for w in words]))
    spreads = per_window.select(*keys, "window", "farthest", *(["others"] if repeats else []), F.explode(starts).alias("start"))
    if repeats:
        spreads = _apart(spreads)
    spreads = (
        spreads.withColumn("spread", F.greatest("start", "farthest") - F.col("window"))
        .groupBy(*keys, "start")
        .agg(F.min("spread").alias("spread"))
    )
    return spreads.groupBy(*keys).agg(F.sum(sloppy_freq(F.col("spread"))).alias("freq"))


def _apart(spreads: DataFrame) -> DataFrame:
    """Windows whose words can be met at different positions; ``farthest`` is then that of the positions taken."""
    # The used positions; a slot without a free one adds a null, so a choice is whole if it has ``slots`` positions.
    taken = F.aggregate(
        "others", F.array("start"),
        lambda used, o: F.concat(used, F.array(F.try_element_at(F.filter(o["places"], lambda p: ~F.array_contains(used, p)), F.lit(1)))),
        lambda used: F.array_compact(used),
    )
    last = F.array_max(F.transform("taken", lambda p, i: p - i))
    return (
        spreads.withColumn("taken", F.when(F.col("repeats"), taken))
        .filter(~F.col("repeats") | (F.size("taken") == F.col("slots")))
        .withColumn("farthest", F.when(F.col("repeats"), last).otherwise(F.col("farthest")))
    )
