"""Analyzers: functions from a text column to an array of terms.

An analyzer is a plain ``Column -> Column`` function returning ``array<string>``. The place of an
element is its position; a dropped token leaves a null behind, so positions never move. What needs
a join, as segmentation by a dictionary does, is a table analyzer (``operators.tokens.analyze``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Analyzer = Callable[[Column], Column]

# What counts as a word and as a Han character.
WORD_CHAR = r"[\p{L}\p{N}]"
HAN = r"\p{IsHan}"
NON_HAN_WORD_CHAR = r"[\p{L}\p{N}&&[^\p{IsHan}]]"

# The reference library keeps this many tokens of a field when told to limit them.
LIMITED_FIELD_LENGTH = 10_000


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD_CHAR}+)"), F.lit(1))


def whole(text: Column) -> Column:
    """The text itself as the only token, unchanged."""
    return F.array(text)


def han_bigrams(text: Column) -> Column:
    """Words, with each run of Han characters cut into overlapping pairs (a lone one stays).

    The pattern is a lookahead, so matches may overlap and one pass over the text is enough.
    """
    token = (
        f"{HAN}{{2}}"
        f"|(?<!{HAN}){HAN}(?!{HAN})"
        f"|(?<!{NON_HAN_WORD_CHAR}){NON_HAN_WORD_CHAR}+"
    )
    return F.regexp_extract_all(F.lower(text), F.lit(f"(?=({token}))"), F.lit(1))


def keeping_codes(codes: Sequence[str]) -> Analyzer:
    """Like :func:`words`, but a listed multi-part code such as ``AB-1200`` stays one token.

    For lists of more than a few hundred codes use ``operators.segment.segment``.
    """
    longest_first = sorted({c.lower() for c in codes}, key=lambda c: (-len(c), c))
    listed = "|".join(re.escape(c) for c in longest_first)

    def analyze(text: Column) -> Column:
        pattern = f"((?:{listed})(?!{WORD_CHAR})|{WORD_CHAR}+)" if listed else f"({WORD_CHAR}+)"
        return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))

    return analyze


def without_stop_words(analyzer: Analyzer, stop_words: Sequence[str]) -> Analyzer:
    """Drop listed tokens; the others keep their positions."""
    listed = sorted(set(stop_words))

    def analyze(text: Column) -> Column:
        return F.transform(analyzer(text), lambda t: F.when(~t.isin(listed), t))

    return analyze


def limited(analyzer: Analyzer, max_tokens: int = LIMITED_FIELD_LENGTH) -> Analyzer:
    """Keep the first ``max_tokens`` tokens of a field, counted after dropped ones.

    This is the reference's optional field limit; nothing applies it unless asked to.
    """

    def analyze(text: Column) -> Column:
        tokens = analyzer(text)
        places = F.filter(
            F.transform(tokens, lambda t, i: F.when(t.isNotNull(), i + 1)),
            lambda p: p.isNotNull(),
        )
        last = F.coalesce(F.try_element_at(places, F.lit(max_tokens)), F.size(tokens))
        return F.slice(tokens, 1, last)

    return analyze


def per_field(field: Column, text: Column, analyzers: Mapping[str, Analyzer], default: Analyzer) -> Column:
    """Analyze ``text`` with the analyzer registered for ``field``, else with the default one."""
    chosen = None
    for name, analyzer in analyzers.items():
        condition = field == name
        chosen = F.when(condition, analyzer(text)) if chosen is None else chosen.when(condition, analyzer(text))
    return default(text) if chosen is None else chosen.otherwise(default(text))


def normalized(text: Column, analyzer: Analyzer = words) -> Column:
    """A keyword query as its tokens, each followed by one space; no token gives ``''``."""
    return F.array_join(F.transform(F.filter(analyzer(text), lambda t: t.isNotNull()), lambda t: F.concat(t, F.lit(" "))), "")
