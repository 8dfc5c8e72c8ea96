"""The classic vector-space scoring formula, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published formula.
MIN_SIMILARITY = 0.5
SCORE_DIGITS = 6


def tf(freq: Column) -> Column:
    return F.sqrt(freq.cast("double"))


def idf(doc_count: Column, doc_freq: Column) -> Column:
    """``1 + ln(N / (df + 1))``; a term that was never seen has df 0."""
    return 1 + F.log(doc_count / (doc_freq + 1))


def length_norm(length: Column) -> Column:
    return 1 / F.sqrt(length.cast("double"))


def query_norm(sum_of_squares: Column) -> Column:
    """``1 / sqrt(sum of squared clause weights)``; a query without weight gets 0."""
    return F.when(sum_of_squares > 0, 1 / F.sqrt(sum_of_squares)).otherwise(F.lit(0.0))


def coord(matched: Column, total: Column) -> Column:
    return matched / total


def similarity(distance: Column, left: Column, right: Column) -> Column:
    """``1 - distance / min(length)`` of two terms."""
    return 1 - distance / F.least(F.length(left), F.length(right))


def fuzzy_boost(similar: Column) -> Column:
    return (similar - MIN_SIMILARITY) / (1 - MIN_SIMILARITY)


def sloppy_freq(spread: Column) -> Column:
    return 1 / (1 + spread.cast("double"))


def rounded(score: Column) -> Column:
    """Scores are rounded before ranking, so that shuffle order cannot change a rank."""
    return F.round(score, SCORE_DIGITS)
