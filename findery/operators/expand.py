"""Expanding patterns and misspelt words to terms of the vocabulary.

Each expansion is an equi join: a pattern is looked up by a piece of text every matching term must
contain, a misspelt word by pieces of which its matches hold one about where it stands. The vocabulary is never crossed with
the patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from findery.functions.scoring import MIN_SIMILARITY, fuzzy_boost, similarity
from findery.runtime import any_of, fits_broadcast

_ANCHOR = 3
PUSHED_STARTS = 64


def pattern_regex(pattern: Column) -> Column:
    """``*`` is any text, ``?`` any one character, everything else stands for itself."""
    quoted = F.regexp_replace(pattern, r"([^\p{L}\p{N}*?])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def _anchored(patterns: DataFrame) -> DataFrame:
    """Add ``kind``, ``width`` and ``anchor``: what a matching term has at its start, end or inside.

    A pattern without any literal is looked up by its length, or matches every term.
    """
    text = F.col("pattern")
    literals = F.regexp_extract_all(text, F.lit("([^*?]+)"), F.lit(1))
    longest = F.array_max(F.transform(literals, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    pieces = {
        "start": F.regexp_extract(text, "^([^*?]*)", 1),
        "end": F.regexp_extract(text, "([^*?]*)$", 1),
        "inside": F.coalesce(longest, F.lit("")),
    }
    width = {k: F.least(F.length(v), F.lit(_ANCHOR)) for k, v in pieces.items()}
    kind = (
        F.when((width["start"] > 0) & (width["start"] >= width["end"]) & (width["start"] >= width["inside"]), "start")
        .when((width["end"] > 0) & (width["end"] >= width["inside"]), "end")
        .when(width["inside"] > 0, "inside")
        .when(~text.contains("*"), "length")
        .otherwise("any")
    )
    anchored = patterns.withColumn("kind", kind)
    chosen = {k: F.col("kind") == k for k in pieces}
    return anchored.withColumns(
        {
            "width": F.when(chosen["start"], width["start"]).when(chosen["end"], width["end"])
            .when(chosen["inside"], width["inside"]).otherwise(F.lit(0)),
            "anchor": F.when(chosen["start"], F.left(pieces["start"], F.lit(_ANCHOR)))
            .when(chosen["end"], F.right(pieces["end"], F.lit(_ANCHOR)))
            .when(chosen["inside"], F.left(pieces["inside"], F.lit(_ANCHOR)))
            .when(F.col("kind") == "length", F.length(text).cast("string"))
            .otherwise(F.lit("")),
        }
    )


def _term_anchors(kind: str, width: int) -> Column:
    term = F.col("term")
    long_enough = F.length(term) >= width
    if kind == "start":
        anchors = F.array(F.left(term, F.lit(width)))
    elif kind == "end":
        anchors = F.array(F.right(term, F.lit(width)))
    elif kind == "inside":
        places = F.sequence(F.lit(1), F.greatest(F.length(term) - width + 1, F.lit(1)))
        anchors = F.array_distinct(F.transform(places, lambda i: F.substr(term, i, F.lit(width))))
    elif kind == "length":
        anchors = F.array(F.length(term).cast("string"))
    else:
        anchors = F.array(F.lit(""))
    anchors = F.filter(anchors, lambda _: long_enough)
    return F.transform(
        anchors, lambda a: F.struct(F.lit(kind).alias("kind"), F.lit(width).alias("width"), a.alias("anchor"))
    )


def wildcard_terms(patterns: DataFrame, terms: DataFrame, *, prefix_only: bool = False) -> DataFrame:
    """``patterns(…, field, pattern)`` joined to the vocabulary rows they match.

    With ``prefix_only`` the pattern text is a plain prefix.
    """
    if prefix_only:
        anchored = patterns.withColumns(
            {
                "kind": F.when(F.length("pattern") > 0, "start").otherwise("any"),
                "width": F.least(F.length("pattern"), F.lit(_ANCHOR)),
                "anchor": F.left(F.col("pattern"), F.lit(_ANCHOR)),
            }
        )
    else:
        anchored = _shaped(_anchored(patterns))
    # At most eleven rows: three widths of each of three kinds, and two kinds without a width.
    used = [(r["kind"], r["width"]) for r in anchored.select("kind", "width").distinct().collect()]
    if not used:
        used = [("length", 0)]
    if all(kind == "start" for kind, _ in used):
        terms = terms.filter(_starting(anchored))
    else:
        terms = _spread(terms)
    keyed = terms.withColumn("k", F.explode(F.concat(*[_term_anchors(k, w) for k, w in sorted(used)])))
    keyed = keyed.select("*", "k.kind", "k.width", "k.anchor").drop("k")
    small = F.broadcast(anchored) if fits_broadcast(anchored) else anchored
    matches = F.col("term").startswith(F.col("pattern")) if prefix_only else _matches(F.col("term"))
    return keyed.join(small, ["field", "kind", "width", "anchor"]).filter(matches).drop("kind", "width", "anchor", *_SHAPE)


def _starting(anchored: DataFrame) -> Column:
    """A condition that terms matching patterns with a literal start meet. It is pushed to the files of the vocabulary, whose
    rows are sorted by field and term; more than ``PUSHED_STARTS`` starts are shortened until there are no more."""
    start = F.when(F.col("pattern").contains("*") | F.col("pattern").contains("?"), F.regexp_extract("pattern", "^([^*?]*)", 1)).otherwise(F.col("pattern"))
    starts = anchored.select("field", start.alias("start"))
    for width in (64, 16, 8, 4, 3, 2, 1):
        found = starts.select("field", F.left("start", F.lit(width)).alias("start")).distinct().limit(PUSHED_STARTS + 1).collect()
        if len(found) <= PUSHED_STARTS:
            return any_of([(F.col("field") == r["field"]) & F.col("term").startswith(r["start"]) for r in found])
    return F.lit(True)


def _shaped(patterns: DataFrame) -> DataFrame:
    """Patterns with what ``_matches`` needs of them, worked out once per pattern and not once per term that it meets."""
    text = F.regexp_replace("pattern", r"\*+", "*")
    return (
        patterns.withColumns({
            "stars": F.length(text) - F.length(F.replace(text, F.lit("*"))),
            "head": F.regexp_extract(text, "^([^*]*)", 1),
            "tail": F.when(text.contains("*"), F.regexp_extract(text, "([^*]*)$", 1)).otherwise(F.lit("")),
            "middle": F.regexp_extract(text, r"(?s)^\*(.*)\*$", 1),
            "least": F.length(F.replace(text, F.lit("*"))),
        })
        .withColumns({
            "open": F.col("head").contains("?") | F.col("tail").contains("?"),
            "letters": F.concat(
                _letters(F.col("head"), lambda i: i), _letters(F.col("tail"), lambda i: i - 1 - F.length("tail"))
            ),
            "inner": (F.col("stars") == 2) & (F.col("head") == "") & (F.col("tail") == "") & ~F.col("middle").contains("?"),
            "regex": F.when(F.col("stars") > 1, pattern_regex(F.col("pattern"))),
        })
    )


_SHAPE = ("stars", "head", "tail", "middle", "least", "open", "letters", "inner", "regex")


def _letters(text: Column, place) -> Column:
    """The characters of a piece but ``?``, each with its place in the term, from the end if negative."""
    at = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    found = F.transform(at, lambda i: F.struct(place(i).alias("at"), F.substr(text, i, F.lit(1)).alias("x")))
    return F.filter(found, lambda c: c["x"] != "?")


def _matches(term: Column) -> Column:
    """Does the term match the pattern beside it (``_shaped``)? What stands before the first ``*`` and after the last one has
    fixed places; only patterns with several ``*`` may need a regular expression for what is between them."""
    long_enough = F.when(F.col("stars") == 0, F.length(term) == F.col("least")).otherwise(F.length(term) >= F.col("least"))
    ends = F.when(
        F.col("open"), F.forall("letters", lambda c: F.substr(term, c["at"], F.lit(1)) == c["x"])
    ).otherwise(term.startswith(F.col("head")) & term.endswith(F.col("tail")))
    between = F.when(F.col("stars") <= 1, F.lit(True)).when(F.col("inner"), term.contains(F.col("middle"))).otherwise(F.regexp_like(term, F.col("regex")))
    return long_enough & ends & between


def _spread(terms: DataFrame) -> DataFrame:
    """Vocabulary rows over all cores: comparing them costs far more than moving them."""
    return terms.repartition("field", "term")


def _limit(keyword: Column, length: Column) -> Column:
    """The most edits that leave a keyword similar to a term of this length."""
    return (F.ceil(F.least(F.length(keyword), length) * MIN_SIMILARITY) - 1).cast("int")


def _pieces(keyword: Column, length: Column) -> Column:
    """What a term of this length must hold one of to be similar: array of (place, piece), places from 0.

    The keyword is cut into limit + 1 pieces. Let piece i be the first one up to whose end there are at most i edits
    (counted from 0; there is one, as all of them are at most limit). Then exactly i edits lie before it, none in it and at most
    limit - i after it, so it is moved by at most i, and by what the lengths differ up to at most limit - i.
    """
    limit = _limit(keyword, length)
    n, grown = F.length(keyword), length - F.length(keyword)

    def moved(i):
        start = F.floor(i * n / (limit + 1)).cast("int")
        piece = F.substr(keyword, start + 1, F.floor((i + 1) * n / (limit + 1)).cast("int") - start)
        moves = F.filter(
            F.sequence(-limit, limit),
            lambda d: (F.abs(d) <= i) & (F.abs(grown - d) <= limit - i) & (start + d >= 0) & (start + d + F.length(piece) <= length),
        )
        return F.transform(moves, lambda d: F.struct((start + d).alias("place"), piece.alias("piece")))

    return F.flatten(F.transform(F.sequence(F.lit(0), limit), moved))


def _holds(term: Column, piece: Column) -> Column:
    return F.substr(term, piece["place"] + 1, F.length(piece["piece"])) == piece["piece"]


def fuzzy_pairs(keywords: DataFrame, terms: DataFrame) -> DataFrame:
    """Keywords joined to terms that hold one of their pieces where it may stand, a row per such piece.

    The key is the field, the length, a place and the two characters there (one at the start, for pieces of one), so the rows
    made are a few per character of the vocabulary and the pairs those that share a piece.
    """
    n = F.length("keyword")
    # similarity > 0.5 means distance < min/2, and the distance is at least the length difference.
    low = F.when(n <= 2, n).otherwise(F.floor(2 * n / 3).cast("int") + 1)
    high = F.when(n <= 2, n).otherwise(F.ceil(3 * n / 2).cast("int") - 1)
    wanted = (
        keywords.filter(n > 0)
        .withColumn("n", F.explode(F.sequence(low, high)))
        .withColumn("pieces", _pieces(F.col("keyword"), F.col("n")))
        .select("*", F.posexplode("pieces").alias("order", "piece"))
        .withColumns({"place": F.col("piece.place"), "gram": F.left(F.col("piece.piece"), F.lit(2))})
    )
    length, term = F.length("term"), F.col("term")
    gram = F.when(F.col("at") < 0, F.left(term, F.lit(1))).otherwise(F.substr(term, F.col("at") + 1, F.lit(2)))
    keyed = (
        _spread(terms.filter(length > 0)).withColumn("n", length)
        .withColumn("at", F.explode(F.sequence(F.lit(-1), F.col("n") - 2)))
        .withColumns({"place": F.greatest("at", F.lit(0)), "gram": gram}).drop("at")
    )
    small = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return keyed.join(small, ["field", "n", "place", "gram"]).filter(_holds(term, F.col("piece"))).drop("place", "gram")


def fuzzy_terms(keywords: DataFrame, terms: DataFrame) -> DataFrame:
    """``keywords(…, field, keyword)`` joined to similar vocabulary rows, with ``distance`` and ``boost``.

    Pairs come from shared pieces (``fuzzy_pairs``); of a pair that shares several the first one is kept. Keywords of at most
    two characters match only themselves.
    """
    limit = _limit(F.col("keyword"), F.col("n"))
    close = fuzzy_pairs(keywords, terms).withColumn("distance", F.call_function("levenshtein", F.col("term"), F.col("keyword"), limit))
    earlier = F.slice("pieces", F.lit(1), F.col("order"))
    found = close.filter("distance >= 0").filter(~F.exists(earlier, lambda p: _holds(F.col("term"), p)))
    boost = F.when(F.length("keyword") <= 2, F.lit(1.0)).otherwise(
        fuzzy_boost(similarity(F.col("distance"), F.col("term"), F.col("keyword")))
    )
    return found.withColumn("boost", boost).drop("n", "order", "piece", "pieces")
