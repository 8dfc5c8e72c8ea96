"""Secret scans: fixed patterns, and the Shannon entropy of sliding windows over candidate strings.

Candidates are maximal runs of a character class (hexadecimal digits; base-64 characters) of at least ``WINDOW``
characters that no allow-list pattern names. A window of ``WINDOW`` characters moves over a candidate; the counts of its
characters and the sum of c * log2(c) change by the character that enters and the one that leaves, so a candidate costs
its length times its distinct characters. Windows at or above the entropy of the class count, overlapping ones as one span.
A long candidate is taken in chunks of ``CHUNK`` windows, which overlap by ``WINDOW`` - 1 characters; spans that touch across
chunks are one span.

Everything is DataFrame operations. Matches of a text become rows, and their places come from the lengths of the matches
and of the gaps between them, so a text with very many matches stays linear.

Defined results: a null text is empty and has no spans; offsets count code points, the end is exclusive; repeated rows are
scanned each on its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from findery.llm.common import read_table, stored

WINDOW = 20
CHUNK = 2048
# kind -> (pattern, least length of the counted group, group)
BASE = {
    "assign": (
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 8, 2,
    ),
    "access": (r"AKIA[A-Z0-9]{12,}", 16, 0),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 32, 0),
}
# kind -> (pattern, least entropy in bits)
CLASSES = {
    "entropy_hex": (rf"(?<![0-9A-Fa-f])[0-9A-Fa-f]{{{WINDOW},}}", 3.0),
    "entropy_base64": (rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}", 3.8),
}
KINDS = [*BASE, *CLASSES]
# Words, identifiers and paths without a digit; numbers; UUIDs; alphabets; placeholders.
ALLOWED = [
    "^[A-Za-z+/_=-]+$",
    "^[0-9]+$",
    "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    "0123456789|abcdefghij|ABCDEFGHIJ",
    "(example|EXAMPLE|sample|placeholder|changeme|xxxx|XXXX|0000)",
]


def _found(text: Column, kind: str, pattern: str, group: int) -> Column:
    """Matches of one kind in order: kind, number, code points of the gap before, of the match, and the match's group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    parts = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.transform(
        F.arrays_zip(whole.alias("whole"), parts.alias("part"), F.slice(gaps, 1, F.size(whole)).alias("gap")),
        lambda m, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.cast("int").alias("number"),
            F.length(m["gap"]).cast("long").alias("gap"), F.length(m["whole"]).cast("long").alias("length"),
            m["part"].alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<kind:int,number:int,gap:bigint,length:bigint,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(empty)


def _entropy_spans(value: str, least: str) -> str:
    """SQL for the merged spans [start, end) of a string whose windows reach the entropy; its characters are cut apart once."""
    table = "array(" + ", ".join(f"{c * math.log2(c) if c else 0.0!r}D" for c in range(WINDOW + 2)) + ")"
    new, old = "element_at(chars, i)", f"element_at(chars, greatest(i - {WINDOW}, 1))"
    full = f"i > {WINDOW}"

    def term(key: str, change: int) -> str:
        return f"(element_at({table}, a.counts[{key}] + {1 + change}) - element_at({table}, a.counts[{key}] + 1))"

    total = f"a.total + CASE WHEN {full} AND {new} = {old} THEN 0D WHEN {full} THEN {term(new, 1)} + {term(old, -1)} ELSE {term(new, 1)} END"
    counts = f"transform_values(a.counts, (k, v) -> v + IF(k = {new}, 1, 0) - IF({full} AND k = {old}, 1, 0))"
    # In the second step of a position the state already holds that position's sum.
    hit = f"i >= {WINDOW} AND {math.log2(WINDOW)!r}D - b.total / {WINDOW} >= {least} - 1e-9D"
    joins = f"b.start >= 0 AND i - {WINDOW} <= b.stop"
    closed = "CASE WHEN b.start >= 0 THEN concat(b.spans, array(named_struct('start', b.start, 'stop', b.stop))) ELSE b.spans END"
    step = f"""element_at(transform(array(named_struct('counts', {counts}, 'total', {total}, 'start', a.start, 'stop', a.stop, 'spans', a.spans)), b ->
        named_struct('counts', b.counts, 'total', b.total,
            'start', CASE WHEN ({hit}) AND NOT ({joins}) THEN i - {WINDOW} ELSE b.start END,
            'stop', CASE WHEN {hit} THEN i ELSE b.stop END,
            'spans', CASE WHEN ({hit}) AND NOT ({joins}) THEN {closed} ELSE b.spans END)), 1)"""
    keys = "array_distinct(chars)"
    return f"""element_at(transform(array(split({value}, '')), chars -> aggregate(sequence(1, length({value})),
            named_struct('counts', map_from_arrays({keys}, array_repeat(0, size({keys}))), 'total', 0D, 'start', -1, 'stop', -1,
                'spans', cast(array() AS array<struct<start:int,stop:int>>)),
            (a, i) -> {step}, b -> {closed})), 1)"""


def high_entropy(candidates: DataFrame, value: str, least: str) -> DataFrame:
    """Adds ``islands``: the merged spans (start, stop, text) of a candidate (of ASCII characters) whose windows reach the entropy."""
    chunks = f"sequence(0, greatest(cast(ceil((octet_length({value}) - {WINDOW - 1}) / {CHUNK}) AS int) - 1, 0))"
    piece = f"cast(substring(bytes, chunk * {CHUNK} + 1, {CHUNK + WINDOW - 1}) AS string)"
    moved = f"s -> named_struct('start', s.start + chunk * {CHUNK}, 'stop', s.stop + chunk * {CHUNK})"
    parts = f"""flatten(element_at(transform(array(cast({value} AS binary)), bytes -> transform({chunks}, chunk ->
        element_at(transform(array({piece}), piece -> transform({_entropy_spans("piece", least)}, {moved})), 1))), 1))"""
    first = "filter(_parts, (x, i) -> i = 0 OR x.start > _parts[greatest(i - 1, 0)].stop)"
    last = "filter(_parts, (x, i) -> i = size(_parts) - 1 OR _parts[least(i + 1, size(_parts) - 1)].start > x.stop)"
    text = "cast(substring(bytes, a.start + 1, b.stop - a.start) AS string)"
    islands = f"""element_at(transform(array(cast({value} AS binary)), bytes ->
        zip_with({first}, {last}, (a, b) -> named_struct('start', a.start, 'stop', b.stop, 'text', {text}))), 1)"""
    return candidates.withColumn("_parts", F.expr(parts)).withColumn("islands", F.expr(islands)).drop("_parts")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (row, doc_id) has every document; spans (row, kind, start, stop, value) has all that was found.

    ``kind`` is the number in ``KINDS``; ``value`` is the text of the span (of an assignment, the value assigned).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = {k: (p, g) for k, (p, _, g) in BASE.items()} | {k: (p, 0) for k, (p, _) in CLASSES.items()}
    found = F.concat(*[_found(text, kind, pattern, group) for kind, (pattern, group) in patterns.items()])
    rows = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), found.alias("found"))
    )
    order = Window.partitionBy("row", "kind").orderBy("number")
    placed = (
        rows.filter(F.size("found") > 0)
        .select("row", F.explode("found").alias("m"))
        .select("row", "m.*")
        .withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("stop") - F.col("length"))
    )
    least = F.element_at(F.array(*[F.lit(n) for _, n, _ in BASE.values()]), F.col("kind") + 1)
    base = placed.filter(F.col("kind") < len(BASE)).filter(F.length("value") >= least)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.col("value").rlike(pattern)
    bits = F.element_at(F.array(*[F.lit(b) for _, b in CLASSES.values()]), F.col("kind") - len(BASE) + 1)
    candidates = placed.filter((F.col("kind") >= len(BASE)) & ~allowed).withColumn("bits", bits)
    windows = (
        high_entropy(candidates, "value", "bits")
        # An inner explode would have its input tested, and so computed, a second time.
        .select("row", "kind", F.col("start").alias("at"), F.explode_outer("islands").alias("span"))
        .filter(F.col("span").isNotNull())
        .select(
            "row", "kind", (F.col("at") + F.col("span.start")).alias("start"), (F.col("at") + F.col("span.stop")).alias("stop"),
            F.col("span.text").alias("value"),
        )
    )
    return rows.select("row", "doc_id"), base.select("row", "kind", "start", "stop", "value").unionByName(windows)


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    rows, spans = scan(read_table(spark, folder, "documents"))
    per = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("all"))
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>"))
    counts = [
        F.size(F.filter(F.col("every.kind"), lambda kind: kind == F.lit(KINDS.index(name)))).cast("long").alias(f"n_{name}")
        for name in BASE
    ]
    return (
        rows.join(per, "row", "left")
        .withColumn("every", every)
        .select(
            "doc_id", *counts,
            F.sha2(_joined(F.filter("every", lambda s: s["kind"] < len(BASE))).cast("binary"), 256).alias("base_sha256"),
            _joined(F.col("every")).alias("spans"),
        )
    )


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _sql_matches(kind: int, pattern: str, group: int = 0) -> str:
    part = f"regexp_extract_all(text, '{pattern}', {group})"
    return f"""SELECT doc_id, {kind} AS kind, generate_subscripts(whole, 1) AS number, unnest(whole) AS whole, unnest(part) AS value,
        unnest(gaps[1:len(whole)]) AS gap FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS whole, {part} AS part,
        string_split_regex(text, '{pattern}') AS gaps FROM texts)"""


def _sql() -> str:
    names = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
    # The same patterns as in BASE and CLASSES; a run's start needs no look-behind there, as the leftmost match begins at it.
    assign = rf"""({names})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    plain = [assign, BASE["access"][0], "[0-9a-f]{32,}", f"[0-9A-Fa-f]{{{WINDOW},}}", f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"]
    union = " UNION ALL ".join(_sql_matches(k, p, 2 if k == 0 else 0) for k, p in enumerate(plain))
    allowed = " OR ".join(f"regexp_matches(value, '{p}')" for p in ALLOWED)
    kinds = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    spell = f"string_agg({kinds}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS ({union}),
placed AS (
    SELECT doc_id, kind, value, stop - length(whole) AS start, stop FROM (
        SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY number
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop FROM found)),
windows AS (
    SELECT doc_id, kind, start + w AS start, start + w + {WINDOW} AS stop, start AS candidate FROM (
        SELECT *, unnest(range(length(value) - {WINDOW - 1})) AS w FROM placed WHERE kind > 2 AND NOT ({allowed}))
    WHERE list_entropy(string_split(substr(value, CAST(w + 1 AS INTEGER), {WINDOW}), '')) >= [3.0, 3.8][kind - 2] - 1e-9),
islands AS (
    SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, kind, candidate ORDER BY start) AS island
    FROM (SELECT *, lag(stop) OVER (PARTITION BY doc_id, kind, candidate ORDER BY start) AS before FROM windows)),
spans AS (
    SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed
    WHERE kind < 3 AND length(value) >= [8, 16, 32][kind + 1]
    UNION ALL SELECT doc_id, kind, CAST(min(start) AS BIGINT), CAST(max(stop) AS BIGINT) FROM islands GROUP BY doc_id, kind, candidate, island)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    sha256(coalesce({spell} FILTER (kind < 3), '')) AS base_sha256, coalesce({spell} FILTER (kind IS NOT NULL), '') AS spans
FROM documents LEFT JOIN spans USING (doc_id) GROUP BY doc_id
"""


OP3_SQL = _sql()
