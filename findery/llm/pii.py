"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Candidates are matches of the fixed patterns (also those that fail their digit checks) and of looser ones: mail addresses
spelled out, phone numbers without a plus (in the forms (ddd) ddd-dddd and ddd-ddd-dddd, and national ones from a leading 0,
not within a longer row of digit groups), full IPv6 addresses, IBANs, and phone, card and account numbers after a naming
word. Those that touch a span of a fixed pattern are no candidates, as they could not be taken.
Regex labelers (the strict form, check sums and ranges, digit counts), gazetteer labelers (mail domains, issuer and country prefixes,
reserved numbers) and context labelers (naming words before, code-like or decimal surroundings) vote for, against or not.
Votes are counted as patterns; a two-class model with one accuracy per labeler and outcome is fitted to the counts by
expectation-maximisation. A logistic classifier is then trained on the posteriors over the votes, the kind and the shape
of a span, and scores every candidate. Spans of the fixed patterns always count; other candidates count from
``ACCEPT`` on.

The texts are read once. The number of vote and feature patterns is bounded by their bits, so only their counts reach the
driver; the models are a few dozen numbers.

Defined results: a null or empty text has no spans; offsets count code points, the end is exclusive; of overlapping accepted
extra spans, and of such over fixed ones, the earlier, then longer is kept and fixed ones win; repeated rows are scanned
each on its own; without candidates the classifier accepts nothing; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import read_table, slices, stored

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
ROUNDS = 60

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# The fixed patterns; a run of digits is entered at its start only, as a match from within it would fail alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63})+"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,4}\)\x20?[0-9]{3,4}[-.\x20][0-9]{3,4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9])"),
    "ip": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){3,7}(?:\x20?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
}
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20[A-Za-z0-9-]{1,63})+")
_NATIONAL = re.compile(r"(?<![0-9A-Za-z+.,/-])(?<![0-9]\x20)0[1-9][0-9]{0,4}([\x20./-])[0-9]{2,8}(?:\1[0-9]{2,8}){0,3}(?![\x20./-]?[0-9])")
# Gazetteers.
_DOMAINS = ("example.com", "example.org", "example.net", "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "web.de", "gmx.de", "orange.fr")
_TOP_LEVELS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
_COUNTRIES = ("1", "33", "34", "39", "41", "43", "44", "49", "7", "81", "86")
_RESERVED = ("0.", "127.", "255.", "224.")
# Context words.
_NAMING = {
    "email": re.compile(r"(?i)(?:e-?mail|contact|write to|correo|courriel|kontakt)\W{0,3}$"),
    "ip": re.compile(r"(?i)(?:\bip\b|address|host|server|login from)\W{0,3}$"),
    "card": re.compile(r"(?i)(?:card|visa|credit|karte|carte|tarjeta|iban|account|konto)\W{0,3}(?:no|number|nr)?\W{0,3}$"),
    "phone": re.compile(r"(?i)(?:phone|call|tel|mobile|fax|telefon|teléfono|téléphone)\W{0,3}(?:no|number|nr)?\W{0,3}$"),
}
_NAMED = {
    "card": re.compile(r"(?i)\b(?:card|visa|credit|karte|carte|tarjeta|account|konto)\W{0,3}(?:(?:no|number|nr)\W{0,3})?(?<![0-9])([0-9](?:[\x20-]?[0-9]){7,18})(?![0-9])"),
    "phone": re.compile(r"(?i)\b(?:phone|call|tel|mobile|fax|telefon|teléfono|téléphone)[^\w(]{0,3}(?:(?:no|number|nr)[^\w(]{0,3})?(?<![0-9+])(\(?[0-9]{2,15}\)?(?:[\x20./-]{1,2}[0-9]{2,8}){0,6})(?![0-9])"),
}
_CODE_BEFORE = re.compile(r"(?:[vV]|[vV]ersion\x20?|ISBN\x20?|[$€#=/]\x20?)$")

LABELERS = ("strict", "checksum", "digits", "gazetteer", "reserved", "naming", "code", "glued")
FEATURES = 2 * len(LABELERS) + len(KINDS) + 3


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each @: the longest run before it that the last match leaves, and a domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def candidates(text: str) -> list[tuple[int, int, int, int, int]]:
    """(kind, start, end, fixed, strict): matches of the fixed patterns (``fixed`` if they pass their checks), looser ones."""
    out = [(0, s, e, 1, 1) for s, e in base_emails(text)] if "@" in text else []
    numbers = re.search("[0-9]", text) is not None
    if numbers:
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
            fine = all(len(p) < 4 and int(p) <= 255 for p in parts)
            out.append((1, m.start(), m.end(), int(fine), int(fine)))
        for m in _CARD.finditer(text):
            n = _digits(m.group())
            if 13 <= len(n) <= 19:
                good = luhn(n)
                out.append((2, m.start(), m.end(), int(good), int(good)))
        if "+" in text:
            for m in _PHONE.finditer(text):
                fine = 9 <= len(_digits(m.group())) <= 15
                out.append((3, m.start(), m.end(), int(fine), int(fine)))
        for name in ("phone", "ip", "card"):
            if name != "ip" or ":" in text:
                out += [(KINDS.index(name), m.start(), m.end(), 0, 0) for m in _LOOSE[name].finditer(text)]
        out += [(3, m.start(), m.end(), 0, 0) for m in _NATIONAL.finditer(text) if 9 <= len(_digits(m.group())) <= 12]
        for name, form in _NAMED.items():
            least = 7 if name == "phone" else 8
            out += [(KINDS.index(name), *m.span(1), 0, 0) for m in form.finditer(text) if least <= len(_digits(m.group(1))) <= 19]
    if "at" in text or "AT" in text:
        if "(" in text or "[" in text:
            out += [(0, m.start(), m.end(), 0, 0) for m in _LOOSE["email"].finditer(text)]
        if " dot " in text:
            out += [(0, m.start(), m.end(), 0, 0) for m in _SPELLED.finditer(text)]
    return _apart(out)


def _apart(found: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Without repeats, and without those that overlap a fixed span."""
    ends, starts = [], []
    for _, start, end, fixed, _ in sorted(found, key=lambda c: c[1]):
        if fixed and ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        elif fixed:
            starts.append(start)
            ends.append(end)
    out = []
    for c in dict.fromkeys(found):
        at = bisect_right(ends, c[1])
        if c[3] or at == len(starts) or starts[at] >= c[2]:
            out.append(c)
    return out


def _plain_mail(span: str) -> str:
    """A spelled-out mail address with its signs."""
    return re.sub(r"[\x20(\[]+(at|dot)[\x20)\]]+", lambda m: "@" if m.group(1).lower() == "at" else ".", span, flags=re.IGNORECASE)


def votes(text: str, kind: int, start: int, end: int, strict: int) -> list[int]:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    before, after = text[max(0, start - 24) : start], text[end : end + 1]
    checksum = gazetteer = reserved = 0
    if kind == 0:
        domain = _plain_mail(span).rpartition("@")[2].lower()
        gazetteer = 1 if domain.endswith(_DOMAINS) else 1 if domain.rpartition(".")[2] in _TOP_LEVELS else -1
        count = 1 if len(span) <= 254 else -1
    elif kind == 1:
        checksum = 0 if ":" in span else 1 if strict else -1
        count = 1 if ":" in span or len(digits) >= 6 else -1
        reserved = -1 if span.startswith(_RESERVED) else 0
    elif kind == 2:
        checksum = (1 if luhn(digits) else -1) if span[:1].isdigit() else 0
        gazetteer = 1 if digits.startswith(_ISSUERS) or span[:2].isalpha() else -1
        count = 1 if len(digits) in (15, 16) else -1
        reserved = -1 if len(set(digits)) < 4 else 0
    else:
        count = 1 if 9 <= len(digits) <= 15 else -1
        gazetteer = 1 if digits.startswith(_COUNTRIES) or span[:1] == "(" else 0
        reserved = -1 if len(set(digits)) < 3 else 0
    naming = 1 if _NAMING[name].search(before) else 0
    code = -1 if _CODE_BEFORE.search(before) else 0
    glued = -1 if (before[-1:].isalnum() or after.isalnum() or (kind and before[-1:] in (".", "-"))) else 1
    return [1 if strict else -1, checksum, count, gazetteer, reserved, naming, code, glued]


def pattern_of(cast: list[int]) -> int:
    """The votes as digits in base 3."""
    pattern = 0
    for vote in cast:
        pattern = 3 * pattern + vote + 1
    return pattern


def size_class(length: int) -> int:
    return 0 if length <= 12 else 13 if length <= 24 else 25


def features(pattern: np.ndarray, kind: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For and against per labeler, the kind, the length class and a constant."""
    out = np.zeros((len(pattern), FEATURES))
    rest = pattern.copy()
    for k in reversed(range(len(LABELERS))):
        vote = rest % 3 - 1
        out[:, 2 * k], out[:, 2 * k + 1] = vote == 1, vote == -1
        rest //= 3
    base = 2 * len(LABELERS)
    out[np.arange(len(kind)), base + kind] = 1
    out[:, base + len(KINDS)] = size > 12
    out[:, base + len(KINDS) + 1] = size > 24
    out[:, -1] = 1
    return out


@dataclass
class Model:
    reliability: np.ndarray  # kind, class, labeler, vote
    prior: np.ndarray
    weights: np.ndarray

    def accepts(self, pattern: np.ndarray, kind: np.ndarray, size: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(pattern, kind, size) @ self.weights, -40, 40)))


def fit(pattern: np.ndarray, kind: np.ndarray, size: np.ndarray, count: np.ndarray) -> Model:
    """Reliabilities by expectation-maximisation per kind over counted patterns, then the classifier on the posteriors."""
    cast = np.stack([pattern // 3**k % 3 for k in reversed(range(len(LABELERS)))], axis=1).astype(int)
    reliability = np.full((len(KINDS), 2, len(LABELERS), 3), 1 / 3)
    prior, soft = np.full(len(KINDS), 0.5), np.zeros(len(pattern))
    for k in range(len(KINDS)):
        own = kind == k
        if not own.any():
            continue
        v, n = cast[own], count[own].astype(np.float64)
        balance = (v - 1).sum(axis=1)
        p = 1 / (1 + np.exp(-1.5 * balance))  # the majority starts
        for _ in range(ROUNDS):
            prior[k] = (n @ p + 1) / (n.sum() + 2)
            for c, weight in enumerate((n * (1 - p), n * p)):
                for j in range(len(LABELERS)):
                    counts = np.bincount(v[:, j], weights=weight, minlength=3) + 0.5
                    reliability[k, c, j] = counts / counts.sum()
            logs = np.log(reliability[k][:, np.arange(len(LABELERS)), v]).sum(axis=2)
            odds = np.log(prior[k] / (1 - prior[k])) + logs[1] - logs[0]
            p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        soft[own] = p
    x, weights = features(pattern, kind, size), np.zeros(FEATURES)
    scale = count / max(count.sum(), 1)
    for _ in range(40):
        q = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        gradient = x.T @ (scale * (q - soft)) + 1e-4 * weights
        hessian = (x * (scale * q * (1 - q))[:, None]).T @ x + 1e-4 * np.eye(FEATURES)
        weights -= np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return Model(reliability, prior, weights)


CANDIDATE = "array<struct<kind:int,start:int,stop:int,fixed:int,pattern:int,size:int>>"


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): the candidates of every row with their votes."""
    fields = ["kind", "start", "stop", "fixed", "pattern", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            offsets, rows = [0], []
            for text in batch.column("text").to_pylist():
                for kind, start, end, fixed, strict in candidates(text) if text else ():
                    pattern = pattern_of(votes(text, kind, start, end, strict))
                    rows.append((kind, start, end, fixed, pattern, size_class(end - start)))
                offsets.append(len(rows))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
            items = pa.StructArray.from_arrays([pa.array(c, type=pa.int32()) for c in columns], names=fields)
            found = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), items)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "found"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(run, f"doc_id long, found {CANDIDATE}")


def train(found: DataFrame) -> Model:
    """``found`` is what ``labelled`` gives; at most kinds * lengths * 3 ** labelers counts reach the driver."""
    rows = (
        found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern", "c.size").agg(F.count("*").alias("n"))
        .orderBy("kind", "pattern", "size").collect()
    )
    column = lambda name: np.array([r[name] for r in rows], dtype=np.int64)
    return fit(column("pattern"), column("kind"), column("size"), column("n"))


def chosen(rows: list[dict], model: Model) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, fixed): the fixed spans, and accepted others that overlap none of those taken before."""
    out = [(r["kind"], r["start"], r["stop"], 1) for r in rows if r["fixed"]]
    rest = [r for r in rows if not r["fixed"]]
    if rest:
        score = model.accepts(*(np.array([r[c] for r in rest], dtype=np.int64) for c in ("pattern", "kind", "size")))
        taken = sorted((s, e) for _, s, e, _ in out)
        extra = sorted(((r["start"], -r["stop"], r["kind"]) for r, p in zip(rest, score, strict=True) if p >= ACCEPT))
        last, at = -1, 0
        for start, stop, kind in extra:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if start >= last and (at == len(taken) or taken[at][0] >= -stop):
                out.append((kind, start, -stop, 0))
                last = -stop
    return sorted(out)


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = stored(labelled(read_table(spark, folder, "documents")))
    model = train(found)
    spell = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spelled = [], [], []
            for rows in batch.column("found").to_pylist():
                spans = chosen(rows, model)
                base = [s for s in spans if s[3]]
                counts.append([sum(s[0] == k for s in base) for k in range(len(KINDS))])
                digests.append(hashlib.sha256(spell(base).encode()).hexdigest())
                spelled.append(spell(spans))
            table = np.array(counts, dtype=np.int64).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, k]) for k in range(len(KINDS))), pa.array(digests, type=pa.string()), pa.array(spelled, type=pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return found.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", mark: str = "<{}>") -> DataFrame:
    """The same columns, every chosen span of the text replaced by its kind's mark."""
    model = train(stored(labelled(docs, id_col, text_col)))
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        rows = [
            {"kind": k, "start": s, "stop": e, "fixed": fixed, "size": size_class(e - s),
             "pattern": pattern_of(votes(text, k, s, e, strict))}
            for k, s, e, fixed, strict in candidates(text)
        ] if text else []
        spans = sorted((s, e, k) for k, s, e, _ in chosen(rows, model)) if rows else []
        if not spans:
            return text
        parts, last = [], 0
        for start, end, kind in spans:
            if start >= last:
                parts += [text[last:start], mark.format(KINDS[kind].upper())]
            last = max(last, end)
        return "".join([*parts, text[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = pa.array([clean(t) for t in batch.column(text_col).to_pylist()], type=batch.column(text_col).type)
            yield pa.RecordBatch.from_arrays([texts if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
