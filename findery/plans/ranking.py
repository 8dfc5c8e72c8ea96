"""Scoring documents against all queries of a search at once, and keeping the best of each query.

The postings of the query terms are sorted by document within their shard, so a row is one posting and never a posting and a
query: how many queries share a term changes neither what is sorted nor what is spilled. A task takes whole documents in
blocks, adds up their scores as a matrix of documents and queries, counts the hits and keeps the k best of each query.

What a task knows of the queries is an ``Entries`` or ``Phrases`` table, made from a query side that was measured to be below
the broadcast bounds; where it is not, the entries of a term come with its postings as lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa

from findery.functions.scoring import SCORE_DIGITS

# A block has at most so many cells of documents and queries, and so many pairs of a posting and a query, or one document.
CELLS = 1 << 20
PAIRS = 1 << 20
# So many postings are gathered before their whole documents are taken.
GATHERED = 1 << 17
_NOWHERE = np.int64(1) << 40


@dataclass(frozen=True)
class Entries:
    """The query words of each term: those of ``terms[i]`` are the entries ``bounds[i]:bounds[i + 1]``.

    Without ``units`` a document's score is the sum of its entries, or ``constant`` per query. With them it is weighed by the
    part of the query's words found, of which ``required`` must be. With ``groups``, one per word and field, a word counts once,
    and is complete where one field holds all ``parts`` of it.
    """

    ids: pa.Array
    terms: np.ndarray
    bounds: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    mult: np.ndarray
    constant: np.ndarray | None = None
    units: np.ndarray | None = None
    required: np.ndarray | None = None
    group: np.ndarray | None = None
    parts: np.ndarray | None = None
    first_group: np.ndarray | None = None
    unit_mult: np.ndarray | None = None
    unit_query: np.ndarray | None = None

    @property
    def width(self) -> int:
        return max(len(self.ids), len(self.parts) if self.parts is not None else 0, 1)


@dataclass(frozen=True)
class Phrases:
    """Phrases by the rarest of their words: those of ``terms[i]`` are ``phrase[bounds[i]:bounds[i + 1]]``, at the slot ``pivot``.

    ``word`` and ``slot`` have a row per phrase, its first word first; the rest of a row is not used.
    """

    ids: pa.Array
    terms: np.ndarray
    bounds: np.ndarray
    phrase: np.ndarray
    pivot: np.ndarray
    word: np.ndarray
    slot: np.ndarray
    slots: np.ndarray
    repeats: np.ndarray
    weight: np.ndarray
    slop: int


@dataclass(frozen=True)
class Clauses:
    """The clauses of boolean queries, those of a query side by side from ``first`` on.

    Terms that the same clauses ask for in the same way share a list: the entries of ``lists[i]`` are ``bounds[i]:bounds[i + 1]``.
    An entry adds its ``factor`` times the term's squared idf and the posting's norm to its clause, or makes it score
    ``constant``. A clause with ``units`` is one of keywords, whose words have groups as those of ``Entries``.
    """

    ids: pa.Array
    first: np.ndarray
    n_clauses: np.ndarray
    n_must: np.ndarray
    role: np.ndarray
    units: np.ndarray
    required: np.ndarray
    constant: np.ndarray
    lists: np.ndarray
    bounds: np.ndarray
    clause: np.ndarray
    factor: np.ndarray
    group: np.ndarray
    parts: np.ndarray
    group_word: np.ndarray
    word_clause: np.ndarray
    word_mult: np.ndarray
    phrases: tuple[Phrases, ...]  # one for each slop; their ids are clause and field as ``clause * fields + field``
    fields: int


class Kept:
    """The best documents of each query among those added, and the number of all. They are added in the order of their ids."""

    def __init__(self, queries: int, k: int):
        self.k, self.seen, self.ids = k, 0, None
        self.count = np.zeros(queries, dtype=np.int64)
        self.least = np.full(queries, -np.inf)
        self.query, self.place, self.score = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)

    def add(self, query: np.ndarray, place: np.ndarray, score: np.ndarray, ids: pa.Array) -> None:
        """Hits of a block of documents with these ids; ``place`` counts from its first one."""
        self.count += np.bincount(query, minlength=len(self.count))
        score = np.floor(score * 10**SCORE_DIGITS + 0.5) / 10**SCORE_DIGITS
        better = np.flatnonzero(score > self.least[query])
        if len(better):
            taken = ids.take(pa.array(place[better]))
            taken = taken if self.ids is None else pa.concat_arrays([self.ids, taken])
            query = np.concatenate([self.query, query[better]])
            score = np.concatenate([self.score, score[better]])
            place = np.concatenate([self.place, self.seen + place[better]])
            order = np.lexsort((place, -score, query))
            rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
            order, rank = order[rank < self.k], rank[rank < self.k]
            self.query, self.score, self.place = query[order], score[order], place[order]
            self.ids = taken.take(pa.array(order))
            full = rank == self.k - 1
            self.least[self.query[full]] = self.score[full]
        self.seen += len(ids)

    def rows(self, names: pa.Array, shard: int, batch: int) -> Iterator[pa.RecordBatch]:
        """(query_id, shard, batch, doc_id, score, shard_hits); the number of hits stands in the first row of a query."""
        if self.ids is None:
            return
        n = len(self.query)
        lead = np.diff(self.query, prepend=-1) != 0
        yield pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(self.query)), pa.array(np.full(n, shard), type=pa.int32()), pa.array(np.full(n, batch), type=pa.int64()),
                self.ids, pa.array(self.score), pa.array(np.where(lead, self.count[self.query], 0)),
            ],
            names=["query_id", "shard", "batch", "doc_id", "score", "shard_hits"],
        )


def _whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole documents of one shard and batch; rows come sorted, with the place in their document, which starts at 1."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) >= GATHERED:
            table = pa.Table.from_batches(held)
            last = np.flatnonzero(table.column("place").to_numpy() == 1)[-1]
            held = table.slice(last).to_batches()
            if last:
                yield from _parts(table.slice(0, last))
    if held:
        yield from _parts(pa.Table.from_batches(held))


def _parts(table: pa.Table) -> Iterator[pa.Table]:
    shard, batch = (table.column(c).to_numpy() for c in ("shard", "batch"))
    change = np.flatnonzero((shard[1:] != shard[:-1]) | (batch[1:] != batch[:-1])) + 1
    cuts = [0, *change.tolist(), table.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield table.slice(a, b - a).combine_chunks()


def _blocks(starts: np.ndarray, pairs: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``CELLS`` cells and ``PAIRS`` pairs, or of one document."""
    before = np.concatenate([[0], np.cumsum(pairs)])
    per_doc = np.append(before[starts], before[-1])
    at, step = 0, max(CELLS // width, 1)
    while at < len(starts):
        end = int(np.searchsorted(per_doc, per_doc[at] + PAIRS, side="right")) - 1
        end = max(min(end, at + step, len(starts)), at + 1)
        yield at, end
        at = end


def _expanded(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, entry): every entry ``first[row] + 0, 1, …`` of every row."""
    row = np.repeat(np.arange(len(count)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _scored(q: Entries, doc: np.ndarray, n: int, entry: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, document, score) of a block of n documents: each pair of a posting and an entry adds the entry's weight
    times the posting's ``norm`` to its document and query."""
    queries = len(q.ids)
    cell = doc * queries + q.query[entry]
    if q.constant is not None:
        hit = np.flatnonzero(np.bincount(cell, minlength=n * queries))
        return hit % queries, hit // queries, q.constant[hit % queries]
    total = np.bincount(cell, q.weight[entry] * norm, minlength=n * queries)
    if q.units is None:
        hit = np.flatnonzero(np.bincount(cell, minlength=n * queries))
        return hit % queries, hit // queries, total[hit]
    if q.parts is None:
        matched = complete = np.bincount(cell, q.mult[entry], minlength=n * queries)
    else:
        groups = len(q.parts)
        found = np.bincount(doc * groups + q.group[entry], minlength=n * groups).reshape(n, groups)
        any_field = np.logical_or.reduceat(found > 0, q.first_group, axis=1)
        whole = np.logical_or.reduceat((found > 0) & (found >= q.parts), q.first_group, axis=1)
        matched, complete = (np.zeros(n * queries) for _ in range(2))
        for have, out in ((any_field, matched), (whole, complete)):
            d, unit = np.nonzero(have)
            out += np.bincount(d * queries + q.unit_query[unit], q.unit_mult[unit], minlength=n * queries)
    hit = np.flatnonzero(matched)
    hit = hit[complete[hit] >= q.required[hit % queries]]
    query = hit % queries
    units = q.units[query]
    return query, hit // queries, total[hit] * np.where(units > 0, matched[hit] / np.maximum(units, 1), 1.0)


def by_entries(entries, k: int) -> Callable:
    """For ``mapInArrow``: the best documents of each query from postings (shard, batch, doc_id, place, term_no, tf, length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Entries = entries.value
        kept, at = None, None
        for table in _whole_documents(batches):
            here = table.column("shard")[0].as_py(), table.column("batch")[0].as_py()
            if here != at:
                if kept is not None:
                    yield from kept.rows(q.ids, *at)
                kept, at = Kept(len(q.ids), k), here
            place = table.column("place").to_numpy()
            norm = np.sqrt(table.column("tf").to_numpy().astype(float)) * (1 / np.sqrt(table.column("length").to_numpy().astype(float)))
            if "query" in table.column_names:
                lists = _column(table, "query")
                ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
                weight = q.weight if q.constant is not None else _column(table, "weight").flatten().to_numpy()
                first, count, own = ends[:-1], np.diff(ends), replace(q, query=lists.flatten().to_numpy().astype(np.int64), weight=weight)
            else:
                term = np.searchsorted(q.terms, table.column("term_no").to_numpy())
                first, count, own = q.bounds[term], q.bounds[term + 1] - q.bounds[term], q
            starts, ids = np.flatnonzero(place == 1), _column(table, "doc_id")
            edges = np.append(starts, len(place))
            for a, b in _blocks(starts, count, q.width):
                rows = slice(edges[a], edges[b])
                row, entry = _expanded(first[rows], count[rows])
                doc = (np.cumsum(place[rows] == 1) - 1)[row]
                kept.add(*_scored(own, doc, b - a, entry, norm[rows][row]), ids.take(pa.array(starts[a:b])))
        if kept is not None:
            yield from kept.rows(q.ids, *at)

    return run


class _Places:
    """The places of the query words in a block: (text, term, position), looked up by all three, or the next one at or after a position."""

    def __init__(self, text: np.ndarray, term: np.ndarray, at: np.ndarray, terms: int, reach: int):
        self.terms, self.stride = terms, int(at.max(initial=0)) + reach + 2
        self.keys = np.unique(self._key(text, term, at))

    def _key(self, text, term, at):
        return (text * self.terms + term) * self.stride + at

    def has(self, text, term, at) -> np.ndarray:
        key = self._key(text, term, np.maximum(at, 0))
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (at >= 0) & (self.keys[found] == key)

    def next(self, text, term, at) -> np.ndarray:
        key = self._key(text, term, np.clip(at, 0, self.stride - 1))
        found = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)]
        good = (found >= key) & (found // self.stride == key // self.stride) & (at < self.stride)
        return np.where(good, found % self.stride, _NOWHERE)


def _spreads(q: Phrases, places: _Places, text: np.ndarray, phrase: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The smallest spread that the first word's position reaches, more than the slop if none within it.

    As in ``operators.phrase``: a window begins at each place up to the slop before the first word, and every other slot takes
    the smallest position in it, one that is still free where a word of the phrase repeats.
    """
    best = np.full(len(start), _NOWHERE)
    for back in range(q.slop + 1):
        low, last = start - back, start.copy()
        used = [start]
        for j in range(1, q.word.shape[1]):
            has = q.slots[phrase] > j
            word, slot = q.word[phrase, j], q.slot[phrase, j]
            at = places.next(text, word, low + slot)
            for _ in used:
                clash = q.repeats[phrase] & has & (np.stack(used) == at).any(axis=0)
                if not clash.any():
                    break
                at = np.where(clash, places.next(text, word, at + 1), at)
            used.append(np.where(has, at, -1))
            last = np.where(has, np.maximum(last, at - slot), last)
        best = np.where(last <= low + q.slop, np.minimum(best, last - low), best)
    return best


def _phrase_hits(q: Phrases, text: np.ndarray, term: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, phrase, frequency) of the phrases in texts whose words, ``terms`` by number, stand at these positions."""
    reach = int(q.slot.max(initial=0)) + q.slop
    places = _Places(text, term, at, len(q.terms), reach)
    row, entry = _expanded(q.bounds[term], q.bounds[term + 1] - q.bounds[term])
    text, phrase = text[row], q.phrase[entry]
    start = at[row] - q.pivot[phrase]
    n = len(q.slots)
    if q.slop == 0:
        for j in range(q.word.shape[1]):
            good = (q.slots[phrase] <= j) | places.has(text, q.word[phrase, j], start + q.slot[phrase, j])
            text, phrase, start = text[good], phrase[good], start[good]
        if len(places.keys) < len(at):
            # Rows of one id share positions, which count once but where the phrase is one word.
            many = q.slots[phrase] > 1
            once = np.unique(np.stack([text[many], phrase[many], start[many]]), axis=1)
            text, phrase = np.concatenate([text[~many], once[0]]), np.concatenate([phrase[~many], once[1]])
        pairs, freq = np.unique(text * n + phrase, return_counts=True)
        return pairs // n, pairs % n, freq.astype(float)
    found = []
    for move in range(-q.slop, q.slop + 1):
        here = (q.pivot[phrase] > 0) | (move == 0)
        t, p, s = text[here], phrase[here], start[here] + move
        good = places.has(t, q.word[p, 0], s)
        found.append(np.stack([t[good] * n + p[good], s[good]]))
    pair, start = np.unique(np.concatenate(found, axis=1), axis=1)
    spread = _spreads(q, places, pair // n, pair % n, start)
    good = spread <= q.slop
    pairs, inverse = np.unique(pair[good], return_inverse=True)
    return pairs // n, pairs % n, np.bincount(inverse, 1 / (1 + spread[good].astype(float)), minlength=len(pairs))


def by_phrases(phrases, k: int) -> Callable:
    """For ``mapInArrow``: the best documents of each phrase from postings (shard, batch, doc_id, place, term_no, length, positions),
    those of a document sorted by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Phrases = phrases.value
        kept, here = None, None
        for table in _whole_documents(batches):
            now = table.column("shard")[0].as_py(), table.column("batch")[0].as_py()
            if now != here:
                if kept is not None:
                    yield from kept.rows(q.ids, *here)
                kept, here = Kept(len(q.ids), k), now
            place, length = table.column("place").to_numpy(), table.column("length").to_numpy()
            term = np.searchsorted(q.terms, table.column("term_no").to_numpy())
            lists = _column(table, "positions")
            ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            at = lists.flatten().to_numpy().astype(np.int64)
            own = np.diff(ends)
            starts, ids = np.flatnonzero(place == 1), _column(table, "doc_id")
            # Rows of one id with texts of different lengths are texts of their own.
            text = np.cumsum((place == 1) | (np.diff(length, prepend=0) != 0)) - 1
            edges = np.append(starts, len(place))
            for a, b in _blocks(starts, own * (1 + q.bounds[term + 1] - q.bounds[term]), 1):
                rows = slice(edges[a], edges[b])
                row = np.repeat(np.arange(edges[a], edges[b]), own[rows])
                first = text[edges[a]]
                t, phrase, freq = _phrase_hits(q, text[row] - first, term[row], at[ends[edges[a]] : ends[edges[b]]])
                row_of = edges[a] + np.unique(text[rows], return_index=True)[1]
                doc = (np.cumsum(place[rows] == 1) - 1)[row_of - edges[a]][t]
                score = q.weight[phrase] * (1 / np.sqrt(length[row_of][t].astype(float))) * np.sqrt(freq)
                pairs, inverse = np.unique(doc * len(q.ids) + phrase, return_inverse=True)
                total = np.bincount(inverse, score, minlength=len(pairs))
                kept.add(pairs % len(q.ids), pairs // len(q.ids), total, ids.take(pa.array(starts[a:b])))
        if kept is not None:
            yield from kept.rows(q.ids, *here)

    return run


def listed_entries(ids: pa.Array, constant: np.ndarray | None) -> Entries:
    """Queries by number, whose entries come with the postings."""
    none, zero = np.zeros(0, dtype=np.int64), np.zeros(0)
    return Entries(ids=ids, terms=none, bounds=none, query=none, weight=zero, mult=zero, constant=constant)


def entries_of(rows: pa.Table, many_fields: bool, words: bool, constant: bool) -> Entries:
    """From (term_no, query_id, units, required, unit, mult, parts, field, weight), a row per query word and term."""
    coded = _column(rows, "query_id").dictionary_encode()
    query, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    term, weight, mult = (rows.column(c).to_numpy() for c in ("term_no", "weight", "mult"))
    order = np.argsort(term, kind="stable")
    term, query, weight, mult = term[order], query[order], weight[order], mult[order].astype(float)
    terms, first = np.unique(term, return_index=True)
    common = dict(ids=coded.dictionary, terms=terms, bounds=np.append(first, len(term)), query=query, weight=weight, mult=mult)
    if constant:
        best = np.zeros(n)
        np.maximum.at(best, query, weight)
        return Entries(**common, constant=best)
    if not words:
        return Entries(**common)
    per_query = {c: np.zeros(n) for c in ("units", "required")}
    for name, out in per_query.items():
        out[query] = rows.column(name).to_numpy()[order]
    if not many_fields:
        return Entries(**common, **per_query)
    unit, parts = (rows.column(c).to_numpy()[order] for c in ("unit", "parts"))
    field = _column(rows, "field").dictionary_encode().indices.to_numpy(zero_copy_only=False)[order]
    # Words are numbered by query, unit and number, and their groups, a field each, in the same order.
    words_, word = np.unique(np.stack([query, unit, mult.astype(np.int64)]), axis=1, return_inverse=True)
    groups, group = np.unique(np.stack([word.ravel(), field, parts]), axis=1, return_inverse=True)
    first_group = np.flatnonzero(np.diff(groups[0], prepend=-1))
    return Entries(
        **common, **per_query, group=group.ravel(), parts=groups[2], first_group=first_group,
        unit_mult=words_[2].astype(float), unit_query=words_[0],
    )


def phrases_of(rows: pa.Table, slop: int) -> Phrases:
    """From (term_no, query_id, slot, slots, repeats, idf, weight), a row per word of a phrase, one phrase per query."""
    coded = _column(rows, "query_id").dictionary_encode()
    query = coded.indices.to_numpy(zero_copy_only=False)
    term, slot, slots, idf, weight = (rows.column(c).to_numpy() for c in ("term_no", "slot", "slots", "idf", "weight"))
    repeats = rows.column("repeats").to_numpy(zero_copy_only=False)
    terms, number = np.unique(term, return_inverse=True)
    order = np.lexsort((slot, query))
    query, number, slot, slots, idf, weight, repeats = (x[order] for x in (query, number, slot, slots, idf, weight, repeats))
    first = np.flatnonzero(np.diff(query, prepend=-1))
    size = np.diff(np.append(first, len(query)))
    n, most = len(first), int(size.max(initial=1))
    word, place = np.zeros((n, most), dtype=np.int64), np.zeros((n, most), dtype=np.int64)
    own = np.arange(len(query)) - np.repeat(first, size)
    word[query, own], place[query, own] = number, slot
    rarest = np.zeros((n, most))
    rarest[query, own] = idf
    pivot = rarest.argmax(axis=1)
    # A phrase that lacks a word, or has one in two rows, matches nothing.
    usable = np.flatnonzero(size == slots[first])
    at_term = word[usable, pivot[usable]]
    by_term = np.argsort(at_term, kind="stable")
    bounds = np.searchsorted(at_term[by_term], np.arange(len(terms) + 1))
    return Phrases(
        ids=coded.dictionary, terms=terms, bounds=bounds, phrase=usable[by_term], pivot=place[np.arange(n), pivot], word=word, slot=place,
        slots=size, repeats=repeats[first].astype(bool), weight=weight[first], slop=slop,
    )


def _clause_totals(q: Clauses, n: int, doc: np.ndarray, entry: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, hit) per cell of n documents and all clauses, from pairs of a posting and an entry; phrases are not in it."""
    width = len(q.role)
    clause = q.clause[entry]
    cell = doc * width + clause
    total = np.bincount(cell, q.factor[entry] * value, minlength=n * width)
    hit = np.bincount(cell, minlength=n * width) > 0
    total = (total.reshape(n, width) + hit.reshape(n, width) * q.constant).ravel()
    of_words = np.flatnonzero(q.group[entry] >= 0)
    if len(of_words):
        # A word counts once, and is whole where one field holds all terms that it makes of the word.
        groups, words = len(q.parts), len(q.word_mult)
        key, found = np.unique(doc[of_words] * groups + q.group[entry[of_words]], return_counts=True)
        group = key % groups
        word = key // groups * words + q.group_word[group]
        lead = np.flatnonzero(np.diff(word, prepend=-1))
        whole = np.logical_or.reduceat(found >= q.parts[group], lead)
        word = word[lead]
        cell, mult = word // words * width + q.word_clause[word % words], q.word_mult[word % words]
        matched = np.bincount(cell, mult, minlength=n * width).reshape(n, width)
        complete = np.bincount(cell, mult * whole, minlength=n * width).reshape(n, width)
        keyword = np.flatnonzero(q.units > 0)
        total, hit = total.reshape(n, width), hit.reshape(n, width)
        total[:, keyword] *= matched[:, keyword] / q.units[keyword]
        hit[:, keyword] &= complete[:, keyword] >= q.required[keyword]
    return total.reshape(n, width), hit.reshape(n, width)


def _combined(q: Clauses, total: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, document, score) of the documents that each query's clauses admit."""
    counted = hit & (q.role != 2)
    matched, must, banned = (
        np.add.reduceat(x, q.first, axis=1, dtype=np.int32) for x in (counted, hit & (q.role == 1), hit & (q.role == 2))
    )
    doc, query = np.nonzero((banned == 0) & (must == q.n_must) & (matched > 0))
    contrib = np.add.reduceat(np.where(counted, total, 0.0), q.first, axis=1)[doc, query]
    return query, doc, contrib * (matched[doc, query] / q.n_clauses[query])


def by_clauses(clauses, k: int) -> Callable:
    """For ``mapInArrow``: the best documents of each boolean query from postings (shard, batch, doc_id, place, list_no, idf2, tf,
    length, word_no, positions), those of a document sorted by length; a posting has a ``list_no`` or a ``word_no``, else -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Clauses = clauses.value
        kept, here, width = None, None, len(q.role)
        for table in _whole_documents(batches):
            now = table.column("shard")[0].as_py(), table.column("batch")[0].as_py()
            if now != here:
                if kept is not None:
                    yield from kept.rows(q.ids, *here)
                kept, here = Kept(len(q.ids), k), now
            place, length, list_no, word_no, tf, idf2 = (table.column(c).to_numpy() for c in ("place", "length", "list_no", "word_no", "tf", "idf2"))
            value = idf2 * (np.sqrt(tf.astype(float)) * (1 / np.sqrt(length.astype(float))))
            known = list_no >= 0
            spot = np.searchsorted(q.lists, np.where(known, list_no, 0)) * known
            first, count = q.bounds[spot], (q.bounds[np.minimum(spot + 1, len(q.lists))] - q.bounds[spot]) * known
            positions = _column(table, "positions")
            ends = positions.offsets.to_numpy().astype(np.int64) - positions.offsets[0].as_py()
            at, own = positions.flatten().to_numpy().astype(np.int64), np.diff(ends)
            pairs = count + own
            terms = []
            for p in q.phrases:
                term = np.minimum(np.searchsorted(p.terms, word_no), len(p.terms) - 1)
                term = np.where(p.terms[term] == word_no, term, -1)
                pairs = pairs + np.where(term >= 0, own * (p.bounds[term + 1] - p.bounds[term]), 0)
                terms.append(term)
            starts, ids = np.flatnonzero(place == 1), _column(table, "doc_id")
            text = np.cumsum((place == 1) | (np.diff(length, prepend=0) != 0)) - 1
            edges = np.append(starts, len(place))
            for a, b in _blocks(starts, pairs, width):
                rows = slice(edges[a], edges[b])
                doc_of = np.cumsum(place[rows] == 1) - 1
                row, entry = _expanded(first[rows], count[rows])
                total, hit = _clause_totals(q, b - a, doc_of[row], entry, value[rows][row])
                row_of = edges[a] + np.unique(text[rows], return_index=True)[1]
                for p, term in zip(q.phrases, terms, strict=True):
                    asked = np.flatnonzero(term[rows] >= 0) + edges[a]
                    if not len(asked):
                        continue
                    row, place_of = _expanded(ends[asked], own[asked])
                    t, phrase, freq = _phrase_hits(p, text[asked][row] - text[edges[a]], term[asked][row], at[place_of])
                    score = p.weight[phrase] * (1 / np.sqrt(length[row_of][t].astype(float))) * np.sqrt(freq)
                    doc, clause = doc_of[row_of - edges[a]][t], p.ids.to_numpy()[phrase] // q.fields
                    np.add.at(total, (doc, clause), score)
                    hit[doc, clause] = True
                kept.add(*_combined(q, total, hit), ids.take(pa.array(starts[a:b])))
        if kept is not None:
            yield from kept.rows(q.ids, *here)

    return run


def clauses_of(named: pa.Table, entries: pa.Table, phrases: tuple[Phrases, ...], fields: int) -> Clauses:
    """From (query_id, role, units, required, n_clauses, n_must), a row per clause in the order of their numbers, those of a query
    together, and (list_no, field, clause, unit, mult, parts, constant, factor), a row per entry."""
    coded = _column(named, "query_id").dictionary_encode()
    query = coded.indices.to_numpy()
    first = np.flatnonzero(np.diff(query, prepend=-1))
    role, units, required, n_clauses, n_must = (named.column(c).to_numpy() for c in ("role", "units", "required", "n_clauses", "n_must"))
    list_no, clause, unit, mult, parts, factor = (
        entries.column(c).to_numpy() for c in ("list_no", "clause", "unit", "mult", "parts", "factor")
    )
    is_constant = entries.column("constant").to_numpy()
    order = np.argsort(list_no, kind="stable")
    lists, start = np.unique(list_no[order], return_index=True)
    constant = np.zeros(len(role))
    np.maximum.at(constant, clause[is_constant], factor[is_constant])
    group = np.full(len(clause), -1)
    keyword = np.flatnonzero(units[clause] > 0)
    field = _column(entries, "field").dictionary_encode().indices.to_numpy(zero_copy_only=False)
    words, word = np.unique(np.stack([clause, unit, mult])[:, keyword], axis=1, return_inverse=True)
    groups, own = np.unique(np.stack([word.ravel(), field[keyword], parts[keyword]]), axis=1, return_inverse=True)
    group[keyword] = own.ravel()
    return Clauses(
        ids=coded.dictionary, first=first, n_clauses=n_clauses[first], n_must=n_must[first], role=role, units=units, required=required,
        constant=constant, lists=lists, bounds=np.append(start, len(list_no)), clause=clause[order].astype(np.int64),
        factor=np.where(is_constant, 0.0, factor)[order], group=group[order], parts=groups[2], group_word=groups[0],
        word_clause=words[0].astype(np.int64), word_mult=words[2].astype(float), phrases=phrases, fields=fields,
    )
