"""Periodic runs, sentence pieces and collocations: awkward tables, the public library, and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from findery.llm import collocations, periodic, pieces

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, runs string, f long, phrase string, ids binary"
TEXTS = [None, "", " \n\t ", "one", "a a a a a a", "red fox. " * 30, "lorem ipsum dolor " * 20_000, "x" * 60_000, "é b \x1c c▁ d  e \x0b 漢 😀 \x00"]


def awkward(spark, n=len(TEXTS)):
    rows = [(None if k == 3 else k, TEXTS[k], None if k % 3 else "en", None, k, "r", 1, "p", b"i") for k in range(n)]
    return spark.createDataFrame([*rows, *rows[4:6]] if rows else [], SCHEMA)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def plain_runs(words) -> list[tuple[int, int, int]]:
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            begin = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = begin - q, i - begin + q
            if length >= max(6, 4 * q) and not any(all(words[j] == words[j - p] for j in range(start + p, i)) for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    random_ = random.Random(11)
    for _ in range(1500):
        letters = random_.choice([1, 2, 3, 10, 50])
        words = [random_.randrange(letters) for _ in range(random_.randrange(40))]
        for _ in range(random_.randrange(3)):
            unit = [random_.randrange(letters) for _ in range(random_.randrange(1, 15))]
            words += (unit * random_.randrange(1, 8))[: random_.randrange(1, 90)] + [random_.randrange(letters) for _ in range(random_.randrange(6))]
        assert periodic.runs(words) == plain_runs(words)


@pytest.mark.parametrize("words", [[1] * 30_000, list(range(3000)) * 10, [k % 2 for k in range(20_001)]])
def test_long_runs(words):
    assert periodic.runs(words) == [(0, len(words), len(set(words)))]


def test_suffix_paths_are_last_occurrences():
    random_ = random.Random(2)
    for _ in range(100):
        words = [random_.randrange(3) for _ in range(60)]
        links, lengths, prefixes = periodic.automaton(words)
        paths = periodic.Paths(links)
        for at, state in enumerate(prefixes):
            for end, node in paths.access(state, at):
                n = lengths[node]
                assert words[at - n + 1 : at + 1] == words[end - n + 1 : end + 1]
                assert not any(words[k - n + 1 : k + 1] == words[at - n + 1 : at + 1] for k in range(end + 1, at) if k >= n - 1)


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    n = len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_runs(key, text, limit=4000):
    words = planted(key, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return (
        key, len(found), best[0], best[1], best[2], 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def test_op11_equals_brute_force(spark):
    docs = [r for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: tuple(r) for r in periodic.op11_runs(spark, SMALL).collect()}
    assert len(got) == len(docs) and sum(r[1] > 0 for r in got.values()) > 3
    short = [r for r in docs if len((r.text or "").split()) <= 1500]
    assert len(short) > 150
    for r in short:
        assert got[r.doc_id] == expected_runs(r.doc_id, r.text)


@pytest.mark.parametrize("size", [0, len(TEXTS)])
def test_runs_of_awkward_documents(spark, size):
    found = periodic.find(awkward(spark, size), rewrite=periodic.planted).collect()
    assert len(found) == (size and size + 2)
    if size:
        by = {r.doc_id: r for r in periodic.find(awkward(spark)).collect()}
        assert by[0].n_words == by[1].n_words == by[2].n_words == 0 and by[0].collapsed == "" and by[0].runs == []
        assert [tuple(r) for r in by[4].runs] == [(0, 6, 1)] and by[4].collapsed == "a"
        assert [tuple(r) for r in by[6].runs] == [(0, 60_000, 3)] and by[6].collapsed == "lorem ipsum dolor"
        assert by[8].collapsed == "é b \x1c c▁ d e 漢 😀 \x00"
        assert any(r.doc_id is None and r.n_words == 1 for r in found)


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


LETTERS = [*"abcde  ▁\n\t<s>é漢字😀 　ﬁ́\x00ABCthe ing 0x41", "the ", "  ", "<unk>", "<0x41>", "�", "ضع", "▁▁", "a" * 30]


def test_pieces_equal_the_library(library):
    random_, own = random.Random(3), pieces.codec()
    for k in range(4000):
        text = "".join(random_.choice(LETTERS) for _ in range(random_.randrange(30)))
        if k % 4 == 0:
            text += "".join(chr(random_.choice([random_.randrange(1, 0x300), random_.randrange(0x300, 0xD800), random_.randrange(0xE000, 0x11000)])) for _ in range(12))
        ids, begins, ends = own.encode(text)
        wanted = library.encode(text, return_type="proto").pieces
        assert list(zip(ids.tolist(), begins.tolist(), ends.tolist(), strict=True)) == [(p.id, p.begin, p.end) for p in wanted]
        whole = [1, *ids.tolist(), 2]
        assert own.decode(np.array(whole)) == library.decode(whole)
    for _ in range(4000):
        ids = [random_.choice([random_.randrange(32_000), random_.randrange(300)]) for _ in range(random_.randrange(12))]
        assert own.decode(np.array(ids, dtype=np.int64)) == library.decode(ids)


def test_short_and_long_parts_merge_alike():
    random_, own = random.Random(4), pieces.codec()
    for _ in range(2000):
        part = "".join(random_.choice("▁theraoinsé") for _ in range(random_.randrange(1, 39)))
        assert own._merge(part) == own._merge_long(list(part))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("flags", [(True, True, True), (True, False, True), (False, True, False)])
def test_normaliser_equals_the_library(rule, flags):
    import sentencepiece

    names = ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces")
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **dict(zip(names, flags, strict=True)))
    spec = next(dict(pieces._fields(v)) for k, v in pieces._fields(library.serialized_model_proto()) if k == 3)
    own, random_ = pieces.Normalizer(spec.get(2, b""), *flags), random.Random(5)
    for _ in range(1500):
        text = "".join(random_.choice(LETTERS) if random_.random() < 0.6 else chr(random_.randrange(1, 0xD800)) for _ in range(random_.randrange(14)))
        wanted, places = library.normalize(text, with_offsets=True)
        got, found = own.normalized(text)
        starts = [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]
        assert (got, found.tolist()) == (wanted, [starts[p] for p in places])


def test_op12_equals_the_library(spark, library):
    got = {r.doc_id: r for r in pieces.op12_pieces(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        row = got[r.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == sha(np.array(ids, dtype="<u4").tobytes()) and row.decoded_sha256 == sha(library.decode(ids))


@pytest.mark.parametrize("size", [0, len(TEXTS)])
def test_pieces_of_awkward_documents(spark, library, size):
    encoded = pieces.encode(awkward(spark, size))
    rows = encoded.collect()
    assert len(rows) == (size and size + 2)
    for r in rows:
        text = TEXTS[3 if r.doc_id is None else r.doc_id] or ""
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == library.encode(text, add_bos=True, add_eos=True) and r.decoded == library.decode(library.encode(text))
    if size:
        spans = [r for r in pieces.pieces(encoded).collect() if r.doc_id == 8]
        assert "".join(TEXTS[8].encode()[r.begin : r.end].decode() for r in sorted(spans, key=lambda r: r.place)) == TEXTS[8]


def plain_collocations(rows, least=10, within=50, best=2000):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in {p[:2], p[1:]}:
                    longer[part] = max(longer[part], a)
        scored = []
        for p, a in candidates.items():
            if len(p) == 2 and 100 * longer[p] >= within * a and longer[p]:
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def test_collocations_equal_brute_force(spark):
    random_ = random.Random(7)
    words = ["New", "york", "times", "a", "b", "É", " x", *[f"w{k}" for k in range(4)]]
    rows = [
        (random_.choice([None, "und", "en", "en", "en", ""]), "".join(random_.choice(words) + random_.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(random_.randrange(250))))
        for _ in range(120)
    ]
    rows += [(None, None), ("en", ""), ("en", "new york times " * 3000)]
    docs = spark.createDataFrame([(lang, text, 1, "p", 2) for lang, text in rows], "lang string, text string, rank int, phrase string, a int")
    found = collocations.best(collocations.mine(docs)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert {tuple(r) for r in found} == plain_collocations(rows) and len(found) > 50


def test_op13_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").collect()]
    assert {tuple(r) for r in collocations.op13_collocations(spark, SMALL).collect()} == plain_collocations(rows)


def test_collocations_of_nothing(spark):
    assert collocations.mine(awkward(spark, 0)).count() == 0
    assert collocations.mine(awkward(spark, 3)).count() == 0
    assert {r.lang for r in collocations.mine(awkward(spark)).collect()} == {"en", "und"}


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    table = spark.createDataFrame([("en", 0, "", 10 * big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 1), ("en", 2, "a b", big)], "lang string, size int, phrase string, f long")
    assert [r.score for r in collocations.scored(table, 2).collect()] == [10**6 * big * big // ((big + 7) * (big + 1))]


def test_summary_keeps_what_is_frequent():
    random_ = np.random.default_rng(5)
    keys = np.concatenate([np.repeat(np.arange(40), 50), random_.integers(1000, 1 << 32, 20_000)]).astype(np.uint32)
    random_.shuffle(keys)
    for least in (10, 50):
        summary = collocations.Summary(len(keys) // least)
        for part in np.array_split(keys, 60):
            summary.add(*collocations._counted(part))
            summary.merge()
        assert summary.taken < least and len(summary.keys) <= summary.capacity
        assert set(range(40)) <= set(summary.frequent(least).tolist())
    assert summary.taken > 0
