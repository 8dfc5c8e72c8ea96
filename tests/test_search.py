"""Scores worked out by hand from the published formula, and the algebra between query kinds."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter

import pytest

import findery as fy
from conftest import TITLES, hits
from findery.functions import analysis as an
from findery.operators import expand
from findery.plans.index import build
from findery.plans.search import total_hits


def test_keyword_scores(title_index, ask):
    queries = ask("valve pressure", "valve valve turbine", "", "-- !")
    top = fy.search_keywords(title_index, queries, 10)
    assert hits(top) == {
        1: [(1, 0.734718), (4, 0.371329), (2, 0.222175), (3, 0.172096)],
        2: [(2, 0.367867), (3, 0.284948), (1, 0.240825)],
    }
    counts = {r["query_id"]: r["total_hits"] for r in total_hits(queries, top).collect()}
    assert counts == {1: 4, 2: 3, 3: 0, 4: 0}


def test_unsaved_index_gives_the_same(titles, title_index, ask):
    queries = ask("valve pressure", "the closes")
    assert hits(fy.search_keywords(build(titles, "Allid", ["Title"]), queries, 10)) == hits(
        fy.search_keywords(title_index, queries, 10)
    )


def test_and(title_index, ask):
    top = fy.search_keywords(title_index, ask("valve pressure", "valve turbine"), 10, operator="and")
    assert hits(top) == {1: [(1, 0.734718)]}


def test_top_k_is_a_prefix_and_counts_all(title_index, ask):
    queries = ask("valve pressure")
    all_hits = hits(fy.search_keywords(title_index, queries, 10))[1]
    for k in (1, 2, 3):
        top = fy.search_keywords(title_index, queries, k)
        assert hits(top)[1] == all_hits[:k]
        assert {r["total_hits"] for r in top.collect()} == {4}


def test_term_is_not_analyzed(title_index, ask):
    found = hits(fy.search_term(title_index, ask("valve", "Valve", "valve closes"), "Title", 10))
    assert list(found) == [1] and {d for d, _ in found[1]} == {1, 2, 3}
    idf = 1 + math.log(5 / 4)
    assert found[1][0] == (2, round(idf / math.sqrt(3), 6))
    assert hits(fy.search_term(title_index, ask("VALVE"), "Title", 10, normalize=True))[1] == found[1]


def test_wildcards(title_index, ask):
    words = {d: set(t.split()) for d, t in TITLES}
    import fnmatch

    patterns = ["p*e", "*", "?ump", "*lo*", "???", "valve", "*s", "c?os*", "*a*e*", "压*", "zz*"]
    found = hits(fy.search_wildcard(title_index, ask(*patterns), "Title", 10))
    for i, pattern in enumerate(patterns, 1):
        want = [d for d in words if any(fnmatch.fnmatchcase(w, pattern) for w in words[d])]
        assert [d for d, _ in found.get(i, [])] == want, pattern
        assert all(s == 1.0 for _, s in found.get(i, []))


def test_prefix_is_a_wildcard(title_index, ask):
    prefixes = ["p", "val", "pressu", "", "锅"]
    by_prefix = hits(fy.search_prefix(title_index, ask(*prefixes), "Title", 10))
    assert by_prefix == hits(fy.search_wildcard(title_index, ask(*[p + "*" for p in prefixes]), "Title", 10))
    assert len(by_prefix[4]) == 5


def test_pattern_punctuation_is_literal(spark, ask):
    index = build(spark.createDataFrame([(1, "a.c"), (2, "abc")], "id int, code string"), "id", ["code"],
                  analyzer=fy.runtime.F.array)
    assert [d for d, _ in hits(fy.search_wildcard(index, ask("a.*"), "code", 10))[1]] == [1]


def test_fuzzy(title_index, ask):
    found = hits(fy.search_fuzzy(title_index, ask("valv", "presure", "lo", "xx", "low"), "Title", 10))
    assert {d for d, _ in found[1]} == {1, 2, 3}
    assert {d for d, _ in found[2]} == {1, 4}
    assert 3 not in found and 4 not in found
    assert {d for d, _ in found[5]} >= {4}
    # one expansion with boost b: idf * b / (idf * b) leaves idf * sqrt(tf) * norm
    idf = 1 + math.log(5 / 4)
    assert dict(found[1])[2] == round(idf / math.sqrt(3), 6)


def test_fuzzy_join_without_broadcast(title_index, ask, monkeypatch):
    want = hits(fy.search_fuzzy(title_index, ask("valv", "presure", "gage"), "Title", 10))
    monkeypatch.setattr("findery.runtime.BROADCAST_MAX_ROWS", -1)
    assert hits(fy.search_fuzzy(title_index, ask("valv", "presure", "gage"), "Title", 10)) == want


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("broadcast", [True, False])
def test_near_words_equal_all_pairs(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("findery.runtime.BROADCAST_MAX_ROWS", -1)
    random_ = random.Random(8)
    words = sorted({"".join(random_.choice("abé") for _ in range(random_.randint(0, 11))) for _ in range(1200)})
    keywords = sorted({"".join(random_.choice("abé") for _ in range(random_.randint(0, 12))) for _ in range(80)}) + ["a", "ab"]
    found = expand.fuzzy_terms(
        spark.createDataFrame([("f", k) for k in set(keywords)], "field string, keyword string"),
        spark.createDataFrame([(f, w) for w in words for f in "fg"], "field string, term string"),
    ).collect()
    want = {}
    for k in filter(None, keywords):
        for w in filter(None, words):
            d = _distance(k, w)
            if (k == w) if len(k) <= 2 else 2 * d < min(len(k), len(w)):
                want[k, w] = d
    assert {(r.keyword, r.term): r.distance for r in found} == want and len(found) == len(want)


def test_near_words_meet_few_terms(spark):
    random_ = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(random_.choice(letters) for _ in range(random_.randint(5, 9))) for _ in range(20_000)]
    terms = spark.createDataFrame([("f", w) for w in words], "field string, term string")
    keywords = spark.createDataFrame([("f", w[:2] + w[3:]) for w in words[:50]], "field string, keyword string")
    met = expand.fuzzy_pairs(keywords, terms).count()
    band = sum(2 * n // 3 < len(w) < 1.5 * n for n in (len(w) - 1 for w in words[:50]) for w in words)
    assert met < 0.2 * band


def test_search_without_broadcast(title_index, ask, monkeypatch):
    queries = ask("valve pressure", "the pump closes")
    want = hits(fy.search_keywords(title_index, queries, 10)), hits(fy.search_phrase(title_index, queries, "Title", 10, slop=9))
    monkeypatch.setattr("findery.runtime.BROADCAST_MAX_ROWS", -1)
    got = hits(fy.search_keywords(title_index, queries, 10)), hits(fy.search_phrase(title_index, queries, "Title", 10, slop=9))
    assert got == want


def _phrase_freq(words: list[str], phrase: list[str], slop: int) -> float:
    """Every combination of positions, by brute force."""
    places = [[p - i for p, w in enumerate(words) if w == q] for i, q in enumerate(phrase)]
    freq = 0.0
    for first in places[0]:
        spreads = [max(c) - min(c) for c in itertools.product([first], *places[1:])]
        if spreads and min(spreads) <= slop:
            freq += 1 / (1 + min(spreads))
    return freq


def test_phrases_against_brute_force(spark, ask):
    rng = random.Random(7)
    docs = {i: [rng.choice("abcd") for _ in range(rng.randint(1, 40))] for i in range(30)}
    index = build(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "id int, t string"), "id", ["t"])
    phrases = ["a b", "b a c", "d", "a b c d", "c a"]
    df = {w: sum(w in d for d in docs.values()) for w in "abcd"}
    for slop in (0, 2, 70):
        found = hits(fy.search_phrase(index, ask(*phrases), "t", 100, slop=slop))
        for i, phrase in enumerate(phrases, 1):
            words = phrase.split()
            idf = sum(1 + math.log(len(docs) / (df[w] + 1)) for w in words)
            want = {}
            for d, text in docs.items():
                freq = _phrase_freq(text, words, slop)
                if freq:
                    want[d] = round(math.sqrt(freq) * idf / math.sqrt(len(text)), 6)
            got = dict(found.get(i, []))
            assert got.keys() == want.keys(), (phrase, slop)
            assert all(abs(got[d] - want[d]) < 2e-6 for d in want)


def test_or_and_phrase_nest(title_index, ask):
    queries = ask("valve closes", "pressure valve", "the valve")
    def docs(top):
        return {q: {d for d, _ in rows} for q, rows in hits(top).items()}
    any_word = docs(fy.search_keywords(title_index, queries, 10))
    all_words = docs(fy.search_keywords(title_index, queries, 10, operator="and"))
    loose = docs(fy.search_phrase(title_index, queries, "Title", 10, slop=2))
    exact = docs(fy.search_phrase(title_index, queries, "Title", 10))
    for q in any_word:
        assert exact.get(q, set()) <= loose.get(q, set()) <= all_words.get(q, set()) <= any_word[q]


def test_many_fields(spark, ask):
    rows = [(1, "red valve", "pump"), (2, "pump", "red"), (3, "blue", None), (4, None, "valve valve red")]
    index = build(spark.createDataFrame(rows, "id int, a string, b string"), "id", ["a", "b"])
    n = 4
    field_words = {(d, f): t.split() for d, *texts in rows for f, t in zip("ab", texts) if t}
    df = Counter((f, w) for (_, f), words in field_words.items() for w in set(words))
    def idf(f, w):
        return 1 + math.log(n / (df[f, w] + 1))
    query = ["red", "valve", "zinc"]
    norm = 1 / math.sqrt(sum(idf(f, w) ** 2 for f in "ab" for w in query))
    want = {}
    for d in range(1, 5):
        total, matched = 0.0, 0
        for w in query:
            parts = [idf(f, w) ** 2 * math.sqrt(words.count(w)) / math.sqrt(len(words))
                     for (dd, f), words in field_words.items() if dd == d and w in words]
            total += sum(parts)
            matched += bool(parts)
        if matched:
            want[d] = round(norm * total * matched / 3, 6)
    assert dict(hits(fy.search_keywords(index, ask("red valve zinc"), 10))[1]) == want
    assert {d for d, _ in hits(fy.search_keywords(index, ask("red valve"), 10, operator="and"))[1]} == {1, 4}


def test_boolean(spark, title_index):
    def run(*clauses):
        rows = [(1, i, *c) for i, c in enumerate(clauses)]
        table = spark.createDataFrame(rows, "query_id bigint, clause_id bigint, kind string, field string, text string, occur string, slop int")
        return dict(hits(fy.search_boolean(title_index, table, 10)).get(1, []))

    assert run(("terms", "Title", "valve pressure", "should", 0)) == {1: 0.734718, 4: 0.371329, 2: 0.222175, 3: 0.172096}
    assert set(run(("terms", None, "valve pressure", "must", 0), ("phrase", "Title", "valve closes", "must_not", 0))) == {3, 4}
    assert set(run(("term", "Title", "valve", "must", 0), ("prefix", "Title", "pre", "must", 0))) == {1}
    assert set(run(("term", "Title", "turbine", "must", 0), ("prefix", "Title", "pre", "should", 0))) == set()
    assert run(("term", "Title", "valve", "must_not", 0)) == {}
    # a constant clause beside a term clause: (idf^2 * norm + 1) * queryNorm * coord
    idf = 1 + math.log(5 / 4)
    query_norm = 1 / math.sqrt(idf**2 + 1)
    scores = run(("term", "Title", "valve", "should", 0), ("wildcard", "Title", "slow*", "should", 0))
    assert scores[2] == round((idf**2 / math.sqrt(3) + 1) * query_norm, 6)
    assert scores[3] == round(idf**2 / math.sqrt(5) * query_norm / 2, 6)


def test_one_exchange_after_the_postings(title_index, ask):
    """Matching, scoring and the first ranking stay inside the shards; unneeded buckets are pruned."""
    top = fy.search_keywords(title_index, ask("valve"), 3)
    plan = top._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan and "dynamicpruning" in plan
    assert "positions" not in plan


def test_hits_get_their_stored_fields(title_index, ask):
    top = fy.search_keywords(title_index, ask("valve pressure", "pump"), 2)
    rows = fy.attach_stored(title_index, top, ["Title"]).collect()
    assert {(r["query_id"], r["rank"], r["Title"]) for r in rows} == {
        (1, 1, TITLES[0][1]), (1, 2, TITLES[3][1]), (2, 1, TITLES[2][1])
    }


def test_phrase_clause_over_all_fields(spark):
    rows = [(1, "red valve", "red valve"), (2, "red x", "y valve"), (3, "red valve", "valve red"), (4, "a pump", "b pump")]
    index = build(spark.createDataFrame(rows, "id int, one string, two string"), "id", ["one", "two"])

    def found(occur):
        clauses = spark.createDataFrame(
            [(1, 1, "phrase", None, "red valve", occur), (1, 2, "term", "one", "a", "should")],
            "query_id long, clause_id long, kind string, field string, text string, occur string",
        )
        return dict(hits(fy.search_boolean(index, clauses, 10))[1])

    must, should = found("must"), found("should")
    assert set(must) == {1, 3} and set(should) == {1, 3, 4}
    # Per field: idf of both words, each in fields of two words; the query norm holds both fields' phrases and the term.
    idf = lambda df: 1 + math.log(4 / (df + 1))
    one, two, term = idf(3) + idf(2), idf(2) + idf(3), idf(1)
    norm = 1 / math.sqrt(one**2 + two**2 + term**2)
    assert abs(must[3] - round(one**2 / math.sqrt(2) * norm / 2, 6)) < 1e-6
    assert abs(must[1] - round((one**2 + two**2) / math.sqrt(2) * norm / 2, 6)) < 1e-6


def test_a_repeated_phrase_word_needs_two_places(spark, ask):
    rows = [(1, "one valve here"), (2, "valve to valve"), (3, "valve valve")]
    index = build(spark.createDataFrame(rows, "id int, text string"), "id", ["text"])
    assert {d for d, _ in hits(fy.search_phrase(index, ask("valve valve"), "text", 9, slop=2))[1]} == {2, 3}
    assert {d for d, _ in hits(fy.search_phrase(index, ask("valve valve"), "text", 9))[1]} == {3}


def test_a_query_word_is_one_unit_in_unlike_fields(spark, ask):
    rows = [(1, "valve 锅炉压力", "锅炉压力 valve", "src6"), (2, "pump", "pump", "src6"), (3, "valve", "x", "src7")]
    table = spark.createDataFrame(rows, "id int, plain string, pairs string, source string")
    index = build(table, "id", ["plain", "pairs", "source"], analyzers={"pairs": an.han_bigrams, "source": an.whole})
    both = fy.search_keywords(index, ask("锅炉压力 valve", "valve src6", "压力 valve"), 9, operator="and")
    assert {q: [d for d, _ in found] for q, found in hits(both).items()} == {1: [1], 2: [1], 3: [1]}
    assert {d for d, _ in hits(fy.search_keywords(index, ask("valve src6"), 9))[1]} == {1, 2, 3}


def scanned(frame, table: str) -> tuple[int, str]:
    """Rows that came out of the scans of a table's files, after pages were skipped, and their plan."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    rows, text, left = 0, [], [plan]
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            left.append(node.plan())
            continue
        if name == "FileSourceScanExec" and table in node.toString():
            rows += node.metrics().apply("numOutputRows").value()
            text.append(node.verboseStringWithOperatorId())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return rows, "\n".join(text)


@pytest.fixture(scope="module")
def paged(spark, tmp_path_factory):
    """An index whose files have many small pages."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.page.row.count.limit", "100")
    conf.set("parquet.block.size", str(64 * 1024))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    store = fy.IndexStore(spark, str(tmp_path_factory.mktemp("paged") / "index"), shards=2, buckets=1)
    store.replace(docs, "doc_id", ["text"])
    yield store.open()
    conf.unset("parquet.page.row.count.limit")
    conf.unset("parquet.block.size")


def test_a_search_reads_the_blocks_of_its_terms(spark, paged, ask):
    postings = paged.postings.count()
    words = [r["term"] for r in paged.term_stats().filter("df BETWEEN 3 AND 9").orderBy("term").limit(400).collect()]
    reads = []
    for n in (2, 40, 400):
        frame = fy.search_keywords(paged, ask(" ".join(words[:n])), 3)
        rows, plan = scanned(frame, "_blocks_")
        reads.append(rows)
        assert "PushedFilters" in plan and "block" in plan
    assert 0 < reads[0] < postings / 20 and reads[0] < reads[1] < reads[2] <= postings
    phrase, plan = scanned(fy.search_phrase(paged, ask(" ".join(words[:2])), "text"), "_blocks_")
    assert phrase < postings / 20


def test_conditions_on_many_blocks_are_compiled(spark, paged):
    """Java runs methods above 8,000 bytes uncompiled, some twenty times slower."""
    from findery.plans import search

    frame = search._in_blocks(paged, list(range(0, 60_000, 7)))
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = debug.codegenStringSeq(frame._jdf.queryExecution().executedPlan())
    sizes = [parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())]
    assert sizes and max(sizes) < 8_000


def test_stored_rows_are_read_by_id(spark, paged, ask):
    queries = ask(*[r["term"] for r in paged.term_stats().filter("df < 4").orderBy("term").limit(10).collect()])
    top = fy.search_keywords(paged, queries, 3)
    frame = fy.attach_stored(paged, top, ["text"])
    rows, plan = scanned(frame, "_stored_")
    assert frame.count() == top.count() and rows < paged.doc_count and "EqualTo(doc_id" in plan


def test_many_ids_are_read_by_their_span(spark, title_index, ask, monkeypatch):
    from findery.plans import search

    want = sorted(map(tuple, fy.attach_stored(title_index, fy.search_keywords(title_index, ask("valve pressure the"), 9)).collect()), key=repr)
    monkeypatch.setattr(search, "PUSHED_IDS", 1)
    monkeypatch.setattr(search, "PUSHED_BLOCKS", 1)
    assert sorted(map(tuple, fy.attach_stored(title_index, fy.search_keywords(title_index, ask("valve pressure the"), 9)).collect()), key=repr) == want
    assert fy.attach_stored(title_index, fy.search_keywords(title_index, ask("nothing"), 9)).count() == 0


def test_a_prefix_reads_its_range_of_the_vocabulary(spark, paged, ask):
    from findery.operators.expand import wildcard_terms

    patterns = spark.createDataFrame([("text", "qu"), ("text", "we")], "field string, pattern string")
    found = wildcard_terms(patterns, paged.terms, prefix_only=True)
    rows, plan = scanned(found, "terms")
    want = {r["term"] for r in paged.term_stats().collect() if r["term"].startswith(("qu", "we"))}
    assert {r["term"] for r in found.collect()} == want and len(want) > 5
    assert "StringStartsWith(term,qu)" in plan and rows < paged.terms.count() / 3
    starred = wildcard_terms(spark.createDataFrame([("text", "qu*"), ("text", "w?e*")], "field string, pattern string"), paged.terms)
    assert "StringStartsWith(term,qu)" in scanned(starred, "terms")[1]


def test_patterns_match_as_written_and_few_by_regular_expressions(spark):
    dice = random.Random(3)
    terms = sorted({"".join(dice.choices("ab\u00e9\U0001f600.", k=dice.randint(1, 7))) for _ in range(300)})
    patterns = sorted({"".join(dice.choices("ab\u00e9.??**", k=dice.randint(0, 6))) for _ in range(150)} | {"", "*", "**", "?", "*a*", "a*b*a", "*?a*"})
    asked = spark.createDataFrame([("text", p) for p in patterns], "field string, pattern string")
    found = expand.wildcard_terms(asked, spark.createDataFrame([("text", t) for t in terms], "field string, term string"))
    want = set()
    for p in patterns:
        by = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in p), re.DOTALL)
        want |= {(p, t) for t in terms if by.fullmatch(t)}
    assert {(r["pattern"], r["term"]) for r in found.collect()} == want and len(want) > 500
    # What a pattern needs is worked out before it meets a term, and one star takes no regular expression.
    shaped = {r["pattern"]: r["regex"] for r in expand._shaped(asked).collect()}
    assert all((regex is None) == (len(re.findall(r"\*+", p)) <= 1) for p, regex in shaped.items())


def test_more_starts_than_can_be_pushed_are_shortened(spark, paged, monkeypatch):

    starts = sorted({r["term"][:3] for r in paged.term_stats().limit(300).collect() if len(r["term"]) > 3})
    patterns = spark.createDataFrame([("text", s) for s in starts], "field string, pattern string")
    want = {(r["pattern"], r["term"]) for r in expand.wildcard_terms(patterns, paged.terms, prefix_only=True).collect()}
    monkeypatch.setattr(expand, "PUSHED_STARTS", 3)
    assert {(r["pattern"], r["term"]) for r in expand.wildcard_terms(patterns, paged.terms, prefix_only=True).collect()} == want


def test_without_total_hits_the_ranking_is_limited(spark, title_index, ask):
    queries = ask("valve pressure the closes", "pump", "nothing")
    with_total = fy.search_keywords(title_index, queries, 2)
    without = fy.search_keywords(title_index, queries, 2, total=False)
    assert hits(without) == hits(with_total) and "total_hits" not in without.columns
    assert without._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_ranges_cover_all_values():
    from findery.runtime import ranges

    assert ranges([], 4) == [] and ranges([5], 4) == [(5, 5)]
    assert ranges([1, 2, 3, 10, 11, 50, 90], 3) == [(1, 11), (50, 50), (90, 90)]
    assert ranges([1, 2, 3, 10, 11, 50, 90], 9) == [(1, 3), (10, 11), (50, 50), (90, 90)]
    assert ranges([1, 5, 9], 1) == [(1, 9)]


def _scores_by_joins(index, clauses, kind, fields, slop=0):
    from findery.plans.search import score_clauses, top_hits

    return top_hits(score_clauses(index, clauses, [kind], many_clauses=False, many_fields=len(fields) > 1, max_slop=slop), 3)


@pytest.mark.parametrize("kind", ["terms", "and", "fields", "prefix", "wildcard", "fuzzy", "phrase", "slop"])
@pytest.mark.parametrize("small", [True, False])
def test_blocks_equal_joins(spark, ask, tmp_path, monkeypatch, kind, small):
    """Ranking by blocks of documents equals joins of queries and postings, also over several batches and replaced documents;
    equal texts are answered once, for every query."""
    from findery.plans import search

    rng = random.Random(3)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), text(3)) for i in range(300)]
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3, buckets=2)
    store.replace(spark.createDataFrame(rows[:250], "id int, one string, two string"), "id", ["one", "two"])
    store.upsert(spark.createDataFrame([(*r, 1) for r in rows[200:]], "id int, one string, two string, n int"), "n")
    index = store.open()
    name = {"and": "terms", "fields": "terms", "slop": "phrase"}.get(kind, kind)
    fields = ["one", "two"] if kind == "fields" else ["one"]
    asked = [text(1) if name in ("prefix", "fuzzy") else "*" + text(1)[:2] if name == "wildcard" else text(2 if kind == "and" else 3) for _ in range(20)]
    queries = ask(*asked, *asked[:5], "", "?*" if name == "wildcard" else words[0])
    clauses = search.make_clauses(queries, name, fields, operator="and" if kind in ("and", "fields") else "or", slop=4 if kind == "slop" else 0)
    want = _scores_by_joins(index, clauses, name, fields, 4 if kind == "slop" else 0)
    key = lambda r: (r["query_id"], r["rank"])
    want = [(*key(r), r["doc_id"], r["total_hits"], round(r["score"], 5)) for r in sorted(want.collect(), key=key)]
    if not small:
        monkeypatch.setattr(search, "measured", lambda df, *more: (False, *df.agg(*more).first()) if more else (False,))
    monkeypatch.setattr("findery.plans.ranking.CELLS", 64)
    monkeypatch.setattr("findery.plans.ranking.GATHERED", 50)
    got = search._search(index, clauses, name, 3, fields, True, 4 if kind == "slop" else 0)
    got = [(*key(r), r["doc_id"], r["total_hits"], round(r["score"], 5)) for r in sorted(got.collect(), key=key)]
    assert got == want and len({q for q, *_ in got}) > 5


def _random_index(spark, path, rng):
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60)), text(3)) for i in range(300)]
    store = fy.IndexStore(spark, path, shards=3, buckets=2)
    # Ten ids come twice.
    store.replace(spark.createDataFrame(rows[:250] + [(i, text(20), text(2)) for i in range(10)], "id int, one string, two string"), "id", ["one", "two"])
    store.upsert(spark.createDataFrame([(*r, 1) for r in rows[200:]], "id int, one string, two string, n int"), "n")
    return store.open(), text


def _as_rows(top):
    key = lambda r: (r["query_id"], r["rank"])
    return [(*key(r), r["doc_id"], r["total_hits"], round(r["score"], 5)) for r in sorted(top.collect(), key=key)]


@pytest.mark.parametrize(("kinds", "in_place"), [(None, False), (("phrase",), True), (("term", "prefix"), True)])
def test_boolean_blocks_equal_joins(spark, tmp_path, monkeypatch, kinds, in_place):
    """Boolean queries ranked by blocks of documents equal those joined with the postings, clause by clause."""
    from findery.plans import search

    rng = random.Random(5)
    index, text = _random_index(spark, str(tmp_path / "i"), rng)
    rows = []
    for query in range(40):
        for clause in range(rng.randint(1, 6)):
            kind = rng.choice(kinds or search.KINDS)
            asked = {"terms": text(3), "phrase": text(2), "wildcard": "*" + text(1)[:2] + "?*", "prefix": text(1)[:2]}.get(kind, text(1))
            occur = rng.choice(["should", "should", "must", "must_not"])
            rows.append((query, clause, kind, rng.choice(["one", "two", None]), asked, occur, rng.choice([0, 0, 2]), rng.choice(["or", "and"])))
    rows += [(100, 0, rows[0][2], "one", "", "should", 0, "or"), (101, 0, rows[0][2], "one", "nothing", "must", 0, "or")]
    schema = "query_id long, clause_id long, kind string, field string, text string, occur string, slop int, operator string"
    clauses = spark.createDataFrame(rows, schema)
    full = search._full_clauses(index, clauses)
    asked = [k for k in search.KINDS if k in {r[2] for r in rows}]
    want = _as_rows(search.top_hits(search.score_clauses(index, full, asked, many_clauses=True, many_fields=True, max_slop=2), 3))
    monkeypatch.setattr("findery.plans.ranking.CELLS", 1 << 10)
    monkeypatch.setattr("findery.plans.ranking.GATHERED", 50)
    if not in_place:
        monkeypatch.setattr(search, "fits_broadcast", lambda df: False)
    top = fy.search_boolean(index, clauses, 3)
    assert _as_rows(top) == want and len({q for q, *_ in want}) > 10
    assert "MapInArrow" in top._jdf.queryExecution().executedPlan().toString()
    if kinds is not None:
        return
    # More clauses than a task may know are joined.
    monkeypatch.setattr(search, "MOST_CLAUSES", 1)
    top = fy.search_boolean(index, clauses, 3)
    assert _as_rows(top) == want and "MapInArrow" not in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("kind", "in_place"), [("prefix", False), ("wildcard", True)])
def test_terms_of_many_patterns_share_lists(spark, ask, tmp_path, monkeypatch, kind, in_place):
    from findery.plans import search

    rng = random.Random(7)
    index, text = _random_index(spark, str(tmp_path / "i"), rng)
    queries = ask(*[text(1)[:2] + ("*" if kind == "wildcard" else "") for _ in range(30)], "")
    clauses = search.make_clauses(queries, kind, ["one"])
    want = _as_rows(search._search(index, clauses, kind, 3, ["one"], True))
    real, rows = search.measured, []
    monkeypatch.setattr(search, "measured", lambda df, *more: (False, *real(df, *more)[1:]) if "boost" in df.columns else real(df, *more))
    monkeypatch.setattr(search, "_listed", None)
    if not in_place:
        monkeypatch.setattr(search, "fits_broadcast", lambda df: rows.append(df) or False)
    assert _as_rows(search._search(index, clauses, kind, 3, ["one"], True)) == want and len(want) > 5
    assert in_place or rows


def test_common_words_make_no_row_per_query(spark, ask, tmp_path):
    """What is sorted and shuffled grows with the postings, not with the queries that share their terms."""
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2, buckets=1)
    store.replace(spark.createDataFrame([(i, "valve pump" + f" w{i}" * (i % 3)) for i in range(200)], "id int, text string"), "id", ["text"])
    top = fy.search_keywords(store.open(), ask(*[f"valve x{i}" for i in range(50)]), 3)
    assert {r["total_hits"] for r in top.collect()} == {200}
    plan, rows, left = top._jdf.queryExecution().executedPlan(), [], []
    left.append(plan)
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            left.append(node.plan())
            continue
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined():
            rows.append(metric.get().value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    assert max(rows) <= 1_000  # 200 postings of the word, 50 queries
