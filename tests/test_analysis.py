"""Analyzers and segmentation."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import findery as fy
from findery import runtime
from findery.functions import analysis as an
from findery.operators import tokens as tk
from findery.operators.segment import Segmenter, segment, units


def analyzed(spark, analyzer, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["x"] for r in df.select("i", analyzer(F.col("t")).alias("x")).orderBy("i").collect()]


def test_words(spark):
    assert analyzed(spark, an.words, "The Pump-2, Élan!", "", None) == [["the", "pump", "2", "élan"], [], None]


def test_stop_words_keep_positions(spark):
    analyzer = an.without_stop_words(an.words, ["the", "and"])
    assert analyzed(spark, analyzer, "the pump and the valve") == [[None, "pump", None, None, "valve"]]
    df = spark.createDataFrame([(1, "the pump and the valve")], "i int, t string").select("i", analyzer(F.col("t")).alias("tokens"))
    assert [tuple(r) for r in tk.explode_tokens(df, ["i"]).collect()] == [(1, 1, "pump"), (1, 4, "valve")]


def test_stop_word_table(spark):
    rows = spark.createDataFrame([(1, 0, "the"), (1, 1, "pump")], "i int, pos int, term string")
    stop = spark.createDataFrame([("the",), ("and",)], "term string")
    assert [tuple(r) for r in tk.remove_stop_words(rows, stop).select("i", "pos", "term").collect()] == [(1, 1, "pump")]


def test_limit_counts_kept_tokens(spark):
    analyzer = an.limited(an.without_stop_words(an.words, ["the"]), 2)
    assert analyzed(spark, analyzer, "the a the b the c", "a", "", "the the") == [[None, "a", None, "b"], ["a"], [], [None, None]]


def test_codes(spark):
    analyzer = an.keeping_codes(["AB-1200", "QX 77", "AB"])
    assert analyzed(spark, analyzer, "an ab-1200 and QX 77x, ab") == [["an", "ab-1200", "and", "qx", "77x", "ab"]]


def test_normalized_queries(spark):
    assert analyzed(spark, an.normalized, "Valve, Pump!", " -- ", "") == ["valve pump ", "", ""]


def test_bigrams(spark):
    assert analyzed(spark, an.han_bigrams, "锅炉压力 ab12 水x火土") == [["锅炉", "炉压", "压力", "ab12", "水", "x", "火土"]]


def test_per_field(spark):
    df = spark.createDataFrame([("a", "X Y"), ("b", "X Y")], "field string, text string")
    rows = tk.analyze(df, {"a": an.whole}).orderBy("field").collect()
    assert [r["tokens"] for r in rows] == [["X Y"], ["x", "y"]]


DICTIONARY = ["试题", "标题", "题标", "试题标", "AB-1200", "QX 77", "锅", "  升高 。"]


@pytest.fixture(params=["broadcast", "shuffle"])
def sides(request, monkeypatch):
    """The same joins with and without broadcasts."""
    if request.param == "shuffle":
        monkeypatch.setattr(runtime, "BROADCAST_MAX_ROWS", -1)
    return request.param


def test_segmentation(spark, sides):
    texts = ["试题标题甲", "用 AB-1200 试题, 标题 x", "", None, "QX 77 qx  77 ab-1200b 题标题", "升高。升,高"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    words = spark.createDataFrame([(w,) for w in DICTIONARY], "word string")
    rows = segment(df, ["i"], "t", words).orderBy("i").collect()
    assert [r["tokens"] for r in rows] == [
        ["试题标", "题", "甲"],
        ["用", "ab-1200", "试题", "标题", "x"],
        [],
        None,
        ["qx 77", "qx", "77", "ab", "1200b", "题标", "题"],
        ["升高", "升", "高"],
    ]


def _longest_match(text: str, words: set[str]) -> list[str]:
    tokens, at = [], 0
    while at < len(text):
        n = max((n for n in range(1, len(text) - at + 1) if n == 1 or text[at : at + n] in words))
        tokens.append(text[at : at + n])
        at += n
    return tokens


def test_segmentation_against_brute_force(spark, sides):
    rng = random.Random(3)
    texts = ["".join(rng.choice("天地玄黄") for _ in range(rng.choice([0, 1, 5, 700]))) for _ in range(25)]
    words = {"".join(rng.choice("天地玄黄") for _ in range(rng.randint(2, 6))) for _ in range(40)}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    want = [_longest_match(t, words) for t in texts]
    rows = segment(df, ["i"], "t", table).orderBy("i").collect()
    assert [r["tokens"] for r in rows] == want


def test_segmentation_of_words_against_brute_force(spark, sides):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "ab", "b", "1", " ", "-", " a "]) for _ in range(rng.choice([0, 1, 4, 300]))) for _ in range(25)]
    words = {"".join(rng.choice(["a", "ab", "b", "1", " ", "-"]) for _ in range(rng.randint(2, 7))).strip(" -") for _ in range(60)}

    def tokens(text):
        parts, found, at = re.findall("[a-z0-9]+[^a-z0-9]*", text), [], 0
        while at < len(parts):
            tried = ((n, "".join(parts[at : at + n]).rstrip(" -")) for n in range(len(parts) - at, 0, -1))
            n, token = next((n, t) for n, t in tried if n == 1 or t in words)
            found.append(token)
            at += n
        return found

    table = spark.createDataFrame([(w,) for w in words], "word string")
    rows = segment(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), ["i"], "t", table).orderBy("i").collect()
    assert [r["tokens"] for r in rows] == [tokens(t) for t in texts]


def test_places_meet_few_lengths(spark):
    """Entries of many lengths that share their first two signs do not make a row per place and length."""
    rng = random.Random(4)
    words = {"天地" + "".join(rng.choice("玄黄宇宙洪荒") for _ in range(n % 12)) for n in range(60)}
    segmenter = Segmenter(spark.createDataFrame([(w,) for w in words], "word string"))
    texts = spark.createDataFrame([(1, "天地日月" * 500)], "i int, t string")
    assert segmenter._begun(texts.select("i", units(F.col("t")).alias("_units")), ["i"]).count() <= 500
    assert segmenter.tokens(texts, ["i"], "t").first()["tokens"] == ["天地", "日", "月"] * 500


def test_index_and_search_by_a_dictionary(spark, sides, tmp_path):
    talks = spark.createDataFrame([(1, "天地玄黄宇宙", "天地 x"), (2, "玄黄天地", "y"), (3, "地玄", None)], "id int, han string, plain string")
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2, buckets=2, analyzers={"han": Segmenter(spark.createDataFrame([("天地",), ("玄黄宇",), ("玄黄",)], "word string"))})
    store.replace(talks, "id", ["han", "plain"])
    index = store.open()
    terms = {(r["field"], r["term"]): r["df"] for r in index.term_stats().collect()}
    assert terms == {("han", "天地"): 2, ("han", "玄黄宇"): 1, ("han", "玄黄"): 1, ("han", "宙"): 1, ("han", "地"): 1, ("han", "玄"): 1, ("plain", "天地"): 1, ("plain", "x"): 1, ("plain", "y"): 1}
    queries = spark.createDataFrame([(1, "玄黄天地"), (2, "地"), (3, "玄黄宇 宙 x")], "query_id bigint, text string")
    found = fy.search_keywords(index, queries, 5, fields="han", operator="and").collect()
    assert {(r["query_id"], r["doc_id"]) for r in found} == {(1, 2), (2, 3)}
    both = fy.search_keywords(index, queries, 5, operator="and").collect()
    assert {(r["query_id"], r["doc_id"]) for r in both} == {(1, 2), (2, 3), (3, 1)}
    assert [r["doc_id"] for r in fy.search_phrase(index, queries.filter("query_id = 1"), "han").collect()] == [2]
    store.upsert(spark.createDataFrame([(3, "玄黄宇", "z", 1)], "id int, han string, plain string, seq int"), "seq")
    assert {r["doc_id"] for r in fy.search_term(store.open(), spark.createDataFrame([(1, "玄黄宇")], "query_id bigint, text string"), "han").collect()} == {1, 3}


def test_a_dictionary_of_a_million_entries(spark):
    han = "".join(chr(0x4E00 + k) for k in range(100))
    sign = lambda n: F.substring(F.lit(han), (F.floor(F.col("id") / n) % 100 + 1).cast("int"), F.lit(1))
    words = spark.range(1_000_000, numPartitions=4).select(F.concat(sign(1), sign(100), sign(10_000)).alias("word"))
    rng = random.Random(1)
    texts = ["".join(rng.choice(han) for _ in range(n)) for n in (0, 1, 2, 3, 8, 300)]
    rows = segment(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), ["i"], "t", words).orderBy("i").collect()
    assert [r["tokens"] for r in rows] == [[t[k : k + 3] for k in range(0, len(t) - len(t) % 3, 3)] + list(t[len(t) - len(t) % 3 :]) for t in texts]


def test_segmentation_runs_no_python(spark):
    df = spark.createDataFrame([(1, "天地")], "i int, t string")
    plan = segment(df, ["i"], "t", spark.createDataFrame([("天地",)], "word string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_postings_of_a_row_equal_the_grouping(spark):
    from findery.operators.tokens import explode_tokens, postings_in_rows, postings_of

    rows = [(1, ["b", "a", None, "b", "c"]), (2, []), (3, [None]), (4, None), (5, ["x"]), (6, ["q"] * 30 + [None, "p", "q"])]
    table = spark.createDataFrame(rows, "id int, tokens array<string>")
    want = postings_of(explode_tokens(table, ["id"]), ["id"]).select("id", "term", "tf", "positions")
    got = postings_in_rows(table, ["id"])
    key = lambda r: (r["id"], r["term"])
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_postings_of_rows_come_in_the_order_of_an_index(spark):
    from findery.operators.tokens import postings_in_rows
    from findery.plans.index import Layout

    rows = [(i, f, [f"w{(i * k) % 97}" for k in range(60)] + [None, "", "é" * 40]) for i in range(40) for f in ("text", "lang")]
    table = spark.createDataFrame(rows, "id int, field string, tokens array<string>").coalesce(1)
    found = postings_in_rows(table, ["id", "field"])
    got = [tuple(r) for r in found.select("field", Layout.block(F.col("field"), F.col("term")).alias("block"), "term", "id").collect()]
    assert len(got) == len({(g[0], g[2], g[3]) for g in got}) > 2000
    for field in ("text", "lang"):
        own = [g[1:] for g in got if g[0] == field]
        assert own == sorted(own, key=lambda g: (g[0], g[1].encode(), g[2]))
    assert "lambda" not in found._jdf.queryExecution().analyzed().toString()
