"""Statistics, appends, updates, versions and streams."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import findery as fy
from conftest import SMALL, hits
from findery.functions.analysis import words
from findery.operators import binding as bd
from findery.plans.index import append, build, upsert
from findery.streaming.standing import maintain_index, standing_search


def stats(index):
    return {(r["term"], r["df"], r["total_tf"]) for r in index.term_stats().collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")


@pytest.fixture(scope="module")
def changes(docs):
    """Changes to known and new documents; the greatest number of a key counts."""
    first = docs.filter("lang = 'de'").select("doc_id", F.lit("early").alias("text"), "lang", F.lit(1).cast("long").alias("seq"))
    second = docs.filter("lang in ('de', 'fr')").select("doc_id", F.lit("zeta changed text").alias("text"), "lang", F.lit(2).cast("long").alias("seq"))
    new = docs.filter("lang = 'es'").select((F.col("doc_id") + 10_000_000).alias("doc_id"), F.lit("zeta new").alias("text"), "lang", F.lit(1).cast("long").alias("seq"))
    return first.unionByName(second).unionByName(new)


@pytest.fixture(scope="module")
def changed_docs(docs, changes):
    latest = changes.filter("seq = 2 or doc_id >= 10000000").drop("seq")
    return docs.join(latest, "doc_id", "left_anti").unionByName(latest)


@pytest.fixture(scope="module")
def rebuilt(changed_docs):
    index = build(changed_docs, "doc_id", ["text"])
    return stats(index), index.doc_count


def test_statistics_by_hand(title_index):
    found = {(r["term"]): (r["df"], r["total_tf"]) for r in title_index.term_stats().collect()}
    assert found["pressure"] == (2, 3) and found["the"] == (2, 3) and found["锅炉压力升高"] == (1, 1)
    assert title_index.doc_count == 5


def test_append_equals_rebuild(spark, docs, tmp_path):
    whole = build(docs, "doc_id", ["text"])
    base, more = docs.filter("lang <> 'en'"), docs.filter("lang = 'en'")
    added = append(build(base, "doc_id", ["text"]), more, batch=1)
    assert stats(added) == stats(whole) and added.doc_count == whole.doc_count
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3, buckets=2)
    first = store.replace(base, "doc_id", ["text"])
    store.append(more)
    saved = store.open()
    assert stats(saved) == stats(whole) and saved.doc_count == whole.doc_count
    queries = spark.read.parquet(f"{SMALL}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    assert hits(fy.search_keywords(saved, queries, 3)) == hits(fy.search_keywords(whole, queries, 3))
    assert store.open(first).doc_count == base.count()


def test_upsert_equals_rebuild(docs, changes, rebuilt):
    index = upsert(build(docs, "doc_id", ["text"]), changes, "seq", batch=1)
    assert (stats(index), index.doc_count) == rebuilt


def test_stored_upsert_is_idempotent_and_survives_compaction(spark, docs, changes, changed_docs, rebuilt, ask, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3, buckets=2)
    old = store.replace(docs, "doc_id", ["text"])
    queries = ask("zeta", "early", "changed new the la")
    want = hits(fy.search_keywords(build(changed_docs, "doc_id", ["text"]), queries, 5))
    for _ in range(2):
        store.upsert(changes, "seq")
        index = store.open()
        assert (stats(index), index.doc_count) == rebuilt
        assert index.documents().count() == rebuilt[1]
        assert hits(fy.search_keywords(index, queries, 5)) == want
    store.compact()
    index = store.open()
    assert index.removed is None and (stats(index), index.doc_count) == rebuilt
    assert hits(fy.search_keywords(index, queries, 5)) == want
    assert store.open(old).doc_count == docs.count()


def test_open_in_a_session_that_does_not_know_the_tables(spark, titles, ask, tmp_path):
    root = str(tmp_path / "i")
    store = fy.IndexStore(spark, root, shards=3, buckets=4)
    store.replace(titles, "Allid", ["Title"])
    want = hits(fy.search_keywords(store.open(), ask("valve pressure"), 5))
    for table in spark.catalog.listTables():
        if table.name.startswith(store._prefix):
            spark.sql(f"DROP TABLE {table.name}")
    again = fy.IndexStore(spark, root)
    assert hits(fy.search_keywords(again.open(), ask("valve pressure"), 5)) == want
    again.append(spark.createDataFrame([(6, "valve pressure")], "Allid int, Title string"))
    assert hits(fy.search_keywords(again.open(), ask("valve pressure"), 1))[1][0][0] == 6


def test_unpublished_batches_stay_invisible(spark, titles, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3)
    store.replace(titles, "Allid", ["Title"])
    settings = store._settings(store._version_rows(), titles, "Allid", ["Title"], None)
    store._write_documents(titles, settings, 1)
    assert store.open().documents().count() == 5


def test_a_second_writer_fails_when_it_publishes(spark, titles, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(titles, "Allid", ["Title"])
    seen = store._version_rows()
    store.append(spark.createDataFrame([(6, "new")], "Allid int, Title string"))
    with pytest.raises(Exception, match="another writer"):
        store._publish(seen, [])
    assert store.open().doc_count == 6


def test_build_shuffles_the_records_once(titles):
    index = build(titles, "Allid", ["Title"])
    plan = index.postings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_shards_are_balanced(spark):
    from findery.plans.index import Layout

    layout = Layout.of(spark, 24, 1)
    placed = spark.range(24_000).select(layout.shard(F.col("id")).alias("shard")).repartition(24, "shard")
    sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 24 and max(sizes) < 1_300


def test_missing_field_fails_early(titles):
    with pytest.raises(ValueError, match="Choosea"):
        build(titles, "Allid", ["Choosea"])


def test_standing_search_equals_batch(spark, title_index, ask, tmp_path):
    folder = str(tmp_path / "queries")
    queries = ask("valve pressure", "pump", "closes")
    queries.repartition(3).write.parquet(folder)
    def search(index, batch):
        return fy.search_keywords(index, batch, 3)
    output = str(tmp_path / "answers")
    def run(progress):
        arriving = spark.readStream.schema(queries.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        standing_search(arriving, title_index, search, output, str(tmp_path / progress)).awaitTermination()
        return hits(spark.read.parquet(output))
    want = hits(search(title_index, queries))
    assert run("progress") == want
    assert run("again") == want  # the same batches answered anew


def test_maintained_index_equals_batch_and_skips_replays(spark, docs, changes, rebuilt, tmp_path):
    folder = str(tmp_path / "changes")
    changes.orderBy("seq").coalesce(1).write.parquet(folder)
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3)
    store.replace(docs, "doc_id", ["text"])
    for progress in ("progress", "again"):
        arriving = spark.readStream.schema(changes.schema).parquet(folder)
        maintain_index(arriving, store, "seq", "feed", str(tmp_path / progress)).awaitTermination()
        index = store.open()
        assert (stats(index), index.doc_count) == rebuilt
        assert store.latest_version() == 2


_APPEND = """
import sys
sys.path.insert(0, sys.argv[1])
import findery as fy
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[3])
    .config("spark.sql.warehouse.dir", sys.argv[3]).config("spark.sql.shuffle.partitions", "2").getOrCreate())
fy.IndexStore(spark, sys.argv[2]).append(spark.createDataFrame([(6, "valve pressure"), (7, "new valve")], "Allid int, Title string"))
"""


def test_batches_of_another_application_are_found(spark, titles, ask, tmp_path):
    root = str(tmp_path / "i")
    store = fy.IndexStore(spark, root, shards=2, buckets=2)
    store.replace(titles, "Allid", ["Title"])
    store.open()
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", _APPEND, here, root, str(tmp_path / "other")], check=True, capture_output=True, timeout=300)
    index = store.open()
    assert index.doc_count == index.documents().count() == 7
    assert hits(fy.search_keywords(index, ask("valve pressure"), 1))[1][0][0] == 6
    store.upsert(spark.createDataFrame([(7, "gauge", 1)], "Allid int, Title string, seq int"), "seq")
    store.compact()
    index = store.open()
    assert index.doc_count == index.documents().count() == 7
    assert not hits(fy.search_keywords(index, ask("new"), 1))


def test_compact_refuses_to_lose_documents(spark, titles, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    version = store.replace(titles, "Allid", ["Title"])
    rows = store._version_rows()
    store._publish(rows, [{**rows[0].asDict(), "docs": rows[0]["docs"] + 1}])
    with pytest.raises(RuntimeError, match="nothing was published"):
        store.compact()
    assert store.latest_version() == version + 1


def test_versions_are_ordered_without_clocks(spark, titles, ask, tmp_path, monkeypatch):
    """Batches with ever smaller names, as writers with slow clocks once gave them, open, update and compact."""
    from findery.plans import store as stores

    names = iter([900, 500, 300, 100, 50])
    monkeypatch.setattr(stores, "_new_batch", lambda: next(names))
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(titles, "Allid", ["Title"])
    store.append(spark.createDataFrame([(6, "late valve")], "Allid int, Title string"))
    index = store.open()
    assert index.doc_count == 6 and [r["batch"] for r in store._version_rows()] == [900, 500]
    store.upsert(spark.createDataFrame([(6, "later pump", 1), (7, "gauge", 1)], "Allid int, Title string, seq int"), "seq", stream="feed", stream_batch=3)
    assert store.upsert(spark.createDataFrame([(6, "x", 9)], "Allid int, Title string, seq int"), "seq", stream="feed", stream_batch=3) == 3
    store.append(spark.createDataFrame([(8, "new valve")], "Allid int, Title string"))
    assert {r["Allid"]: r["Title"] for r in store.open().documents().filter("Allid > 5").collect()} == {6: "later pump", 7: "gauge", 8: "new valve"}
    store.compact()
    index = store.open()
    assert index.doc_count == index.documents().count() == 8 and index.removed is None
    assert not hits(fy.search_keywords(index, ask("late"), 3)) and hits(fy.search_keywords(index, ask("later"), 3))[1][0][0] == 6


def files(root) -> int:
    return sum(name.endswith(".parquet") for _, _, names in os.walk(root) for name in names)


def test_small_batches_are_merged(spark, titles, ask, tmp_path, monkeypatch):
    from findery.plans import store as stores

    monkeypatch.setattr(stores, "FANOUT", 3)
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2, buckets=4)
    store.replace(titles, "Allid", ["Title"])
    live = {r["Allid"]: (r["Title"], 0) for r in titles.collect()}
    known = []
    for k in range(11):
        rows = [(6 + k, f"valve number{k}", k), (1 + k % 4, f"changed pump {k}", k), (5 + k // 2, f"again {k}", k)]
        store.upsert(spark.createDataFrame(rows, "Allid int, Title string, seq int"), "seq")
        live |= {key: (text, k) for key, text, _ in rows}
        known.append(len(store._version_rows()))
    assert max(known) <= 1 + 2 * 3
    index = store.open()
    assert {r["Allid"]: r["Title"] for r in index.documents().collect()} == {key: text for key, (text, _) in live.items()}
    whole = build(spark.createDataFrame([(key, text) for key, (text, _) in live.items()], "Allid int, Title string"), "Allid", ["Title"])
    assert stats(index) == stats(whole) and index.doc_count == whole.doc_count == len(live)
    queries = ask("valve pressure", "pump again", "changed number3")
    want = hits(fy.search_keywords(whole, queries, 9))
    assert hits(fy.search_keywords(index, queries, 9)) == want
    before = files(tmp_path)
    gone = store.vacuum(older_than=0)
    assert gone and files(tmp_path) < before / 2 and store.versions() == [store.latest_version()]
    assert hits(fy.search_keywords(store.open(), queries, 9)) == want
    again = fy.IndexStore(spark, store.root)
    assert hits(fy.search_keywords(again.open(), queries, 9)) == want
    again.compact()
    assert hits(fy.search_keywords(again.open(), queries, 9)) == want and again.open().summed


def test_merging_keeps_what_was_removed_elsewhere(spark, titles, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(titles, "Allid", ["Title"])
    for k in range(2):
        store.upsert(spark.createDataFrame([(1 + k, f"new {k}", 1)], "Allid int, Title string, seq int"), "seq")
    rows = store._version_rows()
    store.merge([r["batch"] for r in rows[1:]])
    merged = store._version_rows()
    assert len(merged) == 2 and merged[1]["removes"] and store.open().documents().count() == store.open().doc_count == 5
    store.merge([r["batch"] for r in merged])
    index = store.open()
    assert index.removed is None and index.documents().count() == index.doc_count == 5
    assert {"boiler", "slowly", "new"} & {r["term"] for r in index.term_stats().collect()} == {"new"}


def test_old_enough_folders_go_and_young_ones_stay(spark, titles, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(titles, "Allid", ["Title"])
    store._write_documents(titles, stores_settings(store), 77)
    store.append(spark.createDataFrame([(6, "new")], "Allid int, Title string"))
    assert store.vacuum(keep=2) == [] and store.versions() == [1, 2]
    gone = store.vacuum(keep=2, older_than=0)
    assert gone and all(name.endswith("/batch=77") for name in gone) and store.open(1).documents().count() == 5
    with pytest.raises(ValueError, match="at least one"):
        store.vacuum(keep=0)


def stores_settings(store):
    from findery.plans.store import _settings_of

    return _settings_of(store._version_rows())


def test_opening_knows_only_named_partitions(spark, titles, tmp_path):
    root = str(tmp_path / "i")
    store = fy.IndexStore(spark, root, shards=2, buckets=16)
    store.replace(titles, "Allid", ["Title"])
    store.append(spark.createDataFrame([(6, "new valve")], "Allid int, Title string"))
    store._write_documents(titles, stores_settings(store), 77)
    for table in spark.catalog.listTables():
        if table.name.startswith(store._prefix):
            spark.sql(f"DROP TABLE {table.name}")
    again = fy.IndexStore(spark, root)
    again.open()
    rows = again._version_rows()
    parts = {t.name: {r[0] for r in spark.sql(f"SHOW PARTITIONS {t.name}").collect()} for t in spark.catalog.listTables() if t.name.startswith(store._prefix)}
    wanted = {f"batch={rows[0]['batch']}/bucket={b}" for b in rows[0]["buckets"]}
    assert sorted(map(len, parts.values())) == sorted([2, 1, len(wanted)]) and wanted in parts.values() and 1 < len(wanted) < 16


def test_both_layouts_keep_their_placement(spark, titles, ask, tmp_path):
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=3, buckets=2)
    store.replace(titles, "Allid", ["Title"])
    alone = plan_of(fy.search_keywords(store.open(), ask("valve pressure"), 3))
    store.append(spark.createDataFrame([(6, "new valve")], "Allid int, Title string"))
    both = plan_of(fy.search_keywords(store.open(), ask("valve pressure"), 3))
    assert "Union" in both and both.count("Exchange hashpartitioning") == alone.count("Exchange hashpartitioning")


def plan_of(frame) -> str:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan[plan.rfind("Initial Plan") :] if "Initial Plan" in plan else plan


def test_newer_changes_win_in_any_order_and_marks_survive(spark, titles, tmp_path):
    def change(text, seq):
        return spark.createDataFrame([(1, text, seq)], "Allid int, Title string, seq int")

    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(titles, "Allid", ["Title"])
    store.upsert(change("nine", 9), "seq", stream="feed", stream_batch=4)
    store.upsert(change("three", 3), "seq")
    store.compact()
    store.upsert(change("eight", 8), "seq")
    version = store.latest_version()
    assert store.upsert(change("ten", 10), "seq", stream="feed", stream_batch=4) == version
    text = {r["Allid"]: r["Title"] for r in store.open().documents().collect()}
    assert text[1] == "nine" and len(text) == 5
    index = upsert(upsert(build(titles, "Allid", ["Title"]), change("nine", 9), "seq", batch=1), change("three", 3), "seq", batch=2)
    assert {r["Title"] for r in index.documents().filter("Allid = 1").collect()} == {"nine"} and index.doc_count == 5


def test_fields_that_are_indexed_only(spark, ask, tmp_path):
    rows = spark.createDataFrame([(1, "red valve", "hidden words"), (2, "pump", "more")], "id int, shown string, kept_out string")
    store = fy.IndexStore(spark, str(tmp_path / "i"), shards=2)
    store.replace(rows, "id", ["shown", "kept_out"], ["id", "shown"])
    index = store.open()
    top = fy.search_keywords(index, ask("hidden"), 3, fields="kept_out")
    assert [r.asDict() for r in fy.attach_stored(index, top).select("id", "shown").collect()] == [{"id": 1, "shown": "red valve"}]
    with pytest.raises(ValueError, match="kept_out"):
        store.compact()


def test_indexing_an_unbound_field_fails_early(spark):
    records = bd.bind(spark.createDataFrame([("1", "x")], "allid string, answer string"), bd.QUESTION)
    with pytest.raises(ValueError, match="Title"):
        build(records, "Allid", ["Title"])


def test_a_shard_holds_text_that_a_task_sorts_in_memory(spark):
    """64 MB of text, of which a task sorts the postings of one shard: they take some 15 times the text."""
    from findery.plans.index import Layout

    texts = spark.range(64).select(F.col("id").alias("doc_id"), F.repeat(F.lit("words of a text "), 65_536).alias("text"))
    assert Layout.sized(texts, ["text"], None, None).shards == 8


def test_texts_are_analyzed_once_for_their_postings(spark):
    from findery.plans.index import Layout, make_postings

    docs = spark.createDataFrame([(1, 1, 1, "b a b"), (1, 1, 2, "--"), (1, 1, 3, None)], "shard int, batch long, doc_id long, text string")
    made = make_postings(docs, ["text"], Layout.of(spark, 1, 1), {}, words, distinct=True)
    assert sorted((r["doc_id"], r["term"], r["positions"], r["length"]) for r in made.collect()) == [(1, "a", [1], 3), (1, "b", [0, 2], 3)]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
