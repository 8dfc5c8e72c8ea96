from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("findery-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


TITLES = [
    (1, "boiler pressure rises when the valve closes"),
    (2, "valve closes slowly"),
    (3, "the pump and the valve"),
    (4, "pressure gauge reads low pressure"),
    (5, "锅炉压力升高"),
]


@pytest.fixture(scope="session")
def titles(spark):
    return spark.createDataFrame(TITLES, "Allid int, Title string")


@pytest.fixture(scope="session")
def title_index(spark, titles, tmp_path_factory):
    import findery as fy

    store = fy.IndexStore(spark, str(tmp_path_factory.mktemp("titles") / "index"), shards=3, buckets=4)
    store.replace(titles, "Allid", ["Title"])
    return store.open()


@pytest.fixture(scope="session")
def ask(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts, 1)), "query_id bigint, text string")

    return make


def hits(top) -> dict:
    """query_id -> [(doc_id, score), …] in rank order."""
    found: dict = {}
    for row in sorted(top.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(row["query_id"], []).append((row["doc_id"], row["score"]))
    return found
