"""Times index building and batch search; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import findery as fy


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="findery-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("findery-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    queries = spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    n_queries = queries.count()
    short = queries.withColumn("text", F.array_join(F.slice(F.split("text", " "), 1, 3), " "))
    first_word = queries.withColumn("text", F.lower(F.element_at(F.split("text", " "), 1)))
    seconds: dict[str, float] = {}

    def timed(name: str, run, repeat: int = 2) -> None:
        for _ in range(repeat):
            start = time.perf_counter()
            run()
            seconds[name] = round(time.perf_counter() - start, 3)

    folders = iter(range(100))
    stores = []

    def build() -> None:
        store = fy.IndexStore(spark, f"{fy.runtime.shared_folder(spark)}/index-{next(folders)}", shards=int(cpus))
        store.replace(docs, "doc_id", ["text"])
        stores.append(store)

    timed("index_build", build)
    index = stores[-1].open()
    timed("search_or", lambda: drain(fy.search_keywords(index, queries)))
    timed("search_and", lambda: drain(fy.search_keywords(index, short, operator="and")))
    timed("search_prefix", lambda: drain(fy.search_prefix(index, first_word, "text")))
    timed("search_wildcard", lambda: drain(
        fy.search_wildcard(index, first_word.withColumn("text", F.concat(F.lit("*"), F.right("text", F.lit(3)))), "text")))
    timed("search_fuzzy", lambda: drain(fy.search_fuzzy(index, first_word, "text")))
    timed("search_phrase", lambda: drain(fy.search_phrase(index, short, "text", slop=2)))
    timed("hits_hydrated", lambda: drain(fy.attach_stored(index, fy.search_keywords(index, queries))))
    seconds["search_or_per_1000_queries"] = round(seconds["search_or"] * 1000 / n_queries, 3)
    total = round(sum(v for k, v in seconds.items() if "per_1000" not in k), 3)
    print(json.dumps({
        "metric": "index build and batch search, warm", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")), "documents": docs.count(), "query_count": n_queries, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
