"""An index on shared storage: plain parquet tables and a list of versions.

A write adds a *batch* to the tables and then publishes a version, which names the batches that are
visible. Readers pin a version. A batch that was never published (a failed attempt) is never read,
so a job can be lost and repeated at any point. Tables are named by their layout, so building anew may
choose another one.

Versions and the rows of a version are counted, not timed: a batch's number is only a name, and its place
among the others is one more than the last one's. A version also says which partitions each batch has,
so a reader makes exactly those known and lists no folder of the tables.

A batch of few documents goes to a layout of its own that does not split it by term bucket. Where
``FANOUT`` of such batches are of about the same size they are merged to one, so the number of batches
and files a reader meets grows with the logarithm of the writes. ``vacuum`` removes what no kept version names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findery.functions.analysis import Analyzer, words
from findery.plans.index import (
    DOC,
    POSTING_COLUMNS,
    SEQ,
    Layout,
    TextIndex,
    latest_per_key,
    make_postings,
    make_terms,
    negated,
    newer_than_live,
    postings_of_versions,
    replaced_versions,
    sharded,
    without_removed,
)
from findery.runtime import broadcast_if_small, cut

# A batch of fewer documents is small; so many small ones of about the same size are merged.
SMALL_DOCS = 100_000
FANOUT = 8

# ``settings`` and ``streams`` (the last batch applied of each stream) stand in one row of a version, that of the last write.
# ``place`` orders the rows, ``docs`` is what the batch adds to the document count, ``written`` how many rows it holds.
_VERSION = (
    "batch bigint, docs bigint, removes boolean, settings string, streams map<string, bigint>, place int, written bigint, "
    "buckets array<int>, small boolean"
)
_TERMS = "field string, term string, df bigint, total_tf bigint, batch bigint, bucket int"


class IndexStore:
    """Build, extend and open the index under one folder."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        analyzers: Mapping[str, Analyzer] | None = None,
        analyzer: Analyzer = words,
        shards: int | None = None,
        buckets: int | None = None,
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.analyzers = analyzers or {}
        self.analyzer = analyzer
        self._wanted = (shards, buckets)
        self._prefix = "findery_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]
        self._known: dict[str, set[int]] = {}

    # -- versions ---------------------------------------------------------------------------

    def _path(self, name: str):
        """A Hadoop path under the root, and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _entries(self, name: str) -> list[tuple[str, int]]:
        """(name, time of the last change in milliseconds) of what a folder holds; nothing if there is none."""
        path, files = self._path(name)
        return [(e.getPath().getName(), e.getModificationTime()) for e in files.listStatus(path)] if files.exists(path) else []

    def versions(self) -> list[int]:
        """The numbers of all versions, oldest first."""
        return sorted(int(m[1]) for name, _ in self._entries("versions") if (m := re.fullmatch(r"version=(\d+)", name)))

    def _version_rows(self, version: int | None = None) -> list:
        """The batches of the latest or the given version, in the order of their writing; only that version's file is read."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            return []
        number = known[-1] if version is None else version
        read = self.spark.read.schema(_VERSION).parquet(f"{self.root}/versions/version={number}")
        rows = read.withColumn("version", F.lit(number)).collect()
        return sorted(rows, key=lambda r: (-1 if r["place"] is None else r["place"], r["batch"]))

    def latest_version(self) -> int | None:
        known = self.versions()
        return known[-1] if known else None

    def _publish(self, seen: list, rows: list[dict]) -> int:
        """Publish the version after the one this write started from; fails if another writer did so first.

        The version is written aside and renamed, which the file system refuses if the name exists.
        """
        version = _number(seen) + 1
        aside = f"{self.root}/staging/{uuid.uuid4().hex}"
        placed = [{**row, "place": place} for place, row in enumerate(rows)]
        names = [field.split()[0] for field in _VERSION.replace("map<string, bigint>", "map").split(", ")]
        self.spark.createDataFrame([tuple(row.get(n) for n in names) for row in placed], _VERSION).coalesce(1).write.parquet(aside)
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        path = jvm.org.apache.hadoop.fs.Path
        target = path(f"{self.root}/versions/version={version}")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        context.mkdir(target.getParent(), jvm.org.apache.hadoop.fs.permission.FsPermission.getDirDefault(), True)
        rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()[0]  # NONE
        options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = rename
        try:
            context.rename(path(aside), target, options)
        except Exception as refused:
            if context.util().exists(target):
                raise RuntimeError(f"version {version} of {self.root} was published by another writer") from refused
            raise
        return version

    # -- tables -----------------------------------------------------------------------------

    def _table(self, name: str, columns: str, partitions: str, sort: str, settings: dict, wanted: Sequence[tuple]) -> str:
        """A bucketed table: a scan of it is already partitioned by shard.

        The ``wanted`` partitions, which a version names, are made known to this session's catalog, whoever wrote them.
        """
        layout = f"{settings['shards']}x{settings['buckets']}"
        table = f"{self._prefix}_{name}_{layout}"
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({partitions}) "
                f"CLUSTERED BY (shard) SORTED BY ({sort}) INTO {settings['shards']} BUCKETS LOCATION '{self.root}/{name}-{layout}'"
            )
            self._known[table] = set()
        known = self._known.setdefault(table, set())
        lacking = [p for p in wanted if p not in known]
        keys = partitions.split(", ")
        for at in range(0, len(lacking), 1000):
            specs = [", ".join(f"{k}={v}" for k, v in zip(keys, p, strict=True)) for p in lacking[at : at + 1000]]
            self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({spec})" for spec in specs))
        known.update(lacking)
        return table

    def _postings_table(self, settings: dict, rows: Sequence[Mapping] = (), small: bool = False) -> str:
        """Of small batches the bucket is a column, of others a partition."""
        columns = (
            f"block int, field string, term string, doc_id {settings['key_type']}, tf int, length int, positions array<int>, "
            "shard int, batch bigint, bucket int"
        )
        rows = [r for r in rows if bool(r["small"]) == small]
        if small:
            return self._table("blocks_small", columns, "batch", "block, field, term, doc_id", settings, [(r["batch"],) for r in rows])
        wanted = [(r["batch"], bucket) for r in rows for bucket in _buckets(r, settings)]
        return self._table("blocks", columns, "batch, bucket", "block, field, term, doc_id", settings, wanted)

    def _stored_table(self, settings: dict, rows: Sequence[Mapping] = ()) -> str:
        schema = T.StructType.fromJson(json.loads(settings["stored"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return self._table("stored", columns, "batch", "doc_id", settings, [(r["batch"],) for r in rows])

    def _postings(self, settings: dict, rows: Sequence[Mapping]) -> DataFrame:
        """The postings of these batches; both layouts are placed by shard alike, and so is their union."""
        parts = []
        for small in (False, True):
            batches = [r["batch"] for r in rows if bool(r["small"]) == small]
            if batches or (not small and not rows):
                table = self.spark.table(self._postings_table(settings, rows, small))
                parts.append(table.filter(F.col("batch").isin(batches)).select(*POSTING_COLUMNS))
        if len(parts) == 1:
            return parts[0]
        # A union keeps the placement by shard only where that column was named anew in each input.
        parts = [p.withColumnRenamed("shard", "home") for p in parts]
        return parts[0].unionByName(parts[1]).withColumnRenamed("home", "shard")

    def _parquet(self, name: str, schema: str, batches: Sequence[int]) -> DataFrame:
        paths = [f"{self.root}/{name}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths)

    def open(self, version: int | None = None) -> TextIndex:
        """A snapshot of the latest or the given version."""
        rows = self._version_rows(version)
        if not rows:
            raise ValueError(f"no index version at {self.root}")
        return self._snapshot(rows)

    def _snapshot(self, rows: list) -> TextIndex:
        settings = _settings_of(rows)
        batches = [r["batch"] for r in rows]
        corpus = self.spark.createDataFrame([(r["docs"],) for r in rows], "docs bigint")
        return TextIndex(
            stored=self.spark.table(self._stored_table(settings, rows)).filter(F.col("batch").isin(batches)),
            postings=self._postings(settings, rows),
            terms=self._parquet("terms", _TERMS, batches).drop("batch"),
            corpus=corpus,
            removed=self._removed(settings, [r["batch"] for r in rows if r["removes"]]),
            key=settings["key"],
            fields=tuple(settings["fields"]),
            layout=Layout.of(self.spark, settings["shards"], settings["buckets"]),
            analyzers=self.analyzers,
            analyzer=self.analyzer,
            summed=len(rows) == 1,
        )

    def _removed(self, settings: dict, batches: Sequence[int]) -> DataFrame | None:
        """(shard, batch, doc_id) of the versions that these batches replaced."""
        if not batches:
            return None
        return self._parquet("removed", self._removed_schema(settings), batches).select("shard", F.col("old_batch").alias("batch"), "doc_id")

    @staticmethod
    def _removed_schema(settings: dict) -> str:
        return f"shard int, doc_id {settings['key_type']}, old_batch bigint, batch bigint"

    # -- writing ----------------------------------------------------------------------------

    def _write_documents(self, records: DataFrame, settings: dict, batch: int, may_be_small: bool = False) -> tuple[DataFrame, dict]:
        """Write stored rows and postings of a batch; gives the postings and what a version says of the batch.

        The records are shuffled once, by shard. Postings are then made from the stored rows, whose
        table is bucketed by shard, without another shuffle.
        """
        layout = Layout.of(self.spark, settings["shards"], settings["buckets"])
        docs = sharded(records, settings["key"], settings["fields"], layout, batch)
        if SEQ not in docs.columns:
            docs = docs.withColumn(SEQ, F.lit(None).cast("long"))
        written, count = self._write_stored(docs, settings, batch)
        # A field that is not stored is analyzed from the records, which are placed by shard once more.
        source = written if set(settings["fields"]) <= set(written.columns) else docs
        row = {"batch": batch, "docs": count, "removes": False, "written": count, "small": may_be_small and count < SMALL_DOCS}
        def make(part: DataFrame, distinct: bool) -> DataFrame:
            return make_postings(part, settings["fields"], layout, self.analyzers, self.analyzer, distinct)

        # Rows of one id are one document; only their tokens are brought together.
        twice = cut(written.groupBy("shard", "doc_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
        if twice.isEmpty():
            made = make(source, True)
        else:
            twice, same = broadcast_if_small(twice.select(F.col("shard").alias("_s"), F.col("doc_id").alias("_d"))), (
                F.col("shard").eqNullSafe(F.col("_s")) & F.col("doc_id").eqNullSafe(F.col("_d"))
            )
            made = make(source.join(twice, same, "left_anti"), True).unionByName(make(source.join(twice, same, "left_semi"), False))
        return self._write_postings(made, settings, row), row

    def _write_stored(self, docs: DataFrame, settings: dict, batch: int) -> tuple[DataFrame, int]:
        schema = T.StructType.fromJson(json.loads(settings["stored"]))
        table = self._stored_table(settings)
        docs.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields]).write.insertInto(table)
        written = self.spark.table(self._stored_table(settings, [{"batch": batch}])).filter(F.col("batch") == F.lit(batch))
        return written, written.count()

    def _write_postings(self, postings: DataFrame, settings: dict, row: dict) -> DataFrame:
        """Write a batch's postings in the layout its row asks for, and add the buckets it has to the row."""
        table = self._postings_table(settings, small=row["small"])
        names = [n for n in POSTING_COLUMNS if n not in ("batch", "bucket")]
        names += ["bucket", "batch"] if row["small"] else ["batch", "bucket"]
        postings.select(*names).write.insertInto(table)
        row["buckets"] = []
        if not row["small"]:
            listed = self.spark.sql(f"SHOW PARTITIONS {table} PARTITION (batch={row['batch']})").collect()
            row["buckets"] = sorted(int(r[0].rsplit("bucket=", 1)[1]) for r in listed)
        return self._postings(settings, [row])

    def _write_terms(self, terms: DataFrame, batch: int) -> None:
        # Rebalancing splits a bucket that is too large for one file and merges small ones.
        (
            terms.select("field", "term", "df", "total_tf", "bucket")
            .hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", "field", "term")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{self.root}/terms/batch={batch}")
        )

    def _settings(
        self, seen: list, records: DataFrame, key: str, fields: Sequence[str], stored: Sequence[str] | None
    ) -> dict:
        kept = [n for n in (stored or records.columns) if n not in (*DOC, SEQ)]
        key_type = records.schema[key].dataType
        schema = T.StructType(
            [T.StructField(n, records.schema[n].dataType) for n in kept]
            + [
                T.StructField(SEQ, T.LongType()), T.StructField("doc_id", key_type), T.StructField("shard", T.IntegerType()),
                T.StructField("batch", T.LongType()),
            ]
        )
        settings = {"key": key, "key_type": key_type.simpleString(), "fields": list(fields), "stored": schema.json()}
        if seen:
            old = _settings_of(seen)
            for name in ("key", "key_type", "stored"):
                if old[name] != settings[name]:
                    raise ValueError(f"{self.root} holds an index with another {name}; use a new folder")
        layout = Layout.sized(records, fields, *self._wanted)
        return {**settings, "shards": layout.shards, "buckets": layout.buckets}

    def replace(self, records: DataFrame, key: str, fields: Sequence[str], stored: Sequence[str] | None = None) -> int:
        """Build the index anew; the version published holds these records only."""
        return self._replace(records, key, fields, stored, self._version_rows(), {}, None)

    def _replace(
        self, records: DataFrame, key: str, fields: Sequence[str], stored: Sequence[str] | None, seen: list,
        streams: dict, expected: int | None,
    ) -> int:
        settings = self._settings(seen, records, key, fields, stored)
        batch = _new_batch()
        postings, row = self._write_documents(records, settings, batch)
        if expected is not None and row["docs"] != expected:
            raise RuntimeError(f"{row['docs']} documents were written, but the version has {expected}; nothing was published")
        self._write_terms(make_terms(postings), batch)
        return self._publish(seen, [{**row, "settings": json.dumps(settings), "streams": streams}])

    def append(self, records: DataFrame) -> int:
        """Add records with new keys; only the new batch is written, and small batches are merged now and then."""
        rows = self._version_rows()
        settings = _settings_of(rows)
        batch = _new_batch()
        postings, row = self._write_documents(records, settings, batch, may_be_small=True)
        self._write_terms(make_terms(postings), batch)
        self._publish(rows, [*_kept(rows), {**row, "settings": json.dumps(settings), "streams": _streams_of(rows)}])
        return self._tidied()

    def upsert(self, updates: DataFrame, seq: str, *, stream: str | None = None, stream_batch: int | None = None) -> int:
        """Add records, replacing those with the same key; the greatest ``seq`` of a key wins, in whatever order
        the updates arrive: one that is not newer than the live version is left out.

        With ``stream`` and ``stream_batch`` a batch of a stream that was already published is left
        alone, so a replay changes nothing.
        """
        rows = self._version_rows()
        streams = _streams_of(rows)
        if stream is not None and streams.get(stream, -1) >= stream_batch:
            return _number(rows)
        if stream is not None:
            streams[stream] = stream_batch
        index = self._snapshot(rows)
        settings = _settings_of(rows)
        batch = _new_batch()
        latest = newer_than_live(index, latest_per_key(updates, settings["key"], seq))
        postings, row = self._write_documents(latest, settings, batch, may_be_small=True)
        added = self.spark.table(self._stored_table(settings)).filter(F.col("batch") == F.lit(batch))
        gone = replaced_versions(index, added)
        self._write_removed(gone, batch)
        removed = self._removed(settings, [batch])
        lost = negated(make_terms(postings_of_versions(index, removed)))
        self._write_terms(make_terms(postings).unionByName(lost), batch)
        row |= {"docs": row["docs"] - removed.count(), "removes": True, "settings": json.dumps(settings), "streams": streams}
        self._publish(rows, [*_kept(rows), row])
        return self._tidied()

    def _write_removed(self, gone: DataFrame, batch: int) -> None:
        path = f"{self.root}/removed/batch={batch}"
        gone.select("shard", "doc_id", F.col("batch").alias("old_batch")).write.mode("overwrite").parquet(path)

    # -- keeping it small -------------------------------------------------------------------

    def _tidied(self) -> int:
        """Merge small batches where enough of about one size have come together; the number of the latest version."""
        while (full := _full_tier(rows := self._version_rows())) and self.merge(full):
            pass
        return _number(rows)

    def merge(self, batches: Sequence[int]) -> int:
        """Write the live documents of these batches as one batch and publish a version that has it in their stead.

        Postings are copied, not made again. Term counts are added up as they are: those of replaced versions were
        taken off by the batch that replaced them. What these batches removed from others stays removed.
        """
        rows = self._version_rows()
        settings, index = _settings_of(rows), self._snapshot(rows)
        chosen = [r for r in rows if r["batch"] in set(batches)]
        names = [r["batch"] for r in chosen]
        batch, inside = _new_batch(), F.col("batch").isin(names)
        live = without_removed(index.stored.filter(inside), index.removed).withColumn("batch", F.lit(batch))
        _, count = self._write_stored(live, settings, batch)
        row = {"batch": batch, "docs": sum(r["docs"] for r in chosen), "removes": False, "written": count, "small": count < SMALL_DOCS}
        postings = without_removed(self._postings(settings, chosen), index.removed).withColumn("batch", F.lit(batch))
        self._write_postings(postings, settings, row)
        terms = self._parquet("terms", _TERMS, names).groupBy("bucket", "field", "term")
        terms = terms.agg(F.sum("df").alias("df"), F.sum("total_tf").alias("total_tf")).filter("df <> 0 OR total_tf <> 0")
        self._write_terms(terms, batch)
        removed = self._removed(settings, [r["batch"] for r in chosen if r["removes"]])
        if removed is not None:
            self._write_removed(removed.filter(~inside), batch)
            row["removes"] = self._removed(settings, [batch]).limit(1).count() > 0
        rest = [r for r in rows if r["batch"] not in names]
        return self._publish(rows, [*_kept(rest), {**row, "settings": json.dumps(settings), "streams": _streams_of(rows)}])

    def vacuum(self, keep: int = 1, older_than: float = 86_400.0) -> list[str]:
        """Remove the versions before the last ``keep`` ones, and the folders of batches that no kept version names and that
        have not changed for ``older_than`` seconds by the file system's clock: replaced ones and those of failed writes.

        A reader that pinned an older version loses it; a writer must not take longer than ``older_than``. Gives the
        folders removed.
        """
        if keep < 1:
            raise ValueError("at least one version is kept")
        known = self.versions()
        named = {r["batch"] for v in known[-keep:] for r in self._version_rows(v)}
        gone = [f"versions/version={v}" for v in known[:-keep]]
        path, files = self._path(f"staging/{uuid.uuid4().hex}")
        files.mkdirs(path)
        now = dict(self._entries("staging"))[path.getName()]
        gone += [f"staging/{name}" for name, changed in self._entries("staging") if name == path.getName() or now - changed >= 1000 * older_than]
        for table, batch, changed in self._batch_folders():
            if batch not in named and now - changed >= 1000 * older_than:
                gone.append(f"{table}/batch={batch}")
        for name in gone:
            path, files = self._path(name)
            files.delete(path, True)
        self._forget({int(name.rsplit("=", 1)[1]) for name in gone if "/batch=" in name})
        return [name for name in gone if not name.startswith("staging/")]

    def _batch_folders(self) -> Iterator[tuple[str, int, int]]:
        for table, _ in self._entries(""):
            if table in ("terms", "removed") or table.startswith(("blocks", "stored-")):
                for name, changed in self._entries(table):
                    if match := re.fullmatch(r"batch=(\d+)", name):
                        yield table, int(match[1]), changed

    def _forget(self, batches: set[int]) -> None:
        """Partitions that are gone are not known any more."""
        for table, known in self._known.items():
            for part in [p for p in known if p[0] in batches]:
                spec = f"batch={part[0]}" + (f", bucket={part[1]}" if len(part) > 1 else "")
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
                known.discard(part)

    def compact(self) -> int:
        """Write the live documents of all batches as one batch, in a layout that fits them.

        Fails, and publishes nothing, if it does not find as many documents as the version has. An index with fields
        that are not stored cannot be compacted.
        """
        rows = self._version_rows()
        index = self._snapshot(rows)
        settings = _settings_of(rows)
        lacking = set(settings["fields"]) - set(index.stored.columns)
        if lacking:
            raise ValueError(f"not stored, so they cannot be indexed again: {sorted(lacking)}")
        records = index.documents().drop(*[c for c in DOC if c != settings["key"]])
        stored = [c for c in records.columns if c != SEQ]
        return self._replace(
            records, settings["key"], settings["fields"], stored, rows, _streams_of(rows), sum(r["docs"] for r in rows)
        )


def _kept(rows: list) -> list[dict]:
    """Rows of earlier batches; the settings go on in the row of the last write alone."""
    return [{**r.asDict(), "settings": None, "streams": None} for r in rows]


def _settings_of(rows: list) -> dict:
    return json.loads(next(r["settings"] for r in reversed(rows) if r["settings"] is not None))


def _streams_of(rows: list) -> dict:
    return dict(next(r["streams"] for r in reversed(rows) if r["settings"] is not None) or {})


def _buckets(row: Mapping, settings: dict) -> Sequence[int]:
    """The term buckets that a batch has; one of a version that does not say so may have all."""
    return range(settings["buckets"]) if row["buckets"] is None else row["buckets"]


def _full_tier(rows: list) -> list[int]:
    """The small batches up to the largest size of which ``FANOUT`` have come together; none if there is no such size."""
    tiers: dict[int, list[int]] = {}
    for row in rows:
        if row["small"]:
            size, tier = max(row["written"], 1), 0
            while size >= FANOUT:
                size, tier = size // FANOUT, tier + 1
            tiers.setdefault(tier, []).append(row["batch"])
    full = max((t for t, batches in tiers.items() if len(batches) >= FANOUT), default=-1)
    return [batch for t, batches in tiers.items() if t <= full for batch in batches]


def _number(rows: list) -> int:
    return rows[0]["version"] if rows else 0


def _new_batch() -> int:
    """A name no other attempt uses, so that repeated attempts never share a partition; it says nothing about order."""
    return uuid.uuid4().int >> 66
