"""Stored tables whose parts are replaced one by one, under a manifest of live folders.

Below a table's path::

    data/version=V/<column>=<value>/...     the parts that one write replaced or added
    manifest/version=V                      which folders are live since then, and marks
    batches/stream=S/batch=N/<column>=...   what micro-batches wrote and no merge has taken in

A write puts its folders in place first and publishes its manifest last; a manifest
counts once its success marker stands.  A write that dies in between leaves folders
that no manifest names, and its repetition replaces them, so readers see all of a
write or nothing of it.  Parts that a write does not touch keep their files.

The driver lists folders, never files: a manifest has a row per part and folder, so for
parts that are days or buckets it stays small.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partyard.contracts import conform
from partyard.sources.files import publish_snapshot, snapshot_versions

#: Folders a part may have before the next merge of that part rewrites it.
MOST_FOLDERS = 4
#: Buckets of a keyed table; a merge rewrites those its keys fall into.
BUCKETS = 64

MANIFEST = "kind string, name string, number long"


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system holds them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def _remove(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bloom_filters(writer: DataFrameWriter, columns: Iterable[str]) -> DataFrameWriter:
    """Bloom filters over columns in every row group, sized by what the group holds.

    A lookup skips the row groups whose filter or dictionary lacks its value, also where
    the value lies between a group's smallest and largest one.
    """
    for name in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


@dataclass(frozen=True)
class Manifest:
    """Live folders as (part, version), and named numbers the table remembers."""

    version: int = 0
    live: frozenset[tuple[str, int]] = frozenset()
    marks: Mapping[str, int] = field(default_factory=dict)


class FolderTable:
    """A table cut into parts by the values of one column."""

    #: Columns whose files get Bloom filters.
    bloom: tuple[str, ...] = ()

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, column: str) -> None:
        self.spark, self.path, self.schema, self.column = spark, path.rstrip("/"), schema, column

    # -- manifests --

    def manifest(self, version: int | None = None) -> Manifest:
        versions = snapshot_versions(self.spark, f"{self.path}/manifest")
        if not versions:
            return Manifest()
        newest = version or versions[-1]
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={newest}").collect()
        return Manifest(
            newest,
            frozenset((r["name"], r["number"]) for r in rows if r["kind"] == "live"),
            {r["name"]: r["number"] for r in rows if r["kind"] == "mark"},
        )

    def publish(
        self, rows: DataFrame, replaced: Iterable[str] = (), marks: Mapping[str, int] | None = None
    ) -> Manifest:
        """Write rows as a new version; they replace the named parts and add to all others."""
        old = self.manifest()
        version = old.version + 1
        self._write(rows, f"{self.path}/data/version={version}")
        written = _matching(self.spark, f"{self.path}/data/version={version}/{self.column}=*")
        gone = set(replaced)
        new = Manifest(
            version,
            frozenset(x for x in old.live if x[0] not in gone) | {(p.rsplit("/", 1)[1], version) for p in written},
            {**old.marks, **(marks or {})},
        )
        lines = [("live", part, n) for part, n in sorted(new.live)] + [("mark", m, n) for m, n in new.marks.items()]
        publish_snapshot(self.spark.createDataFrame(lines, MANIFEST).coalesce(1), f"{self.path}/manifest", version)
        return new

    def _write(self, rows: DataFrame, path: str) -> None:
        """One file or a few per part, however many tasks made its rows."""
        dealt = conform(rows, self.schema).hint("rebalance", self.column)
        writer = bloom_filters(dealt.write, self.bloom)
        writer.mode("overwrite").partitionBy(self.column).parquet(path)

    # -- reading --

    def read(self, parts: Iterable[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
        """Live rows, of the named parts only if some are named."""
        wanted = None if parts is None else set(parts)
        live = (manifest or self.manifest()).live
        folders = [f"{self.path}/data/version={n}/{part}" for part, n in sorted(live) if wanted is None or part in wanted]
        return self._rows(folders, f"{self.path}/data")

    def _rows(self, folders: list[str], base: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", base).parquet(*folders)
        return rows.select(*self.schema.names)

    def vacuum(self, keep: int = 2) -> None:
        """Delete folders that none of the ``keep`` newest manifests names, and older manifests.

        Readers of a kept manifest are safe; others have to start again.
        """
        versions = snapshot_versions(self.spark, f"{self.path}/manifest")
        kept = [self.manifest(v) for v in versions[-keep:]]
        if not kept:
            return
        named = {f"version={n}/{part}" for m in kept for part, n in m.live}
        newest = kept[-1].version
        for folder in _matching(self.spark, f"{self.path}/data/version=*/{self.column}=*"):
            name = "/".join(folder.rsplit("/", 2)[1:])
            if name not in named and int(name.split("/")[0].split("=")[1]) <= newest:
                _remove(self.spark, folder)
        for version in versions[:-keep]:
            _remove(self.spark, f"{self.path}/manifest/version={version}")


class BatchTable(FolderTable):
    """A table that micro-batches append to; merges keep the number of folders down.

    ``fold`` may shrink the rows of a part when they are merged (sum up counts, say);
    readers then fold once more over what they read.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        column: str,
        fold: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        super().__init__(spark, path, schema, column)
        self.fold = fold

    def write_batch(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Store one batch; repeating it replaces it, or does nothing once it is merged."""
        if batch > self.manifest().marks.get(stream, -1):
            self._write(rows, f"{self.path}/batches/stream={stream}/batch={batch}")

    def _fresh(self, manifest: Manifest) -> list[tuple[str, int]]:
        """Complete batches that no merge has taken in."""
        found = []
        for marker in _matching(self.spark, f"{self.path}/batches/stream=*/batch=*/_SUCCESS"):
            stream, batch = (name.split("=", 1)[1] for name in marker.rsplit("/", 3)[1:3])
            if int(batch) > manifest.marks.get(stream, -1):
                found.append((stream, int(batch)))
        return found

    def _batch_rows(
        self, batches: list[tuple[str, int]], parts: set[str] | None = None
    ) -> tuple[DataFrame, set[str]]:
        """Rows of the batches and the parts they have."""
        folders = [
            folder
            for stream, batch in batches
            for folder in _matching(self.spark, f"{self.path}/batches/stream={stream}/batch={batch}/{self.column}=*")
            if parts is None or folder.rsplit("/", 1)[1] in parts
        ]
        return self._rows(folders, f"{self.path}/batches"), {f.rsplit("/", 1)[1] for f in folders}

    def current(self, until: tuple[str, int] | None = None, parts: set[str] | None = None) -> DataFrame:
        """All rows: merged ones and those of later batches.

        ``until`` leaves out a stream's batches from a number on, ``parts`` all other parts.
        """
        manifest = self.manifest()
        batches = self._fresh(manifest)
        if until:
            batches = [b for b in batches if b[0] != until[0] or b[1] < until[1]]
        fresh, _ = self._batch_rows(batches, parts)
        rows = self.read(parts, manifest).unionByName(fresh)
        return self.fold(rows) if self.fold else rows

    def compact(self, most: int = MOST_FOLDERS) -> bool:
        """Take finished batches into the table.

        Their rows become one folder per part; a part that has ``most`` folders already
        is rewritten as one.  Which batches are in is part of the manifest, so a batch
        counts once wherever a merge stops.
        """
        manifest = self.manifest()
        fresh = self._fresh(manifest)
        if not fresh:
            return False
        rows, touched = self._batch_rows(fresh)
        folders = Counter(part for part, _ in manifest.live)
        full = {part for part in touched if folders[part] >= most}
        rows = rows.unionByName(self.read(full, manifest))
        marks: dict[str, int] = {}
        for stream, batch in fresh:
            marks[stream] = max(batch, marks.get(stream, -1))
        self.publish(self.fold(rows) if self.fold else rows, full, marks)
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Also delete batches that all kept manifests have taken in."""
        super().vacuum(keep)
        versions = snapshot_versions(self.spark, f"{self.path}/manifest")
        if len(versions) < keep:
            return
        taken = self.manifest(versions[0]).marks
        for folder in _matching(self.spark, f"{self.path}/batches/stream=*/batch=*"):
            stream, batch = (name.split("=", 1)[1] for name in folder.rsplit("/", 2)[1:])
            if int(batch) <= taken.get(stream, -1):
                _remove(self.spark, folder)


class KeyedTable(FolderTable):
    """A table with one row per key, in buckets by the key's hash.

    A merge reads and rewrites the buckets that hold keys of its delta; all others keep
    their files.  The number of buckets is fixed with the first write.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS
    ) -> None:
        bucketed = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        super().__init__(spark, path, bucketed, "bucket")
        self.key, self.buckets = key, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def rows(self) -> DataFrame:
        return self.read().drop("bucket")

    def look_up(self, key: str) -> DataFrame:
        """The row of one key, from its bucket alone."""
        at = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(key)), F.lit(self.buckets))).first()[0]
        return self.read([f"bucket={at}"]).drop("bucket").filter(F.col(self.key) == key)

    def merge(self, delta: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> Manifest:
        """Replace the rows of the delta's buckets by ``combine(rows, delta)``.

        The delta is read twice; store it first when it comes from a long plan.
        """
        if self.manifest().marks.get("buckets", self.buckets) != self.buckets:
            raise ValueError("the table was stored with another number of buckets")
        # At most as many rows as there are buckets.
        touched = [f"bucket={r[0]}" for r in delta.select(self._bucket().alias("bucket")).distinct().collect()]
        old = self.read(touched).drop("bucket")
        merged = combine(old, delta).withColumn("bucket", self._bucket())
        return self.publish(merged, touched, {"buckets": self.buckets})

