"""Keyed tables as snapshots: immutable data folders and a commit log with one pointer.

A store holds a few tables that change together (the raw tables of an ingest). Layout::

    <root>/data/<table>/commit=<id>/<partition>=<value>/*.parquet    never changed
    <root>/commits/<version>.json                                     one record per commit

A commit record is the whole manifest: for every table the partitions and the commits whose
folders hold their rows. A writer first writes its data folders, which no reader looks at,
and then publishes one record by renaming a finished file to the next version number, which
fails if that version exists. So

* readers work on the version they found, whole and unchanged, whatever is written meanwhile;
* a writer that dies at any point has changed nothing, and there is nothing to repair;
* of two writers that started from one version the second gets ``CommitConflict`` and starts
  again from the new one;
* tables of one commit appear together.

A manifest has one entry per partition (months, branches, hash buckets): bounded by the
calendar and the dimensions, not by rows. ``collect_garbage`` removes what no kept version
refers to. Renaming must be atomic, as in HDFS and local or network file systems.

``KeyIndex`` knows the partition of every key, so a key that comes back with another month
also leaves its old one.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from branchlens.operators.incremental import keep_last

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder of the null partition
MAX_DELTAS = 8  # appended folders of a partition before they are merged
COMPRESSION = "zstd"  # of data folders and of what a job keeps between its steps: about two thirds of snappy's

# A rewrite of a large table goes in slices, one after the other, so that the shuffle files of
# only one are on the disks. Every slice reads the whole input, so there are few.
SLICES, SLICE_BYTES = 6, 32 << 20


class CommitConflict(RuntimeError):
    """Another writer published a version since the one this commit was computed from."""


@dataclass
class Snapshot:
    """One version: table -> partition folder -> commits that hold its rows."""
    version: int
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    meta: dict = field(default_factory=dict)


@dataclass
class Change:
    """What a commit does to a table: ``folders`` were written under ``commit``; ``gone``
    lists the partitions whose earlier rows no longer count (None: all of them)."""
    commit: str
    folders: list[str]
    gone: list[str] | None


def folder_value(folder: str) -> str | None:
    """The partition value of a folder name."""
    text = folder.partition("=")[2]
    return None if text == NULL_FOLDER else unquote(text)


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that a frame reads; rows from elsewhere do not count."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    files = [leaf for leaf in map(leaves.apply, range(leaves.size())) if leaf.nodeName().startswith("LogicalRelation")]
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in files)


def slice_count(df: DataFrame, most: int | None = None) -> int:
    """Number of slices in which a frame is shuffled, at most ``most`` (``SLICES``)."""
    return max(1, min(SLICES if most is None else most, -(-stored_bytes(df) // SLICE_BYTES)))


def sliced(df: DataFrame, keys: Sequence[str], n: int) -> list[DataFrame]:
    """The rows of a frame in ``n`` parts; the rows of a key, nulls included, are in one of them."""
    if n == 1:
        return [df]
    return [df.filter(F.pmod(F.xxhash64(*keys), F.lit(n)) == i) for i in range(n)]


class SnapshotStore:
    """``tables``: name -> (schema with the partition column, partition column)."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[T.StructType, str]]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), tables
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path

    # ------------------------------------------------------------------ versions

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> list:
        path = self._fs_path(folder)
        fs = self._fs(path)
        return list(fs.listStatus(path)) if fs.exists(path) else []

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._children(f"{self.root}/commits")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_")))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """A version (the latest by default); version 0 is the store before its first commit."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return Snapshot(0)
        path = self._fs_path(f"{self.root}/commits/{version:012d}.json")
        stream = self._fs(path).open(path)
        try:
            record = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()
        return Snapshot(version, record["tables"], record["meta"])

    def commit(self, base: Snapshot, changes: dict[str, Change], **meta) -> Snapshot:
        """Publish ``changes``, computed from ``base``, as the next version, or raise
        ``CommitConflict`` and leave the store as it is."""
        after = {name: dict(parts) for name, parts in base.tables.items()}
        for name, change in changes.items():
            kept = {} if change.gone is None else {p: c for p, c in after.get(name, {}).items() if p not in change.gone}
            for p in change.folders:
                kept[p] = [*kept.get(p, []), change.commit]
            after[name] = kept
        version = base.version + 1
        meta = {**meta, "committed": dt.datetime.now(dt.timezone.utc).isoformat()}
        target = self._fs_path(f"{self.root}/commits/{version:012d}.json")
        draft = self._fs_path(f"{self.root}/commits/_{uuid.uuid4().hex}.draft")
        fs = self._fs(target)
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps({"tables": after, "meta": meta}, default=str).encode("utf-8")))
        finally:
            out.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        never = gateway.new_array(rename, 1)
        never[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(draft, target, never)
        except Py4JJavaError as error:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise CommitConflict(f"version {version} of {self.root} was published by another writer") from None
            raise
        return Snapshot(version, after, meta)

    # ------------------------------------------------------------------ reading

    def read(self, table: str, at: Snapshot | None = None, folders: Sequence[str] | None = None) -> DataFrame:
        """The rows of a table in a version; with ``folders`` only of those partitions, and
        nothing else is listed or opened."""
        schema, _ = self.tables[table]
        parts = (at or self.snapshot()).tables.get(table, {})
        base = f"{self.root}/data/{table}"
        paths = [f"{base}/commit={c}/{p}" for p, commits in parts.items()
                 if folders is None or p in folders for c in commits]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())

    # ------------------------------------------------------------------ writing

    def _shaped(self, df: DataFrame, table: str) -> DataFrame:
        """The table's columns in its order and types; absent ones are null."""
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in self.tables[table][0].fields])

    def write(self, table: str, df: DataFrame | Sequence[DataFrame], gone: list[str] | None) -> Change:
        """Write rows into a new data folder that no version refers to yet; slices of them are
        written one after the other."""
        part_col, commit = self.tables[table][1], f"c{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/{table}/commit={commit}"
        for at, rows in enumerate([df] if isinstance(df, DataFrame) else df):
            self._shaped(rows, table).hint("rebalance", part_col).write.mode("append" if at else "errorifexists") \
                .option("compression", COMPRESSION).partitionBy(part_col).parquet(path)
        names = [s.getPath().getName() for s in self._children(path) if s.isDirectory()]
        return Change(commit, sorted(n for n in names if n.startswith(f"{part_col}=")), gone)

    def written(self, table: str, change: Change) -> int:
        """Number of rows that a change wrote (from the files' footers)."""
        return self.read(table, Snapshot(0, {table: {p: [change.commit] for p in change.folders}})).count()

    def replace(self, table: str, df: DataFrame | Sequence[DataFrame]) -> Change:
        """The table becomes ``df``."""
        return self.write(table, df, None)

    def append(self, table: str, df: DataFrame) -> Change:
        return self.write(table, df, [])

    def touched(self, table: str, at: Snapshot, values: Sequence[str | None]) -> list[str]:
        """The folders of ``at`` that hold those partition values."""
        wanted = set(values)
        return [p for p in at.tables.get(table, {}) if folder_value(p) in wanted]

    def merge(self, table: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], at: Snapshot,
              also: Sequence[str | None] = ()) -> Change | None:
        """Keyed keep-last merge of ``batch``: only the partitions it touches (and those named
        by ``also``) are read and written again. The distinct partition values are read to
        the driver; they are months or branches. None for an empty batch.

        A key's rows in all of these partitions are compared together, so a key that the
        batch moves to another partition is removed from the one it had, if that is among
        them (see ``KeyIndex``). Large tables are merged in slices of keys."""
        part_col = self.tables[table][1]
        batch = self._shaped(batch, table)
        values = {r[0] for r in batch.select(part_col).distinct().collect()}
        if not values:
            return None
        folders = self.touched(table, at, [*values, *also])
        both = self.read(table, at, folders).unionByName(batch)
        return self.write(table, [keep_last(rows, keys, order) for rows in sliced(both, keys, slice_count(both))], folders)

    # ------------------------------------------------------------------ retention

    def collect_garbage(self, keep: int = 10, min_age_s: float = 86400.0) -> int:
        """Delete the records of all but the last ``keep`` versions and every data folder that
        no kept version names and that is older than ``min_age_s`` (younger ones may belong
        to a commit under way). Returns the number of deleted folders."""
        kept = self.versions()[-keep:]
        used = {(name, c) for v in kept for name, parts in self.snapshot(v).tables.items() for cs in parts.values() for c in cs}
        before, deleted = (time.time() - min_age_s) * 1000, 0
        for name in self.tables:
            for status in self._children(f"{self.root}/data/{name}"):
                commit = status.getPath().getName().partition("=")[2]
                if commit and (name, commit) not in used and status.getModificationTime() < before:
                    self._fs(status.getPath()).delete(status.getPath(), True)
                    deleted += 1
        for version in self.versions()[:-keep]:
            path = self._fs_path(f"{self.root}/commits/{version:012d}.json")
            self._fs(path).delete(path, False)
        return deleted


# ---------------------------------------------------------------------- key -> partition

BUCKETS = 16  # size it to the data: a bucket is what one task of a merge should hold


def index_schema(keys: Sequence[str]) -> T.StructType:
    """An index table: the key, the partition it is in, the sequence of the entry, its bucket."""
    return T.StructType([*[T.StructField(k, T.StringType()) for k in keys], T.StructField("part", T.StringType()),
                         T.StructField("entry_seq", T.LongType()), T.StructField("bucket", T.StringType())])


class KeyIndex:
    """Which partition of ``table`` a key is in, kept as a table of the same store.

    Entries are dealt to hash buckets, the partitions of the index table. A batch reads the
    buckets of its keys only; its own entries are appended (the last entry of a key counts),
    and a bucket that has gathered ``MAX_DELTAS`` folders is merged by the next batch. The
    index is committed with the rows it describes, so the two never disagree."""

    def __init__(self, store: SnapshotStore, table: str, keys: Sequence[str], name: str | None = None,
                 buckets: int = BUCKETS):
        self.store, self.table, self.keys, self.buckets = store, table, list(keys), buckets
        self.name = name or f"{table}_keys"
        store.tables.setdefault(self.name, (index_schema(self.keys), "bucket"))

    def _bucket(self) -> Column:
        return F.format_string("%04d", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))).alias("bucket")

    def entries(self, rows: DataFrame, seq: int | Column) -> DataFrame:
        """Index entries of rows of the table, the last one of each key; ``seq`` orders the
        entries of a key as ``merge`` orders its rows."""
        part_col = self.store.tables[self.table][1]
        seq = F.lit(seq) if isinstance(seq, int) else seq
        found = rows.select(*self.keys, F.col(part_col).alias("part"), seq.cast("long").alias("entry_seq"), self._bucket())
        return keep_last(found, self.keys, ["entry_seq"])

    def ensure(self, at: Snapshot, seq: int | Column = 0, order: Sequence[str] = ()) -> Snapshot:
        """The version that has the index: committed now where the table has none yet. A key
        that a first load has put into several partitions is settled with it: its last row by
        ``order`` stays."""
        if at.tables.get(self.name) or not at.tables.get(self.table):
            return at
        rows, part_col = self.store.read(self.table, at), self.store.tables[self.table][1]
        # Two different partitions of a key are enough to see it; the null one counts.
        low, high = F.min(F.struct(part_col)), F.max(F.struct(part_col))
        several = rows.groupBy(*self.keys).agg(low.alias("_low"), high.alias("_high")).filter("_low <> _high").drop("_low", "_high")
        match = F.lit(True)
        for k in self.keys:
            match = match & rows[k].eqNullSafe(several[k])
        found = [r[0] for r in rows.join(several, match, "left_semi").select(part_col).distinct().collect()]
        if found:
            folders = self.store.touched(self.table, at, found)
            settled = keep_last(self.store.read(self.table, at, folders), self.keys, order)
            at = self.store.commit(at, {self.table: self.store.write(self.table, settled, folders)}, **at.meta)
            rows = self.store.read(self.table, at)
        built = self.store.replace(self.name, self.entries(rows, seq))
        return self.store.commit(at, {self.name: built}, **at.meta)

    def current(self, at: Snapshot, folders: Sequence[str] | None = None) -> DataFrame:
        """(keys, part): the last entry of every key."""
        return keep_last(self.store.read(self.name, at, folders), self.keys, ["entry_seq"])

    def moves(self, batch: DataFrame, at: Snapshot) -> list[str | None]:
        """The partitions that hold an earlier version of a key which ``batch`` has in another
        partition: distinct values, read to the driver (months)."""
        part_col = self.store.tables[self.table][1]
        if not at.tables.get(self.name):
            return []
        keyed = batch.select(*self.keys, F.col(part_col).alias("_part"), self._bucket())
        wanted = {r[0] for r in keyed.select("bucket").distinct().collect()}
        known = self.current(at, self.store.touched(self.name, at, list(wanted)))
        new, old = keyed.alias("n"), known.alias("o")
        same = F.col("n.bucket") == F.col("o.bucket")
        for k in self.keys:
            same = same & F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}"))
        moved = new.join(old, same).filter(~F.col("n._part").eqNullSafe(F.col("o.part")))
        return [r[0] for r in moved.select("o.part").distinct().collect()]

    def update(self, batch: DataFrame, at: Snapshot, seq: int | Column) -> Change:
        """The entries of a batch, appended; buckets with many folders are merged."""
        new = self.entries(batch, seq)
        full = [p for p, commits in at.tables.get(self.name, {}).items() if len(commits) >= MAX_DELTAS]
        if not full:
            return self.store.append(self.name, new)
        both = self.store.read(self.name, at, full).unionByName(new)
        return self.store.write(self.name, keep_last(both, self.keys, ["entry_seq"]), full)
