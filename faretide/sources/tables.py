"""Stored tables: versioned Parquet directories under one root, split by partition columns.

Data files are never changed in place. A write goes to a folder of its own and becomes the table's next version by one
rename (``versions``), so a reader sees the table before or after it, and an attempt that dies half way has done nothing.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faretide import schemas
from faretide.functions import clock
from faretide.operators import filters, merge
from faretide.schemas import TableSpec
from faretide.sources.versions import FOLDER, Conflict, Snapshot, Version, Versions

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def checkpoints(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where the session names none, local mode gets a folder of this machine, which its one process sees; elsewhere
    every node would write to its own disk, so that is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='faretide-')}"
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared)
    return shared


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the checkpoint folder."""
    return f"{checkpoints(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Lake:
    """The tables under ``root``, a folder every executor can reach. Every write is one new version of its table."""

    spark: SparkSession
    root: str

    def path(self, table: TableSpec) -> str:
        return f"{self.root}/{table.name}"

    def versions(self, table: TableSpec) -> Versions:
        return Versions(self.spark, self.path(table))

    def snapshot(self, table: TableSpec) -> Snapshot:
        """The latest version; version 0 has no rows."""
        return self.versions(table).latest() or Snapshot()

    # -- reading -------------------------------------------------------------------------------

    def read(
        self,
        table: TableSpec,
        values: Iterable[object] | None = None,
        must_exist: bool = False,
        at: Snapshot | None = None,
    ) -> DataFrame:
        """The table as of now, or as of the version ``at``; later writes do not change what the frame reads.

        When nothing was written yet it is empty, or with ``must_exist`` an AnalysisException, as for any missing path.
        With ``values`` of the first partition column only those directories are listed and read, however many others there are.
        """
        snapshot = at or self.versions(table).latest()
        if snapshot is None and must_exist:
            return self.spark.read.schema(table.schema).parquet(self.path(table))
        leaves = self._leaves(table, snapshot or Snapshot())
        if values is not None:
            wanted = set(map(_directory_value, values))
            leaves = [leaf for leaf in leaves if _first_value(leaf) in wanted]
        return self._read_paths(table, (snapshot or Snapshot()).paths(leaves))

    def read_leaves(self, table: TableSpec, at: Snapshot, below: Iterable[str]) -> DataFrame:
        """The rows of the directories that are one of ``below``, or lie below one."""
        wanted = set(below)
        found = [leaf for leaf in self._leaves(table, at) if any(p in wanted for p in _parents(leaf))]
        return self._read_paths(table, at.paths(found))

    def read_images(self, table: TableSpec, versions: Iterable[Version]) -> DataFrame:
        """The images of changed rows that these versions carry."""
        return self._read_paths(table, [path for v in versions for path in v.images.values()])

    def _read_paths(self, table: TableSpec, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        reader = self.spark.read.schema(table.schema).option("basePath", self.path(table))
        return reader.parquet(*[f"{self.path(table)}/{p}" for p in paths]).select(*table.schema.names)

    def _leaves(self, table: TableSpec, snapshot: Snapshot) -> list[str]:
        return [leaf for leaf in snapshot.leaves if table.only is None or leaf.rpartition("/")[2] == table.only]

    def read_stream(self, table: TableSpec, max_versions: int | None = None) -> DataFrame:
        """The changes of a table as a stream of (version, leaf, writes, image), a few rows for each write of it."""
        kinds = schemas.struct(version=T.LongType(), leaf=T.StringType(), writes=T.ArrayType(T.StringType()), image=T.StringType())
        reader = self.spark.readStream.schema(kinds).option("pathGlobFilter", "*.json")
        if max_versions:
            reader = reader.option("maxFilesPerTrigger", max_versions)
        return reader.json(f"{self.path(table)}/{FOLDER}").where("leaf IS NOT NULL")

    def exists(self, table: TableSpec) -> bool:
        return self.versions(table).latest() is not None

    def partition_values(self, table: TableSpec) -> list[str]:
        """Values of the first partition column."""
        return sorted({_first_value(leaf) for leaf in self._leaves(table, self.snapshot(table))})

    # -- writing -------------------------------------------------------------------------------

    def ensure(self, table: TableSpec, database: str | None = None) -> None:
        """Make the table if absent. With ``database`` bring a catalog table, made if absent, to its latest version."""
        if not self.exists(table):
            self.commit(table, {})
        if database:
            self._publish(table, database)

    def _publish(self, table: TableSpec, database: str) -> None:
        """A catalog table knows one folder a partition, so those of several writes are compacted first."""
        self.compact(table, most=1)
        name, path, snapshot = f"`{database}`.`{table.name}`", self.path(table), self.snapshot(table)
        split = f"PARTITIONED BY ({', '.join(table.partitions)})" if table.partitions else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
        place = {leaf: f"{path}/w={snapshot.leaves[leaf][0]}/{leaf}".rstrip("/") for leaf in self._leaves(table, snapshot)}
        home = path + "/_catalog" if table.partitions else place.get("", path + "/_catalog")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {split} LOCATION '{home}'")
        if not table.partitions:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{home}'")
            return

        def spec(leaf: str) -> str:
            pairs = [part.partition("=") for part in leaf.split("/")]
            return ", ".join(f"`{c}` = " + ("NULL" if v == NULL_PARTITION else "'" + unquote(v).replace("'", "\\'") + "'") for c, _, v in pairs)

        known = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        for leaf in known - set(place):
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec(leaf)})")
        for leaf, folder in place.items():
            change = f"PARTITION ({spec(leaf)}) SET" if leaf in known else f"ADD IF NOT EXISTS PARTITION ({spec(leaf)})"
            self.spark.sql(f"ALTER TABLE {name} {change} LOCATION '{folder}'")
        self.spark.sql(f"REFRESH TABLE {name}")

    def create_from(self, df: DataFrame, table: TableSpec) -> bool:
        """Write ``df`` as a new table; leave an existing one alone. Says whether it wrote."""
        if self.exists(table):
            return False
        self.reload(df, table)
        return True

    def reload(self, df: DataFrame, table: TableSpec, marks: Mapping[str, object] | None = None) -> None:
        """Truncate and load."""
        write, leaves = self._stage(df, table)
        self._swap(table, write, leaves, lambda leaf: True, marks)

    def append(self, df: DataFrame, table: TableSpec, marks: Mapping[str, object] | None = None) -> None:
        write, leaves = self._stage(df, table)

        def change(now: Snapshot):
            return {leaf: (*now.leaves.get(leaf, ()), write) for leaf in leaves}, dict(marks or {})

        self.versions(table).commit(change, write, len(leaves))

    def replace_partitions(
        self, df: DataFrame, table: TableSpec, scope: Iterable[object] = (), marks: Mapping[str, object] | None = None
    ) -> None:
        """Replace the partitions ``df`` has rows for, and drop those of ``scope`` it has none for.

        ``scope`` holds values of the first partition column (days, boroughs). Both happen at once: a reader sees the table
        before or after.
        """
        write, leaves = self._stage(df, table)
        written = {_first_value(leaf) for leaf in leaves}
        emptied = set(map(_directory_value, scope)) - written
        self._swap(table, write, leaves, lambda leaf: _first_value(leaf) in emptied, marks)

    def replace_leaves(
        self,
        df: DataFrame,
        table: TableSpec,
        below: Iterable[str],
        base: Snapshot,
        images: str,
        marks: Mapping[str, object] | None = None,
    ) -> Snapshot:
        """Put ``df`` in place of all directories below ``below``, as computed from the version ``base``.

        Directories named ``images`` hold images of changed rows and do not become part of the table.
        """
        scope = set(below)
        write, leaves = self._stage(df, table)
        kept = [leaf for leaf in leaves if leaf.rpartition("/")[2] != images]

        def change(now: Snapshot):
            gone = {leaf: () for leaf in {*now.leaves, *base.leaves} if any(p in scope for p in _parents(leaf))}
            return gone | {leaf: (write,) for leaf in kept}, dict(marks or {})

        extra = [leaf for leaf in leaves if leaf not in kept]
        return self.versions(table).commit(change, write, len(leaves), extra, base)

    def commit(self, table: TableSpec, marks: Mapping[str, object]) -> None:
        """A version that changes no rows."""
        self.versions(table).commit(lambda now: ({}, dict(marks)))

    def merge(
        self,
        table: TableSpec,
        source: DataFrame,
        keys: Sequence[str],
        order: Sequence[str] = (),
        deletes: DataFrame | None = None,
    ) -> None:
        """Upsert ``source`` into the stored table by ``keys``, and remove the keys of ``deletes``.

        Of several source rows with one key the last in ``order`` counts. Only partitions that hold one of the keys, or that
        a new row belongs to, are read whole and rewritten. Unless the partition column is one of the keys, the key columns
        of the whole table are read first: a row whose new version lies in another partition leaves its old one.
        """
        base = self.snapshot(table)
        parts = list(table.partitions[:1])
        latest = merge.keep_latest(source, keys, order or list(source.columns))
        touched = latest.select(*keys) if deletes is None else latest.select(*keys).unionByName(deletes.select(*keys))
        values = None
        if parts:
            homes = latest.select(*parts)
            if parts[0] not in keys:
                stored = self.read(table, at=base).select(*keys, *parts)
                homes = homes.unionByName(stored.join(touched, list(keys), "left_semi").select(*parts))
            elif deletes is not None:
                homes = homes.unionByName(deletes.select(*parts))
            values = [row[0] for row in homes.distinct().collect()]  # partition values, never rows
        rows = merge.apply_deletes(self.read(table, values, at=base), touched, keys)
        added = latest.select(*rows.columns)
        if deletes is not None:
            added = merge.apply_deletes(added, deletes, keys)
        write, leaves = self._stage(rows.unionByName(added), table)
        inside = None if values is None else set(map(_directory_value, values))
        self._swap(table, write, leaves, lambda leaf: inside is None or _first_value(leaf) in inside, base=base)

    def drop_partitions(self, table: TableSpec, values: Iterable[object], marks: Mapping[str, object] | None = None) -> None:
        gone = set(map(_directory_value, values))
        if gone or marks:
            self._swap(table, None, [], lambda leaf: _first_value(leaf) in gone, marks)

    def compact(self, table: TableSpec, most: int = 16) -> int:
        """Rewrite the directories that more than ``most`` writes made up as one write each; gives how many there were.

        The rows stay the same. A writer that adds to one of them meanwhile wins, and the next call tries again.
        """
        base = self.snapshot(table)
        many = [leaf for leaf in self._leaves(table, base) if len(base.leaves[leaf]) > most]
        if many:
            write, leaves = self._stage(self._read_paths(table, base.paths(many)), table)
            versions = self.versions(table)
            try:
                versions.commit(lambda now: ({leaf: (write,) if leaf in leaves else () for leaf in many}, {}), write, len(leaves), (), base)
            except Conflict:
                return 0
        return len(many)

    def vacuum(self, table: TableSpec, keep: int = 100, grace_seconds: float = 86_400) -> list[str]:
        """Delete what only versions before the last ``keep`` name. Readers and followers may lag that far behind."""
        return self.versions(table).vacuum(keep, grace_seconds)

    def _swap(self, table: TableSpec, write: str | None, leaves: list[str], replaced: Callable[[str], bool], marks=None, base=None) -> None:
        def change(now: Snapshot):
            gone = {leaf: () for leaf in now.leaves if replaced(leaf)}
            return gone | {leaf: (write,) for leaf in leaves}, dict(marks or {})

        self.versions(table).commit(change, write, len(leaves), (), base)

    def _stage(self, df: DataFrame, table: TableSpec) -> tuple[str, list[str]]:
        """Write ``df`` to a folder of its own: the folder's name and the directories in it."""
        write = uuid.uuid4().hex
        rows = conform(df, table.schema)
        if table.partitions:
            # Rows of one directory meet in few files, and a directory that holds most of the
            # rows is split over several tasks.
            rows = rows.hint("rebalance", *table.partitions)
            rows = rows.sortWithinPartitions(*table.partitions, *table.sort_by)
        folder = f"{self.path(table)}/w={write}"
        rows.write.partitionBy(*table.partitions).parquet(folder)
        written = self.spark.read.schema(table.schema).parquet(folder).inputFiles()
        return write, sorted({unquote(file).partition(f"/w={write}/")[2].rpartition("/")[0] for file in written})


def _first_value(leaf: str) -> str:
    return unquote(leaf.partition("/")[0].partition("=")[2])


def _parents(leaf: str) -> list[str]:
    """The directory and those it lies in."""
    parts = leaf.split("/")
    return ["/".join(parts[: i + 1]) for i in range(len(parts))]


def _directory_value(value: object) -> str:
    return NULL_PARTITION if value is None else str(value)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, in its order and with its types."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[f.name if kinds[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_first(readers: Sequence[Callable[[], DataFrame]]) -> DataFrame:
    """The first source that can be read."""
    for reader in readers[:-1]:
        try:
            df = reader()
            df.schema
            return df
        except AnalysisException:
            continue
    return readers[-1]()


def apply_retention(df: DataFrame, column: str, days: int = 365, as_of=None) -> DataFrame:
    """Rows not older than ``days`` days."""
    kept = df.filter(F.col(column) >= clock.back(clock.moment(as_of), days=days))
    return filters.prune(kept, column, F.to_date(clock.back(clock.moment(as_of), days=days)), None)


def expire(lake: Lake, table: TableSpec, days: int, as_of: datetime, logs: Sequence[TableSpec] = ()) -> list[str]:
    """Drop the day or month partitions that lie wholly before the retention limit; gives their values.

    ``logs``, the tables from which ``table`` is rebuilt, lose the same days. The limit is stored as the tables' ``fence``:
    change streams reject what lies before it, so that a late change cannot bring an expired partition back.
    """
    limit = date.fromordinal(as_of.date().toordinal() - days)
    before = {len("2024-01-31"): limit.isoformat(), len("202401"): limit.strftime("%Y%m")}

    def drop(one: TableSpec) -> list[str]:
        values = lake.partition_values(one)
        old = [v for v in values if len(v) in before and v < before[len(v)]]
        fences = {before[len(v)] for v in values if len(v) in before}
        was = lake.snapshot(one).marks.get("fence")
        fence = max([f for f in (*fences, was) if f], default=None)
        lake.drop_partitions(one, old, {"fence": fence} if fence != was else None)
        return old

    for log in logs:
        drop(log)
    return drop(table)
