"""Writing the targets.

Plain parquet cannot be changed in place while it is read, so every load writes new
folders and makes them current in one step:

* ``SnapshotTable`` - the whole table is replaced; a new version folder becomes current
  by its ``_SUCCESS`` marker, set once Spark has committed it, so readers see the old or
  the new table, never an empty one.
* ``PartitionedTable`` - only the partitions a load touches are written, once, to a folder
  of the load. A small version file says which folder holds each partition. It is made
  current by a rename, which fails if another load made that version first; the load is
  then computed again from the new version, so no load undoes another. Beside its data a
  load writes key summaries, by which later loads tell the partitions they need not open.

All folders live under the target's path, which must be reachable from every executor.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.day_states import STATE_SCHEMA, DayStates, states_of
from ledgerline.operators.loads import (
    INSERTED,
    KEPT,
    LOADED,
    REMOVED,
    UPDATED,
    apply_latest,
    batch_keys,
    last_per_key,
    observed,
    observed_kinds,
    replace_by_key,
    typed_keys,
)
from ledgerline.sinks import summaries

Columns = Sequence[tuple[str, str]]


def ddl(columns: Columns) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns)


class Folder:
    """The few file-system calls the sinks need, through Hadoop's API."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path_class = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")

    def _resolve(self, name: str):
        path = self._path_class(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path

    def exists(self, name: str = "") -> bool:
        files, path = self._resolve(name)
        return files.exists(path)

    def names(self, name: str = "") -> list[str]:
        files, path = self._resolve(name)
        if not files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(path))

    def mark(self, name: str) -> None:
        files, path = self._resolve(name)
        files.create(path, True).close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a small file so that it appears whole; False if there is one of that name."""
        draft_name = f"draft-{uuid.uuid4().hex}"
        files, path = self._resolve(name)
        _, draft = self._resolve(draft_name)
        stream = files.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        if not files.exists(path) and files.rename(draft, path):
            return True
        self.remove(draft_name)
        return False

    def remove(self, name: str) -> None:
        files, path = self._resolve(name)
        files.delete(path, True)


@dataclass
class SnapshotTable:
    """A target replaced as a whole, kept as numbered version folders."""

    spark: SparkSession
    path: str
    columns: Columns
    keep_versions: int = 2

    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    def versions(self, complete: bool = True) -> list[str]:
        folder = self._folder()
        names = [name for name in folder.names() if name.startswith("version-")]
        return [name for name in names if not complete or folder.exists(f"{name}/_SUCCESS")]

    def read(self) -> DataFrame:
        complete = self.versions()
        if not complete:
            return self.spark.createDataFrame([], ddl(self.columns))
        return self.spark.read.schema(ddl(self.columns)).parquet(f"{self.path}/{complete[-1]}")

    def write_unless_empty(self, df: DataFrame) -> int:
        """Write ``df`` as the next version and return its row count; 0 rows change nothing.

        The rows are counted while they are written. An empty version is taken back; older
        versions beyond ``keep_versions`` are dropped, and unfinished ones.
        """
        taken = self.versions(complete=False)
        number = int(taken[-1].removeprefix("version-")) + 1 if taken else 1
        name = f"version-{number:010d}"
        # Written unmarked first, so that an empty snapshot is never current.
        counted, rows = observed(df, "snapshot")
        counted.write.mode("errorifexists").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
            f"{self.path}/{name}"
        )
        count = rows.get["row_count"]
        if count == 0:
            self._folder().remove(name)
            return 0
        self._folder().mark(f"{name}/_SUCCESS")
        # Older versions, and those a broken load left unfinished.
        kept = self.versions()[-self.keep_versions :]
        for old in self.versions(complete=False):
            if old < name and old not in kept:
                self._folder().remove(old)
        return count


_KIND = "_kind"


def _keys_label(keys: Sequence[str]) -> str:
    """A folder name for a list of key columns."""
    return "-".join(keys)


@dataclass(frozen=True)
class Version:
    """What a version file says: the load folder of each partition, and the latest loads with their row counts.

    ``counts``: of each of these loads, the rows that were kept, removed, loaded, inserted and updated in the partitions
    it touched.
    """

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    loads: Mapping[str, int] = field(default_factory=dict)
    counts: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    def file_name(self) -> str:
        return f"{self.number:010d}.json"


@dataclass
class PartitionedTable:
    """A target partitioned by a derived column, changed partition by partition.

    ``partition`` is computed from each row (for example the month of its date) and gives
    text that can stand in a folder name; a null value is a partition like any other. One
    load has one ``run_id``. A broken load has changed nothing and may be run again, under
    its run id or another; a load already done is not done again under the same id.
    Readers of the previous version are not disturbed by a load, those of older ones are.
    """

    spark: SparkSession
    path: str
    columns: Columns
    partition_name: str
    partition: Column
    keep_versions: int = 2
    keep_loads: int = 1000
    day_states: DayStates | None = None

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _versions(self) -> Folder:
        return Folder(self.spark, f"{self.path}/versions")

    def _version_files(self) -> list[str]:
        return [name for name in self._versions().names() if name.endswith(".json")]

    def _version(self, name: str) -> Version:
        text = self.spark.read.text(f"{self.path}/versions/{name}", wholetext=True).first()[0]
        return Version(int(name.removesuffix(".json")), **json.loads(text))

    def current(self) -> Version:
        names = self._version_files()
        return self._version(names[-1]) if names else Version()

    def _rows_of(self, folders: Mapping[str, str]) -> DataFrame:
        """The given partitions, with the partition column."""
        schema = f"{ddl(self.columns)}, `{self.partition_name}` string"
        if not folders:
            # The limit tells Spark that there is no row, so that joins with it are left out.
            return self.spark.createDataFrame([], schema).limit(0)
        paths = [f"{self._data}/load_folder={load}/{self.partition_name}={name}" for name, load in folders.items()]
        reader = self.spark.read.schema(f"{schema}, load_folder string").option("basePath", self._data)
        return reader.parquet(*paths).drop("load_folder")

    def read(self, since: str | None = None) -> DataFrame:
        """The current version; with ``since`` only partitions from that name on are listed and read."""
        folders = self.current().folders
        wanted = {name: load for name, load in folders.items() if since is None or name >= since}
        return self._rows_of(wanted).drop(self.partition_name)

    def counts(self, run_id: str) -> Mapping[str, int]:
        """Rows by what a load did to them, in the partitions it touched: kept, removed, loaded, inserted, updated."""
        return self.current().counts.get(run_id, {})

    def _summaries(self, version: Version, keys: Sequence[str]) -> DataFrame:
        """The summaries of the version's partitions, where these keys were summarised."""
        kinds = dict(self.columns)
        schema = summaries.summary_schema([(key, kinds[key]) for key in keys], self.partition_name)
        folder = Folder(self.spark, f"{self.path}/summaries")
        label = _keys_label(keys)
        there = {name.removeprefix("load_folder=") for name in folder.names(f"keys_of={label}")}
        paths = [f"{folder.path}/keys_of={label}/load_folder={load}" for load in sorted(set(version.folders.values()) & there)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(f"{schema}, load_folder string").option("basePath", f"{folder.path}/keys_of={label}").parquet(*paths)
        return self._current_only(found, version.folders)

    def _current_only(self, rows: DataFrame, folders: Mapping[str, str]) -> DataFrame:
        """Of rows kept beside the data, those of the given partitions as their load folder has them."""
        held = self.spark.createDataFrame(list(folders.items()), f"`{self.partition_name}` string, load_folder string")
        return rows.join(held, [self.partition_name, "load_folder"], "left_semi").drop("load_folder")

    def states(self, since: str | None = None) -> DataFrame:
        """The day states of the current version's partitions (from a name on); no line is read.

        Only partitions of loads that kept no states yet have theirs made from their lines.
        """
        wanted = {name: load for name, load in self.current().folders.items() if since is None or name >= since}
        folder = Folder(self.spark, f"{self.path}/states")
        there = {name.removeprefix("load_folder=") for name in folder.names()}
        kept = {name: load for name, load in wanted.items() if load in there}
        found = self.spark.createDataFrame([], STATE_SCHEMA)
        if kept:
            paths = [f"{folder.path}/load_folder={load}" for load in sorted(set(kept.values()))]
            schema = f"`{self.partition_name}` string, {STATE_SCHEMA}, load_folder string"
            rows = self.spark.read.schema(schema).option("basePath", folder.path).parquet(*paths)
            found = self._current_only(rows, kept).drop(self.partition_name)
        missing = {name: load for name, load in wanted.items() if name not in kept}
        if missing:
            found = found.unionByName(states_of(self._rows_of(missing), self.day_states))
        return found

    def candidates(self, version: Version, wanted: DataFrame, keys: Sequence[str]) -> set[str]:
        """Partitions of the version that may hold one of the wanted keys; no data is opened."""
        found = self._summaries(version, keys)
        return summaries.candidates(found, self.partition_name, wanted, keys, version.folders)

    def _shaped(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.partition_name, F.coalesce(self.partition.cast("string"), F.lit("none")))

    def replace_by_key(
        self,
        batch: DataFrame,
        run_id: str,
        keys: Sequence[str],
        key_types: Mapping[str, str] | None = None,
        required: Sequence[str] = (),
    ) -> int:
        """Replace the batch's keys; returns the number of rows loaded (0: nothing was touched)."""

        def change(target: DataFrame, staged: DataFrame) -> DataFrame:
            return replace_by_key(target, staged, keys, key_types, required, kind=_KIND)

        def wanted(staged: DataFrame) -> DataFrame:
            if key_types or required:
                # A key that does not fit stops the load, also where no partition is searched for it.
                typed_keys(staged, keys, key_types, required).agg(*[F.max(key) for key in keys]).collect()
            return batch_keys(staged, keys, key_types, required)

        return self._load(batch, run_id, keys, wanted, change)

    def upsert(
        self,
        changes: DataFrame,
        run_id: str,
        keys: Sequence[str],
        order_by: Sequence[str] | None = None,
        defaults: Mapping[str, Column] | None = None,
    ) -> int:
        """Insert or update by key; returns the number of changed rows.

        The last of several changes to a key, by ``order_by``, wins. Without ``order_by`` the
        changes must have one row per key, as those of ``new_or_changed`` do. Columns of the
        target alone keep their value on an update and take their default on an insert.
        """
        latest = changes if order_by is None else last_per_key(changes, keys, order_by)

        def change(target: DataFrame, staged: DataFrame) -> DataFrame:
            return apply_latest(target, staged, keys, defaults, kind=_KIND)

        return self._load(latest, run_id, keys, lambda staged: staged.select(*keys), change)

    def _load(
        self,
        batch: DataFrame,
        run_id: str,
        keys: Sequence[str],
        wanted: Callable[[DataFrame], DataFrame],
        change: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> int:
        """Compute the load from the current version until it can be made the next one."""
        while True:
            version = self.current()
            if run_id in version.loads:
                return version.loads[run_id]
            folder = f"{version.number:010d}-{run_id}"
            staging = Folder(self.spark, f"{self.path}/staging")
            # The batch is written once; the load then reads the copy, not its lineage.
            counted, observation = observed(batch, "batch")
            counted.write.mode("overwrite").parquet(f"{staging.path}/{folder}")
            rows = observation.get["row_count"]
            if rows == 0:
                staging.remove(folder)
                return 0
            staged = self.spark.read.schema(batch.schema).parquet(f"{staging.path}/{folder}")
            after, kinds = self._written(version, folder, staged, keys, wanted(staged), change)
            latest = list(version.loads.items())[1 - self.keep_loads :] if self.keep_loads > 1 else []
            counts = {name: version.counts[name] for name, _ in latest if name in version.counts}
            done = Version(version.number + 1, after, {**dict(latest), run_id: rows}, {**counts, run_id: kinds})
            published = self.publish(done)
            staging.remove(folder)
            if published:
                self._clean(done)
                return rows
            Folder(self.spark, self._data).remove(f"load_folder={folder}")
            for beside in (f"summaries/keys_of={_keys_label(keys)}", "states"):
                Folder(self.spark, f"{self.path}/{beside}").remove(f"load_folder={folder}")

    def _written(
        self,
        version: Version,
        folder: str,
        staged: DataFrame,
        keys: Sequence[str],
        wanted: DataFrame,
        change: Callable[[DataFrame, DataFrame], DataFrame],
    ) -> tuple[dict[str, str], dict[str, int]]:
        """Write the touched partitions' new rows; returns every partition's load folder, and the rows by kind."""
        kinds = dict(self.columns)
        typed = wanted.dropna().select(*[F.col(key).cast(kinds[key]).alias(key) for key in keys])
        # Driver-side list of partition names, one per partition of the table at most. Those that the batch has rows
        # for are written anyway; only the others need be searched for its keys.
        touched = {row[0] for row in self._shaped(staged).select(self.partition_name).distinct().collect()}
        others = replace(version, folders={name: load for name, load in version.folders.items() if name not in touched})
        if others.folders:
            near = self.candidates(others, typed, keys)
            searched = self._rows_of({name: load for name, load in others.folders.items() if name in near})
            old = searched.select(self.partition_name, *keys).join(typed, list(keys), "left_semi")
            touched |= {row[0] for row in old.select(self.partition_name).distinct().collect()}
        held = {name: load for name, load in version.folders.items() if name in touched}
        before = self._rows_of(held)
        after = self._shaped(change(before.drop(self.partition_name), staged))
        # Rebalanced by measured size: a large partition is written by many tasks, small ones by one. The rows are
        # counted behind the exchange, in the tasks that write them.
        path = f"load_folder={folder}"
        marked, observation = observed_kinds(after.hint("rebalance", self.partition_name), _KIND, "after")
        marked.write.mode("overwrite").partitionBy(self.partition_name).parquet(f"{self._data}/{path}")
        prefix = f"{self.partition_name}="
        written = {name.removeprefix(prefix): folder for name in Folder(self.spark, self._data).names(path) if name.startswith(prefix)}
        self._summarise(written, folder, keys)
        by_kind = {name: int(observation.get[name]) for name in (KEPT, LOADED, INSERTED, UPDATED)}
        by_kind[REMOVED] = self._row_count(version, held, keys) - by_kind[KEPT] - by_kind[UPDATED] if held else 0
        kept = {name: load for name, load in version.folders.items() if name not in touched}
        return kept | written, by_kind

    def _row_count(self, version: Version, held: Mapping[str, str], keys: Sequence[str]) -> int:
        """Rows of some partitions, from their summaries; only those without one are counted."""
        known = summaries.row_counts(self._summaries(version, keys), self.partition_name)
        unknown = {name: load for name, load in held.items() if name not in known}
        counted = self._rows_of(unknown).count() if unknown else 0
        return counted + sum(known.get(name, 0) for name in held)

    def _summarise(self, written: Mapping[str, str], folder: str, keys: Sequence[str]) -> None:
        """Write the key summaries, and the day states, of partitions just written, from the columns these need."""
        if not written:
            return
        rows, place = self._rows_of(written), f"load_folder={folder}"
        found = summaries.summarised(rows.select(self.partition_name, *keys), self.partition_name, keys)
        found.write.mode("overwrite").parquet(f"{self.path}/summaries/keys_of={_keys_label(keys)}/{place}")
        if self.day_states is not None:
            states = states_of(rows, self.day_states, [self.partition_name])
            states.write.mode("overwrite").parquet(f"{self.path}/states/{place}")

    def publish(self, version: Version) -> bool:
        """Make the version current; False if another load has made one of its number."""
        content = json.dumps({"folders": version.folders, "loads": version.loads, "counts": version.counts})
        return self._versions().write_new(version.file_name(), content)

    def _clean(self, current: Version) -> None:
        """Drop old version files, and folders no kept version names that began before the previous version."""
        files = self._version_files()
        for name in files[: -self.keep_versions]:
            self._versions().remove(name)
        named = {load for name in files[-self.keep_versions :] for load in self._version(name).folders.values()}
        begun_before = f"{current.number - 1:010d}"
        of_keys = f"{self.path}/summaries"
        summed = [(f"{of_keys}/{name}", "load_folder=") for name in Folder(self.spark, of_keys).names()]
        beside = [(f"{self.path}/states", "load_folder="), *summed]
        for folder, prefix in ((self._data, "load_folder="), (f"{self.path}/staging", ""), *beside):
            for name in Folder(self.spark, folder).names():
                load = name.removeprefix(prefix)
                if load < begun_before and load not in named:
                    Folder(self.spark, folder).remove(name)
