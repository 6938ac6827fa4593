"""Tables that change in one step (SNK-8): immutable partition folders and one list of those in force.

``root/<table>/v=<id>/<col>=<value>/part-*``  folders written once, never changed
``root/_versions/<number>.json``              which folders make up every table, and the load's notes

A reader takes the newest list and reads the folders that it names. A load writes new folders, which
nobody reads yet, and puts the next list in place by a rename that fails if the number is taken, so a
crash at any point leaves the old state or the new one, for all tables of the root together, and of
two loads that began at the same state one fails. Files of a load that did not end, and folders no
longer named, are deleted by :meth:`Snapshots.vacuum`.

A list has an entry per partition folder (days, not rows). A changed key rewrites only the folders that
hold it: several folders of one partition value may be in force side by side.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorwerk.sinks import lake

VERSIONS = "_versions"


class Conflict(RuntimeError):
    """Another load put its list in place since this one read the state."""


@dataclass
class State:
    """A list in force: per table its schema, partition columns and folders."""
    number: int = 0
    tables: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def folders(self, table: str) -> list[str]:
        return self.tables.get(table, {}).get("folders", [])


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}" if relative else self.root)

    # ---- lists ----------------------------------------------------------------------------------
    def numbers(self) -> list[int]:
        if not self._fs.exists(self._path(VERSIONS)):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(VERSIONS))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, number: int | None = None) -> State:
        """The newest state, or that of a number."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return State()
        stream = self._fs.open(self._path(f"{VERSIONS}/{number:012d}.json"))
        try:
            held = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return State(number, held["tables"], held["notes"])

    def _put(self, state: State) -> None:
        name = f"{VERSIONS}/{state.number:012d}.json"
        draft = self._path(f"{VERSIONS}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"tables": state.tables, "notes": state.notes}).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._path(name)), plain)
        except Exception as err:
            self._fs.delete(draft, False)
            if self._fs.exists(self._path(name)):
                raise Conflict(f"state {state.number} of {self.root} is taken") from err
            raise

    # ---- reading --------------------------------------------------------------------------------
    def table(self, name: str, state: State | None = None, folders: list[str] | None = None) -> DataFrame:
        """The table's rows in a state (the newest by default), or those of some of its folders."""
        state = state or self.state()
        if name not in state.tables:
            raise ValueError(f"{self.root} has no table {name}")
        schema = StructType.fromJson(state.tables[name]["schema"])
        named = state.folders(name) if folders is None else folders
        if not named:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        return self._files(name, schema, named).select(*schema.fieldNames())

    def _files(self, name: str, schema: StructType, folders: list[str]) -> DataFrame:
        read = self.spark.read.option("basePath", f"{self.root}/{name}").schema(schema)
        return read.parquet(*[f"{self.root}/{name}/{folder}" for folder in folders])

    def holding(self, name: str, state: State, hit: Callable[[DataFrame], DataFrame]) -> list[str]:
        """The folders with rows that ``hit`` keeps (a semi-join, as a rule)."""
        if not state.folders(name):
            return []
        rows = self._files(name, StructType.fromJson(state.tables[name]["schema"]), state.folders(name))
        place = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
        found = hit(rows.select("*", place)).select("_folder").distinct().collect()      # at most a row a folder
        base = unquote(urlparse(self._fs.makeQualified(self._path(name)).toUri().toString()).path)
        return sorted({unquote(urlparse(r[0]).path)[len(base) + 1:] for r in found})

    # ---- writing --------------------------------------------------------------------------------
    def write(self, name: str, rows: DataFrame, partition_cols: list[str], order=(), size: int | None = None) -> list[str]:
        """New folders with the rows, in force only after :meth:`commit`. With ``order`` the files hold ranges of
        these columns, sorted, as many as ``size`` bytes call for."""
        folder = f"v={uuid.uuid4().hex}"
        if order:
            lake.write_clustered(rows, f"{self.root}/{name}/{folder}", order, order, partition_cols, mode="errorifexists", size=size)
        else:
            lake.write_partitioned(rows, f"{self.root}/{name}/{folder}", partition_cols, mode="errorifexists")
        base = self._fs.makeQualified(self._path(name)).toUri().getPath()
        found = self._fs.globStatus(self._path(f"{name}/{folder}" + "/*=*" * len(partition_cols))) or []
        return sorted(f.getPath().toUri().getPath()[len(base) + 1:] for f in found)

    def commit(self, before: State, changes: dict[str, Change], notes: dict | None = None) -> State:
        """Puts all changes into force at once; raises :class:`Conflict` if ``before`` is not the newest state."""
        tables = {k: dict(v) for k, v in before.tables.items()}
        for name, change in changes.items():
            kept = [f for f in before.folders(name) if f not in set(change.drops)]
            tables[name] = {"schema": change.schema.jsonValue(), "partition_cols": change.partition_cols, "folders": kept + change.adds}
        state = State(before.number + 1, tables, notes or {})
        self._put(state)
        return state

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes folders that none of the ``keep`` newest lists names, and older lists. Run while no load is writing."""
        numbers = self.numbers()
        kept = [self.state(n) for n in numbers[-keep:]]
        gone = []
        tables = {t for s in kept for t in s.tables}
        for t in tables:
            named = {f for s in kept for f in s.folders(t)}
            held = {f.split("/")[0] for f in named}
            for version in self._fs.globStatus(self._path(f"{t}/v=*")) or []:
                folder = version.getPath().getName()
                depth = len(kept[-1].tables.get(t, {}).get("partition_cols", []))
                parts = self._fs.globStatus(self._path(f"{t}/{folder}" + "/*=*" * depth)) or []
                base = self._fs.makeQualified(self._path(t)).toUri().getPath()
                stale = [p.getPath() for p in parts if p.getPath().toUri().getPath()[len(base) + 1:] not in named]
                for path in [version.getPath()] if folder not in held else stale:
                    self._fs.delete(path, True)
                    gone.append(path.toUri().getPath())
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{VERSIONS}/{n:012d}.json"), False)
        return gone


@dataclass
class Change:
    """Folders that a load takes out of force and those it adds."""
    schema: StructType
    partition_cols: list
    drops: list
    adds: list


def replace_rows(snap: Snapshots, state: State, name: str, rows: DataFrame, partition_cols: list[str],
                 keys: DataFrame | None = None, key: str = "event_id", also: Callable[[DataFrame], DataFrame] | None = None,
                 finish: Callable[[DataFrame], DataFrame] | None = None, order=(), size: int = 0) -> Change:
    """Writes a table's next content: rows of the staged ``keys`` go, ``rows`` come.

    ``keys`` (default: the keys of ``rows``) are looked for in the key column alone; NULL keys match
    nothing. Folders that hold one are rewritten without it, the others stay. ``also`` keeps the
    rows whose folders are to be rewritten for another reason, and ``finish`` is applied to all that is
    written (rows kept of these folders and new ones), which ``order`` sorts; ``size``: bytes of the new rows.
    """
    gone = (keys if keys is not None else rows.select(key)).where(F.col(key).isNotNull()).select(key).distinct()
    folders: list[str] = []
    if state.folders(name):
        gone = lake.join_side(gone)
        folders = snap.holding(name, state, lambda t: t.join(gone, key, "left_semi"))
        if also is not None:
            folders = sorted({*folders, *snap.holding(name, state, also)})
    content = rows
    if folders:
        kept = snap.table(name, state, folders).join(gone, key, "left_anti")
        content = kept.unionByName(rows.select(*kept.columns))
    if finish is not None:
        content = finish(content)
    if order:
        size += lake.rows_bytes(snap.table(name, state, folders)) if folders else 0
    adds = snap.write(name, content, partition_cols, order, size)
    schema = content.schema if name not in state.tables else StructType.fromJson(state.tables[name]["schema"])
    return Change(schema, list(partition_cols), folders, adds)


def compact(snap: Snapshots, name: str, where: Column | None = None) -> State:
    """Rewrites the folders of the matching rows' partitions as one folder a partition value."""
    state = snap.state()
    table = state.tables[name]
    cols, schema = table["partition_cols"], StructType.fromJson(table["schema"])
    named = state.folders(name) if where is None else snap.holding(name, state, lambda t: t.where(where))
    values = {f.split("/", 1)[1] for f in named}
    folders = [f for f in state.folders(name) if f.split("/", 1)[1] in values]
    if not folders:
        return state
    adds = snap.write(name, snap.table(name, state, folders), cols)
    return snap.commit(state, {name: Change(schema, cols, folders, adds)}, state.notes)
