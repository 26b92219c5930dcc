"""Published tables (SNK3-SNK5): every write is a new folder, one commit file makes it visible.

Below a root lie ``data/<unique>/`` folders, written once and never changed, and ``commits/``, a
numbered log.  A commit names, for each table, its parts: (run key, folder).  Readers take the
newest commit and read the folders it names, so they see either the old or the new contents, of
all tables of a bundle alike, whatever is lost meanwhile.  A commit file is written aside and
renamed into place; the rename fails if another writer took the number, and the commit is then
made again on top of that writer's.

Replacing a table gives it one part.  Appending a run sets the part of the run's key, so running
a day again replaces that day's rows and adds none twice: the log is the ledger of the runs.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_NUMBER = "{:020d}.json"


class _Store:
    """The few file operations a commit needs, on the file system of ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm, self.root = spark, spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def names(self, folder: str) -> list[str]:
        p = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self._path(f"{self.root}/{name}"), False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def rename_new(self, old: str, new: str) -> bool:
        """Rename unless ``new`` exists; whether it was renamed."""
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        at = self.fs.makeQualified(self._path(f"{self.root}/{new}"))
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), self.conf).rename(
                self.fs.makeQualified(self._path(f"{self.root}/{old}")), at, options)
        except Exception as e:
            if self.fs.exists(at):
                return False
            raise OSError(f"cannot commit {new} below {self.root}") from e
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.root}/{name}"), True)


def _commits(store: _Store) -> list[str]:
    return [n for n in store.names("commits") if n.endswith(".json") and n[:-5].isdigit()]


def _state(store: _Store, version: int | None = None) -> tuple[int, dict]:
    """(version, {table: {run: folder}}) of a commit, the newest by default; (0, {}) before the first."""
    names = _commits(store)
    if version is not None:
        names = [n for n in names if int(n[:-5]) == version]
        if not names:
            raise ValueError(f"no version {version} below {store.root}")
    return (int(names[-1][:-5]), json.loads(store.read(f"commits/{names[-1]}"))) if names else (0, {})


def _commit(store: _Store, change) -> int:
    """Apply ``change`` to the newest state and commit it as the next version."""
    while True:
        version, state = _state(store)
        aside = f"commits/.{uuid.uuid4().hex}"
        store.write(aside, json.dumps(change(state), ensure_ascii=False))
        try:
            if store.rename_new(aside, "commits/" + _NUMBER.format(version + 1)):
                return version + 1
        except BaseException:
            store.delete(aside)
            raise
        store.delete(aside)


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], run: str | None = None,
            dates_as_text: bool = True) -> dict[str, bool]:
    """Write all ``tables`` and make them visible in one commit; tells which had rows.

    Without ``run`` a table's contents are replaced (SNK3, SNK5); with it, the rows become the part
    of that run key and other runs' parts stay (SNK4).  A table without rows keeps what it had.
    Each plan runs once.  If a plan or the commit fails, readers go on seeing the old contents.
    """
    from . import _counted, _dates_as_text
    store, parts = _Store(spark, root), {}
    wrote = {}
    for name, df in tables.items():
        folder = f"data/{uuid.uuid4().hex}"
        out, rows = _counted(_dates_as_text(df) if dates_as_text else df)
        out.write.parquet(f"{store.root}/{folder}")
        wrote[name] = rows.get["n"] > 0
        if wrote[name]:
            parts[name] = folder
        else:
            store.delete(folder)

    def change(state: dict) -> dict:
        return state | {name: (state.get(name, {}) if run is not None else {}) | {run or "": folder} for name, folder in parts.items()}
    if parts:
        _commit(store, change)
    return wrote


def read_published(spark: SparkSession, root: str, table: str, version: int | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """SRC16: a published table as of the newest commit, or of ``version``.

    A table that no commit names is empty with ``schema``, or an error without one."""
    store = _Store(spark, root)
    parts = _state(store, version)[1].get(table)
    if not parts:
        if schema is None:
            raise ValueError(f"table {table} was never published below {root}")
        return spark.createDataFrame([], schema)
    return spark.read.parquet(*[f"{store.root}/{folder}" for folder in parts.values()])


def versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first."""
    return [int(n[:-5]) for n in _commits(_Store(spark, root))]


def runs(spark: SparkSession, root: str, table: str) -> list[str]:
    """Run keys that a published table holds, in order of their first append."""
    return list(_state(_Store(spark, root))[1].get(table, {}))


def forget_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Drop all commits but the newest ``keep`` and every folder none of those names; returns folders dropped.

    Run it when no writer is at work: a folder written but not yet committed would go too."""
    store = _Store(spark, root)
    names = _commits(store)
    kept = {folder for n in names[-keep:] for parts in json.loads(store.read(f"commits/{n}")).values() for folder in parts.values()}
    for n in names[:-keep]:
        store.delete(f"commits/{n}")
    old = [f"data/{n}" for n in store.names("data") if f"data/{n}" not in kept]
    for folder in old:
        store.delete(folder)
    return len(old)
