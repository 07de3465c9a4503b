"""Published zones: versioned table folders behind a list of committed versions.

A zone is a folder with ``_versions/<n>.json``, one small file for each committed version: it
names the folder of every table. A writer fills new folders that nobody reads yet and then
adds one version file; that is the only step a reader can see. So

* all tables of a job change together or not at all, and a failed job changes nothing;
* a reader that has opened a version keeps reading whole tables of it while the zone is
  rewritten, until ``expire`` removes what no kept version names;
* ``rollback`` is one more version that names old folders.

Adding a version file is a rename that fails if the number is taken (``Conflict``), so of
two writers that started from one version only one can publish.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_FILE = re.compile(r"^(\d{12})\.json$")


class Conflict(RuntimeError):
    """Another writer has published since this one began."""


class SmallFiles:
    """Listing, reading and adding small files wherever Spark itself can write."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none if there is no such folder."""
        path = self._path(folder)
        if not self._fs(path).exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(path))

    def stamps(self, path: str) -> list[tuple[str, int, int]]:
        """(name, bytes, time) of a file, or of the files in a folder."""
        target = self._path(path)
        fs = self._fs(target)
        if not fs.exists(target):
            return []
        return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(target))

    def read(self, file: str) -> str:
        path = self._path(file)
        stream = self._fs(path).open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def add(self, file: str, text: str) -> None:
        """A new file with this content, whole from the moment it is there. ``Conflict`` if the
        name is taken."""
        folder, _, name = file.rpartition("/")
        draft, target = self._path(f"{folder}/.{name}.{uuid.uuid4().hex}"), self._path(file)
        fs = self._fs(target)
        fs.mkdirs(self._path(folder))
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        options = self._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf).rename(
                fs.makeQualified(draft), fs.makeQualified(target), options)
        except Exception as e:  # noqa: BLE001 - py4j wraps every Java error alike
            fs.delete(draft, False)
            if fs.exists(target):
                raise Conflict(f"{file} exists") from e
            raise

    def remove(self, path: str) -> None:
        target = self._path(path)
        self._fs(target).delete(target, True)


@dataclass(frozen=True)
class Version:
    """A committed version: ``tables`` maps a table's name to what is known of it (its
    ``folder``, ``rows``, ...), ``meta`` holds whatever the writer needs next time."""

    number: int
    tables: dict
    meta: dict = field(default_factory=dict)


class Zone:
    """The committed versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), SmallFiles(spark)

    def numbers(self) -> list[int]:
        return [int(m[1]) for m in map(_FILE.match, self.files.names(f"{self.root}/_versions")) if m]

    def version(self, number: int | None = None) -> Version | None:
        """The given version, or the newest; None if nothing is published."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        text = json.loads(self.files.read(f"{self.root}/_versions/{number:012d}.json"))
        return Version(number, text["tables"], text.get("meta", {}))

    def commit(self, base: Version | None, tables: dict, meta: dict | None = None) -> Version:
        """Publish ``tables`` as the version after ``base``."""
        new = Version((base.number if base else 0) + 1, tables, meta or {})
        self.files.add(f"{self.root}/_versions/{new.number:012d}.json", json.dumps({"tables": new.tables, "meta": new.meta}))
        return new

    def rollback(self, number: int) -> Version:
        """Publish an old version's tables again."""
        old = self.version(number)
        return self.commit(self.version(), old.tables, old.meta)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` versions, and table folders that none of those
        names. For times when no reader has an older version open."""
        numbers = self.numbers()
        kept, gone = numbers[-keep:], numbers[:-keep]
        used = {f for n in kept for f in _folders(self.version(n))}
        old = sorted({f for n in gone for f in _folders(self.version(n))} - used)
        for n in gone:
            self.files.remove(f"{self.root}/_versions/{n:012d}.json")
        for f in old:
            self.files.remove(f"{self.root}/{f}")
        return old

    def draft(self) -> "Draft":
        return Draft(self, self.version())

    def pinned(self, number: int | None = None) -> "Pinned":
        """A reader of one version."""
        version = self.version(number)
        if version is None:
            raise ValueError(f"nothing is published in {self.root}")
        return Pinned(self, version)


def _folders(version: Version) -> set[str]:
    return {t["folder"] for t in version.tables.values()}


class Pinned:
    """Tables of one version, whatever is published later."""

    def __init__(self, zone: Zone, version: Version):
        self.zone, self.number, self.tables = zone, version.number, version.tables

    def table(self, name: str) -> DataFrame:
        return _open(self.zone, self.tables[name])

    def rows(self) -> dict[str, int]:
        return {n: t["rows"] for n, t in self.tables.items()}


class Draft:
    """Tables on their way to the next version; they can be read back here before."""

    def __init__(self, zone: Zone, base: Version | None):
        self.zone, self.base, self.new = zone, base, {}
        self.stamp = uuid.uuid4().hex[:12]

    def write(self, df: DataFrame, name: str, **layout) -> int:
        """Write a table into its new folder; returns its rows. ``layout`` as in ``write_table``."""
        from trilake.sources.parquet import write_table
        rows = write_table(df, f"{self.zone.root}/{name}", f"run_{self.stamp}", **layout)
        self.new[name] = {"folder": f"{name}/run_{self.stamp}", "rows": rows}
        return rows

    def table(self, name: str) -> DataFrame:
        return _open(self.zone, self.new[name])

    def publish(self) -> Version:
        """All written tables at once; the zone's other tables stay as they are."""
        return self.zone.commit(self.base, (self.base.tables if self.base else {}) | self.new)


def _open(zone: Zone, entry: dict) -> DataFrame:
    from trilake.sources.parquet import read_folder
    prefix, _, name = entry["folder"].rpartition("/")
    return read_folder(zone.spark, f"{zone.root}/{prefix}", name)
