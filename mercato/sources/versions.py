"""Tables that are replaced whole, without a moment when they are missing.

A table is a folder that holds a data folder for each version and, in
``_live``, an empty marker file for each version that was written to its end::

    orders_cleaned.parquet/v-6f.../part-...parquet
    orders_cleaned.parquet/_live/000000000003.150000.v-6f...

Creating the marker is the one step that makes a version visible, so a job
that dies while it writes leaves the old version in place, and readers, which
take the marker with the highest number, see the old or the new table, never a
mixture.  The marker names the rows too, so a count needs no scan.  The
version before the live one stays for readers that have begun; older ones are
removed when a new one is published.  (Spark's own overwrite deletes the table
first and writes then.)

Only file names are handled here, by the Hadoop file system that Spark itself
uses for the path; data is read and written by Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

LIVE = "_live"
KEPT = 2  # versions that stay


@dataclass(frozen=True)
class Version:
    number: int
    rows: int
    folder: str  # below the table's folder


class _Files:
    def __init__(self, spark: SparkSession, root: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(conf)

    def of(self, name: str = ""):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        path = self.of(name)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self) -> bool:
        return self._fs.exists(self.of())

    def create(self, name: str) -> None:
        """A new empty file; fails where there is one."""
        self._fs.create(self.of(name), False).close()

    def delete(self, name: str) -> None:
        self._fs.delete(self.of(name), True)


def _versions(files: _Files) -> list[Version]:
    out = []
    for name in files.names(LIVE):
        number, rows, folder = name.split(".", 2)
        out.append(Version(int(number), int(rows), folder))
    return sorted(out, key=lambda v: (v.number, v.folder))


def live(spark: SparkSession, path: str) -> Version | None:
    """The version that readers take; None where the folder has none."""
    return max(_versions(_Files(spark, path)), key=lambda v: (v.number, v.folder), default=None)


def live_path(spark: SparkSession, path: str) -> str:
    """The folder to read: the live version's, or ``path`` itself for a plain
    table that was not written by ``replace``."""
    version = live(spark, path)
    return path if version is None else f"{path.rstrip('/')}/{version.folder}"


def replace(spark: SparkSession, path: str, write: Callable[[str], int]) -> int:
    """Writes a new version and makes it the live one.  ``write`` fills the
    folder it is given and returns the rows; if it fails, what it has written
    is removed and the old version stays."""
    files, folder = _Files(spark, path), f"v-{uuid.uuid4().hex}"
    try:
        rows = write(f"{files.root}/{folder}")
    except BaseException:
        files.delete(folder)
        raise
    before = _versions(files)
    number = before[-1].number + 1 if before else 1
    files.create(f"{LIVE}/{number:012d}.{rows}.{folder}")
    for old in before[:max(0, len(before) + 1 - KEPT)]:
        files.delete(f"{LIVE}/{old.number:012d}.{old.rows}.{old.folder}")
        files.delete(old.folder)
    return rows


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder and all below it."""
    _Files(spark, path).delete("")


def history(spark: SparkSession, path: str) -> list[Version]:
    """The versions that can still be read, oldest first."""
    return _versions(_Files(spark, path))
