"""Which folders of a stored table count: numbered entries, each created once, so that of two writers one has to look again.

A writer stores its rows in a folder of its own, which no reader sees, and then creates the next entry. An entry that exists is
never replaced; who comes second reads the newer entries and tries again. A writer that dies leaves a folder no entry names:
readers skip it, and `clear_abandoned` removes it later. Entries hold names and counts only.

An entry is written under a passing name and put in place by a step that fails where the name is taken: a hard link on a local
file system, else a rename, which HDFS refuses in that case. A store whose rename overwrites needs another such step (``put``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

DIGITS = 12


class Conflict(Exception):
    """Another writer has created this entry."""


class CommitLog:
    """The entries of the table below ``path``; ``put(fs, source, target)`` returns whether it put a file in place that was not there."""

    def __init__(self, spark: SparkSession, path: str, put: Callable | None = None):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.folder = self._file(f"{self.path}/_commits")
        self.fs = self.folder.getFileSystem(self.conf)
        self.put = put or self._put

    def _file(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _put(self, fs, source, target) -> bool:
        real = fs.resolvePath(source).toUri()
        if real.getScheme() == "file":
            paths, files = self.jvm.java.nio.file.Paths, self.jvm.java.nio.file.Files
            held = paths.get(real)
            try:
                files.createLink(held.resolveSibling(target.getName()), held)
            except Py4JJavaError as problem:
                if problem.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                    return False
                raise
            return True
        return not fs.exists(target) and fs.rename(source, target)

    def _read(self, status) -> dict:
        stream = self.fs.open(status.getPath())
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """The number and content of the newest entry; (0, {}) for a table without any."""
        if not self.fs.exists(self.folder):
            return 0, {}
        entries = [status for status in self.fs.listStatus(self.folder) if status.getPath().getName().endswith(".json")]
        if not entries:
            return 0, {}
        newest = max(entries, key=lambda status: status.getPath().getName())
        return int(newest.getPath().getName().removesuffix(".json")), self._read(newest)

    def commit(self, number: int, entry: dict) -> None:
        """Create the entry ``number``, one more than the one that was read; `Conflict` where it exists."""
        self.fs.mkdirs(self.folder)
        source, target = self._file(f"{self.path}/_commits/_{uuid.uuid4().hex}"), self._file(f"{self.path}/_commits/{number:0{DIGITS}d}.json")
        stream = self.fs.create(source, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        try:
            if self.fs.exists(target) or not self.put(self.fs, source, target):
                raise Conflict(f"entry {number} of {self.path} exists")
        finally:
            self.fs.delete(source, False)

    def folders(self, name: str, prefix: str) -> set[str]:
        """What follows ``prefix`` in the names of the folders that a write made below the folder ``name``."""
        names = [status.getPath().getName() for status in self.fs.listStatus(self._file(f"{self.path}/{name}")) if status.isDirectory()]
        return {found.removeprefix(prefix) for found in names if found.startswith(prefix)}

    def clear_abandoned(self, named: set[str], older_than_s: float) -> list[str]:
        """Remove folders below the table that are not ``named`` and whose last change is older. Returns their names."""
        now, gone = self.jvm.java.lang.System.currentTimeMillis(), []
        root = self._file(self.path)
        if not self.fs.exists(root):
            return gone
        for status in self.fs.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and not name.startswith("_") and name not in named and now - status.getModificationTime() > older_than_s * 1000:
                self.fs.delete(status.getPath(), True)
                gone.append(name)
        return gone
