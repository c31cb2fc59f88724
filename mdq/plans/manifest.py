"""The list of what a stored table consists of, replaced as a whole.

``<root>/_manifest/<number>.json`` is one state of the table. A state is written
under a temporary name and renamed, and the highest number counts; so a reader
sees one state or the next, and folders that no state names (left by a run that
broke off) are never read. Two writers that start from the same state cannot
both commit: the second finds its number taken.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._context = jvm.org.apache.hadoop.fs.FileContext
        self._rename = jvm.org.apache.hadoop.fs.Options.Rename
        self._array = lambda kind, n: spark.sparkContext._gateway.new_array(kind, n)
        self._read_all = jvm.org.apache.hadoop.io.IOUtils
        self._bytes = jvm.org.apache.hadoop.io.Text
        self._conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self._conf)

    def _file(self, number: int):
        return self._path(f"{self.root}/_manifest/{number:08d}.json")

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifest")
        if not self.fs.exists(folder):
            return []
        names = [x.getPath().getName() for x in self.fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """(number, state) of the newest state, or of a given one; (0, {}) if there is none."""
        if number is None:
            number = (self.versions() or [0])[-1]
        if not number:
            return 0, {}
        f = self._file(number)
        size = int(self.fs.getFileStatus(f).getLen())
        stream, text = self.fs.open(f), self._bytes()
        try:
            text.readWithKnownLength(stream, size)
        finally:
            stream.close()
        return number, json.loads(text.toString())

    def commit(self, number: int, state: dict) -> int:
        """Make ``state`` the successor of state ``number``."""
        new, tmp = self._file(number + 1), self._path(f"{self.root}/_manifest/.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(state, indent=1).encode()))
        finally:
            out.close()
        if self.versions()[-1:] != ([number] if number else []):
            raise RuntimeError(f"another run has changed {self.root} since state {number}; start again from its state")
        never = self._array(self._rename, 1)
        never[0] = self._rename.NONE                       # fails where the number is taken
        self._context.getFileContext(self._path(self.root).toUri(), self._conf).rename(tmp, new, never)
        return number + 1

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def folders(self, pattern: str) -> list[str]:
        return sorted(str(x.getPath().toString()) for x in self.fs.globStatus(self._path(f"{self.root}/{pattern}")) or [])

    def name(self, path: str) -> str:
        """The full name of a path, as ``folders`` gives it."""
        return str(self.fs.makeQualified(self._path(path)).toString())

    def age_hours(self, path: str) -> float:
        import time
        return time.time() / 3600 - self.fs.getFileStatus(self._path(path)).getModificationTime() / 3.6e6

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)
