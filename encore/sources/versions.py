"""Versions of a table made of folders: one small manifest a commit.

A writer puts its data into new folders and then commits a manifest that lists
the folders of the new version.  A reader takes the newest manifest and reads
exactly its folders, so it sees one version whole, whatever is being written.
The last ``keep`` versions beside the newest stay readable; a folder that a
version leaves out is dropped with the last version that lists it.  There is one
writer a table; a second one that commits the same number is refused.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

FOLDER = "_versions"
KEEP = 4                 # versions that stay readable beside the newest


class Versions:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path("/".join((self.path,) + parts))
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def exists(self, *parts: str) -> bool:
        fs, where = self._fs(*parts)
        return fs.exists(where)

    def numbers(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, where = self._fs(FOLDER)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def read(self, number: int) -> dict:
        fs, where = self._fs(FOLDER, f"v{number:010d}.json")
        stream = fs.open(where)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """``(number, manifest)`` of the newest version, ``(-1, {})`` before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (-1, {})

    def commit(self, number: int, manifest: dict, keep: int = KEEP) -> None:
        """Make ``manifest`` the version ``number``; it appears whole or not at all.
        ``manifest["folders"]`` lists its folders, relative to the table."""
        fs, last = self._fs(FOLDER, f"v{number:010d}.json")
        _, draft = self._fs(FOLDER, f".v{number:010d}.draft")
        if fs.exists(last):
            raise RuntimeError(f"{self.path}: version {number} is taken, another writer is at work")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(draft, last):
            raise RuntimeError(f"{self.path}: version {number} could not be committed")
        self._drop_old(keep)

    def _drop_old(self, keep: int) -> None:
        numbers = self.numbers()
        for n, later in zip(numbers[:-keep - 1], numbers[1:]):
            # a folder that a version leaves out never comes back
            for folder in set(self.read(n)["folders"]) - set(self.read(later)["folders"]):
                fs, where = self._fs(folder)
                fs.delete(where, True)
            fs, where = self._fs(FOLDER, f"v{n:010d}.json")
            fs.delete(where, False)
