"""Versions of a table's segments: folders written once, made visible by one commit.

A version is a small JSON file ``<root>/_versions/<number>.json`` that lists
the segments (folders) and a mark, the place up to which they cover their
source. The file is created exclusively, so of two writers that start from one
version the second is refused; readers take the newest whole file. A writer
that fails before its commit leaves folders that no version names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Version:
    number: int = 0
    segments: tuple[dict, ...] = ()
    mark: int | None = None

    def paths(self) -> list[str]:
        return [s["path"] for s in self.segments]


class Versions:
    """The versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._folder = self._path(f"{self.root}/_versions")
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _files(self) -> list:
        if not self._fs.exists(self._folder):
            return []
        return sorted((f.getPath() for f in self._fs.listStatus(self._folder)), key=lambda p: p.getName())

    def has(self, path: str) -> bool:
        """Whether a folder has been written."""
        return self._fs.exists(self._path(path))

    def current(self) -> Version:
        """The newest version; an empty one before the first commit. A file
        that a writer did not finish is no version."""
        for path in reversed(self._files()):
            stream = self._fs.open(path)
            try:
                text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                found = json.loads(text)
            except ValueError:
                continue
            return Version(int(path.getName().split(".")[0]), tuple(found["segments"]), found["mark"])
        return Version()

    def new_folder(self, name: str) -> str:
        """A fresh path for a segment."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def commit(self, base: Version, segments, mark: int | None) -> Version:
        """The version after ``base``; raises where another writer took its number."""
        taken = [int(p.getName().split(".")[0]) for p in self._files()]
        newer = [n for n in taken if n > base.number]
        if newer and self.current().number > base.number:
            raise RuntimeError(f"version {base.number} of {self.root} has a successor already")
        number = max([base.number, *taken]) + 1
        out = self._fs.create(self._path(f"{self.root}/_versions/{number:010d}.json"), False)
        try:
            out.write(json.dumps({"segments": list(segments), "mark": mark}).encode())
        finally:
            out.close()
        return Version(number, tuple(segments), mark)

    def drop_unused(self, before: Version, after: Version) -> None:
        """Remove the folders that ``before`` names and ``after`` does not,
        and all but the last few version files."""
        for path in set(before.paths()) - set(after.paths()):
            self._fs.delete(self._path(path), True)
        for path in self._files()[:-8]:
            self._fs.delete(path, False)


def small_tail(segments, rows: int, factor: int = 2) -> int:
    """How many of the last segments to rewrite together with ``rows`` new
    ones: while a segment is under ``factor`` times what follows it. Each row
    is rewritten a logarithmic number of times, and segments stay few."""
    n = 0
    for s in reversed(segments):
        if s["rows"] >= factor * rows:
            break
        rows += s["rows"]
        n += 1
    return n
