"""Versions of a table or store behind a pointer.

Data is written beside what readers see; then one small file, the next version of the
pointer, is moved into place under a name that must be new. A reader takes the newest
version and reads only the folders that it names: a writer that fails before the switch
leaves the old version as it was, and two writers cannot both switch from the same one.
The move is atomic on HDFS and local folders; on an object store whose rename is a copy,
give the pointer's folder a file system that has one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

# Pointer files that stay behind the newest, for readers that have just listed them.
KEPT_POINTERS = 8


class Conflict(RuntimeError):
    """Another writer has switched since this one looked."""


@dataclass(frozen=True)
class Files:
    """The few file operations that Spark's readers and writers lack."""

    spark: SparkSession

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def names(self, folder: str) -> list[str]:
        fs, where = self._at(folder)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a file in one move; False if one of that name is there already."""
        fs, where = self._at(path)
        _, beside = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        moved = not fs.exists(where) and fs.rename(beside, where)
        if not moved:
            fs.delete(beside, False)
        return moved

    def remove(self, paths: Iterable[str]) -> None:
        for path in paths:
            fs, where = self._at(path)
            fs.delete(where, True)

    def touch(self, path: str, seconds: int) -> None:
        """Set the modification time, by which a file stream orders its files; creates an
        empty file where there is none."""
        fs, where = self._at(path)
        if not fs.exists(where):
            fs.create(where, False).close()
        fs.setTimes(where, seconds * 1_000, -1)


@dataclass(frozen=True)
class Pointer:
    """The newest committed state below a folder."""

    spark: SparkSession
    folder: str

    def _path(self, version: int) -> str:
        return f"{self.folder}/{version:012d}.json"

    def current(self) -> tuple[int, dict[str, Any]]:
        """Number and state of the newest version; 0 and nothing before the first."""
        files = Files(self.spark)
        versions = [int(n.removesuffix(".json")) for n in files.names(self.folder) if n.endswith(".json")]
        if not versions:
            return 0, {}
        return max(versions), json.loads(files.read(self._path(max(versions))))

    def switch(self, seen: int, state: dict[str, Any]) -> int:
        """Make ``state`` the version after ``seen``, or raise :class:`Conflict`."""
        files, version = Files(self.spark), seen + 1
        if not files.write_new(self._path(version), json.dumps(state, sort_keys=True)):
            raise Conflict(f"{self.folder}: version {version} is there already")
        if version > KEPT_POINTERS:
            files.remove([self._path(version - KEPT_POINTERS)])
        return version
