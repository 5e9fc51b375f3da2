"""Writes that show all at once: into a staging folder beside the table, then by renames into their places.

Spark writes the files; only file names pass the driver. A write that fails, or that has no rows, leaves nothing but its
staging folder to take away, so the table stays as it was. On stores whose rename copies, a table format with commits of
its own is the better sink.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

HIDDEN = ("_", ".")


class Folder:
    """Files below one path of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.root = self._path(self.path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, text: str) -> JavaObject:
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def below(self, name: str) -> JavaObject:
        return self._path(f"{self.path}/{name}")

    def files(self, name: str) -> Iterator[tuple[str, int]]:
        """Data files below a subfolder: path relative to it, and size."""
        start = self.below(name)
        if not self.fs.exists(start):
            return
        base = len(self.fs.makeQualified(start).toString()) + 1
        found = self.fs.listFiles(start, True)
        while found.hasNext():
            status = found.next()
            relative = status.getPath().toString()[base:]
            if not any(part.startswith(HIDDEN) for part in relative.split("/")):
                yield relative, status.getLen()

    def entries(self) -> list[str]:
        """Names of the visible files and folders right below."""
        if not self.fs.exists(self.root):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.root) if not s.getPath().getName().startswith(HIDDEN)]

    def move(self, source: str, target: str) -> None:
        place = self.below(target)
        self.fs.mkdirs(place.getParent())
        if not self.fs.rename(self.below(source), place):
            raise OSError(f"could not move {source} to {target} below {self.path}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.below(name), True)


def _swap(folder: Folder, old: list[str], moves: list[tuple[str, str]], aside: str) -> None:
    """Old entries go aside and staged ones take their places; if a move fails, all of it is undone."""
    done: list[tuple[str, str]] = []
    try:
        for source, target in [*[(name, f"{aside}/{name}") for name in old], *moves]:
            folder.move(source, target)
            done.append((source, target))
    except Exception:
        for source, target in reversed(done):
            folder.move(target, source)
        raise
    folder.remove(aside)


def publish(spark: SparkSession, path: str, write: Callable[[str], int], mode: str = "append") -> tuple[int, int]:
    """Let ``write`` fill a staging folder and return its row count, then show its files below ``path``.

    ``mode`` is ``append``, ``overwrite``, or ``partitions`` to replace only the partition folders that were written.
    Returns rows and bytes. Without rows nothing is changed.
    """
    folder, run = Folder(spark, path), uuid.uuid4().hex
    stage, aside = f"_stage-{run}", f"_aside-{run}"
    existed = folder.fs.exists(folder.root)
    try:
        rows = write(f"{folder.path}/{stage}")
        files = list(folder.files(stage))
        if rows:
            if mode == "append":
                _swap(folder, [], [(f"{stage}/{name}", name) for name, _ in files], aside)
            elif mode == "overwrite":
                tops = sorted({name.split("/")[0] for name, _ in files})
                _swap(folder, folder.entries(), [(f"{stage}/{name}", name) for name in tops], aside)
            else:
                homes = sorted({name.rpartition("/")[0] for name, _ in files})
                old = [h for h in homes if h and folder.fs.exists(folder.below(h))]
                _swap(folder, old, [(f"{stage}/{h}", h) for h in homes], aside)
    finally:
        folder.remove(stage)
        if not existed and folder.fs.exists(folder.root) and not folder.fs.listStatus(folder.root):
            folder.fs.delete(folder.root, False)
    return rows, sum(size for _, size in files)
