"""Replacing folders of a stored table so that a job which dies half way leaves nothing half done.

New folders are written beside the table, in its own layout. Renaming the finished copy is the commit; after it, folder by
folder takes the place of the old one. Whoever writes next finishes what a lost job has begun: moving the folders that are
still in the copy gives the same table again, and copies that never were committed are thrown away. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file at most; a task with more begins a new file.
ROWS_PER_FILE = 4_000_000
_OPEN = ".open"


class Files:
    """The few calls on Hadoop's file system that moving folders needs."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, source: str, target: str) -> None:
        at = self._path(target)
        self._fs.mkdirs(at.getParent())
        if not self._fs.rename(self._path(source), at):
            raise OSError(f"cannot move {source} to {target}")

    def below(self, path: str, depth: int = 1) -> list[str]:
        """Folders exactly `depth` levels below a path, as paths relative to it."""
        if not self.exists(path):
            return []
        top = self._fs.makeQualified(self._path(path)).toUri().getPath()
        found = self._fs.globStatus(self._path(path + "/*" * depth)) or []
        return sorted(f.getPath().toUri().getPath()[len(top) + 1 :] for f in found if f.isDirectory())


def _pending(path: str) -> str:
    """Where copies for a table wait: a sibling that readers of tables skip."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_pending/{name}"


def _move(files: Files, copy: str, path: str, depth: int) -> None:
    if not depth:  # the table as a whole
        files.delete(path)
        files.rename(copy, path)
        return
    for folder in files.below(copy, depth):
        files.delete(f"{path}/{folder}")
        files.rename(f"{copy}/{folder}", f"{path}/{folder}")
    files.delete(copy)


def finish_pending(spark: SparkSession, path: str) -> int:
    """Completes committed copies of a table that a lost job left and removes all others; returns how many it completed."""
    files, waiting = Files(spark, path), _pending(path)
    done = 0
    for name in files.below(waiting):
        if name.endswith(_OPEN):
            files.delete(f"{waiting}/{name}")
        else:
            _move(files, f"{waiting}/{name}", path, int(name.split("-")[0]))
            done += 1
    return done


def replace_folders(df: DataFrame, path: str, folders: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes the folders that `df` has rows for and leaves all others.

    Rows are rebalanced by folder: Spark puts small folders together and deals a large one to as many tasks as its size
    asks for, so that a day of trades is several tasks and files.
    """
    spark = df.sparkSession
    files = Files(spark, path)
    copy = f"{_pending(path)}/{len(folders)}-{uuid.uuid4().hex}"
    even = df.hint("rebalance", *folders)
    even.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*folders).parquet(copy + _OPEN)
    files.rename(copy + _OPEN, copy)
    _move(files, copy, path.rstrip("/"), len(folders))


def replace_table(df: DataFrame, path: str) -> None:
    """Writes a table without folders anew; it may be among what `df` reads."""
    files = Files(df.sparkSession, path)
    copy = f"{_pending(path)}/0-{uuid.uuid4().hex}"
    df.write.parquet(copy + _OPEN)
    files.rename(copy + _OPEN, copy)
    _move(files, copy, path.rstrip("/"), 0)


def folders_of(spark: SparkSession, path: str, depth: int) -> Iterator[dict[str, str]]:
    """The folders of a table as {column: text}, from their names alone."""
    for folder in Files(spark, path).below(path.rstrip("/"), depth):
        yield dict(part.split("=", 1) for part in folder.split("/"))
