"""Discovery of documents on a file system, as a Spark data source.

A root is cut into its top-level folders, one partition each (files at the root itself are another). Unlike Spark's
own file sources it keeps hidden names, does not follow symbolic links, keeps times in nanoseconds, and fails on any
error of the file system. Paths must be reachable by every executor.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source_root_id string, path string, relative_path string, file_name string, parent_group string, extension string, size_bytes long, mtime_ns long"


class _Folder(InputPartition):
    def __init__(self, folder: str, deep: bool):
        self.folder, self.deep = folder, deep


class DocumentSource(DataSource):
    """Options: path (the root), root_id, and suffix (.pdf by default, in either case)."""

    @classmethod
    def name(cls) -> str:
        return "documents_on_disk"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.root_id, self.suffix = options["path"], options.get("root_id", "root"), options.get("suffix", ".pdf").lower()

    def partitions(self) -> list[InputPartition]:
        with os.scandir(self.root) as entries:
            folders = sorted(e.path for e in entries if e.is_dir(follow_symlinks=False))
        return [_Folder(self.root, False), *(_Folder(f, True) for f in folders)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        waiting = [partition.folder]
        while waiting:
            with os.scandir(waiting.pop()) as entries:
                for e in entries:
                    if e.is_dir(follow_symlinks=False):
                        if partition.deep:
                            waiting.append(e.path)
                    elif e.is_file(follow_symlinks=False) and e.name.lower().endswith(self.suffix):
                        stat = e.stat(follow_symlinks=False)
                        relative = os.path.relpath(e.path, self.root).replace(os.sep, "/")
                        first, slash, _ = relative.partition("/")
                        yield self.root_id, e.path, relative, e.name, first if slash else "", os.path.splitext(e.name)[1], stat.st_size, stat.st_mtime_ns


def discover(spark: SparkSession, roots: dict[str, str], suffix: str = ".pdf") -> DataFrame:
    """The documents of all roots (id and path), with their sizes and times."""
    if not roots:
        raise ValueError("no source root is enabled")
    spark.dataSource.register(DocumentSource)
    out = None
    for root_id, path in sorted(roots.items()):
        one = spark.read.format("documents_on_disk").option("root_id", root_id).option("suffix", suffix).load(path)
        out = one if out is None else out.unionByName(one)
    return out
