"""Tables that are written once to the cluster's shared folder and read back.

They cut the lineage of long plans and outlive lost executors. The folder is the one that spark.checkpoint.dir names;
where that is unset, a temporary one if the session runs on this machine alone, as in tests, and an error on a cluster.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: a cluster needs a shared folder for staged tables")
        base = base or f"file://{tempfile.mkdtemp(prefix='stages-')}"
        _folders[app] = f"{base.rstrip('/')}/stages-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(remove, spark, _folders[app])
    return _folders[app]


def remove(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may be gone at exit
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Stages:
    """The tables of one run, each in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}", 0

    def write(self, df: DataFrame, name: str = "t") -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_at = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        """Tables that later steps no longer need."""
        for df in dfs:
            remove(self.spark, df._staged_at)
