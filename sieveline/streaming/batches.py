"""Resumable processing of a task table in batches, as a stream with availableNow triggers.

Tasks are written as a table of parts, one file a batch; the stream reads them in order, a batch at a time. Structured
Streaming's own checkpoint remembers what is done, so a run that was stopped goes on where it was; each batch is
written under its batch id, so a batch that is done twice after a failure replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_tasks(tasks: DataFrame, path: str, order: list[str], size: int) -> int:
    """The tasks as one file for each `size` of them, in order; returns the number of batches.

    The order comes from a range partitioning, so no task sorts the whole table.
    """
    n = tasks.count()
    parts = max(1, -(-n // size))
    tasks.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
    return parts


def process(spark: SparkSession, tasks: str, work: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, stop_after: int | None = None) -> int:
    """Runs the batches that are not done; with `stop_after`, that many of them. Returns the number of batches run."""
    schema = spark.read.parquet(tasks).schema
    done, stopped = [], []

    def one(batch: DataFrame, batch_id: int) -> None:
        if stop_after is not None and len(done) >= stop_after:
            stopped.append(batch_id)
            raise StopRun
        work(batch).write.mode("overwrite").parquet(f"{results}/batch_id={batch_id}")
        done.append(batch_id)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(tasks)
    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not stopped:
            raise
    return len(done)


class StopRun(RuntimeError):
    """Ends a stream at a batch's beginning; the batch is done by the next run."""


def results(spark: SparkSession, path: str, key: str = "file_instance_id") -> DataFrame:
    """All batches' rows; of a key that several batches hold, the last batch's."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*")
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max("batch_id").alias("_batch"))
    return rows.join(last, (rows[key] == last["_key"]) & (rows["batch_id"] == last["_batch"])).drop("_key", "_batch")
