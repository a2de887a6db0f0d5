"""Helpers that the operators share: column choice, tables, byte-sized batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from sieveline.sources.staging import Stages as Stages

#: text handed to one vectorised step, so that its arrays stay small whatever an Arrow batch holds
STEP_BYTES = 4 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns of a table that may also hold columns of the same name in other letter case, or twice.

    The first column of exactly that name counts; a name without an exact match is taken without regard to case.
    """
    have, own = df.columns, {}
    for name in names:
        exact = [i for i, c in enumerate(have) if c == name] or [i for i, c in enumerate(have) if c.lower() == name.lower()]
        if not exact:
            raise ValueError(f"column {name} is missing; there are {have}")
        own[exact[0]] = name
    if len({c.lower() for c in have}) == len(have):
        return df.select(*names)
    return df.toDF(*(own.get(i, f"_other_{i}") for i in range(len(have)))).select(*names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_bytes(rows: Iterable, size, most: int = STEP_BYTES) -> Iterator[list]:
    """Runs of consecutive rows of at most `most` bytes together; a larger row goes alone."""
    held, total = [], 0
    for row in rows:
        n = size(row)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held


def text_steps(texts: list, most: int = STEP_BYTES) -> Iterator[list]:
    """`by_bytes` for texts that may be null, by their bytes in UTF-8."""
    return by_bytes(texts, lambda t: 1 if not t else len(t) if t.isascii() else len(t.encode("utf-8", "replace")), most)
