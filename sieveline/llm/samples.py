"""The bounded sample of labelled rows that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.llm.common import pick

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from all fitting: crc32 of its doc_id as text, modulo 5, is 0. A null doc_id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, h (a hash of the text), text and label of at most `most` documents that may be learnt from, chosen by a hash of their doc_id.

    A doc_id with several labels has the smallest, one with several texts that of the smallest hash, so the sample
    follows from the tables alone; rows without an id or a label are left out.
    """
    known = pick(labels, "doc_id", label).where(f"doc_id is not null and {label} is not null").where(~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # `most` ids of 12 bytes each are broadcast, whatever the tables' sizes
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null").join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return one.select("doc_id", F.col("t.h").alias("h"), F.col("t.text").alias("text"), "label")
