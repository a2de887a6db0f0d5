"""Evidence texts: assembly of pages under caps, OCR detections in reading order, and metrics by scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sieveline.functions import text as T


def assemble(pages: Column, numbers: Column, cap: int) -> dict[str, Column]:
    """Evidence text, its characters, whether it was cut, and the characters of the pages without delimiters."""
    normal = F.transform(pages, T.newlines)
    whole = T.assembled(normal, numbers)
    text = F.substring(whole, 1, cap)
    return {"evidence_text": text, "evidence_char_count": F.length(text), "evidence_truncated": F.length(whole) > cap, "raw_text_char_count": T.total_length(normal)}


def assemble_ocr(pages: Column, numbers: Column, page_cap: int = 4000, cap: int = 20000) -> dict[str, Column]:
    """Like `assemble`, with a cap for each page before the global one."""
    cut = F.transform(pages, lambda t: F.substring(t, 1, page_cap))
    whole = T.assembled(cut, numbers)
    text = F.substring(whole, 1, cap)
    return {
        "evidence_text": text,
        "stored_chars": F.transform(cut, lambda t: F.length(t)),
        "raw_chars": T.total_length(pages),
        "pages_truncated": F.size(F.filter(pages, lambda t: F.length(t) > page_cap)),
        "globally_truncated": F.length(whole) > cap,
    }


def reading_order(detections: Column) -> Column:
    """Detections (box as points with x and y, text, score) from top to bottom, then left to right, then as given.

    Blank texts are dropped; detections without a box come last.
    """
    lowest = lambda box, axis: F.array_min(F.transform(box, lambda p: p[axis]))
    keyed = F.transform(
        detections,
        lambda d, i: F.struct(
            F.coalesce(F.size(d["box"]) <= 0, F.lit(True)).alias("boxless"),
            F.when(F.size(d["box"]) > 0, lowest(d["box"], "y")).alias("top"),
            F.when(F.size(d["box"]) > 0, lowest(d["box"], "x")).alias("left"),
            i.alias("place"),
            d["text"].alias("text"),
            d["score"].alias("score"),
        ),
    )
    return F.array_sort(F.filter(keyed, lambda d: F.coalesce(T.stripped(d["text"]) != "", F.lit(False))))


def evidence_metrics(rows: DataFrame) -> DataFrame:
    """Counts over all rows, by pool and by group, in one aggregation over grouping sets; scope names the set."""
    sets = rows.groupingSets([[], ["pool_name"], ["parent_group"]], "pool_name", "parent_group")
    usable = F.col("evidence_status").isin("success", "partial")
    out = sets.agg(
        F.grouping_id().alias("g"), F.count("*").alias("count"),
        *(F.count_if(F.col("evidence_status") == s).alias(f"{s}_count") for s in ("success", "partial", "failed", "not_applicable")),
        F.count_if("evidence_truncated").alias("truncated_count"), F.count_if(usable & (F.coalesce("raw_text_char_count", F.lit(0)) == 0)).alias("zero_text_count"),
        F.sum(F.coalesce("evidence_char_count", F.lit(0))).alias("evidence_chars"),
        T.safe_ratio(F.count_if(F.coalesce(T.stripped(F.col("filename_title")) != "", F.lit(False))), F.count("*")).alias("filename_title_rate"),
    )
    scope = F.when(F.col("g") == 3, "overall").when(F.col("g") == 1, "pool").otherwise("group")
    return out.select(scope.alias("scope"), F.coalesce("pool_name", "parent_group", F.lit("")).alias("name"), *out.columns[3:])
