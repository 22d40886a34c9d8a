"""Cutting cleaned text into retrieval chunks (greedy packing of paragraphs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import text as T

MAX_CHARS = 1800
OVERLAP = 180


def windows(c: Column, size: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """Slices of a paragraph that is longer than a chunk, each `size` long and `overlap` shared."""
    starts = F.sequence(F.lit(1), F.length(c), F.lit(size - overlap))
    return F.transform(starts, lambda i: F.substring(c, i, F.lit(size)))


def chunks(c: Column, size: int = MAX_CHARS, overlap: int = OVERLAP) -> Column:
    """array<string>: paragraphs packed while they fit; an oversized one is sliced and packing starts anew.

    Null and blank texts give no chunk.
    """
    paragraphs = F.split(T.strip(c), "\n\n", -1)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        both = F.when(acc["open"] == "", p).otherwise(F.concat(acc["open"], F.lit("\n\n"), p))
        closed = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        fits, small = F.length(both) <= size, F.length(p) <= size
        return F.struct(
            F.when(fits, acc["done"]).when(small, closed).otherwise(F.concat(closed, windows(p, size, overlap))).alias("done"),
            F.when(fits, both).when(small, p).otherwise(F.lit("")).alias("open"),
        )

    end = lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
    packed = F.aggregate(paragraphs, start, step, end)
    return F.when(T.strip(c) == "", F.array().cast("array<string>")).otherwise(packed)


def chunked(df: DataFrame, text: str, size: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """A row for each chunk: the input's columns but `text`, chunk_no from 1, and chunk."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(chunks(F.col(text), size, overlap)).alias("__at", "__chunk")).select(*rest, (F.col("__at") + 1).cast("bigint").alias("chunk_no"), F.col("__chunk").alias("chunk"))
