"""Merging embedded and recognised page text, and rolling pages up to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgraph.functions.text import strip

# What stands between the two layers, and before a page in a document.
LAYER = "\n\n[OCR]\n"
PAGE = "\n\n--- Page %d [%s] ---\n"


def last_ok(log: DataFrame, keys: list[str], ordinal: str = "ordinal", status: str = "status") -> DataFrame:
    """The last good row of each key of an append log, as one hash aggregation."""
    rest = [c for c in log.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.col(ordinal)).alias("r")
    return log.where(F.col(status) == "ok").groupBy(*keys).agg(best).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest))


def merged(pages: DataFrame, ocr: DataFrame) -> DataFrame:
    """pages (record_id, page, embedded) with the last recognised text (record_id, page, ocr).

    Both texts are stripped; a null one is empty. Recognised text that the embedded one contains
    is not repeated.
    """
    df = pages.join(ocr, ["record_id", "page"], "left")
    df = df.withColumn("embedded", strip(F.coalesce("embedded", F.lit("")))).withColumn("ocr", strip(F.coalesce("ocr", F.lit(""))))
    e, o = F.col("embedded"), F.col("ocr")
    both = (e != "") & (o != "") & ~F.contains(e, o)
    text = F.when(both, F.concat(e, F.lit(LAYER), o)).when(e != "", e).otherwise(o)
    source = F.when(both, "embedded+ocr").when(e != "", "embedded").when(o != "", "ocr").otherwise("empty")
    lengths = [F.length(c).cast("bigint").alias(n) for c, n in ((e, "embedded_text_chars"), (o, "ocr_text_chars"), (text, "final_text_chars"))]
    return df.select("record_id", "page", source.alias("source"), *lengths, text.alias("final_text"))


def _below_header() -> Column:
    return F.concat(F.format_string(PAGE, "page", "source"), F.col("final_text"))


def document_texts(pages: DataFrame) -> DataFrame:
    """(record_id, text): a record's non-empty pages in order, each below its header, as one cell.

    For records whose text fits a cell (2 GB); `document_offsets` is the form for any size.
    """
    part = F.struct("page", _below_header().alias("t"))
    parts = F.array_sort(F.collect_list(F.when(F.col("final_text") != "", part)))
    text = F.array_join(F.transform(parts, lambda x: x["t"]), "")
    return pages.groupBy("record_id").agg(strip(text).alias("text"))


def document_offsets(pages: DataFrame) -> DataFrame:
    """(record_id, page, from_char, chars): the place of every non-empty page with its header in its record's text before stripping.

    Texts stay with their pages; the running sum sorts two numbers a page, and a hot record's rows spill.
    """
    rows = pages.where("final_text <> ''").select("record_id", "page", F.length(_below_header()).cast("bigint").alias("chars"))
    before = Window.partitionBy("record_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("from_char", F.coalesce(F.sum("chars").over(before), F.lit(0).cast("bigint"))).select("record_id", "page", "from_char", "chars")


def document_totals(pages: DataFrame) -> DataFrame:
    """Pages and characters of each record."""
    sums = [F.sum(c).alias(c) for c in ("embedded_text_chars", "ocr_text_chars", "final_text_chars")]
    return pages.groupBy("record_id").agg(F.count(F.lit(1)).alias("pages"), *sums)
