"""The curated layer: cleaned pages with quality, their chunks, and documents rolled up from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.functions import urls as U
from corpusgraph.operators import chunks as C
from corpusgraph.operators import lines as L
from corpusgraph.operators import quality as Q

# Where the texts of the curated layer are kept.
READABLE_PAGES, VERBATIM_PAGES, READABLE_DOCUMENTS = "data/curated/readable/pages/", "data/curated/verbatim/pages/", "data/curated/readable/documents/"


def curated_pages(pages: DataFrame) -> DataFrame:
    """Pages (record_id, page, final_text_chars, text normalized) cleaned and rated: clean_text, actions, statistics, quality, include_in_default_rag, paths.

    Null lengths count 0; a page without text is empty.
    """
    df = T.with_stats(L.cleaned(pages), "clean_text")
    removed = sum((F.col(a) for a in L.ACTIONS if a.startswith("removed_")), F.lit(0))
    s = {n: F.col(n) for n in T.STATS}
    df = df.withColumn("raw_text_chars", F.coalesce("final_text_chars", F.lit(0)).cast("bigint")).withColumn("clean_text_chars", F.length("clean_text").cast("bigint"))
    df = df.withColumn("quality", Q.quality(F.col("raw_text_chars"), F.col("clean_text_chars"), removed, s))
    df = df.withColumn("include_in_default_rag", Q.in_default(F.col("clean_text"), F.col("quality"), s))
    folder = T.safe_filename(F.col("record_id"))
    return df.withColumn("readable_page_path", U.page_path(READABLE_PAGES, folder, F.col("page"), ".md")).withColumn("verbatim_page_path", U.page_path(VERBATIM_PAGES, folder, F.col("page"), ".txt"))


def curated_chunks(curated: DataFrame) -> DataFrame:
    """Chunks of curated pages with id and statistics; quality and flag are the page's. Both parts by the flag make up all chunks."""
    keep = [c for c in ("record_id", "title", "page", "source", "quality", "include_in_default_rag", "readable_page_path", "verbatim_page_path") if c in curated.columns]
    df = T.with_stats(C.chunked(curated.select(*keep, "clean_text"), "clean_text"), "chunk")
    df = df.withColumn("chunk_id", F.concat(F.col("record_id"), F.format_string(":p%04d:c%03d", "page", "chunk_no")))
    return df.withColumn("text_chars", F.length("chunk").cast("bigint")).withColumnRenamed("chunk", "text").drop("chunk_no")


def curated_documents(curated: DataFrame, records: DataFrame) -> DataFrame:
    """(record_id, title, pages, raw_text_chars, clean_text_chars, quality_counts map, readable_doc_path) of each record with pages.

    records: (id, title); a record that is not among them has its id for a title. Pages are counted
    by quality first, so a hot record is a handful of rows when its map is made.
    """
    sums = [F.sum(c).alias(c) for c in ("raw_text_chars", "clean_text_chars")]
    by = curated.groupBy("record_id", "quality").agg(F.count(F.lit(1)).alias("n"), *sums)
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct("quality", "n")))).alias("quality_counts")
    docs = by.groupBy("record_id").agg(F.sum("n").alias("pages"), *sums, counts)
    titles = records.select(F.col("id").alias("record_id"), "title")
    return docs.join(titles, "record_id", "left").select(
        "record_id", F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("record_id")).alias("title"), "pages", "raw_text_chars", "clean_text_chars", "quality_counts",
        F.concat(F.lit(READABLE_DOCUMENTS), T.safe_filename(F.col("record_id")), F.lit(".md")).alias("readable_doc_path"),
    )


def readable_sections(curated: DataFrame) -> DataFrame:
    """(record_id, page, section): the parts of readable documents, a row each; pages without text have none.

    A document is its header and these rows by page. They stay rows, so a record of any size is
    never one cell; `document_texts` of merge joins them where a whole text is wanted.
    """
    return curated.where("clean_text <> ''").select("record_id", "page", T.page_section(F.col("page"), F.col("source"), F.col("clean_text")).alias("section"))


def totals(curated: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row: documents, pages, raw and clean characters, chunks, those of the default corpus and the others."""
    a = curated.agg(F.countDistinct("record_id").alias("documents"), F.count(F.lit(1)).alias("pages"), F.sum("raw_text_chars").alias("raw_text_chars"), F.sum("clean_text_chars").alias("clean_text_chars"))
    b = chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_if("include_in_default_rag").alias("default_chunks"))
    return a.crossJoin(b).withColumn("excluded_chunks", F.col("chunks") - F.col("default_chunks"))  # two single rows
