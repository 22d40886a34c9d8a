"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgraph.llm import canonical, encode, pack, reading, scan_repair, site_lines, skeleton, split, text_quality
from corpusgraph.session import checkpoint, read_table, spread, stored


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The ordered pieces of all recognised pages and documents."""
    docs = read_table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "text")
    pages = read_table(spark, d, "ocr_results").select(F.col("result_id").alias("item_id"), "text")
    parts = [split.split_items(t, "item_id", "text").withColumn("src", F.lit(src)) for src, t in (("documents", docs), ("ocr_results", pages))]
    return parts[0].unionByName(parts[1])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Items that the splitter had to cut."""
    docs = read_table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("item_id"), "text")
    pages = read_table(spark, d, "ocr_results").select(F.col("result_id").alias("item_id"), "text")
    parts = [split.split_items(t, "item_id", "text").withColumn("src", F.lit(src)) for src, t in (("documents", docs), ("ocr_results", pages))]
    return parts[0].unionByName(parts[1]).where("piece_no = 2").select("src", "item_id")


def _scans(spark: SparkSession, d: str) -> tuple:
    """What the repair of scanned pages is given: good results, documents, places of results, common words."""
    ok = read_table(spark, d, "ocr_results").where("status = 'ok'").select("result_id", "path", "text")
    at = read_table(spark, d, "ocr_pages").select(F.col("image_path").alias("path"), F.col("record_id").alias("source"), F.col("page").alias("cluster")).where("path is not null").distinct()
    place_of = ok.select("result_id", "path").join(at, "path").select("result_id", "source", "cluster")
    common = text_quality.common_words(read_table(spark, d, "common_words"))
    return spread(ok.select("result_id", "text")), spread(read_table(spark, d, "documents").select("text")), place_of, common


def p6_cases(spark: SparkSession, d: str) -> DataFrame:
    """Furniture, cut words and misread words of all good results, with what replaces a misread word."""
    return scan_repair.cases(*_scans(spark, d))


def p6_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of every good result repaired into continuous paragraphs."""
    return scan_repair.texts(*_scans(spark, d))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines with furniture, a broken word or a misread word."""
    return p6_cases(spark, d).select("result_id", "line_no", "kind").distinct()


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode_corpus(spread(read_table(spark, d, "documents").select("doc_id", "text")))


def p1_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics and verdict of every merged page, each page once."""
    common = text_quality.common_words(read_table(spark, d, "common_words"))
    pages = spread(read_table(spark, d, "final_pages").where("record_id is not null and page is not null").select("record_id", "page", "final_text"))
    return text_quality.text_statistics(pages, ["record_id", "page"], "final_text", common).dropDuplicates(["record_id", "page"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages with text of which more than half is no running prose."""
    common = text_quality.common_words(read_table(spark, d, "common_words"))
    pages = spread(read_table(spark, d, "final_pages").where("record_id is not null and page is not null and final_text is not null").select("record_id", "page", "final_text"))
    stats = text_quality.text_statistics(pages, ["record_id", "page"], "final_text", common)
    return stats.where("verdict not in ('prose', 'empty')").select("record_id", "page").distinct()


def scanned(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(texts, places): good results with ink (doc, at, text), and the pages where their paths stand.

    A path that stands for several pages has a place for each; date is the record's release date.
    """
    texts = read_table(spark, d, "ocr_results").where("status = 'ok' and trim(text) <> ''").select(F.col("result_id").alias("doc"), F.col("path").alias("at"), "text")
    at = read_table(spark, d, "ocr_pages").select(F.col("image_path").alias("at"), F.col("record_id").alias("source"), F.col("page").alias("cluster")).where("at is not null and source is not null and cluster is not null").distinct()
    full = at.join(texts.select("at").distinct(), "at", "left_semi")
    need = full.groupBy("source").agg(F.countDistinct("cluster").alias("clusters")).select("source", site_lines.needed().alias("need"))
    dates = read_table(spark, d, "pdf_records").where("id is not null").select(F.col("id").alias("source"), "release_date").groupBy("source").agg(F.min("release_date").alias("date"))
    return spread(texts), stored(full.join(need, "source").join(dates, "source", "left"))


def p2_occurrences(spark: SparkSession, d: str) -> DataFrame:
    """Every occurrence of a line repeated over a record's pages, with its key and how many pages and dates it has."""
    found = site_lines.repeated(*scanned(spark, d))
    return found.select(F.col("doc").alias("result_id"), "line_no", "key", "n_clusters", "n_dates")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Occurrences of repeated lines."""
    return p2_occurrences(spark, d).select("result_id", "line_no").distinct()


def p2_texts(spark: SparkSession, d: str) -> DataFrame:
    """Page texts without the repeated lines of their record."""
    texts, places = scanned(spark, d)
    out = site_lines.drop_lines(texts.join(places.select("at").distinct(), "at", "left_semi").select("doc", "text"), site_lines.repeated(texts, places))
    return out.withColumnRenamed("doc", "result_id")


def _reference(spark: SparkSession, d: str) -> dict[str, list]:
    return {
        "agency": canonical.entries_of(read_table(spark, d, "ref_agencies"), "agency_id", ["name"], ["acronym"]),
        "incident_location": canonical.entries_of(read_table(spark, d, "ref_locations"), "location_id", ["name", "alt_name"]),
    }


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The reference entry of every non-blank agency and place, or none."""
    df = read_table(spark, d, "image_records")
    a, b = (canonical.map_values(df, "id", field, entries) for field, entries in _reference(spark, d).items())
    return a.unionByName(b)


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Report of the values that belong to no entry: field, value and in how many rows it stands."""
    df = read_table(spark, d, "image_records")
    a, b = (canonical.unmatched(df, "id", field, entries) for field, entries in _reference(spark, d).items())
    return a.unionByName(b)


def p4_candidates(spark: SparkSession, d: str) -> DataFrame:
    """All entries within the distance of each distinct value: field, value, ref_id, cost."""
    df = read_table(spark, d, "image_records")
    parts = []
    for field, entries in _reference(spark, d).items():
        values = df.select(F.col(field).alias("value")).where("value is not null").distinct()
        parts.append(canonical.matches(values, entries, every=True).select(F.lit(field).alias("field"), "value", "ref_id", "cost"))
    return parts[0].unionByName(parts[1])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of rows whose whole text looks the same and is stored differently."""
    a = skeleton.equal_looks(read_table(spark, d, "image_records"), "id", "description").withColumn("src", F.lit("image_records"))
    b = skeleton.equal_looks(read_table(spark, d, "ocr_results"), "result_id", "text").withColumn("src", F.lit("ocr_results"))
    return a.unionByName(b).select("src", "key_a", "key_b")


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """The class of equal looks of every row with ink: src, key, class_id, forms, members."""
    a = skeleton.look_classes(read_table(spark, d, "image_records"), "id", "description").withColumnRenamed("id", "key")
    b = skeleton.look_classes(read_table(spark, d, "ocr_results"), "result_id", "text").withColumnRenamed("result_id", "key")
    return a.withColumn("src", F.lit("image_records")).unionByName(b.withColumn("src", F.lit("ocr_results")))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    """All texts of both tables in their one consistent form."""
    a = skeleton.normalized(read_table(spark, d, "image_records"), "id", "description").select(F.lit("image_records").alias("src"), F.col("id").alias("key"), "form")
    b = skeleton.normalized(read_table(spark, d, "ocr_results"), "result_id", "text").select(F.lit("ocr_results").alias("src"), F.col("result_id").alias("key"), "form")
    return a.unionByName(b)


def p8_slots(spark: SparkSession, d: str) -> DataFrame:
    """The container, and the place in it, of every part of every non-empty document."""
    sizes = checkpoint(encode.count_tokens(read_table(spark, d, "documents").where("text <> ''")))
    return pack.pack(sizes, "doc_id", "n_tokens")


MAX_LANGUAGES = 100


def _languages(spark: SparkSession, d: str) -> dict[str, frozenset[str]]:
    table = read_table(spark, d, "common_words")
    names = [r[0] for r in table.select("lang").where("lang is not null").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError("too many languages for lists of common words")
    return {n: text_quality.common_words(table.where(F.col("lang") == n)) for n in names}


def p9_levels(spark: SparkSession, d: str) -> DataFrame:
    """Level and band of every English prose document."""
    return reading.rate(spread(read_table(spark, d, "documents").select("doc_id", "text")), read_table(spark, d, "reading_labels"), _languages(spark, d))


def p9_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How many of the readers' labels are met by cuts fitted without them."""
    return reading.agreement(p9_levels(spark, d).select("doc_id", "level"), read_table(spark, d, "reading_labels"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """The band of every English prose document."""
    return p9_levels(spark, d).select("doc_id", "band")


QUERIES = {
    "p1_found": p1_found,
    "p1_statistics": p1_statistics,
    "p2_found": p2_found,
    "p2_occurrences": p2_occurrences,
    "p2_texts": p2_texts,
    "p3_found": p3_found,
    "p3_pieces": p3_pieces,
    "p4_candidates": p4_candidates,
    "p4_found": p4_found,
    "p4_unmatched": p4_unmatched,
    "p5_classes": p5_classes,
    "p5_found": p5_found,
    "p5_forms": p5_forms,
    "p6_cases": p6_cases,
    "p6_found": p6_found,
    "p6_texts": p6_texts,
    "p7_ids": p7_ids,
    "p8_slots": p8_slots,
    "p9_agreement": p9_agreement,
    "p9_found": p9_found,
    "p9_levels": p9_levels,
}

ORACLES = {
    "p3_found": """
SELECT 'documents' AS src, CAST(doc_id AS VARCHAR) AS item_id FROM documents WHERE length(text) > 1800
UNION ALL
SELECT 'ocr_results' AS src, result_id AS item_id FROM ocr_results WHERE length(text) > 1800
""",
}
