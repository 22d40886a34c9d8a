"""Checks of a finished graph: counts agree, keys resolve, required columns exist."""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that every chunk must have.
CHUNK_COLUMNS = ("chunk_id", "record_id", "title", "page", "source", "quality", "include_in_default_rag", "text", "text_chars")


# Relations that a graph must have.
MUST_CONNECT = ("contains_record", "from_agency", "incident_date", "incident_location", "supported_by", "pdf_pairing", "video_pairing")


def checks(records: DataFrame, nodes: DataFrame, edges: DataFrame, waiting: DataFrame | None = None) -> DataFrame:
    """(check_name, failures): 0 means passed. All three are read several times and should be stored tables.

    A check of presence fails once if there is nothing. `readable_path` counts PDF record nodes without a
    readable document; `waiting` are pages with an image that still wait for recognition.
    """
    ends = F.array(F.struct(F.col("source").alias("id"), F.lit(1).alias("s"), F.lit(0).alias("t")), F.struct(F.col("target").alias("id"), F.lit(0).alias("s"), F.lit(1).alias("t")))
    used = edges.select(F.inline(ends)).groupBy("id").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    loose = used.join(nodes.select("id"), "id", "left_anti").agg(F.coalesce(F.sum("s"), F.lit(0)).alias("edge_source_exists"), F.coalesce(F.sum("t"), F.lit(0)).alias("edge_target_exists"))
    unique = nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("node_id_unique"))
    own = records.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "PDF").alias("pdf"), F.count_if(F.coalesce("title", F.lit("")) == "").alias("record_has_title"))
    no_path = F.coalesce("readable_doc_path", F.lit("")) == "" if "readable_doc_path" in nodes.columns else F.lit(True)
    of_nodes = nodes.agg(F.count_if(F.col("type") == "record").alias("record_nodes"), F.count_if((F.col("type") == "record") & (F.col("kind") == "PDF") & no_path).alias("pdf_has_readable_path"))
    relations = edges.agg(*(F.when(F.count_if(F.col("relation") == r) == 0, 1).otherwise(0).alias(f"connects_{r}") for r in MUST_CONNECT))
    rest = [] if waiting is None else [waiting.agg(F.count(F.lit(1)).alias("image_is_recognised"))]
    one = reduce(DataFrame.crossJoin, [loose, unique, own, of_nodes, relations, *rest])  # single rows
    one = one.withColumn("record_count_matches", F.abs(F.col("n") - F.col("record_nodes")))
    for name, column in (("records_not_empty", "n"), ("pdf_records_not_empty", "pdf")):
        one = one.withColumn(name, (F.col(column) == 0).cast("int"))
    names = [c for c in one.columns if c not in ("n", "pdf", "record_nodes")]
    cells = F.array(*(F.struct(F.lit(c).alias("check_name"), F.col(c).cast("bigint").alias("failures")) for c in names))
    return one.select(F.inline(cells))


def verdict_row(checks_: DataFrame) -> DataFrame:
    """One row (status, failed_checks, failures): the result of all checks with the names of those that failed, in their order."""
    bad = F.array_sort(F.collect_list(F.when(F.col("failures") > 0, F.col("check_name"))))
    row = checks_.agg(bad.alias("bad"), F.sum("failures").alias("failures"))
    return row.select(F.when(F.size("bad") > 0, "failed").otherwise("ok").alias("status"), F.array_join("bad", ",").alias("failed_checks"), "failures")


def missing_columns(df: DataFrame, required: tuple[str, ...] = CHUNK_COLUMNS) -> list[str]:
    return [c for c in required if c not in df.columns]


def missing_paths(root: str, required: list[str]) -> list[str]:
    return [p for p in required if not (Path(root) / p).exists()]


def verdict(checks_: DataFrame, warnings: list[str] = ()) -> dict:
    """The result of all checks: status failed if any has failures; warnings don't fail."""
    bad = [f"{r['check_name']}: {r['failures']}" for r in checks_.where("failures > 0").orderBy("check_name").collect()]
    return {"status": "failed" if bad else "ok", "failures": bad, "warnings": list(warnings)}
