"""The knowledge graph of records: nodes, edges, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.functions.text import node_id
from corpusgraph.operators.manifest import is_given


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def event_key() -> Column:
    """date|place of a record, the missing half as N/A; a record without both is its own event."""
    date = F.coalesce(F.nullif(F.col("incident_date"), F.lit("")), F.lit("N/A"))
    place = F.coalesce(F.nullif(F.col("incident_location"), F.lit("")), F.lit("N/A"))
    alone = (F.upper(date) == "N/A") & (F.upper(place) == "N/A")
    return F.when(alone, F.concat(F.lit("record:"), F.col("id"))).otherwise(F.concat(date, F.lit("|"), place))


def keyed(records: DataFrame) -> DataFrame:
    """Records with the ids of the nodes they touch; null where a record has none."""
    given = lambda c: is_given(F.col(c))
    key = event_key()
    return records.select(
        "*",
        F.concat(F.lit("release:"), _text("release")).alias("release_node"),
        F.concat(F.lit("record:"), F.col("id")).alias("record_node"),
        node_id("agency", F.col("agency")).alias("agency_node"),
        F.when(given("incident_location"), node_id("location", F.col("incident_location"))).alias("location_node"),
        F.when(given("incident_date"), node_id("date", F.col("incident_date"))).alias("date_node"),
        node_id("event", key).alias("event_node"),
        F.when(key.startswith("record:"), F.col("title")).otherwise(key).alias("event_label"),
        F.when(_text("pdf_pairing") != "", node_id("pairing", F.col("pdf_pairing"))).alias("pdf_node"),
        F.when(_text("video_pairing") != "", node_id("pairing", F.col("video_pairing"))).alias("video_node"),
    )


def edges(records: DataFrame) -> DataFrame:
    """(source, target, relation, ord): a multiset; ord is the record's id with the edge's place in it."""
    pairs = (
        ("release_node", "record_node", "contains_record"), ("record_node", "agency_node", "from_agency"), ("record_node", "location_node", "incident_location"),
        ("record_node", "date_node", "incident_date"), ("event_node", "record_node", "supported_by"), ("record_node", "pdf_node", "pdf_pairing"), ("record_node", "video_node", "video_pairing"),
    )
    rows = F.array(*(F.struct(F.col(s).alias("source"), F.col(t).alias("target"), F.lit(r).alias("relation"), F.lit(i).alias("place")) for i, (s, t, r) in enumerate(pairs)))
    out = keyed(records).select("id", F.inline(rows)).where("source is not null and target is not null")
    return out.select("source", "target", "relation", F.col("id").alias("ord"), "place")


#: What a record node has of its record, and of the layers of its text where `records` has them.
RECORD_TEXTS = ("kind", "agency", "incident_date", "incident_location", "source_url", "description", "thumbnail_url", "local_path")
LAYERS = ("extraction_status", "page_count", "text_chars", "ocr_text_chars", "final_text_chars", "final_text_path", "clean_text_chars", "readable_doc_path", "quality_counts", "image_count")


def nodes(records: DataFrame) -> DataFrame:
    """One row per node: attributes are merged by the first value that isn't blank, in the order of record ids.

    Ids are unique, so a record's node is its row. The other nodes are merged by an aggregation with
    map-side combine, so a hot agency or release is no group in a task.
    """
    k = keyed(records)
    given = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    own = [given(c) for c in RECORD_TEXTS if c in records.columns]
    layers = [c for c in LAYERS if c in records.columns]
    record = k.select(F.col("record_node").alias("id"), F.lit("record").alias("type"), F.nullif(F.col("title"), F.lit("")).alias("label"), *own, *layers)

    null = F.lit(None).cast("string")

    def node(id_: str, type_: str, place: int, label: Column, date: Column = null, event_date: Column = null, location: Column = null) -> Column:
        return F.struct(F.col(id_).alias("id"), F.lit(type_).alias("type"), F.lit(place).alias("place"), label.alias("label"), date.alias("date"), event_date.alias("incident_date"), location.alias("incident_location"))

    rows = F.array(
        node("release_node", "release", 0, F.col("release"), date=F.col("release_date") if "release_date" in records.columns else null),
        node("agency_node", "agency", 2, F.coalesce(F.nullif(F.col("agency"), F.lit("")), F.lit("Unknown agency"))),
        node("location_node", "location", 3, F.col("incident_location")),
        node("date_node", "date", 4, F.col("incident_date")),
        node("event_node", "event", 5, F.col("event_label"), event_date=F.col("incident_date"), location=F.col("incident_location")),
        node("pdf_node", "pairing", 6, F.col("pdf_pairing")),
        node("video_node", "pairing", 7, F.col("video_pairing")),
    )
    flat = k.select(F.col("id").alias("ord"), F.inline(rows)).where("id is not null")
    order = F.struct("ord", "place")
    merged = ("label", "date", "incident_date", "incident_location")
    first = [F.min(F.when(F.coalesce(F.col(a), F.lit("")) != "", F.struct(order.alias("o"), F.col(a).alias("v"))))["v"].alias(a) for a in merged]
    others = flat.groupBy("id", "type").agg(*first, F.sum(F.when(F.col("type") == "event", 1)).alias("record_count"))
    return record.unionByName(others, allowMissingColumns=True)


def degrees(edges_: DataFrame) -> DataFrame:
    """(id, degree, first_ord, first_place): both ends count; first_* is where a node was first seen."""
    end = lambda c, i: F.struct(F.col(c).alias("id"), F.lit(i).alias("side"))
    ends = edges_.select(F.inline(F.array(end("source", 0), end("target", 1))), "ord", "place")
    seen = F.min(F.struct("ord", (F.col("place") * 2 + F.col("side")).alias("place"))).alias("s")
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"), seen).select("id", "degree", F.col("s.ord").alias("first_ord"), F.col("s.place").alias("first_place"))
