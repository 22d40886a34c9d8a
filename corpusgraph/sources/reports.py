"""Markdown reports: small figures worked out by Spark, laid out on the driver; long lists stay rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _report(title: str, figures: list[tuple[str, object]]) -> list[str]:
    return [f"# {title}", "", *(f"- {k}: {v}" for k, v in figures)]


def save(lines: list[str], path: str) -> None:
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")


def manifest(records: DataFrame, title: str, source: str, most_notes: int = 1000) -> list[str]:
    """Counts of records by kind, repairs and warnings, and the notes themselves by id; more notes than `most_notes` are an error, `notes` has them as rows."""
    kinds = {r["kind"]: r["n"] for r in records.where("kind in ('PDF', 'IMG', 'VID')").groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = records.agg(F.count(F.lit(1)).alias("n"), F.count("warning").alias("warning"), F.count("repair").alias("repair")).first()
    if n["warning"] + n["repair"] > most_notes:
        raise ValueError("too many notes for a report: write `notes` as a table")
    out = _report(title, [("Source CSV", f"`{source}`"), ("Total records", n["n"]), *((f"{name} records", kinds.get(k, 0)) for k, name in (("PDF", "PDF"), ("IMG", "Image"), ("VID", "Video"))), ("Warning records", n["warning"]), ("Repaired records", n["repair"])])
    for heading, column in (("Repairs", "repair"), ("Warnings", "warning")):
        if n[column]:
            out += ["", f"## {heading}", *(r["line"] for r in notes(records, column).orderBy("id").collect())]
    return out


def notes(records: DataFrame, column: str) -> DataFrame:
    """(id, line): a line of the report for each record with a note."""
    text = F.format_string("- `%s` `%s`: %s -> %s", "id", F.coalesce("title", F.lit("")), column, F.coalesce("source_url", F.lit("")))
    return records.where(F.col(column).isNotNull()).select("id", text.alias("line"))


def final_text(pages: DataFrame) -> list[str]:
    """Totals of the merged pages."""
    cols = ("embedded_text_chars", "ocr_text_chars", "final_text_chars")
    r = pages.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("d"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols)).first()
    return _report("Final Text Summary", [("Pages", r["n"]), ("Documents", r["d"]), ("Embedded text characters", r[cols[0]]), ("OCR text characters", r[cols[1]]), ("Final text characters", r[cols[2]])])


def recognition(log: DataFrame) -> list[str]:
    """Totals of the recognition log."""
    r = log.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("d"), F.coalesce(F.sum("ocr_text_chars"), F.lit(0)).alias("c")).first()
    return _report("OCR Summary", [("OCR page rows", r["n"]), ("OCR document rows", r["d"]), ("OCR text characters", r["c"])])


def curated(totals: DataFrame) -> list[str]:
    """Totals of the curated layer, from the row of `operators.curate.totals`."""
    r = totals.first()
    names = (("Documents", "documents"), ("Pages", "pages"), ("Search chunks", "chunks"), ("Default LLM/RAG chunks", "default_chunks"), ("Excluded/noisy chunks retained for audit", "excluded_chunks"), ("Raw text characters", "raw_text_chars"), ("Clean text characters", "clean_text_chars"))
    return _report("Curated Text Summary", [(k, r[c] or 0) for k, c in names])


def events(nodes: DataFrame) -> DataFrame:
    """(label, id, section): the event index, a section for each event node, to be written in the order of label and id."""
    given = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A"))
    section = F.format_string("## %s\n\n- Incident date: %s\n- Incident location: %s\n- Record count: %d\n", "label", given("incident_date"), given("incident_location"), F.coalesce("record_count", F.lit(0)))
    return nodes.where("type = 'event'").select("label", "id", section.alias("section"))


def write_events(nodes: DataFrame, path: str) -> None:
    """The event index as text files in the order of labels."""
    events(nodes).orderBy("label", "id").select("section").write.mode("overwrite").text(path)
