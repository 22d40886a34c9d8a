"""From a release's rows to records: ids, addresses, file names, notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.functions import urls as U
from corpusgraph.session import stored

# Header names of the release CSV, and the columns they fill.
CSV_COLUMNS = {
    "Type": "kind", "Title": "title", "PDF | Image Link": "source_url", "Modal Image": "thumbnail_url", "PDF Pairing": "pdf_pairing",
    "Video Pairing": "video_pairing", "Release Date": "release_date", "Redaction": "redaction", "Agency": "agency", "Incident Date": "incident_date",
    "Incident Location": "incident_location", "Description Blurb": "description", "DVIDS Video ID": "dvids_video_id", "Video Title": "video_title",
}


def with_ordinal(df: DataFrame, by: list[str | Column], name: str = "ordinal", tasks: int = 32) -> DataFrame:
    """`df` with its rank from 1 in the order of `by`, which must be unique, without a global window.

    Rows are sorted by ranges and kept as a table, so that both uses see the same ranges; each range
    is numbered on its own and shifted by the sizes of those before it, of which there are `tasks`.
    """
    ranged = df.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_p", F.shiftright("_id", 33)).withColumn("_i", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))
    sizes = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over `tasks` rows
    shifts = sizes.select("_p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(shifts), "_p").withColumn(name, F.col("_before") + F.col("_i") + 1).drop("_p", "_i", "_before")


def records_from_csv(rows: DataFrame, release: str, prefix: str, repair_base: str, ordinal: str = "ordinal") -> DataFrame:
    """Records of a release CSV whose rows carry their number in `ordinal`."""
    df = rows.select(F.col(ordinal).cast("bigint").alias("n"), *(T.clean(F.col(f"`{c}`")).alias(n) for c, n in CSV_COLUMNS.items()))
    df = df.withColumn("kind", F.upper("kind")).withColumn("redaction", F.upper("redaction") == "TRUE")
    fix = U.repaired_pdf(F.col("source_url"), F.col("thumbnail_url"), F.lit(repair_base))
    pdf = (F.col("kind") == "PDF") & (F.col("source_url") != "")
    df = df.withColumn("fix", F.when(pdf, fix)).withColumn("source_url", F.when(pdf, F.col("fix.url")).otherwise(F.col("source_url")))
    df = df.withColumn("filename", F.when(F.col("source_url") == "", F.lit("")).otherwise(U.basename(F.col("source_url"), F.col("title"), F.col("kind"), F.col("n"))))
    return df.select(
        F.format_string(f"{prefix}-%04d", "n").alias("id"), F.lit(release).alias("release"), "release_date", "redaction", "title", "kind", "agency", "incident_date", "incident_location",
        "description", "source_url", "thumbnail_url", "dvids_video_id", "video_title", "pdf_pairing", "video_pairing", "filename",
        U.local_path(F.col("kind"), F.col("filename")).alias("local_path"),
        T.slug(F.col("title"), 120, F.format_string("record-%03d", "n")).alias("slug"),
        F.nullif(F.col("fix.note"), F.lit("")).alias("repair"),
        F.when(pdf & ~F.lower("source_url").endswith(".pdf"), F.lit(U.NOT_PDF)).alias("warning"),
    )


def one_per_id(records: DataFrame) -> DataFrame:
    """Records delivered several times once: the delivery with the least release date, then warning."""
    rest = [c for c in records.columns if c not in ("id", "release_date", "warning")]
    row = F.min(F.struct("release_date", "warning", *rest)).alias("r")
    return records.groupBy("id").agg(row).select("id", *(F.col(f"r.{c}").alias(c) for c in records.columns if c != "id"))


def is_given(c: Column) -> Column:
    """Neither null nor empty nor N/A in any case."""
    return c.isNotNull() & (c != "") & (F.upper(c) != "N/A")


def download_candidates(records: DataFrame, limit: int = 0) -> DataFrame:
    """Records whose file is to be fetched: kind, address and place are given; the first `limit` by id, 0 for all."""
    out = records.where("kind in ('PDF', 'IMG') and coalesce(source_url, '') <> '' and coalesce(local_path, '') <> ''")
    out = out.orderBy("id").limit(limit) if limit else out
    return out.select("id", "kind", "source_url", "local_path")
