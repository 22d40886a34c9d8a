"""Choosing what is still to be recognised, and summing up what has been."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pages with at most so many embedded characters are recognised.
TEXT_THRESHOLD = 20


def best_image(images: DataFrame, keys: list[str], width: str, height: str, order: list[str]) -> DataFrame:
    """The image of the largest area of each key; null sides count 0; of equal areas the first by `order`."""
    area = (F.coalesce(F.col(width), F.lit(0)) * F.coalesce(F.col(height), F.lit(0))).alias("area")
    rest = [c for c in images.columns if c not in keys]
    by_order = F.struct(*order, *(c for c in rest if c not in order))
    top = images.withColumn("area", area).groupBy(*keys).agg(F.max("area").alias("area"))
    tied = images.withColumn("area", area).join(top, [*keys, "area"])
    out = tied.groupBy(*keys, "area").agg(F.min(by_order).alias("r"))
    return out.select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest), "area")


def jobs(pages: DataFrame, images: DataFrame, log: DataFrame, threshold: int = TEXT_THRESHOLD, force: bool = False) -> DataFrame:
    """Pages with little text and an image that no good log entry covers (all of them with `force`)."""
    todo = pages.where(F.coalesce("text_chars", F.lit(0)) <= threshold)
    if not force:
        todo = todo.join(log.where("status = 'ok'").select("record_id", "page").distinct(), ["record_id", "page"], "left_anti")
    return todo.join(images, ["record_id", "page"])


def document_summary(log: DataFrame) -> DataFrame:
    """Log entries, characters and mean confidence of each record; errors and repeats count."""
    confidence = F.when(F.isnan("confidence"), None).otherwise(F.col("confidence"))
    return log.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("ocr_pages"),
        F.sum(F.coalesce("ocr_text_chars", F.lit(0))).alias("ocr_text_chars"),
        F.avg(F.coalesce(confidence, F.lit(0.0))).alias("average_confidence"),
    )


def run_recognizer(images: DataFrame, path: str, recognize: Callable[[list[str]], list[dict]], batch: int = 12) -> DataFrame:
    """(path, status, text, confidence, error) of `recognize`, called with `batch` paths at a time.

    A failing batch gives rows with status error and does not fail the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column(0).to_pylist()
            for i in range(0, len(paths), batch):
                part = paths[i : i + batch]
                try:
                    rows = recognize(part)
                except Exception as e:  # noqa: BLE001
                    rows = [{"path": p, "status": "error", "error": str(e)} for p in part]
                cols = [[r.get(c) for r in rows] for c in ("path", "status", "text", "confidence", "error")]
                types = (pa.string(), pa.string(), pa.string(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=["path", "status", "text", "confidence", "error"])

    return images.select(path).mapInArrow(run, "path string, status string, text string, confidence double, error string")


def render_needed(wanted: bool, text_chars: Column, images: Column) -> Column:
    """Whether a page must be rendered to an image: asked for, no text of its own, no image taken out of it; nulls count 0."""
    return F.lit(wanted) & (F.coalesce(text_chars, F.lit(0)) == 0) & (F.coalesce(images, F.lit(0)) == 0)


def image_confidence(lines: DataFrame, path: str = "path", confidence: str = "confidence") -> DataFrame:
    """(`path`, confidence): the mean over the lines read of each image; null and NaN are left out, an image without any has 0."""
    value = F.when(~F.isnan(confidence), F.col(confidence))
    return lines.groupBy(path).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("confidence"))


def matched(results: DataFrame, jobs: DataFrame, path: str = "image_path", ordinal: str = "ordinal") -> DataFrame:
    """Results of a batch (`path`, ...) with the job each belongs to; of jobs that share a path the last by `ordinal` gets the result.

    Results of a path without a job are left out; null paths belong to none.
    """
    keys = [c for c in jobs.columns if c not in (path, ordinal)]
    last = jobs.where(F.col(path).isNotNull()).groupBy(path).agg(F.max_by(F.struct(*keys), F.col(ordinal)).alias("_job"))
    return results.join(last, path).select(path, *(F.col(f"_job.{k}").alias(k) for k in keys), *(c for c in results.columns if c not in (path, *keys)))


def reused(records: DataFrame, texts: DataFrame, pages: DataFrame, force: bool = False) -> DataFrame:
    """`records` (id) with `reused`: whether an earlier run left both a text and a page of it; `force` starts anew."""
    done = texts.select("id").distinct().join(pages.select("id").distinct(), "id", "left_semi").withColumn("_done", F.lit(not force))
    return records.join(done, "id", "left").withColumn("reused", F.coalesce("_done", F.lit(False))).drop("_done")


def not_fetched(wanted: DataFrame, files: DataFrame, path: str, least_bytes: int = 1) -> DataFrame:
    """Rows whose file is not there; files: (`path`, bytes). An empty file counts as absent unless `least_bytes` is 0."""
    there = files.where((F.col(path).isNotNull()) & (F.coalesce("bytes", F.lit(0)) >= least_bytes)).select(path).distinct()
    return wanted.join(there, path, "left_anti")


IMAGE = "struct<width: bigint, height: bigint, extension: string, path: string, status: string, error: string>"
PAGE = f"path string, page bigint, text string, status string, error string, images array<{IMAGE}>"


def run_extractor(files: DataFrame, extract: Callable[[str, bytes], list[dict]]) -> DataFrame:
    """Pages of binary files (path, content) by an injectable extractor: a row per page in order, numbered from 1, with its images.

    `extract` gives a dict for each page: text, and images as dicts of width, height, extension, path,
    status and error. A file that can't be read is a row with page 0 and status open_error.
    """
    schema = pa.schema(
        [("path", pa.string()), ("page", pa.int64()), ("text", pa.string()), ("status", pa.string()), ("error", pa.string())]
        + [("images", pa.list_(pa.struct([("width", pa.int64()), ("height", pa.int64()), ("extension", pa.string()), ("path", pa.string()), ("status", pa.string()), ("error", pa.string())])))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows = [{"page": i, "status": "ok", "images": [], **r} for i, r in enumerate(extract(path, content), 1)]
                except Exception as e:  # noqa: BLE001
                    rows = [{"page": 0, "status": "open_error", "error": str(e), "images": []}]
                yield pa.RecordBatch.from_pylist([{"path": path, **r, "images": [{"status": "ok", **i} for i in r["images"]]} for r in rows], schema=schema)

    return files.select("path", "content").mapInArrow(run, PAGE)


def extracted_pages(pages: DataFrame) -> DataFrame:
    """The pages table of an extraction: characters, number of images and the paths of those that could be kept."""
    kept = F.filter("images", lambda i: i["status"] == "ok")
    return pages.where("status <> 'open_error'").select("path", "page", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("text_chars"), F.size("images").cast("bigint").alias("embedded_image_count"), F.transform(kept, lambda i: i["path"]).alias("image_paths"), "status")


def extracted_images(pages: DataFrame) -> DataFrame:
    """The images table of an extraction: a row per image, numbered from 1 within its page."""
    rows = pages.select(F.col("path").alias("file"), "page", F.posexplode("images").alias("i", "image"))
    return rows.select("file", "page", (F.col("i") + 1).cast("bigint").alias("image_index"), "image.*")


def extracted_documents(pages: DataFrame) -> DataFrame:
    """The documents table of an extraction: pages, characters and images of each file, and whether it could be opened."""
    n = F.count_if(F.col("page") > 0).alias("page_count")
    sums = (F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("bigint").alias("text_chars"), F.sum(F.size("images")).cast("bigint").alias("image_count"))
    return pages.groupBy("path").agg(n, *sums, F.max(F.when(F.col("status") == "open_error", F.lit("open_error"))).alias("e"), F.max("error").alias("error")).withColumn("status", F.coalesce("e", F.lit("ok"))).drop("e")
