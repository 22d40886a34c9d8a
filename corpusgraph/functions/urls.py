"""URL and path functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusgraph.functions.text import slug

# Reasons and places of the manifest.
NOT_PDF = "pdf_source_url_does_not_end_with_pdf"
REPAIRED = "repaired_pdf_url_from_thumbnail:"


def path(url: Column) -> Column:
    """The path of a URL: without scheme, host, query and fragment."""
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    rest = F.regexp_replace(rest, r"^//[^/?#]*", "")
    return F.regexp_extract(rest, r"^([^?#]*)", 1)


def last_segment(url: Column) -> Column:
    """The last segment of the path, percent-decoded; a wrong escape leaves it as it is."""
    name = F.regexp_extract(path(url), r"([^/]*)/*$", 1)
    decoded = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.coalesce(decoded, name)


def raw_segment(url: Column) -> Column:
    """The last segment of an address as it is written, with query and escapes: the name of a thumbnail's file."""
    return F.regexp_extract(url, r"([^/]+)/*$", 1)


def basename(url: Column, title: Column, kind: Column, index: Column) -> Column:
    """File name of a URL, or one made of the title, or of the record's number."""
    name = last_segment(url)
    ending = F.when(kind == "PDF", ".pdf").when(kind == "IMG", ".jpg").otherwise("")
    return F.when(F.contains(name, F.lit(".")), name).otherwise(F.concat(slug(title, 120, F.format_string("record-%03d", index)), ending))


def repaired_pdf(url: Column, thumbnail: Column, base: Column) -> Column:
    """struct(url, note): a PDF address that doesn't end like one is made from the thumbnail's name below `base`."""
    name = last_segment(thumbnail)
    made = F.concat(base, F.substring(name, F.lit(1), F.length(name) - 4), F.lit(".pdf"))
    fine = F.lower(url).endswith(".pdf")
    usable = (thumbnail != "") & F.lower(name).endswith(".jpg")
    return F.struct(
        F.when(~fine & usable, made).otherwise(url).alias("url"),
        F.when(fine, F.lit("")).when(usable, F.concat(F.lit(REPAIRED), url)).otherwise(F.lit(NOT_PDF)).alias("note"),
    )


def local_path(kind: Column, filename: Column) -> Column:
    return F.when(kind == "PDF", F.concat(F.lit("data/raw/pdfs/"), filename)).when(kind == "IMG", F.concat(F.lit("data/raw/images/"), filename)).otherwise(F.lit(""))


def quoted(url: Column) -> Column:
    """The URL with its path percent-encoded; / % : @ and unreserved characters stay."""
    p = path(url)
    at = F.locate("://", url)
    host = F.when(at > 0, F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)).otherwise(F.lit(""))
    tail = F.substring(url, F.length(host) + F.length(p) + 1, F.length(url) + 1)
    e = F.url_encode(p)
    for coded, char in (("+", "%20"), ("%2F", "/"), ("%25", "%"), ("%3A", ":"), ("%40", "@"), ("%7E", "~"), ("*", "%2A")):
        e = F.replace(e, F.lit(coded), F.lit(char))
    return F.concat(host, e, tail)


def page_path(folder: str, record: Column, page: Column, ending: str) -> Column:
    return F.concat(F.lit(folder), record, F.format_string("/page_%04d", page), F.lit(ending))
