"""Queries over records: manifest, addresses, the graph and what a viewer asks of it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.functions import urls as U
from corpusgraph.operators import graph as G
from corpusgraph.operators import graphview as V
from corpusgraph.operators import manifest as R
from corpusgraph.operators import ocrplan as O
from corpusgraph.operators import validate as K
from corpusgraph.operators.merge import document_totals
from corpusgraph.plans.corpus_queries import SQL_BEST_IMAGE, SQL_DOCUMENTS, WS, curated_documents, page_rows, q_ocr_jobs, sql_strip
from corpusgraph.session import read_table, shared_folder, stored
from corpusgraph.sources import io, reports

COLUMNS = (
    "id", "release", "release_date", "redaction", "title", "kind", "agency", "incident_date", "incident_location", "description", "source_url", "thumbnail_url",
    "dvids_video_id", "video_title", "pdf_pairing", "video_pairing", "filename", "local_path", "slug", "repair", "warning",
)


def deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Both record tables, every delivery."""
    return read_table(spark, d, "pdf_records").select(*COLUMNS).unionByName(read_table(spark, d, "image_records").select(*COLUMNS))


def records(spark: SparkSession, d: str) -> DataFrame:
    """Every record once."""
    return R.one_per_id(deliveries(spark, d).where("id is not null"))


_C = ", ".join(COLUMNS)
SQL_RECORDS = f"""
deliveries AS (SELECT {_C} FROM pdf_records UNION ALL SELECT {_C} FROM image_records),
records AS (SELECT {_C} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY release_date NULLS FIRST, warning NULLS FIRST) AS rn FROM deliveries WHERE id IS NOT NULL) WHERE rn = 1)
"""


def sql_slug(e: str, limit: int, fallback: str) -> str:
    return f"coalesce(nullif(left(regexp_replace(regexp_replace(lower({e}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), {limit}), ''), {fallback})"


def sql_node(prefix: str, e: str) -> str:
    v = f"trim(regexp_replace(coalesce({e}, ''), '[{WS}]+', ' ', 'g'))"
    return f"'{prefix}:' || " + sql_slug(f"CASE WHEN {v} = '' OR upper({v}) = 'N/A' THEN 'unknown' ELSE {v} END", 140, "'unknown'")


# --- manifest ---------------------------------------------------------------------------------


def q_manifest_ids(spark: SparkSession, d: str) -> DataFrame:
    """Records numbered in the order of their ids, and the id made of that number."""
    df = R.with_ordinal(records(spark, d).select("id"), ["id"])
    return df.select("id", F.col("ordinal").cast("bigint").alias("ordinal"), F.format_string("release01-%04d", "ordinal").alias("made_id"))


SQL_IDS = f"WITH {SQL_RECORDS} SELECT id, ordinal, printf('release01-%04d', ordinal) AS made_id FROM (SELECT id, row_number() OVER (ORDER BY id) AS ordinal FROM records)"


def q_slugify(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of titles and agencies."""
    return records(spark, d).select("id", T.slug(F.coalesce("title", F.lit("")), 120, F.lit("record")).alias("title_slug"), T.node_id("agency", F.col("agency")).alias("agency_node"))


SQL_SLUGS = f"WITH {SQL_RECORDS} SELECT id, {sql_slug(chr(99) + 'oalesce(title, ' + chr(39) * 2 + ')', 120, chr(39) + 'record' + chr(39))} AS title_slug, {sql_node('agency', 'agency')} AS agency_node FROM records"


def q_safe_names(spark: SparkSession, d: str) -> DataFrame:
    """Titles and places as file names."""
    return records(spark, d).select("id", T.safe_filename(F.coalesce("title", F.lit(""))).alias("ascii_name"), T.safe_name(F.coalesce("incident_location", F.lit(""))).alias("unicode_name"))


SQL_SAFE = f"""WITH {SQL_RECORDS} SELECT id, coalesce(nullif(regexp_replace(regexp_replace(coalesce(title, ''), '[^A-Za-z0-9_.-]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'untitled') AS ascii_name,
regexp_replace(coalesce(incident_location, ''), '[^\\p{{L}}\\p{{N}}_.-]', '_', 'g') AS unicode_name FROM records"""

# Addresses that bring the rules for names into play.
URLS = (
    ("https://h/p/serial%205.pdf?x=1", "Any", "PDF", 1),
    ("https://h/p/", "My Title", "IMG", 2),
    ("https://h/p/", "", "IMG", 7),
    ("https://h/a+b/c+d.pdf", "Plus", "PDF", 3),
    ("https://h/bad%zz.pdf", "Bad", "PDF", 4),
    ("https://h/with blank/x y.jpg#f", "Blank", "IMG", 5),
    ("https://h", "Only host", "VID", 6),
    ("", "No address", "PDF", 12),
)
_URL_SQL = " UNION ALL ".join(f"SELECT '{u}' AS url, '{t}' AS title, '{k}' AS kind, {i}::BIGINT AS n" for u, t, k, i in URLS)


def _addresses(spark: SparkSession, d: str) -> DataFrame:
    given = spark.createDataFrame(list(URLS), "url string, title string, kind string, n bigint")
    own = records(spark, d).select(F.col("source_url").alias("url"), "title", "kind", F.lit(0).cast("bigint").alias("n")).where("url is not null and title is not null")
    return given.unionByName(own).distinct()


def sql_path(e: str) -> str:
    return f"regexp_extract(regexp_replace(regexp_replace({e}, '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//[^/?#]*', ''), '^([^?#]*)', 1)"


def sql_segment(e: str) -> str:
    raw = f"regexp_extract({sql_path(e)}, '([^/]*)/*$', 1)"
    return f"CASE WHEN regexp_matches({raw}, '%($|[^0-9A-Fa-f]|[0-9A-Fa-f]$|[0-9A-Fa-f][^0-9A-Fa-f])') THEN {raw} ELSE url_decode({raw}) END"


SQL_ADDRESSES = f"""{SQL_RECORDS}, a AS (SELECT DISTINCT url, title, kind, n FROM ({_URL_SQL} UNION ALL SELECT source_url, title, kind, 0 FROM records WHERE source_url IS NOT NULL AND title IS NOT NULL))"""


def q_url_basename(spark: SparkSession, d: str) -> DataFrame:
    """File names of addresses, and where the files are kept."""
    df = _addresses(spark, d).withColumn("name", U.basename(F.col("url"), F.col("title"), F.col("kind"), F.col("n")))
    return df.select("url", "title", "kind", "n", "name", U.local_path(F.col("kind"), F.col("name")).alias("local_path"))


SQL_BASENAME = f"""WITH {SQL_ADDRESSES}, b AS (SELECT *, {sql_segment('url')} AS seg FROM a),
c AS (SELECT url, title, kind, n, CASE WHEN contains(seg, '.') THEN seg ELSE {sql_slug('title', 120, "printf('record-%03d', n)")} || CASE kind WHEN 'PDF' THEN '.pdf' WHEN 'IMG' THEN '.jpg' ELSE '' END END AS name FROM b)
SELECT *, CASE kind WHEN 'PDF' THEN 'data/raw/pdfs/' || name WHEN 'IMG' THEN 'data/raw/images/' || name ELSE '' END AS local_path FROM c"""

BASE = "https://files.archive.invalid/media/repaired/"


def q_repair_url(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of PDF records after the repair from the thumbnail, with the note."""
    df = deliveries(spark, d).where("kind = 'PDF'").select("id", F.coalesce("source_url", F.lit("")).alias("url"), F.coalesce("thumbnail_url", F.lit("")).alias("thumb")).distinct()
    cut = df.withColumn("broken", F.regexp_replace("url", r"\.pdf$", ""))  # every address once whole and once without its ending
    rows = cut.select("id", "thumb", F.explode(F.array("url", "broken")).alias("url")).distinct()
    return rows.withColumn("fix", U.repaired_pdf(F.col("url"), F.col("thumb"), F.lit(BASE))).select("id", "url", F.col("fix.url").alias("repaired"), F.col("fix.note").alias("note"))


SQL_REPAIR = f"""WITH {SQL_RECORDS}, u AS (SELECT DISTINCT id, coalesce(source_url, '') AS url, coalesce(thumbnail_url, '') AS thumb FROM deliveries WHERE kind = 'PDF'),
v AS (SELECT id, thumb, url FROM u UNION SELECT id, thumb, regexp_replace(url, '\\.pdf$', '') FROM u), w AS (SELECT *, {sql_segment('thumb')} AS seg FROM v)
SELECT id, url, CASE WHEN NOT lower(url) LIKE '%.pdf' AND thumb <> '' AND lower(seg) LIKE '%.jpg' THEN '{BASE}' || left(seg, length(seg) - 4) || '.pdf' ELSE url END AS repaired,
CASE WHEN lower(url) LIKE '%.pdf' THEN '' WHEN thumb <> '' AND lower(seg) LIKE '%.jpg' THEN '{U.REPAIRED}' || url ELSE '{U.NOT_PDF}' END AS note FROM w"""


def q_quote_url(spark: SparkSession, d: str) -> DataFrame:
    """Addresses with their paths percent-encoded."""
    return _addresses(spark, d).select("url").distinct().select("url", U.quoted(F.col("url")).alias("quoted"))


SQL_QUOTE = f"""WITH {SQL_ADDRESSES}, p AS (SELECT DISTINCT url, {sql_path('url')} AS path FROM a),
h AS (SELECT *, CASE WHEN contains(url, '://') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) ELSE '' END AS host FROM p)
SELECT url, host || replace(replace(replace(replace(url_encode(path), '%2F', '/'), '%25', '%'), '%3A', ':'), '%40', '@') || url[length(host) + length(path) + 1:] AS quoted FROM h"""


def q_kind_counts(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("repair").alias("repaired"), F.count("warning").alias("warned"))


def q_distinct_files(spark: SparkSession, d: str) -> DataFrame:
    """Records and different files by kind."""
    return records(spark, d).where("local_path <> ''").groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("local_path").alias("files"))


def q_download_all(spark: SparkSession, d: str) -> DataFrame:
    """Every record whose file is to be fetched."""
    return R.download_candidates(records(spark, d))


def q_fetch_missing(spark: SparkSession, d: str) -> DataFrame:
    """Candidates whose file is not there, an empty file counting as absent; a record's document stands for its file."""
    r = records(spark, d)
    docs = read_table(spark, d, "documents").where("record_id is not null").groupBy(F.col("record_id").alias("id")).agg(F.max("n_chars").alias("bytes"))
    files = r.select("id", "local_path").join(docs, "id").select("local_path", "bytes")
    return O.not_fetched(R.download_candidates(r), files, "local_path").select("id", "local_path")


def q_thumbnails(spark: SparkSession, d: str) -> DataFrame:
    """Names of the thumbnails' files."""
    name = U.raw_segment(F.col("thumbnail_url"))
    return records(spark, d).select("id", name.alias("name")).where("name <> ''")


def q_sorted_files(spark: SparkSession, d: str) -> DataFrame:
    """The different files of the records, numbered in the order of their paths."""
    df = records(spark, d).where("local_path <> ''").select("local_path").distinct()
    return R.with_ordinal(df, ["local_path"]).select("ordinal", "local_path")


_ROUND = ("id", "kind", "title", "redaction", "source_url")


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/io-{uuid.uuid4().hex}"


def q_io_jsonl(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON lines in two parts, the second appended, and read again."""
    r, path = stored(records(spark, d).select(*_ROUND)), _folder(spark)
    io.write_jsonl(r.where("kind = 'PDF'"), path)
    io.write_jsonl(r.where("coalesce(kind, '') <> 'PDF'"), path, "append")
    return io.read_jsonl(spark, path, r.schema)


def q_io_csv(spark: SparkSession, d: str) -> DataFrame:
    """Records written as a CSV of two tables with different columns, and read again as strings."""
    r, path = stored(records(spark, d).select(*_ROUND)), _folder(spark)
    io.write_csv([r.where("kind = 'PDF'").drop("source_url"), r.where("coalesce(kind, '') <> 'PDF'")], path)
    got = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return got.select("id", "kind", "title", "redaction", F.when(F.col("kind") != "PDF", F.col("source_url")).alias("source_url"))


def q_io_release(spark: SparkSession, d: str) -> DataFrame:
    """Records written as a release's CSV, read and made records again; the number in the file is not their id."""
    r, path = stored(records(spark, d)), _folder(spark)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for h, c in R.CSV_COLUMNS.items()]
    r.select(*cells).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    got = R.records_from_csv(io.read_release_csv(spark, path), "release_1", "release01", BASE)
    return got.groupBy("kind", "redaction", "agency").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.count("repair").alias("repaired"))


SQL_IO_RELEASE = f"""WITH {SQL_RECORDS}, c AS (SELECT upper(trim(regexp_replace(replace(coalesce(kind, ''), chr(65279), ' '), '[{WS}]+', ' ', 'g'))) AS kind, coalesce(redaction, false) AS redaction,
trim(regexp_replace(replace(coalesce(agency, ''), chr(65279), ' '), '[{WS}]+', ' ', 'g')) AS agency, trim(coalesce(source_url, '')) AS u, trim(coalesce(thumbnail_url, '')) AS t FROM records)
SELECT kind, redaction, agency, count(*) AS n, count(*) AS ids, count(*) FILTER (WHERE kind = 'PDF' AND u <> '' AND NOT lower(u) LIKE '%.pdf' AND t <> '' AND lower(regexp_extract(t, '([^/]*)/*$', 1)) LIKE '%.jpg') AS repaired FROM c GROUP BY kind, redaction, agency"""


def q_io_lines(spark: SparkSession, d: str) -> DataFrame:
    """Addresses written as a list of lines, and how often each stands in it."""
    path = _folder(spark)
    io.write_lines(records(spark, d), "source_url", path)
    return spark.read.text(path).groupBy(F.col("value").alias("source_url")).agg(F.count(F.lit(1)).alias("n"))


def q_io_split(spark: SparkSession, d: str) -> DataFrame:
    """Records written in a folder for each kind, and read again."""
    path = _folder(spark)
    io.write_split(records(spark, d).where("kind is not null").select(*_ROUND), "kind", path)
    return spark.read.schema("id string, title string, redaction boolean, source_url string, kind string").json(path).select(*_ROUND)


def q_io_texts(spark: SparkSession, d: str) -> DataFrame:
    """Merged pages written below a folder for each record, texts ending in a line break, and read again."""
    path = _folder(spark)
    rows = page_rows(spark, d).select("record_id", "page", F.coalesce("final_text", F.lit("")).alias("text"))
    io.write_page_texts(rows, path)
    return spark.read.schema("page bigint, text string, record_id string").parquet(path).select("record_id", "page", F.md5("text").alias("text_md5"))


def q_io_tables(spark: SparkSession, d: str) -> DataFrame:
    """Three tables written from one pass over the pages, and the rows of each."""
    path = _folder(spark)
    parts = {"pages": lambda df: df, "embedded": lambda df: df.where("source like 'embedded%'"), "records": lambda df: df.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))}
    io.write_tables(page_rows(spark, d).select("record_id", "page", "source"), parts, path)
    counts = [io.read_jsonl(spark, f"{path}/{name}", "record_id string").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name in parts]
    return reduce(DataFrame.unionByName, counts)


def q_agencies(spark: SparkSession, d: str) -> DataFrame:
    """Every agency as it is written, with its number of records."""
    return records(spark, d).where(R.is_given(F.col("agency"))).groupBy("agency").agg(F.count(F.lit(1)).alias("n"))


# --- records with their texts -----------------------------------------------------------------


def record_layers(spark: SparkSession, d: str) -> DataFrame:
    """Records with what was extracted, merged and curated for them; missing layers fall back to the one before.

    The curated layer is that of the texts as they are stored; its counts by quality are JSON.
    """
    doc = read_table(spark, d, "documents").where("record_id is not null")
    doc = doc.groupBy(F.col("record_id").alias("id")).agg(F.max_by(F.struct("pages", "n_chars", "final_text_path"), "doc_id").alias("x"))
    final = document_totals(page_rows(spark, d)).select(F.col("record_id").alias("id"), F.col("ocr_text_chars").alias("o"), F.col("final_text_chars").alias("f"))
    cur = curated_documents(spark, d, compatible=False).select(F.col("record_id").alias("id"), F.col("clean_text_chars").alias("c"), F.col("readable_doc_path").alias("r"), F.to_json("quality_counts").alias("q"))
    images = read_table(spark, d, "ocr_pages").where("record_id is not null and page is not null and image_path is not null").groupBy(F.col("record_id").alias("id")).agg(F.countDistinct("image_path").alias("i"))
    df = records(spark, d).join(doc, "id", "left").join(final, "id", "left").join(cur, "id", "left").join(images, "id", "left")
    zero, empty = F.lit(0).cast("bigint"), F.lit("")
    return df.select(
        *COLUMNS,
        F.when(F.col("x").isNull(), "not_extracted").otherwise("ok").alias("extraction_status"),
        F.coalesce("x.pages", zero).alias("page_count"),
        F.coalesce("x.n_chars", zero).alias("text_chars"),
        F.coalesce("o", zero).alias("ocr_text_chars"),
        F.coalesce("f", "x.n_chars", zero).alias("final_text_chars"),
        F.when(F.col("f").isNotNull(), F.concat(F.lit("data/extracted/final_text/documents/"), F.col("id"), F.lit(".txt"))).otherwise(F.coalesce("x.final_text_path", empty)).alias("final_text_path"),
        F.coalesce("c", "f", "x.n_chars", zero).alias("clean_text_chars"),
        F.coalesce("r", empty).alias("readable_doc_path"),
        F.coalesce("q", F.lit("{}")).alias("quality_counts"),
        F.coalesce("i", zero).alias("image_count"),
    )


def q_record_layers(spark: SparkSession, d: str) -> DataFrame:
    return record_layers(spark, d).select("id", *G.LAYERS)


SQL_LAYERED = f"""{SQL_RECORDS}, {SQL_DOCUMENTS},
x AS (SELECT record_id, arg_max(struct_pack(p := pages, n := n_chars, f := final_text_path), doc_id) AS x FROM documents WHERE record_id IS NOT NULL GROUP BY record_id),
fi AS (SELECT record_id, CAST(sum(ocr_text_chars) AS BIGINT) AS o, CAST(sum(final_text_chars) AS BIGINT) AS f FROM (SELECT DISTINCT record_id, page, ocr_text_chars, final_text_chars FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL) GROUP BY record_id),
im AS (SELECT record_id, count(DISTINCT image_path) AS i FROM ocr_pages WHERE record_id IS NOT NULL AND page IS NOT NULL GROUP BY record_id HAVING count(image_path) > 0),
layered AS (SELECT r.*, CASE WHEN x.record_id IS NULL THEN 'not_extracted' ELSE 'ok' END AS extraction_status, coalesce(x.x.p, 0) AS page_count, coalesce(x.x.n, 0) AS text_chars, coalesce(fi.o, 0) AS ocr_text_chars,
  coalesce(fi.f, x.x.n, 0) AS final_text_chars, CASE WHEN fi.f IS NOT NULL THEN 'data/extracted/final_text/documents/' || r.id || '.txt' ELSE coalesce(x.x.f, '') END AS final_text_path,
  coalesce(docs.clean_text_chars, fi.f, x.x.n, 0) AS clean_text_chars, coalesce(docs.readable_doc_path, '') AS readable_doc_path, coalesce(docs.quality_counts, '{{}}') AS quality_counts, coalesce(im.i, 0) AS image_count
  FROM records r LEFT JOIN x ON x.record_id = r.id LEFT JOIN fi ON fi.record_id = r.id LEFT JOIN docs ON docs.record_id = r.id LEFT JOIN im ON im.record_id = r.id)
"""
_LAYERS = ", ".join(G.LAYERS)


def q_layer_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals over all records by kind and state of extraction."""
    sums = [F.sum(c).alias(n) for c, n in (("page_count", "pages"), ("final_text_chars", "final_text_chars"), ("image_count", "images"))]
    return record_layers(spark, d).groupBy("kind", "extraction_status").agg(F.count(F.lit(1)).alias("n"), *sums)


def q_doc_headers(spark: SparkSession, d: str) -> DataFrame:
    """The Markdown header of every record; blank fields as N/A, the title falls back to the id."""
    return records(spark, d).select("id", F.md5(T.document_header()).alias("header_md5"))


def _sql_na(c: str) -> str:
    return f"coalesce(nullif({c}, ''), 'N/A')"


SQL_HEADERS = f"""WITH {SQL_RECORDS}, h AS (SELECT id, '# ' || coalesce(nullif(title, ''), id) || chr(10) || chr(10) || '- Record ID: `' || id || '`' || chr(10) || '- Agency: ' || {_sql_na('agency')} || chr(10) || '- Release date: ' || {_sql_na('release_date')}
|| chr(10) || '- Incident date: ' || {_sql_na('incident_date')} || chr(10) || '- Incident location: ' || {_sql_na('incident_location')} || chr(10) || '- Source URL: ' || {_sql_na('source_url')}
|| CASE WHEN coalesce(description, '') <> '' THEN chr(10) || chr(10) || '## Official Description' || chr(10) || chr(10) || description ELSE '' END AS t FROM records)
SELECT id, md5({sql_strip('t')} || chr(10)) AS header_md5 FROM h"""

# --- graph ------------------------------------------------------------------------------------

_EVENT_KEY = """CASE WHEN upper(coalesce(nullif(incident_date, ''), 'N/A')) = 'N/A' AND upper(coalesce(nullif(incident_location, ''), 'N/A')) = 'N/A' THEN 'record:' || id
ELSE coalesce(nullif(incident_date, ''), 'N/A') || '|' || coalesce(nullif(incident_location, ''), 'N/A') END"""

_SQL_GRAPH = f"""
k0 AS (SELECT *, {_EVENT_KEY} AS ekey FROM records),
k AS (SELECT *, 'release:' || coalesce(release, '') AS rel_n, 'record:' || id AS rec_n, {sql_node('agency', 'agency')} AS age_n,
  CASE WHEN incident_location IS NOT NULL AND incident_location <> '' AND upper(incident_location) <> 'N/A' THEN {sql_node('location', 'incident_location')} END AS loc_n,
  CASE WHEN incident_date IS NOT NULL AND incident_date <> '' AND upper(incident_date) <> 'N/A' THEN {sql_node('date', 'incident_date')} END AS dat_n,
  {sql_node('event', 'ekey')} AS eve_n, CASE WHEN ekey LIKE 'record:%' THEN title ELSE ekey END AS elabel,
  CASE WHEN coalesce(pdf_pairing, '') <> '' THEN {sql_node('pairing', 'pdf_pairing')} END AS pdf_n, CASE WHEN coalesce(video_pairing, '') <> '' THEN {sql_node('pairing', 'video_pairing')} END AS vid_n FROM k0),
edges AS (SELECT * FROM (SELECT rel_n AS source, rec_n AS target, 'contains_record' AS relation, id AS ord, 0 AS place FROM k UNION ALL SELECT rec_n, age_n, 'from_agency', id, 1 FROM k
  UNION ALL SELECT rec_n, loc_n, 'incident_location', id, 2 FROM k UNION ALL SELECT rec_n, dat_n, 'incident_date', id, 3 FROM k UNION ALL SELECT eve_n, rec_n, 'supported_by', id, 4 FROM k
  UNION ALL SELECT rec_n, pdf_n, 'pdf_pairing', id, 5 FROM k UNION ALL SELECT rec_n, vid_n, 'video_pairing', id, 6 FROM k) WHERE source IS NOT NULL AND target IS NOT NULL),
flat AS (SELECT * FROM (
  SELECT rel_n AS nid, 'release' AS type, id AS ord, 0 AS place, release AS label, NULL AS nkind, NULL AS nagency, NULL AS ndate, NULL AS nloc, NULL AS nurl, NULL AS ndesc, NULL AS nthumb, NULL AS npath, release_date AS nrel FROM k
  UNION ALL SELECT rec_n, 'record', id, 1, title, kind, agency, incident_date, incident_location, source_url, description, thumbnail_url, local_path, NULL FROM k
  UNION ALL SELECT age_n, 'agency', id, 2, coalesce(nullif(agency, ''), 'Unknown agency'), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k
  UNION ALL SELECT loc_n, 'location', id, 3, incident_location, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k
  UNION ALL SELECT dat_n, 'date', id, 4, incident_date, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k
  UNION ALL SELECT eve_n, 'event', id, 5, elabel, NULL, NULL, incident_date, incident_location, NULL, NULL, NULL, NULL, NULL FROM k
  UNION ALL SELECT pdf_n, 'pairing', id, 6, pdf_pairing, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k
  UNION ALL SELECT vid_n, 'pairing', id, 7, video_pairing, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM k) WHERE nid IS NOT NULL),
nodes AS (SELECT nid AS id, type, first(label ORDER BY ord, place) FILTER (WHERE coalesce(label, '') <> '') AS label, first(nkind ORDER BY ord, place) FILTER (WHERE coalesce(nkind, '') <> '') AS kind,
  first(nagency ORDER BY ord, place) FILTER (WHERE coalesce(nagency, '') <> '') AS agency, first(ndate ORDER BY ord, place) FILTER (WHERE coalesce(ndate, '') <> '') AS incident_date,
  first(nloc ORDER BY ord, place) FILTER (WHERE coalesce(nloc, '') <> '') AS incident_location, first(nurl ORDER BY ord, place) FILTER (WHERE coalesce(nurl, '') <> '') AS source_url,
  first(ndesc ORDER BY ord, place) FILTER (WHERE coalesce(ndesc, '') <> '') AS description, first(nthumb ORDER BY ord, place) FILTER (WHERE coalesce(nthumb, '') <> '') AS thumbnail_url,
  first(npath ORDER BY ord, place) FILTER (WHERE coalesce(npath, '') <> '') AS local_path, first(nrel ORDER BY ord, place) FILTER (WHERE coalesce(nrel, '') <> '') AS date, CASE WHEN type = 'event' THEN count(*) END AS record_count FROM flat GROUP BY nid, type),
ends AS (SELECT source AS id, ord, place * 2 AS place FROM edges UNION ALL SELECT target, ord, place * 2 + 1 FROM edges),
degrees AS (SELECT id, count(*) AS degree, min(ord) AS first_ord, arg_min(place, (ord, place)) AS first_place FROM ends GROUP BY id)
"""
SQL_GRAPH = f"{SQL_RECORDS}, {_SQL_GRAPH}"
SQL_FULL = f"{SQL_LAYERED}, {_SQL_GRAPH}"


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the records, which are worked out once for both."""
    r = stored(records(spark, d))
    return G.nodes(r), G.edges(r)


def q_graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    """All nodes with their merged attributes, record nodes with those of all layers; the count of records is 0 but for events."""
    return G.nodes(stored(record_layers(spark, d))).withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("bigint")))


def q_graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1].select("source", "target", "relation")


def q_event_order(spark: SparkSession, d: str) -> DataFrame:
    """The sections of the event index, numbered in the order of labels."""
    e = reports.events(_graph(spark, d)[0]).withColumn("label", F.coalesce("label", F.lit("")))
    return R.with_ordinal(e, ["label", "id"]).select("ordinal", "id", F.md5("section").alias("section_md5"))


SQL_EVENT_ORDER = f"""WITH {SQL_GRAPH} SELECT row_number() OVER (ORDER BY coalesce(label, ''), id) AS ordinal, id, md5('## ' || label || chr(10) || chr(10) || '- Incident date: ' || coalesce(nullif(incident_date, ''), 'N/A') || chr(10)
|| '- Incident location: ' || coalesce(nullif(incident_location, ''), 'N/A') || chr(10) || '- Record count: ' || record_count || chr(10)) AS section_md5 FROM nodes WHERE type = 'event'"""


def q_event_index(spark: SparkSession, d: str) -> DataFrame:
    """Events with label, date, place and number of records."""
    n = _graph(spark, d)[0].where("type = 'event'")
    text = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("N/A")).alias(c)
    return n.select("id", "label", text("incident_date"), text("incident_location"), "record_count")


def q_graph_metadata(spark: SparkSession, d: str) -> DataFrame:
    r = stored(records(spark, d))
    n, e = G.nodes(r), G.edges(r)
    a = r.agg(F.count(F.lit(1)).alias("record_count"))
    return a.crossJoin(n.agg(F.count(F.lit(1)).alias("node_count"))).crossJoin(e.agg(F.count(F.lit(1)).alias("edge_count")))  # three rows of one


def q_node_order(spark: SparkSession, d: str) -> DataFrame:
    """All nodes, numbered in the order of their ids."""
    return R.with_ordinal(_graph(spark, d)[0].select("id", "type"), ["id"]).select("ordinal", "id", "type")


def q_degree(spark: SparkSession, d: str) -> DataFrame:
    return G.degrees(_graph(spark, d)[1]).select("id", "degree")


def q_top_nodes(spark: SparkSession, d: str) -> DataFrame:
    """The 18 nodes of the highest degree, ties in the order of first sight."""
    n, e = _graph(spark, d)
    top = G.degrees(e).orderBy(F.desc("degree"), "first_ord", "first_place").limit(18)
    return top.join(n.select("id", "type", "label"), "id").select("id", "type", "label", "degree")


def _event_records(n: DataFrame, e: DataFrame) -> DataFrame:
    """(event id, distinct records) through edges from an event to a record."""
    is_ = lambda t, c: n.where(F.col("type") == t).select(F.col("id").alias(c))
    s = e.where("relation = 'supported_by'").join(is_("event", "source"), "source", "left_semi").join(is_("record", "target"), "target", "left_semi")
    return s.groupBy("source").agg(F.countDistinct("target").alias("records"))


def q_top_events(spark: SparkSession, d: str) -> DataFrame:
    """The ten events with most records, ties by id."""
    n, e = _graph(spark, d)
    top = _event_records(n, e).orderBy(F.desc("records"), "source").limit(10)
    return top.join(n.select(F.col("id").alias("source"), "label"), "source").select(F.col("source").alias("id"), T.spaced_label(F.col("label")).alias("label"), "records")


def q_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[0].groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def q_relation_counts(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1].groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def q_relation_order(spark: SparkSession, d: str) -> DataFrame:
    """Relations by their number of edges, as the viewer lists and names them."""
    n = _graph(spark, d)[1].groupBy("relation").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "relation")).cast("bigint")  # over a handful of relations
    return n.select(place.alias("place"), "relation", T.relation_label(F.col("relation")).alias("label"), T.number(F.col("n")).alias("shown"))


SQL_RELATION_ORDER = f"""WITH {SQL_GRAPH}, c AS (SELECT relation, count(*) AS n FROM edges GROUP BY relation) SELECT row_number() OVER (ORDER BY n DESC, relation) AS place, relation,
CASE WHEN relation = 'pdf_pairing' THEN 'PDF pairing' ELSE replace(relation, '_', ' ') END AS label, format('{{:,}}', n) AS shown FROM c"""


def q_preset_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many nodes and edges each preset view shows."""
    n, e = map(stored, _graph(spark, d))
    parts = []
    for name, types in V.PRESETS.items():
        seen = n.where(F.col("type").isin(*types)).select("id")
        one = seen.agg(F.count(F.lit(1)).alias("nodes")).crossJoin(V.visible_edges(e, seen).agg(F.count(F.lit(1)).alias("edges")))  # single rows
        parts.append(one.select(F.lit(name).alias("preset"), "nodes", "edges"))
    return reduce(DataFrame.unionByName, parts)


_PRESET = "SELECT '{name}' AS preset, (SELECT count(*) FROM nodes WHERE type IN {types}) AS nodes, (SELECT count(*) FROM edges JOIN nodes a ON a.id = source JOIN nodes b ON b.id = target WHERE a.type IN {types} AND b.type IN {types}) AS edges"
SQL_PRESETS = f"WITH {SQL_GRAPH} " + " UNION ALL ".join(_PRESET.format(name=k, types=v) for k, v in V.PRESETS.items())


def q_top_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The first ten neighbours of the node of the highest degree."""
    n, e = map(stored, _graph(spark, d))
    deg = stored(G.degrees(e))
    top = deg.orderBy(F.desc("degree"), "first_ord", "first_place").limit(1).select("id")
    return V.top_neighbours(e, n, deg, top)


SQL_TOP_NEIGHBOURS = f"""WITH {SQL_GRAPH}, t AS (SELECT id FROM degrees ORDER BY degree DESC, first_ord, first_place LIMIT 1),
o AS (SELECT target AS id FROM edges WHERE source IN (SELECT id FROM t) UNION ALL SELECT source FROM edges WHERE target IN (SELECT id FROM t))
SELECT o.id, n.type, coalesce(n.label, '') AS label, d.degree FROM o JOIN nodes n ON n.id = o.id JOIN degrees d ON d.id = o.id ORDER BY d.degree DESC, coalesce(n.label, ''), o.id LIMIT 10"""


def q_agency_bars(spark: SparkSession, d: str) -> DataFrame:
    """Records of each agency and the width of its bar."""
    n = _graph(spark, d)[0].where("type = 'record' and coalesce(agency, '') <> ''").groupBy("agency").agg(F.count(F.lit(1)).alias("n"))
    top = n.agg(F.max("n").alias("top"))
    return n.join(F.broadcast(top)).select("agency", "n", F.round(F.greatest(F.lit(4.0), F.col("n") / F.col("top") * 100), 6).alias("width"))


def q_neighbors(spark: SparkSession, d: str) -> DataFrame:
    """How many neighbours each agency has, by relation and type."""
    n, e = _graph(spark, d)
    got = V.neighbours(e, n.where("type in ('agency', 'event')").select("id"))
    return got.join(n.select(F.col("id").alias("other"), "type"), "other").groupBy("id", "relation", "type").agg(F.count(F.lit(1)).alias("n"))


def q_search_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes in any of whose fields the term stands."""
    return _graph(spark, d)[0].where(V.matches("Lake")).select("id", "type")


def q_visible_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges between visible nodes: records and events of degree 3 or more that hold the term."""
    n, e = _graph(spark, d)
    seen = V.visible_nodes(n, G.degrees(e), ["record", "event"], 3, "valley")
    return V.visible_edges(e, seen, ["supported_by"]).select("source", "target", "relation")


def q_highlight(spark: SparkSession, d: str) -> DataFrame:
    """Nodes next to a location."""
    n, e = _graph(spark, d)
    return V.highlighted(e, n.where("type = 'location'").select("id"))


def q_dangling_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges left by relation when all date nodes are taken away."""
    n, e = _graph(spark, d)
    return V.visible_edges(e, n.where("type <> 'date'")).groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    n, e = _graph(spark, d)
    return V.layout_ranks(n.select("id", "type", F.coalesce("label", F.lit("")).alias("label")).join(G.degrees(e).select("id", "degree"), "id"))


def q_layout_rank(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("id", "type", "layout_index", "layout_count")


_SQL_RANKED = f"""{SQL_GRAPH}, ranked AS (SELECT n.id, n.type, d.degree, row_number() OVER (PARTITION BY n.type ORDER BY d.degree DESC, coalesce(n.label, ''), n.id) - 1 AS layout_index, count(*) OVER (PARTITION BY n.type) AS layout_count
FROM nodes n JOIN degrees d ON d.id = n.id)"""


def _placed(spark: SparkSession, d: str) -> DataFrame:
    x, y = V.anchors(F.col("type"), F.col("layout_index"), F.col("layout_count"))
    return _ranked(spark, d).withColumn("x", x).withColumn("y", y)


def q_anchor_layout(spark: SparkSession, d: str) -> DataFrame:
    """Homes and radii of all nodes."""
    r = V.node_radius(F.col("type"), F.col("degree"))
    return _placed(spark, d).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(r, 6).alias("radius"), F.round(V.screen_radius(r, F.lit(0.5)), 6).alias("screen_radius"))


def _sql_by(table: dict, other: object) -> str:
    return "CASE type " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in table.items()) + f" ELSE {other!r}::DOUBLE END"


_A = [_sql_by({k: v[i] for k, v in V.ANCHORS.items()}, V.OTHER_ANCHOR[i]) for i in range(6)]
_SQL_ANGLE = f"(layout_index * {V.GOLDEN_ANGLE!r}::DOUBLE * {_A[0]} + (layout_index + 0.5::DOUBLE) / greatest(layout_count, 1) * {_A[1]} + {_A[2]})"
_SQL_RING = f"({_A[3]} + (layout_index % ({_A[4]})::BIGINT) * {_A[5]})"
_SQL_RADIUS = f"({_sql_by(V.TYPE_RADIUS, V.OTHER_RADIUS)} + least(8.0::DOUBLE, sqrt(degree) * 0.75::DOUBLE))"
_SQL_PLACED = f"{_SQL_RANKED}, placed AS (SELECT *, cos({_SQL_ANGLE}) * {_SQL_RING} AS x, sin({_SQL_ANGLE}) * {_SQL_RING} AS y, {_SQL_RADIUS} AS radius FROM ranked)"


def q_spiral(spark: SparkSession, d: str) -> DataFrame:
    """First places of the nodes, and there and back between world and screen."""
    n = R.with_ordinal(_graph(spark, d)[0].select("id"), ["id"])
    x, y = V.spiral(F.col("ordinal") - 1)
    p = n.select("id", x.alias("x"), y.alias("y"))
    sx, sy = V.to_screen(F.col("x"), F.col("y"), 1200.0, 800.0, 0.5, 10.0, -20.0)
    p = p.withColumn("sx", sx).withColumn("sy", sy)
    wx, wy = V.to_world(F.col("sx"), F.col("sy"), 1200.0, 800.0, 0.5, 10.0, -20.0)
    return p.select("id", *(F.round(c, 4).alias(c) for c in ("x", "y", "sx", "sy")), F.round(wx, 4).alias("wx"), F.round(wy, 4).alias("wy"))


SQL_SPIRAL = f"""WITH {SQL_GRAPH}, i AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS i FROM nodes),
p AS (SELECT id, cos(i * {V.SPIRAL_ANGLE!r}::DOUBLE) * (90 + (i % 31) * 8) AS x, sin(i * {V.SPIRAL_ANGLE!r}::DOUBLE) * (90 + (i % 29) * 8) AS y FROM i)
SELECT id, round(x, 4) AS x, round(y, 4) AS y, round(600 + (x + 10) * 0.5::DOUBLE, 4) AS sx, round(400 + (y - 20) * 0.5::DOUBLE, 4) AS sy, round(x, 4) AS wx, round(y, 4) AS wy FROM p"""


def q_viewport(spark: SparkSession, d: str) -> DataFrame:
    """Bounding box, zoom and shift for all nodes."""
    v = V.viewport(_placed(spark, d), 1200.0, 800.0)
    return v.select("n", *(F.round(c, 3).alias(c) for c in ("min_x", "max_x", "min_y", "max_y", "dx", "dy")), F.round("zoom", 6).alias("zoom"))


SQL_VIEWPORT = f"""WITH {_SQL_PLACED}, b AS (SELECT count(*) AS n, min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM placed)
SELECT n, round(a, 3) AS min_x, round(b, 3) AS max_x, round(c, 3) AS min_y, round(d, 3) AS max_y, round(-(a + b) / 2, 3) AS dx, round(-(c + d) / 2, 3) AS dy,
round(greatest(0.18::DOUBLE, least(2.2::DOUBLE, 1110.0::DOUBLE / greatest(1, b - a), 710.0::DOUBLE / greatest(1, d - c))), 6) AS zoom FROM b"""


def q_close_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many other nodes are in reach of each node of the layout, over nodes of all types."""
    return V.close_counts(_placed(spark, d))


SQL_CLOSE = f"WITH {_SQL_PLACED} SELECT a.id, count(b.id) AS n FROM placed a LEFT JOIN placed b ON a.id <> b.id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + 36 <= 150000 GROUP BY a.id"


def q_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The node under a place of the layout."""
    p = _placed(spark, d).withColumn("radius", V.node_radius(F.col("type"), F.col("degree")))
    return V.nearest(p, 150.0, 30.0, reach=40.0).select("id", F.round("dist", 4).alias("dist"))


SQL_NEAREST = f"""WITH {_SQL_PLACED}, n AS (SELECT id, sqrt(pow(x - 150, 2) + pow(y - 30, 2)) AS dist, radius FROM placed)
SELECT id, round(dist, 4) AS dist FROM n WHERE dist < radius + 40 ORDER BY n.dist, id LIMIT 1"""


def q_force_step(spark: SparkSession, d: str) -> DataFrame:
    """The first step of the layout for all nodes, from their homes."""
    e = _graph(spark, d)[1]
    p = stored(_placed(spark, d))
    state = p.select("id", "type", "degree", F.col("x").alias("home_x"), F.col("y").alias("home_y"), "x", "y", F.lit(0.0).alias("vx"), F.lit(0.0).alias("vy"))
    return V.force_step(state, e, 1.0).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


SQL_FORCE = f"""WITH {_SQL_PLACED}, v AS (SELECT * FROM placed),
pairs AS (SELECT a.id, a.x - b.x AS dx, a.y - b.y AS dy, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + 36 AS d2, a.radius + b.radius + 16 AS near FROM v a JOIN v b ON a.id <> b.id AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + 36 <= 150000),
push AS (SELECT id, dx / sqrt(d2) * f AS fx, dy / sqrt(d2) * f AS fy FROM (SELECT *, least(0.72::DOUBLE, 2100 / d2) + CASE WHEN sqrt(d2) < near THEN (near - sqrt(d2)) * 0.052::DOUBLE ELSE 0 END AS f FROM pairs)),
e1 AS (SELECT e.source, e.target, b.x - a.x AS dx, b.y - a.y AS dy, CASE WHEN pow(b.x - a.x, 2) + pow(b.y - a.y, 2) = 0 THEN 1 ELSE sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) END AS d,
  CASE relation WHEN 'contains_record' THEN 280 WHEN 'supported_by' THEN 170 ELSE 132 END AS want, CASE relation WHEN 'contains_record' THEN 0.0012::DOUBLE ELSE 0.0038::DOUBLE END AS k FROM edges e JOIN v a ON a.id = e.source JOIN v b ON b.id = e.target),
f AS (SELECT id, sum(fx) AS fx, sum(fy) AS fy FROM (SELECT * FROM push UNION ALL SELECT source, dx / d * (d - want) * k, dy / d * (d - want) * k FROM e1 UNION ALL SELECT target, -dx / d * (d - want) * k, -dy / d * (d - want) * k FROM e1) GROUP BY id),
s AS (SELECT v.id, x, y, coalesce(fx, 0) * 0.78::DOUBLE AS vx, coalesce(fy, 0) * 0.78::DOUBLE AS vy FROM v LEFT JOIN f ON f.id = v.id),
t AS (SELECT *, CASE WHEN sqrt(vx * vx + vy * vy) > 18 THEN 18 / sqrt(vx * vx + vy * vy) ELSE 1 END AS slow FROM s)
SELECT id, round(x + vx * slow, 3) AS x, round(y + vy * slow, 3) AS y FROM t"""


def _checks(spark: SparkSession, d: str) -> DataFrame:
    r = stored(record_layers(spark, d))
    return K.checks(r, stored(G.nodes(r)), stored(G.edges(r)), q_ocr_jobs(spark, d))


def q_validate(spark: SparkSession, d: str) -> DataFrame:
    """All checks of the finished graph with their failures."""
    return _checks(spark, d)


def q_verdict(spark: SparkSession, d: str) -> DataFrame:
    """The result of all checks in one row."""
    return K.verdict_row(_checks(spark, d))


SQL_CHECKS = f"""{SQL_FULL}, {SQL_BEST_IMAGE}, checks AS (SELECT 'edge_source_exists' AS check_name, count(*) AS failures FROM edges WHERE source NOT IN (SELECT id FROM nodes)
UNION ALL SELECT 'edge_target_exists', count(*) FROM edges WHERE target NOT IN (SELECT id FROM nodes)
UNION ALL SELECT 'node_id_unique', count(*) FROM (SELECT id FROM nodes GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'record_has_title', count(*) FROM records WHERE coalesce(title, '') = ''
UNION ALL SELECT 'records_not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM records UNION ALL SELECT 'pdf_records_not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM records WHERE kind = 'PDF'
UNION ALL SELECT 'record_count_matches', abs((SELECT count(*) FROM records) - (SELECT count(*) FROM nodes WHERE type = 'record'))
UNION ALL SELECT 'pdf_has_readable_path', count(*) FROM layered WHERE kind = 'PDF' AND readable_doc_path = ''
UNION ALL SELECT 'image_is_recognised', count(*) FROM (SELECT DISTINCT record_id, page FROM final_pages p WHERE record_id IS NOT NULL AND page IS NOT NULL AND coalesce(embedded_text_chars, 0) <= 20
  AND EXISTS (SELECT 1 FROM best i WHERE i.record_id = p.record_id AND i.page = p.page) AND NOT EXISTS (SELECT 1 FROM ocr_pages o WHERE o.record_id = p.record_id AND o.page = p.page AND o.status = 'ok'))
""" + " ".join(f"UNION ALL SELECT 'connects_{r}', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM edges WHERE relation = '{r}'" for r in K.MUST_CONNECT) + ")"
SQL_VALIDATE = f"WITH {SQL_CHECKS} SELECT check_name, CAST(failures AS BIGINT) AS failures FROM checks"
SQL_VERDICT = f"""WITH {SQL_CHECKS} SELECT CASE WHEN max(failures) > 0 THEN 'failed' ELSE 'ok' END AS status, coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE failures > 0), '') AS failed_checks, CAST(sum(failures) AS BIGINT) AS failures FROM checks"""


def q_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels as they are shown: cut, with bars as slashes (all, and the first), names in words."""
    n = _graph(spark, d)[0].where("label is not null")
    return n.select("id", T.clamp(F.col("description"), 180).alias("note"), T.clamp(F.col("label"), 96).alias("short"), T.spaced_label(F.col("label")).alias("all_bars"), T.spaced_label_once(F.col("label")).alias("first_bar"), T.humanized(F.col("type")).alias("kind_name"))


_CLAMP = "CASE WHEN length({v}) <= {n} THEN {v} ELSE rtrim(left({v}, {n} - 1)) || '...' END"


def _sql_clamp(e: str, n: int) -> str:
    return _CLAMP.format(v=f"trim(regexp_replace(coalesce({e}, ''), '[{WS}]+', ' ', 'g'))", n=n)


SQL_LABELS = f"""WITH {SQL_GRAPH} SELECT id, {_sql_clamp('description', 180)} AS note, {_sql_clamp('label', 96)} AS short, replace(label, '|', ' / ') AS all_bars,
regexp_replace(label, '^([^|]*)\\|', '\\1 / ') AS first_bar, upper(left(type, 1)) || type[2:] AS kind_name FROM nodes WHERE label IS NOT NULL"""

PAIRS: dict[str, tuple] = {
    "q_manifest_ids": (q_manifest_ids, SQL_IDS),
    "q_slugify": (q_slugify, SQL_SLUGS),
    "q_safe_names": (q_safe_names, SQL_SAFE),
    "q_url_basename": (q_url_basename, SQL_BASENAME),
    "q_repair_url": (q_repair_url, SQL_REPAIR),
    "q_quote_url": (q_quote_url, SQL_QUOTE),
    "q_kind_counts": (q_kind_counts, f"WITH {SQL_RECORDS} SELECT kind, count(*) AS n, count(repair) AS repaired, count(warning) AS warned FROM records GROUP BY kind"),
    "q_distinct_files": (q_distinct_files, f"WITH {SQL_RECORDS} SELECT kind, count(*) AS n, count(DISTINCT local_path) AS files FROM records WHERE local_path <> '' GROUP BY kind"),
    "q_download_all": (q_download_all, f"WITH {SQL_RECORDS} SELECT id, kind, source_url, local_path FROM records WHERE kind IN ('PDF', 'IMG') AND coalesce(source_url, '') <> '' AND coalesce(local_path, '') <> ''"),
    "q_agencies": (q_agencies, f"WITH {SQL_RECORDS} SELECT agency, count(*) AS n FROM records WHERE agency IS NOT NULL AND agency <> '' AND upper(agency) <> 'N/A' GROUP BY agency"),
    "q_record_layers": (q_record_layers, f"WITH {SQL_LAYERED} SELECT id, {_LAYERS} FROM layered"),
    "q_layer_totals": (q_layer_totals, f"WITH {SQL_LAYERED} SELECT kind, extraction_status, count(*) AS n, CAST(sum(page_count) AS BIGINT) AS pages, CAST(sum(final_text_chars) AS BIGINT) AS final_text_chars, CAST(sum(image_count) AS BIGINT) AS images FROM layered GROUP BY kind, extraction_status"),
    "q_doc_headers": (q_doc_headers, SQL_HEADERS),
    "q_graph_nodes": (q_graph_nodes, f"WITH {SQL_FULL} SELECT n.* REPLACE (coalesce(record_count, 0) AS record_count), {_LAYERS} FROM nodes n LEFT JOIN layered l ON n.id = 'record:' || l.id"),
    "q_graph_edges": (q_graph_edges, f"WITH {SQL_GRAPH} SELECT source, target, relation FROM edges"),
    "q_event_index": (q_event_index, f"WITH {SQL_GRAPH} SELECT id, label, coalesce(nullif(incident_date, ''), 'N/A') AS incident_date, coalesce(nullif(incident_location, ''), 'N/A') AS incident_location, record_count FROM nodes WHERE type = 'event'"),
    "q_graph_metadata": (q_graph_metadata, f"WITH {SQL_GRAPH} SELECT (SELECT count(*) FROM records) AS record_count, (SELECT count(*) FROM nodes) AS node_count, (SELECT count(*) FROM edges) AS edge_count"),
    "q_degree": (q_degree, f"WITH {SQL_GRAPH} SELECT id, degree FROM degrees"),
    "q_top_nodes": (q_top_nodes, f"WITH {SQL_GRAPH} SELECT t.id, n.type, n.label, t.degree FROM (SELECT * FROM degrees ORDER BY degree DESC, first_ord, first_place LIMIT 18) t JOIN nodes n ON n.id = t.id"),
    "q_top_events": (q_top_events, f"WITH {SQL_GRAPH} SELECT t.id, replace(n.label, '|', ' / ') AS label, t.records FROM (SELECT source AS id, count(DISTINCT target) AS records FROM edges WHERE relation = 'supported_by' GROUP BY source ORDER BY records DESC, id LIMIT 10) t JOIN nodes n ON n.id = t.id"),
    "q_type_counts": (q_type_counts, f"WITH {SQL_GRAPH} SELECT type, count(*) AS n FROM nodes GROUP BY type"),
    "q_relation_counts": (q_relation_counts, f"WITH {SQL_GRAPH} SELECT relation, count(*) AS n FROM edges GROUP BY relation"),
    "q_agency_bars": (q_agency_bars, f"WITH {SQL_GRAPH}, b AS (SELECT agency, count(*) AS n FROM nodes WHERE type = 'record' AND coalesce(agency, '') <> '' GROUP BY agency) SELECT agency, n, round(greatest(4.0::DOUBLE, n::DOUBLE / (SELECT max(n) FROM b) * 100), 6) AS width FROM b"),
    "q_neighbors": (q_neighbors, f"WITH {SQL_GRAPH}, o AS (SELECT source AS id, target AS other, relation FROM edges UNION ALL SELECT target, source, relation FROM edges) SELECT o.id, o.relation, n.type, count(*) AS n FROM o JOIN nodes a ON a.id = o.id AND a.type IN ('agency', 'event') JOIN nodes n ON n.id = o.other GROUP BY o.id, o.relation, n.type"),
    "q_search_nodes": (q_search_nodes, f"WITH {SQL_GRAPH} SELECT id, type FROM nodes WHERE contains(lower(concat_ws(chr(1), id, label, type, kind, agency, incident_date, incident_location, description)), 'lake')"),
    "q_visible_edges": (q_visible_edges, f"WITH {SQL_GRAPH}, v AS (SELECT n.id FROM nodes n JOIN degrees d ON d.id = n.id WHERE n.type IN ('record', 'event') AND d.degree >= 3 AND contains(lower(concat_ws(chr(1), n.id, label, type, kind, agency, incident_date, incident_location, description)), 'valley')) SELECT source, target, relation FROM edges WHERE relation = 'supported_by' AND source IN (SELECT id FROM v) AND target IN (SELECT id FROM v)"),
    "q_highlight": (q_highlight, f"WITH {SQL_GRAPH}, l AS (SELECT id FROM nodes WHERE type = 'location') SELECT target AS id FROM edges WHERE source IN (SELECT id FROM l) UNION SELECT source FROM edges WHERE target IN (SELECT id FROM l)"),
    "q_dangling_edges": (q_dangling_edges, f"WITH {SQL_GRAPH}, x AS (SELECT id FROM nodes WHERE type <> 'date') SELECT relation, count(*) AS n FROM edges WHERE source IN (SELECT id FROM x) AND target IN (SELECT id FROM x) GROUP BY relation"),
    "q_layout_rank": (q_layout_rank, f"WITH {_SQL_RANKED} SELECT id, type, layout_index, layout_count FROM ranked"),
    "q_anchor_layout": (q_anchor_layout, f"WITH {_SQL_PLACED} SELECT id, round(x, 3) AS x, round(y, 3) AS y, round(radius, 6) AS radius, round(greatest(2.8::DOUBLE, radius * pow(0.5::DOUBLE, 0.82::DOUBLE)), 6) AS screen_radius FROM placed"),
    "q_spiral": (q_spiral, SQL_SPIRAL),
    "q_viewport": (q_viewport, SQL_VIEWPORT),
    "q_force_step": (q_force_step, SQL_FORCE),
    "q_close_counts": (q_close_counts, SQL_CLOSE),
    "q_nearest": (q_nearest, SQL_NEAREST),
    "q_validate": (q_validate, SQL_VALIDATE),
    "q_verdict": (q_verdict, SQL_VERDICT),
    "q_event_order": (q_event_order, SQL_EVENT_ORDER),
    "q_node_order": (q_node_order, f"WITH {SQL_GRAPH} SELECT row_number() OVER (ORDER BY id) AS ordinal, id, type FROM nodes"),
    "q_relation_order": (q_relation_order, SQL_RELATION_ORDER),
    "q_preset_counts": (q_preset_counts, SQL_PRESETS),
    "q_top_neighbours": (q_top_neighbours, SQL_TOP_NEIGHBOURS),
    "q_fetch_missing": (q_fetch_missing, f"WITH {SQL_RECORDS}, f AS (SELECT r.local_path FROM records r JOIN documents x ON x.record_id = r.id WHERE x.n_chars >= 1 AND r.local_path IS NOT NULL) SELECT id, local_path FROM records WHERE kind IN ('PDF', 'IMG') AND coalesce(source_url, '') <> '' AND coalesce(local_path, '') <> '' AND local_path NOT IN (SELECT local_path FROM f)"),
    "q_thumbnails": (q_thumbnails, f"WITH {SQL_RECORDS} SELECT id, regexp_extract(thumbnail_url, '([^/]+)/*$', 1) AS name FROM records WHERE regexp_extract(thumbnail_url, '([^/]+)/*$', 1) <> ''"),
    "q_sorted_files": (q_sorted_files, f"WITH {SQL_RECORDS} SELECT row_number() OVER (ORDER BY local_path) AS ordinal, local_path FROM (SELECT DISTINCT local_path FROM records WHERE local_path <> '')"),
    "q_io_jsonl": (q_io_jsonl, f"WITH {SQL_RECORDS} SELECT {', '.join(_ROUND)} FROM records"),
    "q_io_csv": (q_io_csv, f"WITH {SQL_RECORDS} SELECT id, kind, title, CAST(redaction AS VARCHAR) AS redaction, CASE WHEN kind <> 'PDF' THEN source_url END AS source_url FROM records"),
    "q_io_release": (q_io_release, SQL_IO_RELEASE),
    "q_io_lines": (q_io_lines, f"WITH {SQL_RECORDS} SELECT source_url, count(*) AS n FROM records WHERE source_url <> '' GROUP BY source_url"),
    "q_io_split": (q_io_split, f"WITH {SQL_RECORDS} SELECT {', '.join(_ROUND)} FROM records WHERE kind IS NOT NULL"),
    "q_io_texts": (q_io_texts, "SELECT DISTINCT record_id, page, md5(CASE WHEN coalesce(final_text, '') = '' THEN '' ELSE final_text || chr(10) END) AS text_md5 FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL"),
    "q_io_tables": (q_io_tables, "WITH p AS (SELECT DISTINCT record_id, page, source FROM final_pages WHERE record_id IS NOT NULL AND page IS NOT NULL) SELECT 'pages' AS name, count(*) AS n FROM p UNION ALL SELECT 'embedded', count(*) FROM p WHERE source LIKE 'embedded%' UNION ALL SELECT 'records', count(DISTINCT record_id) FROM p"),
    "q_labels": (q_labels, SQL_LABELS),
}
