import json
import struct
import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from corpusgraph.operators import curate as K
from corpusgraph.operators import ocrplan as O
from corpusgraph.operators import validate as W
from corpusgraph.sources import io, reports


def png(width, height):
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = b"".join(b"\0" + b"\x40\x80\xc0" * width for _ in range(height))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def test_json_document_and_results(spark, tmp_path):
    p = tmp_path / "r.json"
    p.write_text(json.dumps({"generated_at": "2026-05-08T00:00:00Z", "results": [{"id": "a", "status": "downloaded", "bytes": 3, "path": "x"}, {"id": "b", "status": "error", "error": "no"}]}, indent=1))
    assert io.read_json(spark, str(p)).count() == 1
    report = io.read_download_results(spark, str(p))
    assert {(r["id"], r["status"]) for r in report.collect()} == {("a", "downloaded"), ("b", "error")}
    q = tmp_path / "flat.jsonl"
    q.write_text(json.dumps({"record_id": "c", "status": "failed", "path": "y"}) + "\n\n" + json.dumps({"record_id": "d", "status": "exists", "bytes": 1, "http_status": 200}) + "\n")
    flat = io.read_http_results(spark, str(q))
    assert {(r["id"], r["status"]) for r in io.all_download_results(report, flat).collect()} == {("a", "downloaded"), ("b", "error"), ("c", "error"), ("d", "exists")}
    assert io.read_http_results(spark, str(tmp_path / "none")).count() == 0


def test_absent_files_are_told_from_other_errors(spark, tmp_path):
    with pytest.raises(AnalysisException):
        io.read_jsonl(spark, str(tmp_path / "none"), "a string", optional=False)
    assert io.read_jsonl(spark, str(tmp_path / "none"), "a string").count() == 0


def test_texts_and_binary(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b" caf\xc3\xa9 \xff\n")
    assert io.read_texts(spark, str(tmp_path)).first()["text"] == " café \ufffd\n"
    assert io.read_texts(spark, str(tmp_path), stripped=True).first()["text"] == "café \ufffd"
    r = io.read_binary(spark, str(tmp_path)).first()
    assert (r["length"], bytes(r["content"])) == (9, b" caf\xc3\xa9 \xff\n")


def test_images_are_decoded(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png(5, 3))
    (tmp_path / "b.png").write_bytes(b"no image")
    got = {r["path"].rsplit("/", 1)[-1]: (r["width"], r["height"], r["channels"]) for r in io.read_images(spark, str(tmp_path)).collect()}
    assert got["a.png"] == (5, 3, 3)
    assert got["b.png"][:2] == (-1, -1)


def test_listing_is_sorted(spark, tmp_path):
    for n in ("b/2.txt", "a/9.txt", "b/1.txt", "c.png"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text("x" * 3)
    got = [(r["path"].split(str(tmp_path))[-1], r["bytes"]) for r in io.listing(spark, str(tmp_path), "*.txt").collect()]
    assert got == [("/a/9.txt", 3), ("/b/1.txt", 3), ("/b/2.txt", 3)]


def test_csv_of_several_tables(spark, tmp_path):
    a = spark.createDataFrame([(1, 'x "q"\ny')], "id int, b string")
    b = spark.createDataFrame([(2, "z", 3)], "id int, zz string, aa int")
    io.write_csv([a, b], str(tmp_path / "o"))
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "o"))
    assert df.columns == ["id", "b", "aa", "zz"]
    assert {(r["id"], r["b"], r["zz"]) for r in df.collect()} == {("1", 'x "q"\ny', None), ("2", None, "z")}


def test_lines_keep_repeats_and_drop_blanks(spark, tmp_path):
    io.write_lines(spark.createDataFrame([("u",), ("u",), ("",), (None,)], "u string"), "u", str(tmp_path / "o"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "o")).collect()) == ["u", "u"]


def test_page_texts_end_in_a_line_break(spark, tmp_path):
    io.write_page_texts(spark.createDataFrame([("r", 1, "a"), ("r", 2, ""), ("s", 1, None)], "record_id string, page int, text string"), str(tmp_path / "o"))
    got = {(r["record_id"], r["page"]): r["text"] for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {("r", 1): "a\n", ("r", 2): "", ("s", 1): ""}


def test_several_tables_from_one_pass(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(10).repartition(2).mapInPandas(count, "id bigint")
    io.write_tables(df, {"all": lambda x: x, "even": lambda x: x.where("id % 2 = 0")}, str(tmp_path / "o"))
    assert seen.value == 10
    assert spark.read.json(str(tmp_path / "o/even")).count() == 5


def test_graph_file_and_page(spark, tmp_path):
    n = spark.createDataFrame([("b", "record", "B </script>"), ("a", "agency", None)], "id string, type string, label string")
    e = spark.createDataFrame([("b", "a", "from_agency", "r1", 1), ("x", "b", "contains_record", "r1", 0)], "source string, target string, relation string, ord string, place int")
    io.graph_json(n, e, {"node_count": 2}, str(tmp_path / "g.json"))
    g = json.loads((tmp_path / "g.json").read_text())
    assert [x["id"] for x in g["nodes"]] == ["a", "b"]
    assert [x["relation"] for x in g["edges"]] == ["contains_record", "from_agency"]
    io.graph_json(n.limit(0), e.limit(0), {}, str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == {"metadata": {}, "nodes": [], "edges": []}
    io.graph_html(g, {"types": {"record": 1}}, "2 nodes & more", str(tmp_path / "g.html"))
    page = (tmp_path / "g.html").read_text()
    assert "2 nodes &amp; more" in page
    assert page.count("</script>") == 3
    body = page.split('id="graph">')[1].split("</script>")[0]
    assert json.loads(body) == g


def test_reports(spark, tmp_path):
    r = spark.createDataFrame([("r2", "PDF", "T", None, "w", "u"), ("r1", "PDF", "S", "fixed", None, "v"), ("r3", "VID", None, None, None, None)], "id string, kind string, title string, repair string, warning string, source_url string")
    lines = reports.manifest(r, "A release", "data/source.csv")
    assert lines[:2] == ["# A release", ""]
    assert "- PDF records: 2" in lines
    assert "- Image records: 0" in lines
    assert lines[-5:] == ["- `r1` `S`: fixed -> v", "", "## Warnings", "- `r2` `T`: w -> u"][-5:] or lines[-1] == "- `r2` `T`: w -> u"
    pages = spark.createDataFrame([("r", 1, 2, 3, 5), ("r", 2, 0, 1, 1)], "record_id string, page int, embedded_text_chars int, ocr_text_chars int, final_text_chars int")
    assert reports.final_text(pages)[2:] == ["- Pages: 2", "- Documents: 1", "- Embedded text characters: 2", "- OCR text characters: 4", "- Final text characters: 6"]
    assert reports.recognition(pages)[2:] == ["- OCR page rows: 2", "- OCR document rows: 1", "- OCR text characters: 4"]
    assert reports.recognition(pages.limit(0))[-1] == "- OCR text characters: 0"
    reports.save(lines, str(tmp_path / "m.md"))
    assert (tmp_path / "m.md").read_text().endswith("\n")
    n = spark.createDataFrame([("event:b", "event", "B", "1969", "", 2), ("event:a", "event", "A", None, "Moon", 1), ("x", "date", "C", None, None, None)], "id string, type string, label string, incident_date string, incident_location string, record_count int")
    reports.write_events(n, str(tmp_path / "events"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "events").glob("part-*")))
    assert text.index("## A") < text.index("## B")
    assert "- Incident location: N/A\n- Record count: 2" in text


def test_extraction_tables(spark):
    def extract(path, content):
        if content == b"bad":
            raise ValueError("broken")
        images = [{"width": 2, "height": 3, "extension": "png", "path": f"{path}-{i}"} for i in range(2)]
        return [{"text": content.decode(), "images": images}, {"text": None, "images": [{"path": "z", "status": "extract_error", "error": "e"}]}]

    files = spark.createDataFrame([("a", b"hello"), ("b", b"bad")], "path string, content binary")
    pages = O.run_extractor(files, extract)
    p = {(r["path"], r["page"]): (r["text_chars"], r["embedded_image_count"], r["image_paths"]) for r in O.extracted_pages(pages).collect()}
    assert p == {("a", 1): (5, 2, ["a-0", "a-1"]), ("a", 2): (0, 1, [])}
    i = [(r["file"], r["page"], r["image_index"], r["status"]) for r in O.extracted_images(pages).orderBy("page", "image_index").collect()]
    assert i == [("a", 1, 1, "ok"), ("a", 1, 2, "ok"), ("a", 2, 1, "extract_error")]
    d = {r["path"]: (r["page_count"], r["text_chars"], r["image_count"], r["status"], r["error"]) for r in O.extracted_documents(pages).collect()}
    assert d == {"a": (2, 5, 3, "ok", None), "b": (0, 0, 0, "open_error", "broken")}
    assert O.extracted_images(O.run_extractor(files.limit(0), extract)).count() == 0


def test_last_job_of_a_path_gets_the_result(spark):
    jobs = spark.createDataFrame([("p", "r", 1, 1), ("p", "s", 2, 5), (None, "t", 1, 6)], "image_path string, record_id string, page int, ordinal int")
    results = spark.createDataFrame([("p", "ok"), ("q", "ok"), (None, "ok")], "image_path string, status string")
    assert [(r["image_path"], r["record_id"], r["page"]) for r in O.matched(results, jobs).collect()] == [("p", "s", 2)]


def test_resuming_by_files_and_artifacts(spark):
    wanted = spark.createDataFrame([("a", "pa"), ("b", "pb"), ("c", "pc")], "id string, path string")
    files = spark.createDataFrame([("pa", 3), ("pb", 0)], "path string, bytes int")
    assert {r["id"] for r in O.not_fetched(wanted, files, "path").collect()} == {"b", "c"}
    assert {r["id"] for r in O.not_fetched(wanted, files, "path", least_bytes=0).collect()} == {"c"}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    got = {r["id"]: r["reused"] for r in O.reused(ids("a", "b", "c"), ids("a", "a", "b"), ids("a", "c")).collect()}
    assert got == {"a": True, "b": False, "c": False}
    assert not any(r["reused"] for r in O.reused(ids("a"), ids("a"), ids("a"), force=True).collect())


def test_image_confidence(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 1.0), ("a", float("nan")), ("b", None)], "path string, confidence double")
    assert {r["path"]: r["confidence"] for r in O.image_confidence(df).collect()} == {"a": 0.75, "b": 0.0}


def test_render_needed(spark):
    df = spark.createDataFrame([(0, 0), (None, None), (1, 0), (0, 2)], "t int, i int")
    assert [r[0] for r in df.select(O.render_needed(True, F.col("t"), F.col("i"))).collect()] == [True, True, False, False]
    assert not any(r[0] for r in df.select(O.render_needed(False, F.col("t"), F.col("i"))).collect())


def test_curated_documents(spark):
    c = spark.createDataFrame([("r", "clean", 5, 4), ("r", "clean", 5, 4), ("r", "empty", 0, 0), ("s s", "clean", 1, 1)], "record_id string, quality string, raw_text_chars bigint, clean_text_chars bigint")
    got = {r["record_id"]: r for r in K.curated_documents(c, spark.createDataFrame([("r", "Title"), ("x", "No")], "id string, title string")).collect()}
    assert (got["r"]["title"], got["r"]["pages"], got["r"]["quality_counts"], got["r"]["clean_text_chars"]) == ("Title", 3, {"clean": 2, "empty": 1}, 8)
    assert got["s s"]["title"] == "s s"
    assert got["s s"]["readable_doc_path"].endswith("/s-s.md")


def test_gate(spark, tmp_path):
    rec = spark.createDataFrame([("r1", "PDF", "T"), ("r2", "IMG", "")], "id string, kind string, title string")
    nodes = spark.createDataFrame([("record:r1", "record", "PDF", ""), ("record:r2", "record", "IMG", None), ("a", "agency", None, None), ("a", "agency", None, None)], "id string, type string, kind string, readable_doc_path string")
    edges = spark.createDataFrame([("record:r1", "a", "from_agency"), ("record:r1", "gone", "incident_date")], "source string, target string, relation string")
    got = {r["check_name"]: r["failures"] for r in W.checks(rec, nodes, edges).collect()}
    assert got["edge_target_exists"] == got["node_id_unique"] == got["record_has_title"] == got["pdf_has_readable_path"] == got["connects_supported_by"] == 1
    assert got["edge_source_exists"] == got["record_count_matches"] == got["records_not_empty"] == got["connects_from_agency"] == 0
    assert W.verdict_row(W.checks(rec, nodes, edges)).first()["status"] == "failed"
    empty = {r["check_name"]: r["failures"] for r in W.checks(rec.limit(0), nodes.limit(0), edges.limit(0)).collect()}
    assert empty["records_not_empty"] == empty["pdf_records_not_empty"] == 1
    assert W.verdict(W.checks(rec, nodes, edges), ["w"])["warnings"] == ["w"]
    (tmp_path / "there").write_text("")
    assert W.missing_paths(str(tmp_path), ["there", "not/there"]) == ["not/there"]
    assert "chunk_id" in W.missing_columns(rec)
