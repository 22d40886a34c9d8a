import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.operators import chunks as C
from corpusgraph.operators import graph as G
from corpusgraph.operators import lines as L
from corpusgraph.operators import manifest as R
from corpusgraph.operators import merge as M
from corpusgraph.operators import ocrplan as O
from corpusgraph.operators import quality as Q
from corpusgraph.sources import io


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i bigint, text string")


def lengths(spark, t):
    return [len(x) for x in texts(spark, [t]).select(C.chunks(F.col("text"))).first()[0]]


@pytest.mark.parametrize("paragraphs,expected", [([1800], [1800]), ([1801], [1800, 181]), ([3400], [1800, 1780, 160]), ([1000, 798], [1800]), ([1000, 799], [1000, 799]), ([2000, 50], [1800, 380, 50])])
def test_chunk_lengths(spark, paragraphs, expected):
    assert lengths(spark, "\n\n".join("x" * n for n in paragraphs)) == expected


def without_overlaps(chunks, whole):
    """Whether the chunks cover the text in order: each starts where the last ended, behind a gap of blank lines, or within the last slice."""
    end = 0
    for c in chunks:
        at = whole.find(c, max(0, end - C.OVERLAP))
        if at < 0 or whole[end:at].strip():
            return False
        end = max(end, at + len(c))
    return not whole[end:].strip()


def test_chunks_of_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").select(T.strip(F.col("text")).alias("t"), C.chunks(F.col("text")).alias("c")).collect()
    for r in rows:
        assert all(0 < len(c) <= C.MAX_CHARS for c in r["c"])
        assert without_overlaps(r["c"], r["t"])
        # Neighbours that were not cut out of one paragraph could not have been one chunk.
        for a, b in zip(r["c"], r["c"][1:]):
            if f"{a}\n\n{b}" in r["t"] and len(a) < C.MAX_CHARS:
                assert len(a) + 2 + len(b) > C.MAX_CHARS or any(len(p) > C.MAX_CHARS and a[-40:] in p for p in r["t"].split("\n\n"))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 4000), min_size=1, max_size=6))
def test_chunks_fit(spark, sizes):
    got = lengths(spark, "\n\n".join("y" * n for n in sizes))
    assert max(got) <= 1800
    assert sum(got) >= sum(sizes)


def folded(spark, t, repeated=()):
    df = texts(spark, [t]).withColumn("rep", F.array(*map(F.lit, repeated)) if repeated else F.array().cast("array<string>"))
    r = df.select(L.folded(F.col("text"), F.col("rep")).alias("f")).first()["f"]
    return r["lines"], dict(zip(L.ACTIONS, r["n"]))


def test_adjacent_over_removed(spark):
    lines, n = folded(spark, "Alpha line here\n###\nalpha  line here")
    assert lines == ["Alpha line here"]
    assert (n["removed_artifact_lines"], n["removed_adjacent_duplicate_lines"]) == (1, 1)


def test_blank_resets(spark):
    assert folded(spark, "Alpha line here\n\nAlpha line here")[0] == ["Alpha line here", "", "Alpha line here"]


def test_hyphens(spark):
    lines, n = folded(spark, "inter-\nnational law")
    assert lines == ["international law"]
    assert n["repaired_hyphenated_line_breaks"] == 1
    assert folded(spark, "inter-\nx")[0] == ["interx"]
    assert folded(spark, "inter-\nNational law")[0] == ["inter-", "National law"]


def test_repeated_removed(spark):
    lines, n = folded(spark, "Page 3\nSome line of text", ["page 3"])
    assert lines == ["Some line of text"]
    assert n["removed_repeated_boilerplate_lines"] == 1


def test_repeated_counts_pages_once(spark):
    pages = spark.createDataFrame([("r", p, "PAGE 1 OF REPORT\nPAGE 1 OF REPORT\nbody") for p in (1, 2)], "record_id string, page bigint, text string")
    assert L.repeated_lines(pages).count() == 0
    pages = spark.createDataFrame([("r", p, "PAGE 1 OF REPORT\nbody") for p in (1, 2, 3)], "record_id string, page bigint, text string")
    assert [r["n_pages"] for r in L.repeated_lines(pages).collect()] == [3]


def test_cleaned_has_no_wide_gaps(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/final_pages.parquet").dropDuplicates(["record_id", "page"]).withColumn("text", T.normalize(F.coalesce("final_text", F.lit(""))))
    rows = L.cleaned(df).select("clean_text").collect()
    assert rows
    assert not any("\n\n\n" in r[0] for r in rows)


@pytest.mark.parametrize(
    "raw,kept,removed,stats,expected",
    [
        (0, 10, 0, (0.9, 2, 60), "empty"),
        (1000, 400, 0, (0.9, 2, 60), "aggressive_cleanup"),
        (1000, 400, 41, (0.9, 2, 60), "needs_review"),
        (1000, 300, 0, (0.9, 0, 27), "needs_review"),
        (1000, 450, 0, (0.9, 2, 60), "clean"),
    ],
)
def test_quality(spark, raw, kept, removed, stats, expected):
    s = dict(zip(("natural_language_score", "sentence_like_blocks", "alpha_word_count"), map(F.lit, stats)))
    got = spark.range(1).select(Q.quality(F.lit(raw), F.lit(kept), F.lit(removed), s)).first()[0]
    assert got == expected


@pytest.mark.parametrize("e,o,source,n", [("", "", "empty", 0), ("a", "", "embedded", 1), ("", "b", "ocr", 1), ("abc", "b", "embedded", 3), ("abc", "x", "embedded+ocr", 12)])
def test_merge(spark, e, o, source, n):
    p = spark.createDataFrame([("r", 1, e)], "record_id string, page bigint, embedded string")
    q = spark.createDataFrame([("r", 1, o)], "record_id string, page bigint, ocr string")
    r = M.merged(p, q).first()
    assert (r["source"], r["final_text_chars"]) == (source, n)


def test_last_write(spark):
    log = spark.createDataFrame([("r", 1, "ok", "a", 1), ("r", 1, "error", "b", 2), ("r", 1, "ok", "c", 3), ("s", 1, "ok", "a", 1), ("s", 1, "error", "b", 2)], "record_id string, page bigint, status string, v string, ordinal bigint")
    assert {r["record_id"]: r["v"] for r in M.last_ok(log, ["record_id", "page"]).collect()} == {"r": "c", "s": "a"}


def test_best_image(spark):
    rows = [("r", 1, "a", None, 5, 1), ("r", 1, "b", 2, 3, 2), ("r", 1, "c", 3, 2, 3)]
    df = spark.createDataFrame(rows, "record_id string, page bigint, path string, width bigint, height bigint, ordinal bigint")
    r = O.best_image(df, ["record_id", "page"], "width", "height", ["ordinal"]).first()
    assert (r["path"], r["area"]) == ("b", 6)


def test_recognizer_batches(spark):
    def recognize(paths):
        if "bad" in paths:
            raise RuntimeError("no")
        return [{"path": p, "status": "ok", "text": p.upper(), "confidence": 1.0} for p in paths]

    df = spark.createDataFrame([("a",), ("bad",)], "path string").coalesce(1)
    got = {r["path"]: r["status"] for r in O.run_recognizer(df, "path", recognize, batch=1).collect()}
    assert got == {"a": "ok", "bad": "error"}


def test_degrees(spark):
    e = spark.createDataFrame([("a", "b", "x", "1", 0), ("b", "b", "x", "2", 0)], "source string, target string, relation string, ord string, place int")
    assert {r["id"]: r["degree"] for r in G.degrees(e).collect()} == {"a": 1, "b": 3}


def record(**kw):
    base = dict.fromkeys(("id", "release", "title", "kind", "agency", "incident_date", "incident_location", "source_url", "description", "pdf_pairing", "video_pairing"), "")
    return base | {"id": "r1", "release": "release_1", "title": "T"} | kw


def test_events(spark):
    rows = [record(id="r1", incident_date="n/a"), record(id="r2", incident_date="1969")]
    k = {r["id"]: (r["event_node"], r["event_label"]) for r in G.keyed(spark.createDataFrame(rows)).collect()}
    assert k == {"r1": ("event:record-r1", "T"), "r2": ("event:1969-n-a", "1969|N/A")}


def test_node_merge_takes_first_given(spark):
    rows = [record(id="r1", agency="FBI"), record(id="r2", agency="F.B.I"), record(id="r3", agency="fbi")]
    n = G.nodes(spark.createDataFrame(rows)).where("type = 'agency'").collect()
    assert {r["id"]: r["label"] for r in n} == {"agency:fbi": "FBI", "agency:f-b-i": "F.B.I"}


def test_graph_invariants(spark):
    r = spark.createDataFrame([record(id=f"r{i}", agency="A" * (i % 3), incident_date=str(i % 4)) for i in range(20)])
    n, e = G.nodes(r), G.edges(r)
    assert n.count() == n.select("id").distinct().count()
    assert G.degrees(e).agg(F.sum("degree")).first()[0] == 2 * e.count()


def test_ordinals(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(100)], "k string").repartition(7)
    got = R.with_ordinal(df, ["k"], tasks=5).orderBy("k").select("ordinal").collect()
    assert [r[0] for r in got] == list(range(1, 101))


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "record_id string, page bigint, text string")
    assert L.cleaned(pages).count() == 0
    assert C.chunked(texts(spark, []), "text").count() == 0
    assert C.chunked(spark.createDataFrame([(1, None), (2, "")], "i bigint, text string"), "text").count() == 0


def test_csv_source(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_bytes("﻿Type,Title,PDF | Image Link,Modal Image,PDF Pairing,Video Pairing,Release Date,Redaction,Agency,Incident Date,Incident Location,Description Blurb,DVIDS Video ID,Video Title\n"
                  'PDF,"A ""quoted""\ntitle",https://h/x,https://h/t/y.jpg,,,5/8/26,true,FBI,1969,Moon,Text,,\n'.encode())
    df = io.read_release_csv(spark, str(p))
    r = R.records_from_csv(df, "release_1", "release01", "https://h/base/").first()
    assert r["id"] == "release01-0001"
    assert r["title"] == 'A "quoted" title'
    assert r["source_url"] == "https://h/base/y.pdf"
    assert r["repair"].startswith("repaired_pdf_url_from_thumbnail:")
    assert r["redaction"] is True
    assert r["warning"] is None


def test_jsonl(spark, tmp_path):
    assert io.read_jsonl(spark, str(tmp_path / "none"), "a string").count() == 0
    io.write_jsonl(spark.createDataFrame([(1, None)], "b bigint, a string"), str(tmp_path / "o"))
    assert "".join(p.read_text() for p in (tmp_path / "o").glob("*.json")) == '{"b":1}\n'
    assert "</script>" not in io.embedded_json({"a": "</script>"})


def test_layout_cools_down(spark):
    from corpusgraph.operators import graphview as V

    rows = [(f"n{i}", "agency", 2, 10.0 * i, 0.0, 10.0 * i, 0.0, 0.0, 0.0) for i in range(4)]
    state = spark.createDataFrame(rows, "id string, type string, degree bigint, home_x double, home_y double, x double, y double, vx double, vy double")
    e = spark.createDataFrame([("n0", "n1", "from_agency")], "source string, target string, relation string")
    a = {r["id"]: (r["x"], r["y"]) for r in V.force_step(state, e, 1.0).collect()}
    assert a["n0"][0] < 0 < 30 < a["n3"][0]
    b = V.simulate(state, e, alpha=0.016, most_steps=50).collect()
    assert len(b) == 4
    assert all(abs(r["vx"]) <= 18 for r in b)


def test_close_pairs_against_brute_force(spark):
    import random

    from corpusgraph.operators import graphview as V

    rng = random.Random(1)
    pts = [(f"p{i:02d}", rng.uniform(-900, 900), rng.uniform(-900, 900)) for i in range(60)]
    got = {(r["id_a"], r["id_b"]) for r in V.close_pairs(spark.createDataFrame(pts, "id string, x double, y double")).collect()}
    assert got == {(a, b) for a, ax, ay in pts for b, bx, by in pts if a < b and (ax - bx) ** 2 + (ay - by) ** 2 + 36 <= 150000}
