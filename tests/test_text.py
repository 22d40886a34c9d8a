import pytest
from pyspark.sql import functions as F

from corpusgraph.functions import text as T
from corpusgraph.functions import urls as U
from tests import model


def one(spark, column, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {'bigint' if isinstance(v, int) else 'string'}" for i, v in enumerate(values)))
    return df.select(column(*(F.col(f"c{i}") for i in range(len(values))))).first()[0]


def test_normalize(spark):
    t = "ﬁle a­ b\x0bc\t\td"
    assert one(spark, T.normalize, t) == "file a b c d" == model.normalize(t)
    assert one(spark, lambda c: T.canonical(T.normalize(c)), "  SECRET\t\tNOTE ") == "secret note"


def test_normalize_on_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/final_pages.parquet").select("final_text").where("final_text is not null").distinct()
    for r in rows.select("final_text", T.normalize(F.col("final_text")).alias("n")).collect():
        assert r["n"] == model.normalize(r["final_text"])


@pytest.mark.parametrize("line,expected", [("-", True), ("--", True), ("###", True), ("a.....", True), ("aaaaaa", True), ("", False), ("##", False), ("aaaaa", False), ("Alpha", False)])
def test_artifact(spark, line, expected):
    assert one(spark, T.is_artifact, line) is expected


@pytest.mark.parametrize("line,expected", [("FBI", True), ("1947", True), ("ab", True), ("12:30", True), ("Abc", False), ("aaaaa", False), ("##", False), ("1950.x", False)])
def test_low_value(spark, line, expected):
    assert one(spark, T.is_low_value, line) is expected


def test_threshold(spark):
    pages = [1, 15, 16, 27, 28, 50, 100, 500]
    df = spark.createDataFrame([(p,) for p in pages], "p bigint").select("p", T.boilerplate_threshold(F.col("p")).alias("t"))
    assert {r["p"]: r["t"] for r in df.collect()} == dict(zip(pages, [3, 3, 4, 4, 5, 9, 18, 90]))


def test_node_ids(spark):
    assert one(spark, lambda c: T.node_id("agency", c), "N/A") == "agency:unknown"
    assert one(spark, lambda c: T.node_id("event", c), "1/24/85|Papua New Guinea") == "event:1-24-85-papua-new-guinea"
    assert one(spark, lambda c: T.node_id("x", c), "—") == "x:unknown"


def test_names(spark):
    assert one(spark, T.safe_filename, "a b/c") == "a-b-c"
    assert one(spark, T.safe_name, "é b") == "é_b"


def test_labels(spark):
    assert one(spark, T.spaced_label, "a|b|c") == "a / b / c"
    assert one(spark, T.spaced_label_once, "a|b|c") == "a / b|c"
    assert len(one(spark, lambda c: T.clamp(c, 20), "x" * 50)) == 22


@pytest.mark.parametrize(
    "url,title,kind,n,expected",
    [("https://h/p/serial%205.pdf?x=1", "T", "PDF", 1, "serial 5.pdf"), ("https://h/p/", "My Title", "IMG", 2, "my-title.jpg"), ("https://h/p/", "", "IMG", 7, "record-007.jpg"), ("https://h/a+b.pdf", "T", "PDF", 3, "a+b.pdf"), ("https://h/x%zz.pdf", "T", "PDF", 3, "x%zz.pdf")],
)
def test_basename(spark, url, title, kind, n, expected):
    assert one(spark, U.basename, url, title, kind, n) == expected


def test_quote(spark):
    assert one(spark, U.quoted, "https://h/a b/é.pdf?q=a b") == "https://h/a%20b/%C3%A9.pdf?q=a b"


def test_nulls(spark):
    df = spark.createDataFrame([(None,)], "c string")
    c = F.col("c")
    row = df.select(T.clean(c), T.node_id("a", c), T.is_boilerplate(c), T.normalize(c)).first()
    assert tuple(row) == ("", "a:unknown", None, None)


@pytest.mark.parametrize(
    "before,after,expected",
    [
        ("", "text of a line", False), ("text", "", False), ("THE HEADING", "goes on with more", False), ("it went on for a while", "NOTE: this is new", False),
        ("12", "goes on for a while here", False), ("it went on for a while", "- an item of a list", False), ("it went on for a while.", "then it stopped", False),
        ("it went on", "Then it stopped", False), ("it went on for a while", "then it stopped", True), ("it went on for a while", "Then it stopped at once", False),
        ("it went on for a while and for a good while longer", "Then it stopped at the gate of it", True), ("it went on for a while", "From the gate it went", False),
    ],
)
def test_lines_that_go_on(spark, before, after, expected):
    assert spark.range(1).select(T.joins(F.lit(before), F.lit(after))).first()[0] is expected
