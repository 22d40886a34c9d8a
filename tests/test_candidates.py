from corpusgraph.operators import manifest as R
from corpusgraph.plans import catalog


def test_download_candidates_have_no_limit_unless_asked(spark):
    rows = [(f"r{i:03d}", "PDF" if i % 2 else "IMG", "u", "p") for i in range(150)] + [("s", "PDF", None, "p"), ("t", "PDF", "u", ""), ("v", "VID", "u", "p")]
    df = spark.createDataFrame(rows, "id string, kind string, source_url string, local_path string")
    assert {r["id"] for r in R.download_candidates(df).collect()} == {f"r{i:03d}" for i in range(150)}
    assert [r["id"] for r in R.download_candidates(df, 2).collect()] == ["r000", "r001"]
    assert "q_download_all" in catalog.QUERIES
