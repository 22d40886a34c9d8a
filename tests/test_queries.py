"""Every core query with SQL gives what the SQL gives, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from corpusgraph.plans import catalog

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for p in Path(D).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: "NULL" if v is None or isinstance(v, float) and math.isnan(v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows), sorted(names)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, sql, name):
    df = catalog.QUERIES[name](spark, D)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    r = sql.execute(catalog.ORACLES[name])
    names = [x[0] for x in r.description]
    assert got == plain(r.fetchall(), names)


def test_partition_of_chunks(spark):
    a = catalog.QUERIES["q_rag_partition"](spark, D).collect()
    assert sum(r["chunks"] for r in a) == catalog.QUERIES["q_chunk_ids"](spark, D).count()


@pytest.mark.parametrize("name", ["q_clean_page", "q_cleaning_actions", "q_curated_pages", "q_curated_chunks", "q_normalize", "q_canonical_line"])
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, D).count() > 0


def unchanged(spark):
    """Keys of pages in records of which NFKC changes no page."""
    import unicodedata

    from corpusgraph.plans import corpus_queries

    rows = corpus_queries.page_rows(spark, D).select("record_id", "page", "final_text").collect()
    other = {r["record_id"] for r in rows if unicodedata.normalize("NFKC", r["final_text"] or "") != (r["final_text"] or "")}
    return {(r["record_id"], r["page"]) for r in rows if r["record_id"] not in other}, {(r["record_id"], r["page"]) for r in rows}


@pytest.mark.parametrize("name,stored", [("q_normalize", "q_tidy"), ("q_clean_page", "q_clean_stored"), ("q_cleaning_actions", "q_clean_stored"), ("q_curated_pages", "q_curated_stored")])
def test_compatible_form_agrees_with_the_stored_one(spark, name, stored):
    """Queries without SQL give what those with SQL give wherever NFKC has nothing to do."""
    same, every = unchanged(spark)
    a, b = catalog.QUERIES[name](spark, D), catalog.QUERIES[stored](spark, D)
    cols = [c for c in a.columns if c in b.columns]
    one, two = ({(r["record_id"], r["page"]): tuple(r) for r in df.select(*cols).collect()} for df in (a, b))
    assert set(one) == set(two) == every
    assert len(cols) > 2
    assert same
    assert all(one[k] == two[k] for k in same)


def test_every_query_without_sql_is_named(spark):
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"q_clean_page", "q_cleaning_actions", "q_curated_pages", "q_curated_chunks", "q_normalize", "q_canonical_line"}
