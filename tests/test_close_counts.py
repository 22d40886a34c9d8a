import random

from corpusgraph.operators import graphview as V
from corpusgraph.plans import catalog
from corpusgraph.plans import graph_queries as Q

D = "/root/testdata/sf0.001"


def brute_force(pts):
    return {a: sum((ax - bx) ** 2 + (ay - by) ** 2 + 36 <= 150000 for _, bx, by in pts) - 1 for a, ax, ay in pts}


def test_close_counts_against_brute_force(spark):
    rng = random.Random(5)
    pts = [(f"p{i:04d}", rng.uniform(-900, 900), rng.uniform(-900, 900)) for i in range(700)]
    pts += [("far", 9000.0, -9000.0), ("same", pts[0][1], pts[0][2]), ("edge_a", -5000.0, 0.0), ("edge_b", -5000.0 + (150000 - 36) ** 0.5, 0.0)]
    got = {r["id"]: r["n"] for r in V.close_counts(spark.createDataFrame(pts, "id string, x double, y double")).collect()}
    assert got == brute_force(pts)
    assert V.close_counts(spark.createDataFrame([], "id string, x double, y double")).count() == 0


def test_all_nodes_of_the_layout(spark):
    pts = [(r["id"], r["x"], r["y"]) for r in Q._placed(spark, D).select("id", "x", "y").collect()]
    rows = catalog.QUERIES["q_close_counts"](spark, D).collect()
    assert len(rows) == len(pts)
    assert {r["id"]: r["n"] for r in rows} == brute_force(pts)


def test_pushes_against_all_pairs():
    import numpy as np

    from corpusgraph.operators import farfield

    rng = np.random.RandomState(3)
    law = (V.REACH2, V.LIFT, V.PUSH, V.MOST_PUSH, V.GAP, V.COLLISION)
    angle = rng.uniform(0, 7, 6000)
    ring = 250 + 42 * rng.randint(0, 7, 6000)
    x, y, r = np.cos(angle) * ring, np.sin(angle) * ring, rng.uniform(7, 24, 6000)
    x[:40], y[:40] = x[40], y[40]
    own = (x > 0) & (x < 300)
    a, b = (x[own], y[own], r[own]), (x, y, r)
    want = farfield.all_pairs(*a, *b, law)
    for levels in (1, 2, 3, 4, 5, 6):
        assert np.abs(farfield.pushes(a, b, law, levels) - want).max() < 1e-10


def test_more_points_are_not_all_pairs():
    from corpusgraph.operators import farfield

    # Points of the layout's densest square and of all squares about it, at some 1 GB of records.
    assert farfield.finest(100_000, 550_000, 1161.0**2, V.REACH2) >= 3
    assert farfield.finest(20, 50, 1161.0**2, V.REACH2) == 0
