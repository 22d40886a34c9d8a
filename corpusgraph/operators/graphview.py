"""What a viewer asks of the graph: search, neighbours, visible parts, layout."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgraph.operators import farfield
from corpusgraph.operators.manifest import with_ordinal
from corpusgraph.session import checkpoint

SEARCH_FIELDS = ("id", "label", "type", "kind", "agency", "incident_date", "incident_location", "description")

# The viewer's sizes, layout and forces.
GOLDEN_ANGLE = 2.399963229728653
SPIRAL_ANGLE = 2.399963
TYPE_RADIUS = {"release": 16, "agency": 12, "record": 7, "event": 9, "date": 7, "location": 8, "pairing": 7}
OTHER_RADIUS = 7
#: type: (share of the golden angle, sweep of the arc, first angle, radius, rings, distance of rings)
ANCHORS = {
    "release": (0.0, 0.0, 0.0, 0, 1, 0),
    "agency": (0.0, 2 * math.pi, -math.pi / 2, 150, 2, 45),
    "record": (1.0, 0.0, -math.pi / 2, 390, 7, 42),
    "event": (1.0, 0.0, math.pi / 8, 650, 6, 42),
    "date": (0.0, 1.36, -2.82, 720, 5, 44),
    "location": (0.0, 1.38, 1.42, 720, 5, 44),
    "pairing": (0.0, 1.26, -0.66, 690, 4, 40),
}
OTHER_ANCHOR = (1.0, 0.0, 0.0, 520, 1, 0)
REACH2, LIFT, PUSH, MOST_PUSH = 150000.0, 36.0, 2100.0, 0.72
GAP, COLLISION = 16.0, 0.052
LENGTHS, OTHER_LENGTH = {"contains_record": 280.0, "supported_by": 170.0}, 132.0
PULLS, OTHER_PULL = {"contains_record": 0.0012}, 0.0038
HOMES, OTHER_HOME = {"record": 0.009, "event": 0.009}, 0.007
DAMPING, MOST_SPEED, COOLING, REST = 0.78, 18.0, 0.987, 0.015


# The node types of the viewer's two preset views.
PRESETS = {"records": ("release", "agency", "record", "pairing"), "events": ("release", "event", "date", "location", "record")}


def matches(term: str, fields: tuple[str, ...] = SEARCH_FIELDS) -> Column:
    """Whether any field holds the term, in any case."""
    out = F.lit(False)
    for f in fields:
        out = out | F.contains(F.lower(F.coalesce(F.col(f), F.lit(""))), F.lit(term.lower()))
    return out


def visible_nodes(nodes: DataFrame, degrees: DataFrame, types: list[str], min_degree: int, term: str = "") -> DataFrame:
    out = nodes.where(F.col("type").isin(types)).join(degrees.where(F.col("degree") >= min_degree).select("id", "degree"), "id")
    return out.where(matches(term)) if term else out


def visible_edges(edges: DataFrame, nodes: DataFrame, relations: list[str] | None = None) -> DataFrame:
    """Edges of the given relations both of whose ends are among `nodes`."""
    ids = nodes.select("id")
    out = edges if relations is None else edges.where(F.col("relation").isin(relations))
    out = out.join(ids.withColumnRenamed("id", "source"), "source", "left_semi")
    return out.join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def neighbours(edges: DataFrame, active: DataFrame) -> DataFrame:
    """(id, other, relation) for each edge of the nodes in `active` (id); parallel edges repeat."""
    out = edges.join(active.withColumnRenamed("id", "source"), "source").select(F.col("source").alias("id"), F.col("target").alias("other"), "relation")
    back = edges.join(active.withColumnRenamed("id", "target"), "target").select(F.col("target").alias("id"), F.col("source").alias("other"), "relation")
    return out.unionByName(back)


def highlighted(edges: DataFrame, active: DataFrame) -> DataFrame:
    """Distinct ids of nodes next to an active node."""
    return neighbours(edges, active).select(F.col("other").alias("id")).distinct()


def top_neighbours(edges: DataFrame, nodes: DataFrame, degrees: DataFrame, active: DataFrame, most: int = 10) -> DataFrame:
    """(id, type, label, degree): the first `most` neighbours of the active nodes by degree, then label and id; parallel edges repeat them."""
    near = neighbours(edges, active).select(F.col("other").alias("id"))
    rows = near.join(nodes.select("id", "type", F.coalesce("label", F.lit("")).alias("label")), "id").join(degrees.select("id", "degree"), "id")
    return rows.orderBy(F.desc("degree"), "label", "id").limit(most)


def layout_ranks(nodes: DataFrame) -> DataFrame:
    """nodes (id, type, label, degree) with their place within the type, by degree and label, and the type's size.

    All nodes are numbered by ranges in the order of their types; a type's places count from its first.
    """
    ranked = with_ordinal(nodes, ["type", F.desc("degree"), "label", "id"], "_n")
    types = ranked.groupBy("type").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("layout_count"))
    return ranked.join(F.broadcast(types), "type").withColumn("layout_index", F.col("_n") - F.col("_first")).drop("_n", "_first")


def _by(column: Column, table: dict, other: object) -> Column:
    """CASE over a small table."""
    out = F.lit(other)
    for k, v in table.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def anchors(type_: Column, index: Column, count: Column) -> tuple[Column, Column]:
    """Where a node is at home: on an arc or on golden-angle rings, by type and rank within the type."""
    part = lambda i: _by(type_, {k: v[i] for k, v in ANCHORS.items()}, OTHER_ANCHOR[i])
    turn = (index + F.lit(0.5)) / F.greatest(count, F.lit(1))
    angle = index * F.lit(GOLDEN_ANGLE) * part(0) + turn * part(1) + part(2)
    radius = part(3) + (index % part(4)) * part(5)
    return F.cos(angle) * radius, F.sin(angle) * radius


def spiral(index: Column) -> tuple[Column, Column]:
    """First places of nodes numbered from 0, before they have a home."""
    angle = index * F.lit(SPIRAL_ANGLE)
    return F.cos(angle) * (90 + (index % 31) * 8), F.sin(angle) * (90 + (index % 29) * 8)


def node_radius(type_: Column, degree: Column) -> Column:
    return _by(type_, TYPE_RADIUS, OTHER_RADIUS) + F.least(F.lit(8.0), F.sqrt(degree) * F.lit(0.75))


def screen_radius(radius: Column, zoom: Column) -> Column:
    return F.greatest(F.lit(2.8), radius * F.pow(zoom, F.lit(0.82)))


def to_screen(x: Column, y: Column, width: float, height: float, zoom: float, dx: float, dy: float) -> tuple[Column, Column]:
    return F.lit(width / 2) + (x + F.lit(dx)) * F.lit(zoom), F.lit(height / 2) + (y + F.lit(dy)) * F.lit(zoom)


def to_world(x: Column, y: Column, width: float, height: float, zoom: float, dx: float, dy: float) -> tuple[Column, Column]:
    return (x - F.lit(width / 2)) / F.lit(zoom) - F.lit(dx), (y - F.lit(height / 2)) / F.lit(zoom) - F.lit(dy)


def viewport(points: DataFrame, width: float, height: float) -> DataFrame:
    """Bounding box of points (x, y), the clamped zoom that shows it, and the shift to its middle."""
    box = points.agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"), F.count(F.lit(1)).alias("n"))
    span = lambda a, b: F.greatest(F.lit(1.0), F.col(a) - F.col(b))
    fit = F.least(F.lit(width - 90) / span("max_x", "min_x"), F.lit(height - 90) / span("max_y", "min_y"))
    box = box.withColumn("zoom", F.greatest(F.lit(0.18), F.least(F.lit(2.2), fit)))
    return box.withColumn("dx", -(F.col("min_x") + F.col("max_x")) / 2).withColumn("dy", -(F.col("min_y") + F.col("max_y")) / 2)


def _cells(points: DataFrame, side: float, suffix: str, around: bool) -> DataFrame:
    """Points with their square cell; with `around`, once for each of the nine cells about it."""
    out = points.select(*(F.col(c).alias(c + suffix) for c in points.columns), F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    if not around:
        return out
    steps = F.array(*(F.struct(F.lit(i).alias("sx"), F.lit(j).alias("sy")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    return out.select("*", F.inline(steps)).withColumn("cx", F.col("cx") + F.col("sx")).withColumn("cy", F.col("cy") + F.col("sy")).drop("sx", "sy")


def push_forces(points: DataFrame, alpha: float) -> DataFrame:
    """(id, fx, fy): how far the other points in reach push each point (id string, x, y, r).

    A point goes to the nine squares as wide as the reach about its own; a square works out the
    forces on its own points, see `farfield`. Points at one place don't push each other.
    """
    side = math.sqrt(REACH2)
    own = (F.col("cx") == F.floor(F.col("x") / side)) & (F.col("cy") == F.floor(F.col("y") / side))
    p = _cells(points.select("id", "x", "y", "r"), side, "", True).withColumn("own", own).withColumn("id", F.when(F.col("own"), F.col("id")))
    law = (REACH2, LIFT, PUSH * alpha, MOST_PUSH, GAP, COLLISION * alpha)

    def forces(t: pa.Table) -> pa.Table:
        x, y, r, mine = (t.column(c).to_numpy() for c in ("x", "y", "r", "own"))
        fx, fy = farfield.pushes((x[mine], y[mine], r[mine]), (x, y, r), law)
        return pa.table({"id": t.column("id").filter(t.column("own")).cast(pa.string()), "fx": pa.array(fx), "fy": pa.array(fy)})

    # Few bytes and much work: a number of tasks is asked for, or all would end up in one.
    spark = points.sparkSession
    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return p.repartition(tasks, "cx", "cy").groupBy("cx", "cy").applyInArrow(forces, "id string, fx double, fy double")


def force_step(state: DataFrame, edges: DataFrame, alpha: float) -> DataFrame:
    """One step of the layout: state (id, type, degree, home_x, home_y, x, y, vx, vy) to the next.

    Repulsion reaches a fixed distance and is summed by squares; edges pull by two equi-joins; all
    forces are summed by node. A node without any neighbour only moves home.
    """
    push = push_forces(state.select("id", "x", "y", node_radius(F.col("type"), F.col("degree")).alias("r")), alpha)

    at = lambda s: state.select(F.col("id").alias(s), F.col("x").alias(f"x_{s}"), F.col("y").alias(f"y_{s}"))
    e = edges.select("source", "target", "relation").join(at("source"), "source").join(at("target"), "target")
    e = e.withColumn("dx", F.col("x_target") - F.col("x_source")).withColumn("dy", F.col("y_target") - F.col("y_source"))
    e = e.withColumn("d", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).withColumn("d", F.when(F.col("d") == 0, 1.0).otherwise(F.col("d")))
    pull = (F.col("d") - _by(F.col("relation"), LENGTHS, OTHER_LENGTH)) * _by(F.col("relation"), PULLS, OTHER_PULL) * F.lit(alpha)
    fx, fy = F.col("dx") / F.col("d") * pull, F.col("dy") / F.col("d") * pull
    ends = F.array(F.struct(F.col("source").alias("id"), fx.alias("fx"), fy.alias("fy")), F.struct(F.col("target").alias("id"), (-fx).alias("fx"), (-fy).alias("fy")))
    forces = push.unionByName(e.select(F.inline(ends))).groupBy("id").agg(F.sum("fx").alias("fx"), F.sum("fy").alias("fy"))

    home = _by(F.col("type"), HOMES, OTHER_HOME) * F.lit(alpha)
    out = state.join(forces, "id", "left")
    for v, f, h, c in (("vx", "fx", "home_x", "x"), ("vy", "fy", "home_y", "y")):
        out = out.withColumn(v, (F.col(v) + F.coalesce(f, F.lit(0.0)) + (F.col(h) - F.col(c)) * home) * F.lit(DAMPING))
    speed = F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy"))
    out = out.withColumn("slow", F.when(speed > MOST_SPEED, F.lit(MOST_SPEED) / speed).otherwise(F.lit(1.0)))
    out = out.withColumn("vx", F.col("vx") * F.col("slow")).withColumn("vy", F.col("vy") * F.col("slow"))
    return out.withColumn("x", F.col("x") + F.col("vx")).withColumn("y", F.col("y") + F.col("vy")).select(*state.columns)


def simulate(state: DataFrame, edges: DataFrame, alpha: float = 1.0, most_steps: int = 1000, every: int = 1) -> DataFrame:
    """Steps until the layout has cooled down; a step reads the state several times, so the lineage is cut after each."""
    for i in range(most_steps):
        if alpha < REST:
            break
        state = force_step(state, edges, alpha)
        if i % every == every - 1:
            state = checkpoint(state)
        alpha *= COOLING
    return state


def close_pairs(points: DataFrame, limit2: float = REACH2, lift: float = LIFT) -> DataFrame:
    """Pairs of points (id, x, y) with id_a < id_b and dx² + dy² + lift <= limit2.

    Points are put into square cells as wide as the distance, and each meets only the nine cells
    around its own, so the join is an equi-join on cells.
    """
    side = math.sqrt(max(limit2 - lift, 1e-9))
    p = points.select("id", "x", "y")
    dist2 = F.pow(F.col("x_a") - F.col("x_b"), 2) + F.pow(F.col("y_a") - F.col("y_b"), 2) + F.lit(lift)
    out = _cells(p, side, "_a", False).join(_cells(p, side, "_b", True), ["cx", "cy"]).where("id_a < id_b")
    return out.withColumn("dist2", dist2).where(F.col("dist2") <= limit2).select("id_a", "id_b", "dist2")


def _disc(k: int, side: float, limit2: float, lift: float) -> list[tuple[int, int, int]]:
    """(dy, inner, outer) of rows of cells about a cell: cells of |dx| <= inner lie wholly in reach of it (-1: none), beyond outer none does."""
    out = []
    for dy in range(-k - 1, k + 2):
        far = lambda dx: ((abs(dx) + 1) ** 2 + (abs(dy) + 1) ** 2) * side * side + lift  # noqa: B023, E731
        close = lambda dx: (max(abs(dx) - 1, 0) ** 2 + max(abs(dy) - 1, 0) ** 2) * side * side + lift  # noqa: B023, E731
        # Cells at the very edge, where rounding may matter, are compared point by point.
        inner = max((dx for dx in range(k + 2) if far(dx) <= limit2 * (1 - 1e-9)), default=-1)
        outer = max((dx for dx in range(k + 2) if close(dx) <= limit2 * (1 + 1e-9)), default=-1)
        if outer >= 0:
            out.append((dy, inner, outer))
    return out


def count_in_reach(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, limit2: float, lift: float) -> np.ndarray:
    """For each point a, the number of points b with dx² + dy² + lift <= limit2.

    Cells wholly in reach are counted by sums of their rows, only those the edge runs through by
    their points; cells are the narrower the more points there are.
    """
    k = max(2, min(128, int(math.sqrt(len(bx)) / 6)))
    side = math.sqrt(limit2 - lift) / k
    pad = k + 2
    cell = lambda v: np.floor(v / side).astype(np.int64)
    acx, acy, bcx, bcy = cell(ax), cell(ay), cell(bx), cell(by)
    x0, y0 = min(acx.min(), bcx.min()) - pad, min(acy.min(), bcy.min()) - pad
    width, height = max(acx.max(), bcx.max()) + pad + 1 - x0, max(acy.max(), bcy.max()) + pad + 1 - y0
    at = (bcy - y0) * width + (bcx - x0)
    order = np.argsort(at, kind="stable")
    bx, by = bx[order], by[order]
    before = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=width * height))])
    own = (acy - y0) * width + (acx - x0)
    mine = np.argsort(own, kind="stable")
    cells, first = np.unique(own[mine], return_index=True)
    dy, inner, outer = np.array(_disc(k, side, limit2, lift)).T
    some = inner >= 0
    n = np.zeros(len(ax), dtype=np.int64)
    for c, idx in zip(cells, np.split(mine, first[1:])):
        row = c + dy * width
        whole = (before[row + inner + 1] - before[row - inner])[some].sum()
        lo = np.concatenate([row - outer, (row + inner + 1)[some]])
        hi = np.concatenate([np.where(some, row - inner, row + outer + 1), (row + outer + 1)[some]])
        spans = [(a, b) for a, b in zip(before[lo].tolist(), before[hi].tolist()) if a < b]
        n[idx] = whole
        if not spans:
            continue
        ex, ey = (np.concatenate([v[a:b] for a, b in spans]) for v in (bx, by))
        step = max(1, 4_000_000 // len(ex))
        for i in range(0, len(idx), step):
            j = idx[i : i + step]
            dx, dy_ = ax[j, None] - ex, ay[j, None] - ey
            n[j] += (dx * dx + dy_ * dy_ + lift <= limit2).sum(axis=1)
    return n


def close_counts(points: DataFrame, limit2: float = REACH2, lift: float = LIFT) -> DataFrame:
    """(id, n): for each of all points (id string, x, y) the number of others with dx² + dy² + lift <= limit2.

    A point goes to the nine squares as wide as the reach about its own; a square counts for its own points.
    """
    side = math.sqrt(max(limit2 - lift, 1e-9))
    own = (F.col("cx") == F.floor(F.col("x") / side)) & (F.col("cy") == F.floor(F.col("y") / side))
    p = _cells(points.select("id", "x", "y"), side, "", True).withColumn("own", own)
    p = p.withColumn("id", F.when(F.col("own"), F.col("id")))

    def count(t: pa.Table) -> pa.Table:
        x, y, mine = (t.column(c).to_numpy() for c in ("x", "y", "own"))
        ids = t.column("id").filter(t.column("own")).cast(pa.string())
        n = count_in_reach(x[mine], y[mine], x, y, limit2, lift) - 1 if mine.any() else np.zeros(0, dtype=np.int64)
        return pa.table({"id": ids, "n": pa.array(n, type=pa.int64())})

    return p.groupBy("cx", "cy").applyInArrow(count, "id string, n bigint")


def nearest(points: DataFrame, x: float, y: float, reach: float = 6.0) -> DataFrame:
    """The point (id, x, y, radius) nearest to a place, if nearer than its radius and `reach`; ties by id."""
    d = F.sqrt(F.pow(F.col("x") - F.lit(x), 2) + F.pow(F.col("y") - F.lit(y), 2))
    near = points.withColumn("dist", d).where(F.col("dist") < F.col("radius") + F.lit(reach))
    return near.agg(F.min(F.struct("dist", "id")).alias("m")).where("m is not null").select(F.col("m.id").alias("id"), F.col("m.dist").alias("dist"))
