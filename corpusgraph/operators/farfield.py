"""Sums of the layout's pushes over all points in reach, without visiting all pairs.

Beyond the distance in which points collide the push is a smooth function of the distance, so the
points of a square of a grid act on a distant square as if their weights sat at the square's
Chebyshev nodes. Pairs of squares are taken from coarse to fine: a pair wholly in reach and far
enough apart is settled by its nodes, one out of reach is dropped, any other goes down to its
quarters. What is left at the finest level (near pairs, and those that the edge of the reach runs
through) is summed point by point, so the cut at the reach is exact for each pair of points. The
number of nodes is such that the sums are within some 1e-12 of those over all pairs.
"""

from __future__ import annotations

import math

import numpy as np

#: Sides of the squares and nodes along a side; a pair of squares is settled from APART sides on.
SIDES = (48.0, 24.0, 12.0, 6.0, 3.0, 1.5)
NODES = (13, 13, 11, 9, 8, 7)
APART = 3.0
OUT, FAR, OPEN = 0, 1, 2
TILE = 30_000
#: Seconds of a pair of points, and of a pair of squares' offset, by which the finest level is chosen.
PAIR_S, OFFSET_S = 5e-9, 1.2e-4


def all_pairs(ax, ay, ar, bx, by, br, law: tuple, tile: int = 2_000_000) -> np.ndarray:
    """(2, points a): the push on each point a by all points b in reach. law: (reach², lift, push, most push, gap, collision)."""
    reach2, lift, push, most, gap, collision = law
    out = np.zeros((2, len(ax)))
    step = max(1, tile // max(1, len(bx)))
    for i in range(0, len(ax), step):
        j = slice(i, i + step)
        dx, dy = ax[j, None] - bx, ay[j, None] - by
        d2 = dx * dx + dy * dy + lift
        d, near = np.sqrt(d2), ar[j, None] + br + gap
        force = np.minimum(most, push / d2) + np.maximum(near - d, 0) * collision
        force = np.where(d2 <= reach2, force, 0) / d
        out[0, j], out[1, j] = (dx * force).sum(axis=1), (dy * force).sum(axis=1)
    return out


def _basis(u: np.ndarray, p: int) -> np.ndarray:
    """(points, p): Lagrange polynomials of the Chebyshev nodes at u in [-1, 1]."""
    k = np.arange(p)
    t = np.cos(np.arccos(np.clip(u, -1, 1))[:, None] * k)
    at = np.cos(np.outer(k, math.pi * (k + 0.5) / p)) * 2 / p
    at[0] /= 2
    return t @ at


def _nodes(p: int, side: float) -> tuple[np.ndarray, np.ndarray]:
    c = np.cos(math.pi * (np.arange(p) + 0.5) / p) * side / 2
    return np.repeat(c, p), np.tile(c, p)


class _Level:
    """Squares of one side: which hold points, and the kinds of their offsets from another square."""

    def __init__(self, side: float, p: int, x0: float, y0: float, width: float, height: float, law: tuple, near: float):
        self.side, self.p, self.x0, self.y0 = side, p, x0, y0
        reach2, lift = law[:2]
        self.r = r = math.ceil(math.sqrt(reach2) / side) + 2
        self.columns, self.rows = math.ceil(width / side) + 1 + 2 * r, math.ceil(height / side) + 1 + 2 * r
        o = np.abs(np.arange(-r, r + 1))
        least, most = np.maximum(o - 1, 0) * side, (o + 1) * side
        d_min, d_max = least[:, None] ** 2 + least**2, most[:, None] ** 2 + most**2
        self.apart = d_min >= max(near, APART * side) ** 2
        self.kind = np.where(d_min + lift > reach2 * (1 + 1e-9), OUT, np.where(self.apart & (d_max + lift <= reach2 * (1 - 1e-9)), FAR, OPEN))

    def place(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.floor((x - self.x0) / self.side).astype(np.int64) + self.r, np.floor((y - self.y0) / self.side).astype(np.int64) + self.r

    def within(self, x, y, cx, cy) -> np.ndarray:
        """(points, p * p): the basis of the nodes of each point's square."""
        u = ((x - self.x0) / self.side - (cx - self.r)) * 2 - 1
        v = ((y - self.y0) / self.side - (cy - self.r)) * 2 - 1
        return (_basis(u, self.p)[:, :, None] * _basis(v, self.p)[:, None, :]).reshape(len(x), -1)

    def open_by_turn(self, above: _Level | None) -> list[np.ndarray]:
        """For squares in each quarter of the square above (2 * odd row + odd column): offsets whose pair above is open; indexed (row, column)."""
        o = np.arange(-self.r, self.r + 1)
        if above is None:
            return [np.ones((len(o), len(o)), dtype=bool)] * 4
        out = []
        for turn in range(4):
            y, x = ((turn >> 1) + o) // 2 + above.r, ((turn & 1) + o) // 2 + above.r
            fine = lambda v: (v >= 0) & (v < len(above.kind))
            got = above.kind[np.clip(y, 0, len(above.kind) - 1)[:, None], np.clip(x, 0, len(above.kind) - 1)] == OPEN
            out.append(got & fine(y)[:, None] & fine(x))
        return out


def _settle(lv: _Level, given: list[np.ndarray], a: tuple, b: tuple, law: tuple) -> np.ndarray:
    """(2, points a): the pushes of the pairs of squares that are settled at this level."""
    (ax, ay), (bx, by), p2 = a, b, lv.p * lv.p
    bcx, bcy = lv.place(bx, by)
    cell = bcy * lv.columns + bcx
    order = np.argsort(cell, kind="stable")
    occupied, first = np.unique(cell[order], return_index=True)
    weight = np.zeros((len(occupied), p2))
    ends = np.append(first[1:], len(order))
    i = 0
    while i < len(occupied):
        # So many squares as have some points together; a single one may have more.
        n = max(i + 1, int(np.searchsorted(ends, first[i] + TILE, "right")))
        j = order[first[i] : ends[n - 1]]
        if n == i + 1:
            for k in range(0, len(j), TILE):
                q = j[k : k + TILE]
                weight[i] += lv.within(bx[q], by[q], bcx[q], bcy[q]).sum(axis=0)
        else:
            weight[i:n] = np.add.reduceat(lv.within(bx[j], by[j], bcx[j], bcy[j]), first[i:n] - first[i], axis=0)
        i = n
    grid = np.full(lv.rows * lv.columns, -1, dtype=np.int32)
    grid[occupied] = np.arange(len(occupied))

    acx, acy = lv.place(ax, ay)
    cells, mine = np.unique(acy * lv.columns + acx, return_inverse=True)
    local = np.zeros((2, len(cells), p2))
    # Squares of one turn lie side by side; the turn counts from the grid's corner without its margin.
    turn = ((cells // lv.columns - lv.r) & 1) * 2 + ((cells % lv.columns - lv.r) & 1)
    by_turn = [np.flatnonzero(turn == t) for t in range(4)]
    asked = np.array([g & (lv.kind == FAR) for g in given])
    nx, ny = _nodes(lv.p, lv.side)
    rx, ry = nx[:, None] - nx, ny[:, None] - ny
    for oy, ox in np.argwhere(asked.any(axis=0)).tolist():
        t = np.concatenate([by_turn[k] for k in range(4) if asked[k, oy, ox]])
        s = grid[cells[t] + (oy - lv.r) * lv.columns + (ox - lv.r)]
        some = s >= 0
        t, s = t[some], s[some]
        if not len(t):
            continue
        dx, dy = rx - (ox - lv.r) * lv.side, ry - (oy - lv.r) * lv.side
        d2 = dx * dx + dy * dy + law[1]
        force = law[2] / (d2 * np.sqrt(d2))
        w = weight[s]
        local[0, t] += w @ (dx * force).T
        local[1, t] += w @ (dy * force).T
    out = np.zeros((2, len(ax)))
    for i in range(0, len(ax), TILE):
        j = slice(i, i + TILE)
        base = lv.within(ax[j], ay[j], acx[j], acy[j])
        for k in range(2):
            out[k, j] = np.einsum("ij,ij->i", base, local[k, mine[j]])
    return out


def _spans(asked: np.ndarray, r: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the runs of squares in the rows of `asked`, as distances in the grid."""
    edge = np.diff(np.pad(asked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    y, x = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return (y - r) * columns + x - r, (y - r) * columns + end - r


def _rest(lv: _Level, given: list[np.ndarray], a: tuple, b: tuple, law: tuple) -> np.ndarray:
    """(2, points a): the pushes of the pairs of points in squares that are still open at the finest level."""
    (ax, ay, ar), (bx, by, br) = a, b
    reach2, lift, push, most, gap, collision = law
    bcx, bcy = lv.place(bx, by)
    at = bcy * lv.columns + bcx
    order = np.argsort(at, kind="stable")
    bx, by, br = bx[order], by[order], br[order]
    before = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=lv.rows * lv.columns))])
    acx, acy = lv.place(ax, ay)
    own = acy * lv.columns + acx
    mine = np.argsort(own, kind="stable")
    cells, first = np.unique(own[mine], return_index=True)
    asked = [g & (lv.kind == OPEN) for g in given]
    near = [_spans(g & ~lv.apart, lv.r, lv.columns) for g in asked]
    edge = [_spans(g & lv.apart, lv.r, lv.columns) for g in asked]

    def members(c: int, spans: tuple) -> np.ndarray:
        lo, hi = before[c + spans[0]], before[c + spans[1]]
        some = hi > lo
        lo, n = lo[some], (hi - lo)[some]
        return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())

    out = np.zeros((2, len(ax)))
    for c, idx in zip(cells.tolist(), np.split(mine, first[1:])):
        row, column = divmod(c, lv.columns)
        turn = ((row - lv.r) & 1) * 2 + ((column - lv.r) & 1)
        # Places count from the square's middle.
        mx, my = lv.x0 + (column - lv.r + 0.5) * lv.side, lv.y0 + (row - lv.r + 0.5) * lv.side
        for close, spans in ((True, near[turn]), (False, edge[turn])):
            q = members(c, spans)
            if not len(q):
                continue
            qx, qy, qr = bx[q] - mx, by[q] - my, br[q]
            cols = np.stack([np.ones(len(q)), qx, qy], axis=1)
            high = min(len(idx), 64)
            wide = max(1, TILE // high)
            for i in range(0, len(idx), high):
                j = idx[i : i + high]
                px, py = ax[j] - mx, ay[j] - my
                total = np.zeros((len(j), 3))
                for k in range(0, len(q), wide):
                    d2 = px[:, None] - qx[k : k + wide]
                    d2 *= d2
                    dy = py[:, None] - qy[k : k + wide]
                    dy *= dy
                    d2 += dy
                    d2 += lift
                    d = np.sqrt(d2)
                    if close:
                        force = ar[j, None] + (qr[k : k + wide] + gap)
                        force -= d
                        np.maximum(force, 0, out=force)
                        force *= collision
                        np.divide(push, d2, out=d2)
                        np.minimum(d2, most, out=d2)
                        force += d2
                        force /= d
                    else:
                        d *= d2
                        force = np.divide(push, d, out=d)
                        force *= d2 <= reach2
                    total += force @ cols[k : k + wide]
                out[0, j] += px * total[:, 0] - total[:, 1]
                out[1, j] += py * total[:, 0] - total[:, 2]
    return out


def finest(n_a: int, n_b: int, area: float, reach2: float) -> int:
    """How many levels make least work; 0 if all pairs do."""
    reach = math.sqrt(reach2)
    least, best, offsets = n_a * min(n_b, n_b * math.pi * reach2 / area) * 2 * PAIR_S, 0, 0.0
    for i, side in enumerate(SIDES, 1):
        offsets += (math.pi * reach2 if i == 1 else 5.6 * 2 * math.pi * reach * side) / side**2
        work = n_a * n_b / area * 2.8 * 2 * math.pi * reach * side * PAIR_S + offsets * OFFSET_S
        if work < least:
            least, best = work, i
    return best


def pushes(a: tuple, b: tuple, law: tuple, levels: int | None = None) -> np.ndarray:
    """(2, points a): the push on each point of a by all points of b in reach; a and b are (x, y, radius) in arrays."""
    (ax, ay, ar), (bx, by, br) = a, b
    if not len(ax) or not len(bx):
        return np.zeros((2, len(ax)))
    reach2, lift, push, most, gap, _ = law
    x0, y0 = min(ax.min(), bx.min()), min(ay.min(), by.min())
    width, height = max(ax.max(), bx.max()) - x0, max(ay.max(), by.max()) - y0
    if levels is None:
        levels = finest(len(ax), len(bx), max(width * height, 1.0), reach2)
    near = max(math.sqrt(max(push / most - lift, 0)), ar.max() + br.max() + gap)
    # Where points collide over most of the reach, all pairs are looked at.
    if not levels or (near + APART * SIDES[0]) * 1.5 > math.sqrt(reach2 - lift):
        return all_pairs(ax, ay, ar, bx, by, br, law)
    out, above = np.zeros((2, len(ax))), None
    for side, p in list(zip(SIDES, NODES))[:levels]:
        lv = _Level(side, p, x0, y0, width, height, law, near)
        given = lv.open_by_turn(above)
        out += _settle(lv, given, (ax, ay), (bx, by), law)
        above = lv
    return out + _rest(lv, given, a, b, law)
