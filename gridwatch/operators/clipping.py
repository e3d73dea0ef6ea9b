"""Polygons with holes cut at the cells of a grid."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwatch.functions.grid import Grid
from gridwatch.operators.geo import edge_cells, inside_polygons

#: A cell counts as covered where no edge cuts it if this part of its side away from its corner lies inside.
NEAR_CORNER = 1e-7
Point = tuple[float, float]


def signed_area(ring: list[Point]) -> float:
    """Positive for a ring that turns left."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def holds(ring: list[Point], p: Point) -> bool:
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


class Cell:
    """The box x0..x1, y0..y1; a place on its border has a number that grows from (x0, y0) to the left-turning way round."""

    def __init__(self, x0: float, y0: float, x1: float, y1: float):
        self.x0, self.y0, self.x1, self.y1 = x0, y0, x1, y1
        self.corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        w, h = x1 - x0, y1 - y0
        self.stops = [0.0, w, w + h, 2 * w + h]
        self.around = 2 * (w + h)

    def on_border(self, p: Point) -> bool:
        return p[0] in (self.x0, self.x1) or p[1] in (self.y0, self.y1)

    def number(self, p: Point) -> float:
        if p[1] == self.y0:
            return p[0] - self.x0
        if p[0] == self.x1:
            return self.stops[1] + p[1] - self.y0
        if p[1] == self.y1:
            return self.stops[2] + self.x1 - p[0]
        return self.stops[3] + self.y1 - p[1]

    def cut(self, a: Point, b: Point) -> tuple[Point, Point] | None:
        """The part of a..b in the box, without parts along its border."""
        low, high, d = 0.0, 1.0, (b[0] - a[0], b[1] - a[1])
        sides: list[tuple[int, float] | None] = [None, None]
        for axis, least, most in ((0, self.x0, self.x1), (1, self.y0, self.y1)):
            if d[axis] == 0:
                if not least <= a[axis] <= most:
                    return None
                continue
            near, far = ((least, most) if d[axis] > 0 else (most, least))
            t, u = (near - a[axis]) / d[axis], (far - a[axis]) / d[axis]
            if t > low:
                low, sides[0] = t, (axis, near)
            if u < high:
                high, sides[1] = u, (axis, far)
        if low >= high:
            return None
        ends = []
        for t, side, whole in ((low, sides[0], a), (high, sides[1], b)):
            p = list(whole) if side is None else [min(max(a[k] + t * d[k], (self.x0, self.y0)[k]), (self.x1, self.y1)[k]) for k in (0, 1)]
            if side is not None:
                p[side[0]] = side[1]
            ends.append((p[0], p[1]))
        p, q = ends
        along = any(p[k] == q[k] and p[k] in limits for k, limits in ((0, (self.x0, self.x1)), (1, (self.y0, self.y1))))
        return None if p == q or along else (p, q)

    def walk(self, start: float, end: float) -> list[Point]:
        """The corners between two numbers, the left-turning way round."""
        end = end if end >= start else end + self.around
        return [self.corners[k % 4] for k in range(8) if start < self.stops[k % 4] + (k // 4) * self.around < end]


def clipped(cell: Cell, edges: list[tuple], covered: bool) -> list[list[list[Point]]]:
    """A polygon's parts in the cell, each as its outer ring and its holes.

    edges: (ring, order, x1, y1, x2, y2), with the polygon to the left of each. Runs of edges inside the cell go from border to border;
    from where one leaves, the border leads left to where the next one comes in.
    """
    runs: list[list[Point]] = []
    heads: dict[tuple, list[Point]] = {}  # runs that start inside the cell: a ring's first edges, which its last ones lead to
    last = None
    for ring, _, x1, y1, x2, y2 in sorted(edges):
        piece = cell.cut((x1, y1), (x2, y2))
        if piece is None:
            continue
        if last == (ring, piece[0]) and not cell.on_border(piece[0]):
            runs[-1].append(piece[1])
        else:
            runs.append([*piece])
            if not cell.on_border(piece[0]):
                heads[ring, piece[0]] = runs[-1]
        last = (ring, piece[1])
    for run in [r for r in runs if not cell.on_border(r[-1])]:
        ring = next((g for (g, p), head in heads.items() if p == run[-1]), None)
        head = heads.get((ring, run[-1]))
        if head is not None and head is not run:
            run += head[1:]
            runs = [r for r in runs if r is not head]
    whole = [r[:-1] for r in runs if r[0] == r[-1] and not cell.on_border(r[0])]
    open_ = sorted((cell.number(r[0]), k, r) for k, r in enumerate(runs) if cell.on_border(r[0]) and cell.on_border(r[-1]))
    starts, used, outer = [n for n, _, _ in open_], set(), []
    for k in range(len(open_)):
        if k in used:
            continue
        ring, at = [], k
        while at not in used:
            used.add(at)
            ring += open_[at][2]
            leaves = cell.number(ring[-1])
            at = bisect_left(starts, leaves) % len(open_)
            ring += cell.walk(leaves, starts[at])
        outer.append([p for p, q in zip(ring, ring[1:] + ring[:1], strict=True) if p != q])
    if not open_ and covered:
        outer.append(list(cell.corners))
    outer += [r for r in whole if signed_area(r) > 0]
    parts = [[r] for r in outer if len(r) > 2 and signed_area(r) > 1e-15]
    for hole in (r for r in whole if signed_area(r) < 0):
        around = [p for p in parts if holds(p[0], hole[0])] or parts[:1]
        if around:
            min(around, key=lambda p: signed_area(p[0])).append(hole)
    return parts


def clipped_geometries(edges: DataFrame, grid: Grid) -> DataFrame:
    """grid_id, type, coordinates, area: each cell's part of the polygons, holes left out; cells without any area have no row.

    edges: poly, ring (0 the outer one, others holes), seq (in order along the ring), x1, y1, x2, y2; rings are closed and don't cross, and polygons
    don't overlap. Rings may turn either way. `type` is Polygon or MultiPolygon, and `coordinates` the list of its polygons, each its rings with
    the first point again at the end, outer rings turning left. Rings are never put together: each edge goes to the cells that it passes, and a
    task sees a cell's edges only. Cells that no edge cuts are whole or absent by a place near their corner.
    """
    known = edges.select("poly", "ring", "seq", "x1", "y1", "x2", "y2").distinct()
    turn = known.groupBy("poly", "ring").agg(F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("_turn"))
    flip = ((F.col("_turn") > 0) != (F.col("ring") == 0)).alias("_flip")
    faced = known.join(turn.select("poly", "ring", flip), ["poly", "ring"])
    swap = lambda a, b, name: F.when(F.col("_flip"), F.col(b)).otherwise(F.col(a)).alias(name)
    faced = faced.select("poly", "ring", F.when(F.col("_flip"), -F.col("seq")).otherwise(F.col("seq")).alias("seq"), swap("x1", "x2", "x1"), swap("y1", "y2", "y1"), swap("x2", "x1", "x2"), swap("y2", "y1", "y2"))
    pieces = edge_cells(faced, grid.size).groupBy("i", "j", "poly").agg(F.collect_list(F.struct("ring", "seq", "x1", "y1", "x2", "y2")).alias("edges"))
    index = lambda c: F.floor(F.col(c) / grid.size)
    low, high = (lambda a, b: F.min(F.least(a, b))), (lambda a, b: F.max(F.greatest(a, b)))
    boxes = known.groupBy("poly").agg(low("y1", "y2").alias("a"), high("y1", "y2").alias("b"), low("x1", "x2").alias("c"), high("x1", "x2").alias("d"))
    cells = boxes.select("poly", F.explode(F.sequence(index("a"), index("b"))).alias("i"), "c", "d").select("poly", "i", F.explode(F.sequence(index("c"), index("d"))).alias("j"))
    spots = cells.withColumns({"_y": (F.col("i") + NEAR_CORNER) * grid.size, "_x": (F.col("j") + NEAR_CORNER) * grid.size})
    covered = spots.join(inside_polygons(spots.select(F.col("_y").alias("_lat"), F.col("_x").alias("_lon")).distinct(), known).select(F.col("_lat").alias("_y"), F.col("_lon").alias("_x"), "poly"), ["_y", "_x", "poly"]).select("i", "j", "poly", F.lit(True).alias("covered"))
    size = grid.size

    def shapes(frames):
        for frame in frames:
            out = []
            for i, j, rows, full in zip(frame["i"], frame["j"], frame["edges"], frame["covered"], strict=True):
                cell = Cell(j * size, i * size, (j + 1) * size, (i + 1) * size)
                told = [] if rows is None else [tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows]
                for part in clipped(cell, told, bool(full)):
                    out.append((i, j, [[[*p] for p in [*ring, ring[0]]] for ring in part], sum(map(signed_area, part))))
            yield pd.DataFrame(out, columns=["i", "j", "rings", "area"])

    met = pieces.join(covered, ["i", "j", "poly"], "full_outer").select("i", "j", "edges", F.coalesce("covered", F.lit(False)).alias("covered"))
    parts = met.mapInPandas(shapes, "i long, j long, rings array<array<array<double>>>, area double")
    whole = parts.groupBy("i", "j").agg(F.sort_array(F.collect_list("rings")).alias("coordinates"), F.sum("area").alias("area")).filter("area > 1e-12")
    return whole.select(F.concat_ws("_", "i", "j").alias("grid_id"), F.when(F.size("coordinates") == 1, "Polygon").otherwise("MultiPolygon").alias("type"), "coordinates", "area")


def polygon_geometry() -> Column:
    """GeoJSON text of `clipped_geometries`' columns."""
    one = F.to_json(F.struct("type", F.col("coordinates")[0].alias("coordinates")))
    return F.when(F.col("type") == "Polygon", one).otherwise(F.to_json(F.struct("type", "coordinates")))
