"""Clusters, nearest rows, best rows in boxes and boundaries on skewed frames, against plain loops."""

import datetime as dt
import json
import math
import random

from pyspark.sql import functions as F

from gridwatch.functions.grid import Grid
from gridwatch.operators.clipping import clipped_geometries, polygon_geometry, signed_area
from gridwatch.operators.cluster import dbscan, latest_window
from gridwatch.operators.geo import edge_cells, within_cells, within_polygons
from gridwatch.operators.nearest import nearest, nearest_predictions, top_in_boxes


def clusters_by_loops(spots, eps, least):
    near = {i: [j for j, a, b in spots if (a - y) ** 2 + (b - x) ** 2 <= eps * eps] for i, y, x in spots}
    core = {i for i in near if len(near[i]) >= least}
    label = {i: i for i in core}
    while True:
        new = {i: min(label[j] for j in near[i] if j in core) for i in core}
        if new == label:
            return {i: label.get(i, min((label[j] for j in near[i] if j in core), default=-1)) for i in near}
        label = new


def test_clusters_of_dense_and_sparse_cells(spark):
    draw = random.Random(2)
    for n, eps, least in ((500, 0.25, 10), (700, 0.5, 30)):
        spots = [(i, round(draw.gauss(3 * (i % 3 > 0), 1), 2), round(draw.gauss(0, 1), 2)) for i in range(n)]
        odd = [(n, None, 1.0), *((n + 1 + k, float("nan"), 1.0) for k in range(40)), *((n + 50 + k, 1.0, float("inf")) for k in range(40))]
        got = dbscan(spark.createDataFrame([*spots, *odd], "id long, latitude double, longitude double"), eps, least).collect()
        assert {r.id: r.cluster_id for r in got} == {**clusters_by_loops(spots, eps, least), **{i: -1 for i, *_ in odd}}


def test_clusters_of_one_crowded_cell(spark):
    """Sixty thousand places within a cell, and as many in one just in reach and one just out of it."""
    side = 0.5 / 2**0.5
    at = lambda low, start: spark.range(start, start + 60_000).select("id", (F.rand(start) * 0.3 + low).alias("latitude"), (F.rand(start + 1) * 0.3).alias("longitude"))
    points = at(0.01, 0).unionByName(at(2 * side + 0.01, 60_000)).unionByName(at(6 * side + 0.01, 120_000))
    found = dbscan(points, 0.5, 20).groupBy("cluster_id").count().collect()
    assert sorted((r.cluster_id, r["count"]) for r in found) == [(0, 120_000), (120_000, 60_000)]


def test_latest_window(spark):
    rows = [(1, dt.datetime(2024, 1, 2, 6)), (2, dt.datetime(2024, 1, 1, 6)), (3, dt.datetime(2024, 1, 1, 5, 59)), (4, None)]
    df = spark.createDataFrame(rows, "id int, acquired_at timestamp")
    assert sorted(r.id for r in latest_window(df).collect()) == [1, 2]
    assert latest_window(df.limit(0)).count() == 0


def km(a, b, c, d):
    h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return round(2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h))), 3)


def test_nearest_of_few_and_far_stations(spark):
    """Crowds, stations an ocean away, across the date line and beyond the poles, ties, and a limit."""
    draw = random.Random(5)
    sites = [(i, 10 + draw.random(), 100 + draw.random()) for i in range(80)] + [(100, -60.0, -179.5), (101, 89.5, 10.0), (102, 0.0, 179.9), (103, 0.0, 179.9)]
    spots = [(f"p{i}", draw.uniform(-90, 90), draw.uniform(-180, 180)) for i in range(150)] + [("q", 0.0, -179.9), ("r", 89.9, -170.0), ("s", 10.5, 100.5), ("t", -89.9, 0.0), ("u", None, 1.0)]
    points, stations = spark.createDataFrame(spots, "point_id string, latitude double, longitude double"), spark.createDataFrame([*sites, (104, None, None)], "id long, latitude double, longitude double")
    want = {}
    for p, a, b in spots[:-1]:
        distance, site = min((km(a, b, c, d), i) for i, c, d in sites)
        want[p] = (site, distance)
    for limit in (None, 500.0, 3000.0):
        got = {r.point_id: (r.station_id, r.distance_km) for r in nearest(points, stations, "point_id", max_km=limit).collect()}
        fit = {k: v for k, v in want.items() if limit is None or v[1] <= limit}
        assert got.keys() == fit.keys()
        assert all(got[k][0] == fit[k][0] and abs(got[k][1] - fit[k][1]) <= 0.001 for k in fit)
    plan = nearest(points, stations, "point_id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert nearest(points, stations.limit(0), "point_id").count() == 0


def test_requests_far_from_predictions(spark):
    draw = random.Random(6)
    day = lambda k: dt.date(2024, 1, 1 + k)
    cells = [(f"g{i % 40}_{i // 40}", day(i % 3), draw.choice([0, 1]) * 90 + round(draw.random() * 3, 1), round(draw.random() * 3, 1), draw.random()) for i in range(300)]
    asked = [(i, draw.uniform(-80, 80), draw.uniform(-170, 170), day(draw.randrange(5))) for i in range(60)] + [(60 + i, 1.05, 1.05, day(0)) for i in range(5)]
    predictions = spark.createDataFrame([*cells, ("none", day(9), None, 1.0, 0.5)], "grid_id string, date date, latitude double, longitude double, risk_score double")
    requests = spark.createDataFrame([*asked, (99, None, 1.0, day(0))], "request_id int, latitude double, longitude double, date date")
    got = {r.request_id: (r.grid_id, r.date) for r in nearest_predictions(requests, predictions).collect()}
    want = {}
    for i, y, x, d in asked:
        served = d if d <= day(2) else day(2)
        want[i] = min((pow(c[2] - y, 2) + pow(c[3] - x, 2), c[0]) for c in cells if c[1] == served)[1], served
    assert got == want


def test_best_rows_in_boxes(spark):
    """Boxes of all sizes, on cell bounds, empty and turned round; ties; places with many days."""
    draw = random.Random(7)
    rows = [(f"g{i}", dt.date(2024, 1, 1 + draw.randrange(20)), draw.choice([-33, 0, 12]) + draw.randrange(40) / 4, draw.choice([-90, 0, 100]) + draw.randrange(60) / 4, draw.randrange(3), draw.randrange(5) / 4) for i in range(1500)]
    rows += [("lost", dt.date(2024, 1, 30), None, None, 2, 1.5)]
    boxes = []
    for i in range(120):
        y, x = draw.uniform(-40, 20), draw.uniform(-100, 110)
        h, w = (draw.choice([0.0, 0.3, 2.0, 9.0, 60.0]) for _ in range(2))
        boxes.append((i, draw.randrange(3), round(x), round(y), round(x) + w, round(y) + h))
    boxes += [(200, 1, None, None, None, None), (201, 2, None, 1.0, 2.0, 3.0), (202, 0, 5.0, 5.0, 1.0, 1.0), (203, 0, 1.0, None, 2.0, 3.0), (204, None, None, None, None, None), (205, 0, -180.0, -90.0, 180.0, 90.0)]
    predictions = spark.createDataFrame(rows, "grid_id string, date date, latitude double, longitude double, risk_level int, risk_score double")
    subscribers = spark.createDataFrame([(i, r, *(v if v is None else float(v) for v in b)) for i, r, *b in boxes], "id int, min_severity_rank int, bbox_min_lon double, bbox_min_lat double, bbox_max_lon double, bbox_max_lat double")
    want = []
    for i, rank, x0, y0, x1, y1 in boxes:
        if rank is None or (x0 is not None and None in (y0, x1, y1)):
            continue
        fit = [r for r in rows if r[4] >= rank and (x0 is None or (r[2] is not None and y0 <= r[2] <= y1 and x0 <= r[3] <= x1))]
        fit.sort(key=lambda r: (-r[4], -r[5], -r[1].toordinal(), r[0]))
        want += [(i, n + 1, r[0]) for n, r in enumerate(fit[:5])]
    got = top_in_boxes(predictions, subscribers, levels=5)
    assert sorted((r.subscriber_id, r.n, r.grid_id) for r in got.collect()) == want


def ring(poly, number, corners):
    return [(poly, number, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]


EDGES = "poly int, ring int, x1 double, y1 double, x2 double, y2 double"


def test_boundary_cells_agree_with_all_edges(spark):
    """Ragged rings with holes, touching corners and cell sides, and places on corners, sides and cell bounds."""
    draw = random.Random(9)
    star = lambda y, x, r, n, grain: [(round((x + r * draw.uniform(0.4, 1) * math.cos(2 * math.pi * k / n)) * grain) / grain, round((y + r * draw.uniform(0.4, 1) * math.sin(2 * math.pi * k / n)) * grain) / grain) for k in range(n)]
    rows = ring(0, 0, star(0, 0, 3, 40, 4)) + ring(0, 1, star(0, 0, 1, 12, 8)) + ring(1, 0, star(2, 4, 2, 300, 1e6)) + ring(2, 0, [(-4.0, -4.0), (-3.0, -4.0), (-3.0, -3.0), (-4.0, -3.0)]) + ring(3, 0, star(-2, 2, 1.5, 9, 2))
    spots = [(draw.randrange(-40, 41) / 8, draw.randrange(-40, 57) / 8) for _ in range(1500)] + [(draw.uniform(-5, 5), draw.uniform(-5, 7)) for _ in range(1500)] + [(y, x) for _, _, x, y, *_ in rows] + [(None, 1.0), (1.0, None)]
    points, edges = spark.createDataFrame(spots, "latitude double, longitude double"), spark.createDataFrame(rows, EDGES)
    want = sorted(map(tuple, within_polygons(points, edges).collect()))
    for cell in (0.25, 0.4, 3.0):
        assert sorted(map(tuple, within_cells(points, edges, cell=cell).collect())) == want
    assert within_cells(points, edges.limit(0)).count() == within_cells(points.limit(0), edges).count() == 0


def test_crowded_band_of_edges(spark):
    """Two hundred thousand edges in one band of latitude: cells share them out, and a place meets its own cell's."""
    n = 100_000
    x = lambda k: -20 + 40 * k / n
    top = spark.range(n).select(F.lit(0).alias("poly"), F.lit(0).alias("ring"), x(F.col("id")).alias("x1"), (0.10 + 0.02 * (F.col("id") % 2)).alias("y1"), x(F.col("id") + 1).alias("x2"), (0.10 + 0.02 * ((F.col("id") + 1) % 2)).alias("y2"))
    low = spark.range(n).select(F.lit(0).alias("poly"), F.lit(0).alias("ring"), x(F.col("id") + 1).alias("x1"), F.lit(0.05).alias("y1"), x(F.col("id")).alias("x2"), F.lit(0.05).alias("y2"))
    sides = spark.createDataFrame([(0, 0, 20.0, 0.10, 20.0, 0.05), (0, 0, -20.0, 0.05, -20.0, 0.10)], EDGES)
    edges = top.unionByName(low).unionByName(sides)
    points = spark.range(3000).select((F.rand(1) * 0.15).alias("latitude"), (F.rand(2) * 44 - 22).alias("longitude"))
    assert edge_cells(edges, 0.25).groupBy("i", "j").count().agg(F.max("count")).first()[0] < 3000
    rise = lambda p: 0.10 + 0.02 * (1 - abs((p.longitude + 20) * n / 40 % 2 - 1))
    want = sum(-20 < p.longitude < 20 and 0.05 < p.latitude < rise(p) for p in points.collect())
    assert abs(within_polygons(points, edges).count() - want) <= 2


def area_in_box(corners, x0, y0, x1, y1):
    """Of a ring's part in a box, cut side by side."""
    for axis, limit, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for a, b in zip(corners, corners[1:] + corners[:1], strict=True):
            ia, ib = sign * (a[axis] - limit) >= 0, sign * (b[axis] - limit) >= 0
            if ia:
                out.append(a)
            if ia != ib:
                t = (limit - a[axis]) / (b[axis] - a[axis])
                out.append(tuple(limit if k == axis else a[k] + t * (b[k] - a[k]) for k in (0, 1)))
        corners = out
        if not corners:
            return 0.0
    return abs(signed_area(corners))


def test_cells_cut_out_of_polygons_with_holes(spark):
    """Bent and star-like rings, either way round, with holes within and across cells, some along cell sides; several polygons in a cell."""
    draw = random.Random(11)
    star = lambda y, x, low, high, n: [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n)) for k in range(n) for r in [draw.uniform(low, high)]]
    shapes = [
        [[(-1.2, -0.7), (0.9, -0.7), (0.9, 0.9), (0.3, -0.1), (-1.2, 0.9)]],
        [star(4, 4, 1.0, 1.6, 25), star(4, 4, 0.2, 0.8, 11)[::-1]],
        [[(8.0, 0.0), (10.0, 0.0), (10.0, 2.0), (8.0, 2.0)], [(8.5, 0.5), (9.5, 0.5), (9.5, 1.5), (8.5, 1.5)]],  # along cell sides
        [star(-4, -4, 1.2, 1.5, 9)[::-1], star(-4.2, -4.2, 0.02, 0.04, 5), star(-3.8, -3.8, 0.1, 0.2, 6)],
        [[(6.1, 6.1), (6.2, 6.1), (6.15, 6.2)]],
        [[(6.3, 6.3), (6.4, 6.3), (6.35, 6.4)]],
        [[(12.0, 0.25), (14.0, 0.25), (14.0, 0.3), (12.25, 0.3), (12.25, 0.4), (14.0, 0.4), (14.0, 0.45), (12.0, 0.45)]],  # two parts in a cell
    ]
    rows = [(p, r, k, *a, *b) for p, rings in enumerate(shapes) for r, c in enumerate(rings) for k, (a, b) in enumerate(zip(c, c[1:] + c[:1], strict=True))]
    edges = spark.createDataFrame(rows + rows[:2], "poly long, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    got = {r.grid_id: r for r in clipped_geometries(edges, Grid(0.5)).withColumn("text", polygon_geometry()).collect()}
    want = {}
    for i in range(-14, 20):
        for j in range(-14, 30):
            box = (j / 2, i / 2, j / 2 + 0.5, i / 2 + 0.5)
            area = sum(area_in_box(rings[0], *box) - sum(area_in_box(h, *box) for h in rings[1:]) for rings in shapes)
            if area > 1e-12:
                want[f"{i}_{j}"] = area
    assert got.keys() == want.keys()
    for key, row in got.items():
        i, j = map(int, key.split("_"))
        assert abs(row.area - want[key]) < 1e-9
        told = json.loads(row.text)
        parts = told["coordinates"] if told["type"] == "MultiPolygon" else [told["coordinates"]]
        assert told["type"] == row.type and (len(parts) > 1) == (row.type == "MultiPolygon")
        assert abs(sum(signed_area([tuple(p) for p in ring[:-1]]) for part in parts for ring in part) - want[key]) < 1e-9
        assert all(ring[0] == ring[-1] and (signed_area([tuple(p) for p in ring[:-1]]) > 0) == (k == 0) for part in parts for k, ring in enumerate(part))
        assert all(j / 2 <= x <= j / 2 + 0.5 and i / 2 <= y <= i / 2 + 0.5 for part in parts for ring in part for x, y in ring)
    assert len(json.loads(got["12_12"].text)["coordinates"]) == 2 and len(json.loads(got["0_27"].text)["coordinates"]) == 2 and len(json.loads(got["-9_-9"].text)["coordinates"]) == 2
    assert clipped_geometries(edges.limit(0), Grid(0.5)).count() == 0
