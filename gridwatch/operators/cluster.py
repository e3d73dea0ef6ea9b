"""Density clusters and their hulls."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwatch.operators.components import components
from gridwatch.sources.shared import materialize


#: Pairs of places that two boxes may have to be compared place by place, and places of a cell that one task compares.
PAIRS, CELL_PLACES = 4096, 10_000


def latest_window(points: DataFrame, hours: int = 24, at: str = "acquired_at") -> DataFrame:
    """The rows of the last `hours` before the newest row's time, both ends included."""
    last = points.agg(F.max(at).alias("_last"))
    return points.crossJoin(F.broadcast(last)).filter(F.col(at) >= F.col("_last") - F.make_interval(hours=F.lit(hours))).drop("_last")


def _square(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def _around(df: DataFrame, half: bool = False) -> DataFrame:
    """A row for each of the 5 x 5 cells around (i, j); half: for one of each two that lie opposite, without the cell itself."""
    steps = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if not half or (a, b) > (0, 0)]
    shift = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps])).alias("_s")
    return df.select("*", shift).withColumns({"i": F.col("i") + F.col("_s.a"), "j": F.col("j") + F.col("_s.b")}).drop("_s")


def _boxes(dense: DataFrame, side: float, level: int) -> DataFrame:
    """The places of dense cells in boxes of side / 2^level: bounds, places, and one of them to try."""
    small = side / 2**level
    held = dense.groupBy("node", F.floor(F.col("latitude") / small).alias("u"), F.floor(F.col("longitude") / small).alias("v"))
    return held.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("latitude", "longitude")).alias("one"),
        *[f(c).alias(k) for c, k, f in (("latitude", "y0", F.min), ("latitude", "y1", F.max), ("longitude", "x0", F.min), ("longitude", "x1", F.max))],
    )


def touching(dense: DataFrame, side: float, eps: float) -> DataFrame:
    """(a, b): neighbouring dense cells, by node, with places within eps of each other.

    dense: node, i, j, latitude, longitude. Boxes of two cells are left once their bounds are too far apart, and settle it where
    one place of each is near enough; the rest meet place by place if they are few, and else as boxes of half the side.
    """
    cells = materialize(_boxes(dense, side, 0).join(dense.select("node", "i", "j").distinct(), "node"), "cells")
    held = ["u", "v", "n", "one", "y0", "y1", "x0", "x1"]
    as_side = lambda df, k: df.select(F.col("node").alias(k), F.struct(*held).alias(f"_{k}"))
    left, right = (df.select("i", "j", F.col("node").alias(k), F.struct(*held).alias(f"_{k}")) for df, k in ((_around(cells, half=True), "a"), (cells, "b")))
    open_, found, level = left.join(right, ["i", "j"]).select("a", "b", "_a", "_b"), [], 0
    a, b = F.col("_a"), F.col("_b")
    gap = lambda p, q: F.greatest(F.lit(0.0), a[p] - b[q], b[p] - a[q])
    apart = gap("y0", "y1") * gap("y0", "y1") + gap("x0", "x1") * gap("x0", "x1")
    tried = _square(a["one"]["latitude"], b["one"]["latitude"]) + _square(a["one"]["longitude"], b["one"]["longitude"])
    while True:
        near = materialize(open_.filter(apart <= eps * eps), "near")
        sure = materialize(near.filter(tried <= eps * eps).select("a", "b").distinct(), "sure")
        left = near.join(sure, ["a", "b"], "left_anti")
        few = left.filter(a["n"] * b["n"] <= PAIRS)
        small = side / 2**level
        spots = dense.select("node", F.floor(F.col("latitude") / small).alias("u"), F.floor(F.col("longitude") / small).alias("v"), "latitude", "longitude")
        keyed = few.select("a", "b", a["u"].alias("ua"), a["v"].alias("va"), b["u"].alias("ub"), b["v"].alias("vb"))
        mine, theirs = (spots.select(F.col("node").alias(k), F.col("u").alias(f"u{k}"), F.col("v").alias(f"v{k}"), F.col("latitude").alias(f"y{k}"), F.col("longitude").alias(f"x{k}")) for k in "ab")
        both = keyed.join(mine, ["a", "ua", "va"]).join(theirs, ["b", "ub", "vb"])
        met = materialize(both.filter(_square(F.col("ya"), F.col("yb")) + _square(F.col("xa"), F.col("xb")) <= eps * eps).select("a", "b").distinct(), "met")
        found += [sure, met]
        left = left.filter(a["n"] * b["n"] > PAIRS).join(met, ["a", "b"], "left_anti")
        if not left.limit(1).count():
            break
        level += 1
        half = _boxes(dense, side, level)
        part = lambda k: as_side(half, k).withColumns({f"u{k}": F.shiftright(F.col(f"_{k}.u"), 1), f"v{k}": F.shiftright(F.col(f"_{k}.v"), 1)})  # noqa: B023, E731
        keyed = left.select("a", "b", a["u"].alias("ua"), a["v"].alias("va"), b["u"].alias("ub"), b["v"].alias("vb"))
        open_ = keyed.join(part("a"), ["a", "ua", "va"]).join(part("b"), ["b", "ub", "vb"]).select("a", "b", "_a", "_b")
    whole = found[0]
    for t in found[1:]:
        whole = whole.unionByName(t)
    return whole.distinct()


def dbscan(points: DataFrame, eps: float, min_points: int) -> DataFrame:
    """points (id, latitude, longitude) with cluster_id, -1 for noise.

    A place (distinct coordinates) is core if at least `min_points` points lie within eps, its own included.
    Clusters are components of core places; a border place goes to the least cluster among its core
    neighbours. cluster_id is the least point id of the component's core places. Points at one place are
    counted, not paired; coordinates that are null or not finite are noise.

    Places stand in cells whose diagonal is eps. A cell with `min_points` points is core as a whole and one node, so its places are
    never paired with each other; a cell with fewer has fewer places than `min_points`, and those meet the places of the
    24 cells around. Neighbouring dense cells are tied by `touching`. So work grows with the places, however dense.
    """
    side = eps / 2**0.5 * (1 - 1e-9)
    known = points.filter((F.abs("latitude") < float("inf")) & (F.abs("longitude") < float("inf")))  # a NaN is greater
    places = known.groupBy("latitude", "longitude").agg(F.min("id").alias("place"), F.count(F.lit(1)).alias("n"))
    places = materialize(places.withColumns({"i": F.floor(F.col("latitude") / side), "j": F.floor(F.col("longitude") / side)}), "places")
    cells = places.groupBy("i", "j").agg(F.min("place").alias("node"), (F.sum("n") >= min_points).alias("dense"), F.ceil(F.count(F.lit(1)) / CELL_PLACES).cast("int").alias("parts"))
    cells = materialize(cells, "cells")
    celled = materialize(places.join(cells, ["i", "j"]), "celled")
    part = F.pmod(F.xxhash64("place"), F.col("parts")).cast("int").alias("part")
    sparse = celled.filter("not dense").select("i", "j", F.col("place").alias("a"), F.col("latitude").alias("_y"), F.col("longitude").alias("_x"))
    asked = _around(sparse).join(cells.select("i", "j", "parts"), ["i", "j"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    met = asked.join(celled.select("i", "j", part, "latitude", "longitude", "n", F.when(F.col("dense"), F.col("node")).otherwise(F.col("place")).alias("to"), "dense"), ["i", "j", "part"])
    near = met.filter(_square(F.col("latitude"), F.col("_y")) + _square(F.col("longitude"), F.col("_x")) <= eps * eps)
    near = materialize(near.groupBy("a", "to", "dense").agg(F.sum("n").alias("n")), "near")
    core = materialize(near.groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_points).select(F.col("a").alias("node")), "core")
    ties = near.join(core.withColumnRenamed("node", "a"), "a", "left_semi")
    edges = ties.filter("dense").select("a", F.col("to").alias("b")).unionByName(ties.filter("not dense").join(core.withColumnRenamed("node", "to"), "to", "left_semi").select("a", F.col("to").alias("b")))
    edges = edges.unionByName(touching(celled.filter("dense").select("node", "i", "j", "latitude", "longitude"), side, eps))
    nodes = core.unionByName(cells.filter("dense").select("node"))
    label = materialize(nodes.join(components(edges), "node", "left").select("node", F.coalesce("comp", "node").alias("cluster_id")), "labels")
    reach = near.join(label, near["to"] == label["node"]).groupBy(F.col("a").alias("place")).agg(F.min("cluster_id").alias("border"))
    own = label.withColumnsRenamed({"node": "place", "cluster_id": "own"})
    single = celled.filter("not dense").join(own, "place", "left").join(reach, "place", "left").select("latitude", "longitude", F.coalesce("own", "border", F.lit(-1)).alias("cluster_id"))
    whole = celled.filter("dense").join(label, "node").select("latitude", "longitude", "cluster_id")
    return points.join(whole.unionByName(single), ["latitude", "longitude"], "left").fillna(-1, ["cluster_id"])


def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Convex hull counter-clockwise from the least point, by sorted chains."""
    spots = sorted(set(points))
    if len(spots) < 3:
        return spots

    def chain(order: list) -> list:
        out: list = []
        for p in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    return chain(spots) + chain(spots[::-1])


def hulls(clustered: DataFrame, eps: float, salts: int = 16) -> DataFrame:
    """cluster_id, ring_size, min and max coordinates, ring (lon, lat pairs) of each cluster.

    Hulls of salted parts come first, then the hull of those: no task holds a cluster's points. Fewer than
    three hull points give a box padded by eps / 2.
    """

    def part(frame: pd.DataFrame) -> pd.DataFrame:
        ring = hull(list(zip(frame["longitude"], frame["latitude"], strict=True)))
        return pd.DataFrame({"cluster_id": frame["cluster_id"].iloc[0], "longitude": [p[0] for p in ring], "latitude": [p[1] for p in ring]})

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        ring = hull(list(zip(frame["longitude"], frame["latitude"], strict=True)))
        if len(ring) < 3:
            (x0, x1), (y0, y1) = ((min(v) - eps / 2, max(v) + eps / 2) for v in zip(*ring, strict=True))
            ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        xs, ys = zip(*ring, strict=True)
        row = {"cluster_id": frame["cluster_id"].iloc[0], "ring_size": len(ring), "min_lon": min(xs), "min_lat": min(ys), "max_lon": max(xs), "max_lat": max(ys), "ring": [v for p in [*ring, ring[0]] for v in p]}
        return pd.DataFrame([row])

    salted = clustered.select("cluster_id", "longitude", "latitude").distinct().withColumn("salt", F.pmod(F.xxhash64("longitude", "latitude"), F.lit(salts)))
    parts = salted.groupBy("cluster_id", "salt").applyInPandas(part, "cluster_id long, longitude double, latitude double")
    return parts.groupBy("cluster_id").applyInPandas(whole, "cluster_id long, ring_size int, min_lon double, min_lat double, max_lon double, max_lat double, ring array<double>")
