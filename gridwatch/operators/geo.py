"""Polygons and cells as joins and expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridwatch.functions.grid import Grid

#: Edges that are sent along as one broadcast row; larger sets are joined by cells of CELL degrees.
MAX_EDGES = 20_000
CELL = 0.25


def crosses(lat: Column, lon: Column, e) -> Column:
    """Whether a ray to the east from the point meets the edge."""
    at = F.try_divide((e["x2"] - e["x1"]) * (lat - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
    return ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at)


def within_polygons(points: DataFrame, edges: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Points inside the outer ring (0) and outside all holes of some polygon. Null coordinates are outside. Edges are counted first."""
    if edges.limit(MAX_EDGES + 1).count() > MAX_EDGES:
        return within_cells(points, edges, lat, lon)
    ends = [f(F.least(a, b) if f is F.min else F.greatest(a, b)).alias(n) for f, a, b, n in ((F.min, "x1", "x2", "x0"), (F.min, "y1", "y2", "y0"), (F.max, "x1", "x2", "x9"), (F.max, "y1", "y2", "y9"))]
    wider = [f(n).alias(n) for f, n in ((F.min, "x0"), (F.min, "y0"), (F.max, "x9"), (F.max, "y9"))]
    rings = edges.groupBy("poly", "ring").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"), *ends)
    polys = rings.groupBy("poly").agg(F.collect_list(F.struct("ring", "edges")).alias("rings"), *wider)
    whole = polys.agg(F.collect_list("rings").alias("polys"), *wider)
    # One value of a subquery, not a row to join: as a join's condition the test may be moved to where the point's columns are not.
    y, x, t = F.col(lat), F.col(lon), F.col("_told")
    odd = lambda r: F.aggregate(r["edges"], F.lit(False), lambda s, e: s != crosses(y, x, e))
    inside = F.exists(t["polys"], lambda p: F.exists(p, lambda r: (r["ring"] == 0) & odd(r)) & ~F.exists(p, lambda r: (r["ring"] > 0) & odd(r)))
    # A subquery's value, not a joined row: Spark may move a nested lambda in a join's condition to where the point's columns are not.
    near = points.withColumn("_told", whole.select(F.struct("polys", "x0", "y0", "x9", "y9")).scalar())
    return near.filter(x.between(t["x0"], t["x9"]) & y.between(t["y0"], t["y9"]) & inside).drop("_told")


def edge_cells(edges: DataFrame, cell: float) -> DataFrame:
    """Each edge with the cells (i, j) that it passes through, or passes within a hair of."""
    hair = cell * 1e-9
    index = lambda v: F.floor(v / cell)
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("i", F.explode(F.sequence(index(low - hair), index(high + hair))))
    at = lambda y: F.coalesce(F.try_divide((F.col("x2") - F.col("x1")) * (y - F.col("y1")), F.col("y2") - F.col("y1")) + F.col("x1"), F.col("x1"))
    within = lambda v: F.least(F.greatest(v, low), high)
    ends = [at(within(F.col("i") * F.lit(cell) - hair)), at(within((F.col("i") + 1) * F.lit(cell) + hair))]
    level = F.col("y1") == F.col("y2")
    west = F.when(level, F.least("x1", "x2")).otherwise(F.least(*ends))
    east = F.when(level, F.greatest("x1", "x2")).otherwise(F.greatest(*ends))
    return rows.withColumn("j", F.explode(F.sequence(index(west - hair), index(east + hair))))


def inside_polygons(places: DataFrame, edges: DataFrame, cell: float = CELL) -> DataFrame:
    """(_lat, _lon, poly) of the distinct places (_lat, _lon) inside polygons, for any number of edges: a place meets only those of its own cell.

    What lies further east is carried as the parity of the crossings beyond the cell's lower right corner. A row of
    cells takes it from the edges that cross the row's lower side, counted by column and summed from the east, and
    runs of columns between crossings are written out cell by cell. From the corner to the place it changes with the edges
    between them; each edge tells its part as the place's crossing, the corner's, and its ends' side of the way. On closed rings
    the sum is the same as over all edges, also where an edge goes through the place or the corner. Rings must be closed.
    """
    size = F.lit(cell)
    index = lambda v: F.floor(v / cell)
    places = places.withColumns({"i": index(F.col("_lat")), "j": index(F.col("_lon"))})
    e = {k: F.col(k) for k in ("x1", "y1", "x2", "y2")}
    # Crossings of each row's lower side, by the last column whose right side lies west of them.
    lines = edges.filter("y1 <> y2").withColumn("i", F.explode(F.sequence(index(F.least("y1", "y2")), index(F.greatest("y1", "y2")))))
    y = F.col("i") * size
    at = F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]) + e["x1"]
    crossed = lines.filter((e["y1"] > y) != (e["y2"] > y)).select("poly", "ring", "i", at.alias("at"))
    k = index(F.col("at"))
    fit = k + F.when((k + 1) * size < F.col("at"), 1).otherwise(0) - F.when(k * size < F.col("at"), 0).otherwise(1)
    counted = crossed.groupBy("poly", "ring", "i", (fit - 1).alias("last")).agg((F.count(F.lit(1)) % 2).alias("odd")).filter("odd = 1")
    row = Window.partitionBy("poly", "ring", "i").orderBy(F.desc("last"))
    runs = counted.withColumns({"n": F.row_number().over(row), "next": F.lead("last").over(row)}).filter("n % 2 = 1")
    corners = runs.withColumn("j", F.explode(F.sequence(F.col("next") + 1, F.col("last")))).select("poly", "ring", "i", "j")
    east, below = (F.col("j") + 1) * size, F.col("i") * size
    beyond = lambda x, y: (x > east) & (y > below) & (y <= F.col("_lat"))
    turns = (crosses(F.col("_lat"), F.col("_lon"), e) != crosses(below, east, e)) != (beyond(e["x1"], e["y1"]) != beyond(e["x2"], e["y2"]))
    own = places.join(edge_cells(edges, cell), ["i", "j"]).filter(turns).select("_lat", "_lon", "poly", "ring")
    odd = own.unionByName(places.join(corners, ["i", "j"]).select("_lat", "_lon", "poly", "ring")).groupBy("_lat", "_lon", "poly", "ring").agg((F.count(F.lit(1)) % 2 == 1).alias("odd"))
    whole = odd.groupBy("_lat", "_lon", "poly").agg((F.max(F.col("odd") & (F.col("ring") == 0)) & ~F.max(F.col("odd") & (F.col("ring") > 0))).alias("inside"))
    return whole.filter("inside").select("_lat", "_lon", "poly")


def within_cells(points: DataFrame, edges: DataFrame, lat: str = "latitude", lon: str = "longitude", cell: float = CELL) -> DataFrame:
    """As `within_polygons`, for any number of edges, of closed rings."""
    places = points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).distinct()
    inside = inside_polygons(places, edges, cell).select("_lat", "_lon").distinct()
    return points.join(inside, (points[lat] == inside["_lat"]) & (points[lon] == inside["_lon"]), "left_semi")


def grid_product(spark, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """All cells from the box's lower corner to its upper one, inclusive (min_lon, min_lat, max_lon, max_lat)."""
    first = lambda v: int(v // grid.size)
    lats = spark.range(first(box[1]), first(box[3]) + 1).select(F.col("id").cast("int").alias("grid_lat_index"))
    lons = spark.range(first(box[0]), first(box[2]) + 1).select(F.col("id").cast("int").alias("grid_lon_index"))
    cells = lats.crossJoin(F.broadcast(lons))
    return cells.withColumns({"grid_id": F.concat_ws("_", "grid_lat_index", "grid_lon_index"), "grid_lat": F.round(F.col("grid_lat_index") * grid.size, 6), "grid_lon": F.round(F.col("grid_lon_index") * grid.size, 6)})


def touched_cells(cells: DataFrame, edges: DataFrame, grid: Grid) -> DataFrame:
    """The cells whose closed box meets some polygon: an edge passes through the box, or the box lies inside.

    An edge meets only the cells of its own bounding box, by an equality join on the indexes; a cell that no
    edge meets is inside or outside as a whole, so its corner decides. Degrees need not fill whole cells.
    """
    size = F.lit(grid.size)
    span = lambda a, b: F.explode(F.sequence((F.ceil(F.least(a, b) / size) - 1).cast("int"), F.floor(F.greatest(a, b) / size).cast("int")))
    parts = edges.withColumn("grid_lat_index", span("y1", "y2")).withColumn("grid_lon_index", span("x1", "x2"))
    both = cells.join(parts, ["grid_lat_index", "grid_lon_index"])
    enter, leave = [F.lit(0.0)], [F.lit(1.0)]  # where along the edge it is between two sides; level edges have no such place
    for a, b, index in (("x1", "x2", "grid_lon_index"), ("y1", "y2", "grid_lat_index")):
        low, high = (F.try_divide((F.col(index) + k) * size - F.col(a), F.col(b) - F.col(a)) for k in (0, 1))
        enter.append(F.least(low, high))
        leave.append(F.greatest(low, high))
    met = both.filter(F.greatest(*enter) <= F.least(*leave)).select("grid_id").distinct()
    rest = within_polygons(cells.join(met, "grid_id", "left_anti"), edges, "grid_lat", "grid_lon")
    return cells.join(met, "grid_id", "left_semi").unionByName(rest)


#: What a cell without observations has.
DEFAULTS = {"station_distance_km": 0.0, "weather_points_count": 1.0, "mean_ndvi_30days": 0.0}


def full_grid(edges: DataFrame, grid: Grid, box: tuple[float, float, float, float]) -> DataFrame:
    """The cells of `box` that touch the polygons, with DEFAULTS, sorted by their indexes."""
    touched = touched_cells(grid_product(edges.sparkSession, grid, box), edges, grid)
    return touched.withColumns({k: F.lit(v) for k, v in DEFAULTS.items()}).orderBy("grid_lat_index", "grid_lon_index")


def attach_cells(points: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    """Points with the cell that holds them, without those outside all cells: an equality join on the indexes."""
    return grid.with_cells(points).join(cells.select("grid_id"), "grid_id")
