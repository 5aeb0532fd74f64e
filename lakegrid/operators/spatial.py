"""Spatial joins: equi-joins on coarse cells, then exact predicates as expressions.

A polygon is a set of edges (x0, y0, x1, y1); holes and parts count by parity. Each cell of
CELL degrees carries the lakes that reach into it, each with only its edges of the cell's
latitude band, so a point meets few edges however large its lake is, and nothing is crossed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import isin
from ..sources.tables import SMALL, stored

CELL = 0.1


def cell(x: Column) -> Column:
    return F.floor(x / CELL).cast("int")


def _covered(low: Column, high: Column) -> Column:
    return F.explode(F.sequence(cell(low), cell(high)))


def crosses(e: Column, lon: Column, lat: Column) -> Column:
    """Whether the edge passes east of the point at its latitude; an edge owns its lower end."""
    return ((e["y0"] > lat) != (e["y1"] > lat)) & (lon < (e["x1"] - e["x0"]) * F.try_divide(lat - e["y0"], e["y1"] - e["y0"]) + e["x0"])


def lake_bounds(edges: DataFrame, *keys: str) -> DataFrame:
    return edges.groupBy("hylak_id", *keys).agg(F.min(F.least("x0", "x1")).alias("xmin"), F.min(F.least("y0", "y1")).alias("ymin"), F.max(F.greatest("x0", "x1")).alias("xmax"), F.max(F.greatest("y0", "y1")).alias("ymax"))


def lake_cells(edges: DataFrame) -> DataFrame:
    """(gx, gy, lakes): per cell its lakes in order, each with bounds and the edges of the cell's latitude band."""
    bands = edges.withColumn("gy", _covered(F.least("y0", "y1"), F.greatest("y0", "y1"))).groupBy("hylak_id", "gy").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))
    reach = lake_bounds(edges, "lake_order").withColumn("gx", _covered(F.col("xmin"), F.col("xmax")))
    found = reach.join(bands, "hylak_id")
    return found.groupBy("gx", "gy").agg(F.array_sort(F.collect_list(F.struct("lake_order", "hylak_id", "xmin", "ymin", "xmax", "ymax", "edges"))).alias("lakes"))


def lake_table(edges: DataFrame) -> DataFrame:
    """lake_cells stored once, marked for broadcast if they hold SMALL edges at most (48 MB)."""
    cells = stored(lake_cells(edges))
    n = cells.select(F.sum(F.aggregate("lakes", F.lit(0), lambda s, p: s + F.size(p["edges"])))).first()[0] or 0
    return F.broadcast(cells) if n <= SMALL else cells


def assign_lake(points: DataFrame, edges: DataFrame, lon: str = "lon", lat: str = "lat", cells: DataFrame | None = None) -> DataFrame:
    """points with hylak_id of the first lake, in order, that strictly contains each; null for none. One equi-join; no group is formed per point. cells: the lakes' cells, where they are at hand."""
    x, y = F.col(lon), F.col(lat)
    keyed = points.withColumns({"gx": cell(x), "gy": cell(y)}).join(lake_cells(edges) if cells is None else cells, ["gx", "gy"], "left")
    inside = F.filter("lakes", lambda p: (x >= p["xmin"]) & (x <= p["xmax"]) & (y >= p["ymin"]) & (y <= p["ymax"]) & (F.size(F.filter(p["edges"], lambda e: crosses(e, x, y))) % 2 == 1))
    return keyed.withColumn("hylak_id", F.get(inside, F.lit(0))["hylak_id"]).drop("gx", "gy", "lakes")


def boxes_meet(a: str, b: str) -> Column:
    c = lambda t, n: F.col(f"{t}.{n}")
    return (c(a, "xmin") <= c(b, "xmax")) & (c(b, "xmin") <= c(a, "xmax")) & (c(a, "ymin") <= c(b, "ymax")) & (c(b, "ymin") <= c(a, "ymax"))


def box_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """(left_key, right_key) of boxes that meet: an equi-join on covered cells, each pair kept in one cell only."""
    a = left.withColumns({"gx": _covered(F.col("xmin"), F.col("xmax"))}).withColumn("gy", _covered(F.col("ymin"), F.col("ymax"))).alias("a")
    b = right.withColumns({"gx": _covered(F.col("xmin"), F.col("xmax"))}).withColumn("gy", _covered(F.col("ymin"), F.col("ymax"))).alias("b")
    found = a.join(b, (F.col("a.gx") == F.col("b.gx")) & (F.col("a.gy") == F.col("b.gy"))).filter(boxes_meet("a", "b"))
    own = (F.col("a.gx") == cell(F.greatest("a.xmin", "b.xmin"))) & (F.col("a.gy") == cell(F.greatest("a.ymin", "b.ymin")))
    return found.filter(own).select(F.col(f"a.{left_key}").alias(left_key), F.col(f"b.{right_key}").alias(right_key))


def _segment_meets_box(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Liang-Barsky: a part of the segment lies within the box."""
    dx, dy = e["x1"] - e["x0"], e["y1"] - e["y0"]

    def span(d, p, lo, hi):
        a, b = F.try_divide(lo - p, d), F.try_divide(hi - p, d)
        near = F.when(d == 0, F.when((p >= lo) & (p <= hi), 0.0).otherwise(2.0)).otherwise(F.least(a, b))
        far = F.when(d == 0, F.when((p >= lo) & (p <= hi), 1.0).otherwise(-1.0)).otherwise(F.greatest(a, b))
        return near, far

    (nx, fx), (ny, fy) = span(dx, e["x0"], x0, x1), span(dy, e["y0"], y0, y1)
    return F.greatest(F.lit(0.0), nx, ny) <= F.least(F.lit(1.0), fx, fy)


def box_lakes(boxes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, hylak_id) of boxes and lakes that intersect: an edge meets the box, or the lake holds the box's corner."""
    pairs = box_join(boxes, lake_bounds(edges), key, "hylak_id")
    outlines = edges.groupBy("hylak_id").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))
    full = pairs.join(boxes.select(key, "xmin", "ymin", "xmax", "ymax"), key).join(outlines, "hylak_id")
    touch = F.exists("edges", lambda e: _segment_meets_box(e, F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")))
    holds = F.size(F.filter("edges", lambda e: crosses(e, F.col("xmin"), F.col("ymin")))) % 2 == 1
    return full.filter(touch | holds).select(key, "hylak_id")


def polygon_bins(edges: DataFrame, wrapped: bool = True) -> DataFrame:
    """(hylak_id, bin_row, bin_col, bin) of grid bins whose centre lies inside, by scanlines: edges are split over the grid rows they cross, a row's crossings pair up, and the columns between are listed.

    Columns past 180 degrees go on from the west end of their row; unless wrapped they are counted on, as are their numbers.
    """
    n = float(isin.N_ROWS)
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    first = F.ceil((low + 90.0) * n / 180.0 - 0.5).cast("int")
    last = (F.ceil((high + 90.0) * n / 180.0 - 0.5) - 1).cast("int")
    rows = edges.filter("y0 <> y1").withColumns({"r0": first - 1, "r1": last + 1}).withColumn("bin_row", F.explode(F.sequence("r0", "r1")))
    rows = rows.withColumn("lat", isin.centre_lat(F.col("bin_row"))).filter((F.col("y0") > F.col("lat")) != (F.col("y1") > F.col("lat")))
    rows = rows.withColumn("x", (F.col("x1") - F.col("x0")) * (F.col("lat") - F.col("y0")) / (F.col("y1") - F.col("y0")) + F.col("x0"))
    lines = rows.groupBy("hylak_id", "bin_row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    spans = lines.select("hylak_id", "bin_row", isin.bins_in_row(F.col("bin_row")).alias("n"), F.explode(F.expr("transform(sequence(0, size(xs) div 2 - 1), i -> struct(xs[2 * i] as a, xs[2 * i + 1] as b))")).alias("s"))
    # a column's centre is inside where a <= centre < b, as the edge rule has it
    spans = spans.withColumns({"c0": F.ceil((F.col("s.a") + 180.0) / 360.0 * F.col("n") - 0.5), "c1": F.ceil((F.col("s.b") + 180.0) / 360.0 * F.col("n") - 0.5) - 1})
    bins = spans.filter("c0 <= c1").select("hylak_id", "bin_row", "n", F.explode(F.sequence("c0", "c1")).alias("c"))
    bins = bins.select("hylak_id", "bin_row", (F.pmod("c", "n") if wrapped else F.col("c")).alias("bin_col"))
    rows_ = isin.rows_table(edges.sparkSession).select(F.col("row").alias("bin_row"), "before")
    return bins.join(F.broadcast(rows_), "bin_row").select("hylak_id", "bin_row", "bin_col", isin.bin_key(F.col("before"), F.col("bin_col")).alias("bin")).distinct()


#: Lines across a lake on which its widest run is looked for.
LINES = 15


def interior_points(edges: DataFrame) -> DataFrame:
    """(hylak_id, lon, lat) strictly inside each lake: the middle of its widest run over LINES level lines (ties: the lowest, then the most westerly). Holes and parts count by parity; a lake without height has none."""
    shape = lake_bounds(edges).select("hylak_id", "ymin", ((F.col("ymax") - F.col("ymin")) / LINES).alias("step"))
    e = edges.join(shape, "hylak_id").filter("y0 <> y1")
    line = lambda y: F.floor((y - F.col("ymin")) / F.col("step"))
    e = e.withColumn("k", F.explode(F.sequence(line(F.least("y0", "y1")), line(F.greatest("y0", "y1"))))).filter(F.col("k") < LINES)
    e = e.withColumn("lat", F.col("ymin") + (F.col("k") + 0.5) * F.col("step")).filter((F.col("y0") > F.col("lat")) != (F.col("y1") > F.col("lat")))
    e = e.withColumn("x", F.col("x0") + (F.col("x1") - F.col("x0")) * (F.col("lat") - F.col("y0")) / (F.col("y1") - F.col("y0")))
    runs = e.groupBy("hylak_id", "lat").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    runs = runs.select("hylak_id", "lat", F.explode(F.expr("transform(sequence(0, size(xs) div 2 - 1), i -> struct(xs[2 * i] as a, xs[2 * i + 1] as b))")).alias("r"))
    best = runs.groupBy("hylak_id").agg(F.max_by(F.struct(((F.col("r.a") + F.col("r.b")) / 2).alias("lon"), "lat"), F.struct(F.col("r.b") - F.col("r.a"), -F.col("lat"), -F.col("r.a"))).alias("p"))
    return best.select("hylak_id", "p.lon", "p.lat")


def merge_boxes(boxes: DataFrame, group: str, key: str) -> DataFrame:
    """(group, key, part): boxes of one group that overlap, directly or through others, share a part, by least labels."""
    cells = boxes.withColumn("gx", _covered(F.col("xmin"), F.col("xmax"))).withColumn("gy", _covered(F.col("ymin"), F.col("ymax")))
    a, b = cells.alias("a"), cells.alias("b")
    near = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col("a.gx") == F.col("b.gx")) & (F.col("a.gy") == F.col("b.gy"))).filter(boxes_meet("a", "b"))
    near = near.select(F.col(f"a.{group}").alias(group), F.col(f"a.{key}").alias(key), F.col(f"b.{key}").alias("other")).distinct()
    labels = boxes.select(group, key, F.col(key).alias("part"))
    while True:
        seen = labels.select(group, F.col(key).alias("other"), F.col("part").alias("near"))
        new = near.join(seen, [group, "other"]).groupBy(group, key).agg(F.min("near").alias("part"))
        new = stored(new)
        if new.exceptAll(labels).isEmpty():
            return new
        labels = new


def plan_windows(scenes: DataFrame, lakes: DataFrame, pairs: DataFrame, km: float = 3.0, most: int = 6, fraction: float = 0.35) -> DataFrame:
    """Processing windows (scene_no, xmin, ymin, xmax, ymax), nulls for a whole scene.

    A scene's lakes, widened by km, merge where they overlap and are clipped to the scene.
    The whole scene is taken instead if it has no lake, more windows than most, windows over
    a fraction of its area or more, or spans over 170 degrees.
    """
    from ..functions.names import expand_box

    wide = dict(zip(("xmin", "ymin", "xmax", "ymax"), expand_box(*(F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")), km), strict=True))
    boxes = pairs.join(lakes.select("hylak_id", "xmin", "ymin", "xmax", "ymax"), "hylak_id").withColumns(wide)
    parts = merge_boxes(boxes, "scene_no", "hylak_id").join(boxes, ["scene_no", "hylak_id"])
    parts = parts.groupBy("scene_no", "part").agg(F.min("xmin").alias("x0"), F.min("ymin").alias("y0"), F.max("xmax").alias("x1"), F.max("ymax").alias("y1")).join(scenes.select("scene_no", "xmin", "ymin", "xmax", "ymax"), "scene_no")
    clip = parts.select("scene_no", F.greatest("x0", "xmin").alias("x0"), F.greatest("y0", "ymin").alias("y0"), F.least("x1", "xmax").alias("x1"), F.least("y1", "ymax").alias("y1"), ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area")).filter("x0 < x1 and y0 < y1")
    w = Window.partitionBy("scene_no")
    kept = clip.withColumns({"n": F.count("*").over(w), "share": F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).over(w) / F.greatest(F.col("area"), F.lit(1e-9))})
    kept = kept.filter((F.col("n") <= most) & (F.col("share") < fraction)).select("scene_no", "x0", "y0", "x1", "y1")
    narrow = scenes.filter(F.col("xmax") - F.col("xmin") <= 170).select("scene_no")
    found = kept.join(narrow, "scene_no", "left_semi")
    return scenes.select("scene_no").join(found, "scene_no", "left").select("scene_no", F.col("x0").alias("xmin"), F.col("y0").alias("ymin"), F.col("x1").alias("xmax"), F.col("y1").alias("ymax"))


def lakes_for_window(windows: DataFrame, lakes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, hylak_id) of windows and the lakes that touch them; a window without bounds (the whole scene) takes all lakes, by a broadcast of its key alone. Few windows are whole scenes."""
    whole = windows.filter("xmin is null").select(key)
    return box_lakes(windows.filter("xmin is not null"), edges, key).union(lakes.select("hylak_id").join(F.broadcast(whole)).select(key, "hylak_id"))


def shore_distance(points: DataFrame, edges: DataFrame) -> DataFrame:
    """points (hylak_id, lon, lat, ...) with metres to their lake's nearest edge, in a plane about each point."""
    degree = 6371000.0 * 3.141592653589793 / 180.0
    outlines = edges.groupBy("hylak_id").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"))
    wide = degree * F.cos(F.radians("lat"))
    # a pass over the edges for each step, so that no value is worked out twice
    named = lambda **of: F.struct(*(v.alias(k) for k, v in of.items()))
    e = F.transform("edges", lambda e: named(ax=(e["x0"] - F.col("lon")) * F.col("_wide"), ay=(e["y0"] - F.col("lat")) * degree, bx=(e["x1"] - F.col("lon")) * F.col("_wide"), by=(e["y1"] - F.col("lat")) * degree))
    e = F.transform(e, lambda e: named(ax=e["ax"], ay=e["ay"], dx=e["bx"] - e["ax"], dy=e["by"] - e["ay"]))
    nearest = lambda e: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(-(e["ax"] * e["dx"] + e["ay"] * e["dy"]), e["dx"] * e["dx"] + e["dy"] * e["dy"]), F.lit(0.0))))
    e = F.transform(e, lambda e: named(ax=e["ax"], ay=e["ay"], dx=e["dx"], dy=e["dy"], t=nearest(e)))
    e = F.transform(e, lambda e: named(x=e["ax"] + e["t"] * e["dx"], y=e["ay"] + e["t"] * e["dy"]))
    e = F.transform(e, lambda e: F.sqrt(e["x"] * e["x"] + e["y"] * e["y"]))
    return points.join(outlines, "hylak_id").withColumn("_wide", wide).withColumn("metres", F.array_min(e)).drop("edges", "_wide")


def shore_buffer(points: DataFrame, edges: DataFrame, metres: float) -> DataFrame:
    """Points of lakes at least that far from the shore; all for 0."""
    return points if metres <= 0 else shore_distance(points, edges).filter(F.col("metres") >= metres).drop("metres")
