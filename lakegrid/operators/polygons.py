"""Polygons with points and with polygons, over quadtree cells of several sizes; all as equi-joins.

A polygon is a set of edges (x0, y0, x1, y1) under a key; holes and parts count by parity. Its
cover is few cells whatever its size: inner cells, merged where they fill larger ones, need no
test; boundary cells carry the edges that a ray from within them to the east can meet. Two
polygons meet if edges of theirs do, or if one holds a vertex of the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spatial import crosses

#: Degrees of the largest cells; cells of the next level have a FOURTH of their side, down to DEEPEST.
LARGEST, FOURTH, DEEPEST = 64.0, 4, 10
#: A polygon's smallest cells: about one row of them for EDGES_A_ROW edges, between these numbers of rows over its larger side. Inner cells are merged so many times.
EDGES_A_ROW, FEWEST_ROWS, MOST_ROWS, MERGES = 16, 4, 32, 3
#: Degrees of the cells in which edges of two sides meet; those of over DENSE edges are cut into smaller ones.
MEETING, DENSE = 0.125, 256


def cell_size(level: Column) -> Column:
    """Degrees of a cell's side: a power of two, so that cell numbers are exact."""
    return LARGEST / F.pow(F.lit(float(FOURTH)), level)


def _levels(edges: DataFrame, key: str) -> DataFrame:
    """(key, level) of each polygon's smallest cells."""
    side = lambda v: F.max(F.greatest(f"{v}0", f"{v}1")) - F.min(F.least(f"{v}0", f"{v}1"))
    shape = edges.groupBy(key).agg(F.greatest(side("x"), side("y"), F.lit(1e-6)).alias("extent"), F.count("*").alias("n"))
    rows = F.greatest(F.lit(FEWEST_ROWS), F.least(F.lit(MOST_ROWS), F.col("n") / EDGES_A_ROW))
    level = F.ceil(F.log(LARGEST * rows / F.col("extent")) / F.log(F.lit(float(FOURTH))))
    return shape.select(key, F.greatest(F.lit(0), F.least(F.lit(DEEPEST), level)).cast("int").alias("level"))


def edge_cells(edges: DataFrame, size: Column) -> DataFrame:
    """edges with the cells (cx, cy) of that size they pass: row by row, the columns between the places where the edge enters and leaves it. In line with the edge's length, not its box."""
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    e = edges.withColumn("_g", size).withColumn("cy", F.explode(F.sequence(F.floor(low / F.col("_g")), F.floor(high / F.col("_g")))))
    # at the row's ends; where the edge is flat, its own ends
    at = lambda y: F.col("x0") + (F.col("x1") - F.col("x0")) * F.try_divide(y - F.col("y0"), F.col("y1") - F.col("y0"))
    ends = (F.coalesce(at(F.greatest(low, F.col("cy") * F.col("_g"))), F.col("x0")), F.coalesce(at(F.least(high, (F.col("cy") + 1) * F.col("_g"))), F.col("x1")))
    left, right = F.least("x0", "x1"), F.greatest("x0", "x1")
    held = lambda x: F.greatest(left, F.least(right, x))
    a, b = F.floor((F.least(*map(held, ends)) - 1e-9) / F.col("_g")), F.floor((F.greatest(*map(held, ends)) + 1e-9) / F.col("_g"))
    return e.withColumn("cx", F.explode(F.sequence(a, b))).drop("_g")


def cover(edges: DataFrame, key: str) -> DataFrame:
    """(key, level, cx, cy, edges): the cells of each polygon; edges is null for inner cells.

    Its box has at most about (4 MOST_ROWS)^2 smallest cells; with inner ones merged, cells are in
    line with its outline. Boundary cells carry the edges of their rows that reach to their east.
    """
    e = edges.select(key, "x0", "y0", "x1", "y1").join(_levels(edges, key), key)
    size = cell_size(F.col("level"))
    border = edge_cells(e, size).select(key, "level", "cx", "cy").distinct()
    by_row = e.withColumn("cy", F.explode(F.sequence(F.floor(F.least("y0", "y1") / size), F.floor(F.greatest("y0", "y1") / size))))
    ray = F.struct("x0", "y0", "x1", "y1")
    carried = border.join(by_row, [key, "level", "cy"]).filter(F.greatest("x0", "x1") >= F.col("cx") * size).groupBy(key, "level", "cx", "cy").agg(F.collect_list(ray).alias("edges"))
    # centres of a row lie inside between its crossings, taken two by two
    centre = (F.col("cy") + 0.5) * size
    lines = by_row.filter((F.col("y0") > centre) != (F.col("y1") > centre)).withColumn("x", F.col("x0") + (F.col("x1") - F.col("x0")) * (centre - F.col("y0")) / (F.col("y1") - F.col("y0")))
    lines = lines.groupBy(key, "level", "cy").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    spans = lines.withColumn("s", F.explode(F.expr("transform(sequence(0, size(xs) div 2 - 1), i -> struct(xs[2 * i] as a, xs[2 * i + 1] as b))")))
    spans = spans.withColumns({"c0": F.ceil(F.col("s.a") / size - 0.5), "c1": F.ceil(F.col("s.b") / size - 0.5) - 1}).filter("c0 <= c1")
    inner = spans.select(key, "level", F.explode(F.sequence("c0", "c1")).alias("cx"), "cy").join(border, [key, "level", "cx", "cy"], "left_anti")
    for _ in range(MERGES):  # sixteen that fill a larger cell are that cell
        up = [F.floor(F.col(c) / FOURTH).alias(c) for c in ("cx", "cy")]
        full = F.count("*").over(Window.partitionBy(key, "level", *(F.floor(F.col(c) / FOURTH) for c in ("cx", "cy")))) == FOURTH * FOURTH
        marked = inner.withColumn("full", full & (F.col("level") > 0))
        placed = [F.when(F.col("full"), to).otherwise(F.col(c)).alias(c) for c, to in (("level", F.col("level") - 1), *zip(("cx", "cy"), up, strict=True))]
        inner = marked.select(key, *placed).distinct()
    kind = carried.schema["edges"].dataType
    return carried.union(inner.withColumn("edges", F.lit(None).cast(kind)))


def containing(points: DataFrame, edges: DataFrame, key: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """points with the key of every polygon of edges that holds them, a row each. A point is looked up once for each level in use, of which there are DEEPEST + 1 at most."""
    finest = [r.level for r in _levels(edges, key).select("level").distinct().collect()]
    levels = sorted({k for level in finest for k in range(max(0, level - MERGES), level + 1)}) or [0]
    at = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    size = cell_size(F.col("_level"))
    at = at.withColumns({"_cx": F.floor(F.col(lon) / size), "_cy": F.floor(F.col(lat) / size)})
    cells = cover(edges, key).withColumnsRenamed({c: f"_{c}" for c in ("level", "cx", "cy", "edges")})
    odd = F.size(F.filter("_edges", lambda e: crosses(e, F.col(lon), F.col(lat)))) % 2 == 1
    return at.join(cells, ["_level", "_cx", "_cy"]).filter(F.col("_edges").isNull() | odd).drop("_level", "_cx", "_cy", "_edges")


def _side(p: str, q: str, r: str) -> Column:
    """On which side of the line from p to q the point r lies; points are names of (x, y) columns' ends."""
    (ax, ay), (bx, by), (cx, cy) = ((F.col(f"{t[0]}.x{t[1]}"), F.col(f"{t[0]}.y{t[1]}")) for t in (p, q, r))
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def segments_meet() -> Column:
    """Whether the closed segments of the aliases a and b share a point."""
    boxes = [F.least(f"{s}.{v}0", f"{s}.{v}1") <= F.greatest(f"{o}.{v}0", f"{o}.{v}1") for v in "xy" for s, o in ("ab", "ba")]
    apart = (_side("a0", "a1", "b0") * _side("a0", "a1", "b1") <= 0) & (_side("b0", "b1", "a0") * _side("b0", "b1", "a1") <= 0)
    return boxes[0] & boxes[1] & boxes[2] & boxes[3] & apart


def _dealt(edges: DataFrame, key: str, dense: DataFrame | None) -> DataFrame:
    """Edges by the cells in which they meet others; dense cells are cut into 16^depth."""
    e = edge_cells(edges.select(key, "x0", "y0", "x1", "y1"), F.lit(MEETING))
    if dense is None:
        return e.withColumn("depth", F.lit(0))
    e = e.join(dense, ["cx", "cy"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    whole = e.filter("depth = 0").select(key, "x0", "y0", "x1", "y1", "depth", "cx", "cy")
    deep = e.filter("depth > 0").withColumnsRenamed({"cx": "bx", "cy": "by"})
    parts = F.pow(F.lit(float(FOURTH)), F.col("depth"))
    deep = edge_cells(deep, MEETING / parts).filter((F.floor(F.col("cx") / parts) == F.col("bx")) & (F.floor(F.col("cy") / parts) == F.col("by")))
    return whole.union(deep.select(whole.columns))


def edges_meet(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """(a_key, b_key) of polygons of which two edges meet."""
    both = a.select("x0", "y0", "x1", "y1").union(b.select("x0", "y0", "x1", "y1"))
    counts = edge_cells(both, F.lit(MEETING)).groupBy("cx", "cy").agg(F.count("*").alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    dense = None if most <= DENSE else counts.filter(F.col("n") > DENSE).select("cx", "cy", F.least(F.lit(4), F.ceil(F.log(F.col("n") / DENSE) / F.log(F.lit(float(FOURTH * FOURTH))))).cast("int").alias("depth"))
    x, y = _dealt(a, a_key, dense).alias("a"), _dealt(b, b_key, dense).alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("depth", "cx", "cy")]
    return x.join(y, same[0] & same[1] & same[2]).filter(segments_meet()).select(F.col(f"a.{a_key}").alias(a_key), F.col(f"b.{b_key}").alias(b_key)).distinct()


def vertices(edges: DataFrame, key: str) -> DataFrame:
    """A vertex (lon, lat) of each ring, where edges name theirs (column ring); else every vertex."""
    of = edges.select(key, F.col("x0").alias("lon"), F.col("y0").alias("lat"), *(["ring"] if "ring" in edges.columns else []))
    return of.groupBy(key, "ring").agg(F.min(F.struct("lon", "lat")).alias("corner")).select(key, "corner.lon", "corner.lat") if "ring" in edges.columns else of


def meeting(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """(a_key, b_key), once each, of the polygons of two edge tables that share a point: edges meet, or one holds a ring of the other."""
    held = containing(vertices(a, a_key), b, b_key).select(a_key, b_key)
    holds = containing(vertices(b, b_key), a, a_key).select(a_key, b_key)
    return edges_meet(a, b, a_key, b_key).union(held).union(holds).distinct()


def box_edges(boxes: DataFrame, key: str) -> DataFrame:
    """The edges of boxes (key, xmin, ymin, xmax, ymax) as polygons."""
    corner = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax")]
    sides = [F.struct(F.col(p[0]).alias("x0"), F.col(p[1]).alias("y0"), F.col(q[0]).alias("x1"), F.col(q[1]).alias("y1")) for p, q in zip(corner, corner[1:] + corner[:1], strict=True)]
    return boxes.select(key, F.lit(0).alias("ring"), F.explode(F.array(*sides)).alias("e")).select(key, "ring", "e.*")
