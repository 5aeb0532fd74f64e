"""Polygons with points and with polygons against plain loops, over shapes of very different sizes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lakegrid.operators import polygons as O

EDGES = "long, ring int, x0 double, y0 double, x1 double, y1 double"


def star(rng, x, y, radius, n, least=0.4):
    """A tilted, dented polygon about a point."""
    turn = rng.random() * 6
    at = [(turn + 2 * math.pi * k / n, radius * rng.uniform(least, 1.0)) for k in range(n)]
    ring = [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in at]
    return list(zip(ring, ring[1:] + ring[:1], strict=True))


def inside(edges, x, y):
    return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges) % 2 == 1


def side(p, q, r):
    d = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (d > 0) - (d < 0)


def touch(e, f):
    boxes = all(min(a[0][k], a[1][k]) <= max(b[0][k], b[1][k]) for k in (0, 1) for a, b in ((e, f), (f, e)))
    return boxes and side(*e, f[0]) * side(*e, f[1]) <= 0 and side(*f, e[0]) * side(*f, e[1]) <= 0


def meet(a, b):
    return any(touch(e, f) for e in a for f in b) or any(inside(b, *e[0]) for e in a) or any(inside(a, *e[0]) for e in b)


def frame(spark, shapes, key):
    rows = [(k, ring, *p, *q) for k, rings in shapes.items() for ring, edges in enumerate(rings) for p, q in edges]
    return spark.createDataFrame(rows, f"{key} {EDGES}").repartition(3)


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(11)
    a = {k: [star(rng, rng.uniform(-84, -83), rng.uniform(45, 46), 10 ** rng.uniform(-2.5, -0.3), rng.choice((3, 5, 40)))] for k in range(40)}
    b = {100 + k: [star(rng, rng.uniform(-84, -83), rng.uniform(45, 46), 10 ** rng.uniform(-2, 0.2), rng.choice((4, 300)))] for k in range(12)}
    b[200] = [star(rng, -83.5, 45.5, 3.0, 600, 0.99), star(rng, -83.5, 45.5, 0.9, 12)]  # with a hole that holds smaller ones
    a[300] = [star(rng, -83.5, 45.5, 0.02, 6)]
    b[400] = [star(rng, 10.0, -5.0, 0.5, 8), star(rng, 179.0, 5.0, 0.5, 8)]  # two parts far apart
    return a, b


def test_cover_and_points(spark, shapes):
    """Every point is found in the polygons that hold it; cells are few, none twice, and none within another."""
    _, b = shapes
    edges = frame(spark, b, "k")
    rng = random.Random(12)
    points = [(i, rng.uniform(-85, -82), rng.uniform(44, 47)) for i in range(3000)] + [(9000, 10.0, -5.0), (9001, 179.0, 5.0), (9002, 50.0, 50.0)]
    got = {(r.id, r.k) for r in O.containing(spark.createDataFrame(points, "id long, lon double, lat double"), edges, "k").collect()}
    assert got == {(i, k) for i, x, y in points for k, rings in b.items() if inside([e for ring in rings for e in ring], x, y)}
    cells = O.cover(edges, "k").select("k", "level", "cx", "cy", F.col("edges").isNull().alias("inner")).collect()
    assert len({(r.k, r.level, r.cx, r.cy) for r in cells}) == len(cells)
    own = {(r.k, r.level, r.cx, r.cy) for r in cells}
    assert not any((r.k, r.level - u, r.cx // 4**u, r.cy // 4**u) in own for r in cells for u in (1, 2, 3))
    assert {r.level for r in cells if r.k == 200 and r.inner} != {r.level for r in cells if r.k == 200 and not r.inner}  # large inner cells
    assert sum(r.k == 200 for r in cells) < 64 * O.MOST_ROWS  # of about 130^2 in its box


@pytest.mark.parametrize("dense", [256, 4])
def test_meeting_polygons(spark, shapes, dense, monkeypatch):
    """Crossing, touching, one within the other, in a hole, apart; with dense cells cut too."""
    monkeypatch.setattr(O, "DENSE", dense)
    a, b = shapes
    whole = lambda rings: [e for ring in rings for e in ring]
    got = O.meeting(frame(spark, a, "i"), frame(spark, b, "k"), "i", "k").collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == {(i, k) for i, x in a.items() for k, y in b.items() if meet(whole(x), whole(y))}


def test_flat_edges_and_boxes(spark):
    """Boxes that share an edge, a corner, or nothing."""
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 1.0, 0.0, 2.0, 1.0), (3, 1.0, 1.0, 2.0, 2.0), (4, 1.5, 3.0, 2.0, 4.0), (5, 0.25, 0.25, 0.75, 0.75)], "i long, xmin double, ymin double, xmax double, ymax double")
    edges = O.box_edges(boxes, "i")
    got = {(r.i, r.k) for r in O.meeting(edges, edges.withColumnRenamed("i", "k"), "i", "k").collect()}
    near = {(1, 2), (1, 3), (2, 3), (1, 5)}
    assert got == near | {(b, a) for a, b in near} | {(k, k) for k in range(1, 6)}
    assert O.meeting(edges.limit(0), edges.withColumnRenamed("i", "k"), "i", "k").collect() == []
