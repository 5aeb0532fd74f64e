"""Hand-computed cases, properties and streams."""

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakegrid.functions import bands as B
from lakegrid.functions import isin
from lakegrid.functions import names as N
from lakegrid.operators import catalogue as C
from lakegrid.operators import daily as D
from lakegrid.operators import overlap as O
from lakegrid.operators import spatial as P
from lakegrid.plans import grid_queries as G
from lakegrid.plans.fixtures import view
from lakegrid.sources import tables as T
from lakegrid.streaming import jobs

SF = "/root/testdata/sf0.001"


def one(df):
    return df.collect()[0]


def test_bands_and_flags(spark):
    assert B.nearest_band(["rhos_884", "rhos_865"], "rhos_", 885, 30) == "rhos_884"
    assert B.nearest_band(["rhos_400"], "rhos_", 443, 5) is None
    with pytest.raises(ValueError):
        B.flag_map(["A"], [1, 2])
    assert B.unpack_range(None, 10, 0.5, 1) == (-float("inf"), 6.0)
    r = one(spark.range(1).select(B.flag_is_set(F.lit(5), {"X": 4}, "X").alias("x"), B.flag_is_set(F.lit(5), {}, "Y").alias("y")))
    assert r.x and not r.y


def test_detection_limit_differs_by_side(spark):
    v = F.lit(B.DETECTION_LIMIT)
    r = one(spark.range(1).select(B.ci_to_dn(v, F.lit(True)).alias("at"), B.ci_to_dn(F.lit(0.0), F.lit(True)).alias("zero"), B.ci_to_dn(v, F.lit(False)).alias("bad"), B.ci_to_dn(F.lit(1e9), F.lit(True)).alias("top")))
    assert (r["at"], r.zero, r.bad, r.top) == (1, 0, 255, 253)


def cloud_of(spark, albedo, **bands):
    base = {443: 0.01, 490: 0.01, 560: 0.01, 620: 0.01, 665: 0.01, 681: 0.01, 709: 0.01, 754: 0.01, 865: 0.01}
    base |= {int(k[1:]): v for k, v in bands.items()}
    lit = lambda x: F.lit(x).cast("float")
    return one(spark.range(1).select(B.cloud({w: lit(v) for w, v in base.items()}, lit(albedo)).alias("c"))).c


def test_cloud_cases(spark):
    assert not cloud_of(spark, 0.02)
    assert cloud_of(spark, 0.2, r443=0.2, r490=0.2, r560=0.2, r620=0.2, r665=0.2, r681=0.2, r709=0.2, r754=0.2, r865=0.2)
    assert not cloud_of(spark, 0.2, r443=-0.01)
    assert not cloud_of(spark, 0.09, r560=0.05, r709=0.06, r754=0.07)  # scum with a green peak
    assert cloud_of(spark, None, r865=0.09)  # 865 nm stands in for a missing albedo


def test_mph_ties_take_the_first_peak(spark):
    m, at = B.mph(*(F.lit(x) for x in (0.0, 0.5, 0.5, 0.5, 0.0)))
    assert one(spark.range(1).select(at.alias("w"))).w == 681.0


def test_grid_totals_and_round_trip(spark):
    rows = isin.rows_table(spark)
    r = one(rows.agg(F.sum("n").alias("n"), F.max("n").alias("m"), F.sum(isin.bin_area(F.col("row")) * F.col("n")).alias("area")))
    assert (r.n, r.m) == (6_082_996_640, 138_240)
    assert abs(r.area / (4 * 3.141592653589793 * isin.RADIUS**2) - 1) < 1e-9
    p = spark.range(20_000).select((F.rand(1) * 360 - 180).alias("lon"), (F.rand(2) * 180 - 90).alias("lat"))
    b = isin.with_bin(p)
    back = isin.with_row_col(b.withColumnsRenamed({"bin_row": "r", "bin_col": "c"}))
    assert back.filter("bin_row <> r or bin_col <> c").count() == 0 and back.count() == 20_000
    centre = b.select(isin.centre_lon(F.col("bin_row"), F.col("bin_col")).alias("lon"), isin.centre_lat(F.col("bin_row")).alias("lat"), F.col("bin").alias("want"))
    assert isin.with_bin(centre).filter("bin <> want").count() == 0
    assert one(isin.with_bin(spark.createDataFrame([(0.0, 99.0)], "lon double, lat double"))).bin == 0


def test_albers_round_trip(spark):
    q = G.e_albers(spark, SF)
    assert q.filter("not lon_back or not lat_back").count() == 0


def test_footprints_conserve_area(spark):
    q = G.d_footprint_overlap(spark, SF)
    assert q.count() > 0 and q.filter("not conserved").count() == 0


def test_aligned_footprint_is_its_bin(spark):
    """A footprint of exactly one bin lies in that bin alone."""
    row = 52000
    step = isin.RADIUS * 3.141592653589793 / isin.N_ROWS
    c = spark.range(1).select(isin.centre_lat(F.lit(row)).alias("lat"), isin.centre_lon(F.lit(row), F.lit(1000)).alias("lon"), isin.bins_in_row(F.lit(row)).alias("n"))
    c = c.withColumn("lon0", F.col("lon"))
    x, y = isin.project(F.col("lon"), F.col("lat"), F.col("lon0"))
    width = isin.RADIUS * F.cos(F.radians("lat")) * 2 * 3.141592653589793 / F.col("n")
    c = c.withColumns({"x": x, "y": y, "ax": F.lit(0.0), "ay": F.lit(-step * 0.999), "bx": width * 0.999, "by": F.lit(0.0)})
    got = O.footprint_overlaps(c, []).collect()
    assert len(got) == 1 and (got[0].bin_row, got[0].bin_col) == (row, 1000)


def test_first_lake_in_order_wins(spark):
    def box(i, order, x0, x1):
        return [(i, order, x0, 0.0, x0, 1.0), (i, order, x0, 1.0, x1, 1.0), (i, order, x1, 1.0, x1, 0.0), (i, order, x1, 0.0, x0, 0.0)]

    e = spark.createDataFrame(box(7, 2, 0.0, 0.6) + box(9, 1, 0.4, 1.0), "hylak_id long, lake_order long, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame([(0.2, 0.5), (0.5, 0.5), (0.8, 0.5), (1.5, 0.5), (None, 0.5)], "lon double, lat double")
    assert [r.hylak_id for r in P.assign_lake(p, e).orderBy("lon").collect()] == [None, 7, 9, 9, None]


def test_polygon_bins_over_the_date_line(spark):
    x0, x1, y0, y1 = 179.995, 180.005, 10.0, 10.006
    e = spark.createDataFrame([(1, 1, x0, y0, x1, y0), (1, 1, x1, y0, x1, y1), (1, 1, x1, y1, x0, y1), (1, 1, x0, y1, x0, y0)], "hylak_id long, lake_order long, x0 double, y0 double, x1 double, y1 double")
    b = P.polygon_bins(e)
    lon = [r.x for r in b.select(isin.centre_lon(F.col("bin_row"), F.col("bin_col")).alias("x")).collect()]
    assert any(x > 179.9 for x in lon) and any(x < -179.9 for x in lon) and all(abs(x) > 179.9 for x in lon)


def test_raster_layout_is_one_cell_a_bin(spark):
    q = G.e_raster_layout(spark, SF)
    assert q.groupBy("hylak_id", "iy", "ix").count().filter("count > 1").count() == 0 and q.filter("iy < 0 or ix < 0").count() == 0


def test_solar_date_at_150_east(spark):
    t = F.lit(datetime.datetime(2024, 8, 1, 23, 0)).cast("timestamp_ntz")
    assert str(one(spark.range(1).select(N.solar_date(t, F.lit(150.0)).alias("d"))).d) == "2024-08-02"


def test_utc_date_needs_a_zone(spark):
    assert str(one(spark.createDataFrame([("2024-08-01T23:30:00-02:00",)], "t string").select(N.utc_date(F.col("t")).alias("d"))).d) == "2024-08-02"
    with pytest.raises(Exception, match="no time zone"):
        spark.createDataFrame([("2024-08-01T23:30:00",)], "t string").select(N.utc_date(F.col("t")).alias("d")).collect()


def test_best_done_version_is_used(spark):
    v = spark.createDataFrame([(1, 1, "NR", "done", "2024-01-01"), (2, 1, "NT", "failed", "2024-01-02"), (3, 2, "NT", "queued", "2024-01-01"), (4, 3, "NT", "skipped_no_lakes", "2024-01-01")], "scene_id long, acq long, timeliness string, status string, created string")
    r = {x.acq: (x.status, x.used) for x in C.acquisition_status(v, "acq").collect()}
    assert r == {1: ("done", 1), 2: ("waiting", None), 3: ("done", 4)}


def test_daily_cells_keep_unseen_bins_and_empty_input(spark):
    bins = spark.createDataFrame([(1, 10), (1, 11)], "hylak_id long, bin long")
    days = spark.createDataFrame([(datetime.date(2024, 8, 1), 1, 5)], "date_solar date, hylak_id long, scene_no long")
    names = [f"{i}_mean" for i in (*O.INDICES, *O.NINE)]
    row = Row(scene_no=5, bin=10, footprint_area=1.0, **{n: 0.5 for n in names}, **{f"{f}_any": True for f in O.FLAGS})
    sb = spark.createDataFrame([row])
    c = {r.bin: r for r in D.daily_cells(bins, days, sb).collect()}
    assert c[10].observed and c[10].dn == 253 and not c[11].observed and c[11].dn == 255 and c[11].scenes_valid == 0
    assert D.daily_cells(bins, days.limit(0), sb).count() == 0


def test_sources(spark, tmp_path):
    lakes = spark.createDataFrame([(1, 2.0), (1, 3.0)], "hylak_id long, lake_area double")
    with pytest.raises(Exception, match="duplicate lake"):
        T.load_lakes(lakes).collect()
    with pytest.raises(Exception, match="unsafe"):
        spark.createDataFrame([("a", "../b")], "c string, s string").select(T.region_path(F.col("c"), F.col("s"), F.lit("2024-08-01").cast("date"))).collect()
    m = spark.createDataFrame([(1, 1)], "scene_no long, n long")
    with pytest.raises(Exception, match="already"):
        T.append_scene(m, m).collect()
    a, b = T.publish(m, str(tmp_path / "t")), T.publish(m, str(tmp_path / "t"))
    assert a.endswith("v1") and b.endswith("v2") and spark.read.parquet(a).count() == 1
    bins = spark.createDataFrame([(5, 1, "2024-08-01")], "scene_no long, bin long, date_utc string")
    T.write_scene_bins(bins, str(tmp_path / "bins"))
    assert T.read_scene_bins(spark, str(tmp_path / "bins")).count() == 1
    with pytest.raises(ValueError):
        T.read_scene_bins(spark, str(tmp_path / "bins"), "other")
    rows = spark.createDataFrame([("X", "Y", datetime.date(2024, 8, 1), 2, None), ("X", "Y", datetime.date(2024, 8, 1), 1, 0.5)], "country string, state string, date_solar date, hylak_id long, v double")
    T.write_daily_lakes(rows, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").rglob("part-*.csv")).read_text().splitlines()
    assert text == ["hylak_id,v", "1,0.5", "2,"]


def test_replace_date_twice_is_the_same(spark):
    m = spark.createDataFrame([(datetime.date(2024, 8, d), h, d) for d in (1, 2) for h in (1, 2)], "date_solar date, hylak_id long, v long")
    new = m.filter("v = 2 and hylak_id = 1").withColumn("v", F.lit(9).cast("long"))
    once = T.replace_date(m, new)
    twice = T.replace_date(once, new)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 3
    assert T.replace_date(m, new, lakes_only=True).count() == 4


def test_stream_status_counts_equal_batch(spark, tmp_path):
    e = view(spark, SF, "status_events")
    e.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    q = jobs.status_counts(s).writeStream.outputMode("complete").format("memory").queryName("hours").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = e.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"), "status").agg(F.count("*").alias("n"))
    assert sorted(map(tuple, spark.table("hours").collect())) == sorted(map(tuple, want.collect()))


def test_stream_first_record_and_maintenance(spark, tmp_path):
    e = view(spark, SF, "status_events").select("event_id", "scene_id", F.col("ts").cast("timestamp").alias("ts"), "status")
    e.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = jobs.register_scenes(s, "10000 days").writeStream.format("memory").queryName("first").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("first").count() == e.select("scene_id").distinct().count()
    seen = []
    jobs.maintain(s, str(tmp_path / "c2"), lambda latest, number: seen.extend(latest.collect())).awaitTermination(120)
    last = {r.scene_id: r.status for r in sorted(seen, key=lambda r: r.event_id)}
    assert last == {r.scene_id: r.status for r in e.groupBy("scene_id").agg(F.max_by("status", "event_id").alias("status")).collect()}


def test_stream_daily_max(spark, tmp_path):
    d = datetime.datetime
    rows = [(d(2024, 8, 1, 10), -84.0, 1, 5, 0.2), (d(2024, 8, 1, 12), -84.0, 1, 5, 0.4), (d(2024, 8, 2, 3), -84.0, 1, 5, 0.3), (d(2024, 8, 2, 10), -84.0, 1, 5, None)]
    df = spark.createDataFrame(rows, "start timestamp_ntz, lon double, hylak_id long, bin long, ci_cyano_mean double")
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    jobs.daily_max(s).writeStream.outputMode("update").format("memory").queryName("dm").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    got = {str(r.day.start.date()): (r.ci_cyano, r.scenes_valid) for r in spark.table("dm").collect()}
    assert got == {"2024-08-01": (0.4, 3), "2024-08-02": (None, 0)}


def test_late_change_merges_its_date_again(spark):
    day = datetime.date(2024, 8, 1)
    m = spark.createDataFrame([(day, 1, 0.9), (datetime.date(2024, 8, 2), 1, 0.5)], "date_solar date, hylak_id long, v double")
    changed = spark.createDataFrame([(day, "a", "b"), (datetime.date(2024, 8, 2), "c", "c")], "date_solar date, signature string, merged string")
    out = jobs.remerge(changed, m, lambda dates: m.join(dates, "date_solar", "left_semi").withColumn("v", F.lit(0.1)))
    assert sorted((str(r.date_solar), r.v) for r in out.collect()) == [("2024-08-01", 0.1), ("2024-08-02", 0.5)]


def clipped_area(points, west, east, south, north):
    """Area of a convex polygon's part in a rectangle, by cutting it along each side in turn."""
    for axis, line, sign in ((0, west, 1), (0, east, -1), (1, south, 1), (1, north, -1)):
        out = []
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            a, b = sign * (p[axis] - line), sign * (q[axis] - line)
            if a >= 0:
                out.append(p)
            if a * b < 0:
                t = a / (a - b)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = out
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1], strict=True))) / 2


def test_overlaps_are_clipped_areas(spark):
    """Random footprints, either way round, against polygon clipping in longitude and latitude."""
    import math
    import random

    from lakegrid.functions import isin
    from lakegrid.operators import overlap as O

    rng, r = random.Random(4), isin.RADIUS
    rows = []
    for i in range(150):
        lat, lon = rng.uniform(-70, 70), rng.uniform(-179.99, 179.99)
        a, b = (rng.uniform(-400, 400), rng.uniform(-400, 400)), (rng.uniform(-400, 400), rng.uniform(-400, 400))
        if i % 5 == 0:  # level and upright edges
            a, b = (0.0, -300.0), (300.0, 0.0)
        lon0 = lon - rng.uniform(-2, 2)
        rows.append((i, lon0, r * math.radians(lon - lon0) * math.cos(math.radians(lat)), r * math.radians(lat), *a, *b))
    df = spark.createDataFrame(rows, "i int, lon0 double, x double, y double, ax double, ay double, bx double, by double")
    got = {}
    for row in O.footprint_overlaps(df, ["i"]).collect():
        got.setdefault(row.i, {})[row.bin_row, row.bin_col] = row.weight
    for i, lon0, x, y, ax, ay, bx, by in rows:
        ring = []
        for s, t in ((-0.5, -0.5), (0.5, -0.5), (0.5, 0.5), (-0.5, 0.5)):
            px, py = x + s * ax + t * bx, y + s * ay + t * by
            ring.append((lon0 + math.degrees(px / (r * math.cos(py / r))), math.degrees(py / r)))
        whole, plane = clipped_area(ring, -999, 999, -99, 99), abs(ax * by - ay * bx)
        assert abs(sum(got[i].values()) / plane - 1) < 1e-6
        for (row, col), weight in got[i].items():
            n = math.floor(2 * isin.N_ROWS * math.cos(math.radians((row + 0.5) * 180 / isin.N_ROWS - 90)) + 0.5)
            west = col * 360 / n - 180
            near = west + 360 * round((ring[0][0] - west) / 360)
            want = clipped_area(ring, near, near + 360 / n, row * 180 / isin.N_ROWS - 90, (row + 1) * 180 / isin.N_ROWS - 90) / whole * plane
            assert abs(weight - want) < 1e-4 * plane


def test_nearest_pixel_over_borders(spark):
    """Pixels within the radius are found over the rows' and columns' borders, at any latitude and over the date line."""
    import random

    from lakegrid.operators import scene as S

    rng = random.Random(6)
    cells, pixels = [(1, 49.9995, 10.0), (2, 0.0, 179.9999), (3, 85.0, -180.0)], [(1, 50.0005, 10.0), (2, 0.0001, -179.9999), (3, 85.0001, 179.99)]
    for k in range(4, 300):
        lat, lon = rng.uniform(-88, 88), rng.uniform(-180, 180)
        cells.append((k, lat, lon))
        pixels.append((k, lat + rng.uniform(-0.006, 0.006), lon + rng.uniform(-0.006, 0.006)))
    c = spark.createDataFrame(cells, "k int, lat double, lon double")
    p = spark.createDataFrame([(k, lat, lon, k + 1000) for k, lat, lon in pixels], "k int, lat double, lon double, place int")
    got = {r.k: (r.match, r.metres) for r in S.nearest_same_lake(c, p, ["k"], "place").collect()}

    def metres(a, b):
        import math

        u = [(math.cos(math.radians(y)) * math.cos(math.radians(x)), math.cos(math.radians(y)) * math.sin(math.radians(x)), math.sin(math.radians(y))) for _, y, x in (a, b)]
        return 2 * 6371000 * math.asin(min(1, math.dist(*u) / 2))

    assert len(got) == len(cells) and all(got[k][0] == k + 1000 for k in (1, 2, 3))
    for a, b in zip(cells, pixels, strict=True):
        m = metres(a, b)
        assert got[a[0]][0] == (a[0] + 1000 if m <= 600 else None), (a, b, m)
    assert S.nearest_same_lake(c, p, ["k"], "place", 500.0).filter("match is null").count() <= sum(v[0] is None for v in got.values())


def test_granule_names(spark):
    from lakegrid.operators import nasa as N

    names = {
        "L2024227.L3m_DAY_CYAN_CI_cyano_CYAN_CONUS_300m_7_5.tif": ("CONUS", "7_5"), "L2024227.L3m_DAY_CYAN_CI_cyano_CYAN_CONUS_300m.tif": ("CONUS", "ALL"), "L2024227.L3m_DAY_CYANAK_CI_cyano_CYAN_AK_300m_1_2.tif": ("AK", "1_2"),
        "L2024227.L3m_DAY_CYAN_CI_cyano_CYAN_AK_300m.tif": None, "L20242212024227.L3m_7D_CYAN_CI_cyano_CYAN_CONUS_300m_7_5.tif": None, "L2024228.L3m_DAY_CYAN_CI_cyano_CYAN_CONUS_300m_7_5.tif": None, "L2024227.L3m_DAY_CYAN_CI_cyano_CYAN_CONUS_300m_7.tif": None, "x": None,
    }
    entries = spark.createDataFrame([(n, x, y) for n in names for x, y in ((0.0, 5.0), (300.0, 9.0))], "name string, x double, y double")
    got = {r.name: r for r in N.parse_granules(entries, "2024227").collect()}
    assert {n: (r.region, r.tile) for n, r in got.items()} == {n: v for n, v in names.items() if v}
    assert all((r.xmin, r.ymin, r.xmax, r.ymax) == (-100.0, -95.0, 400.0, 109.0) for r in got.values())


def test_tiles_around_a_hole_are_not_complete(spark):
    """Four tiles about the rim of a lake whose middle lies in none."""
    from lakegrid.operators import nasa as N
    from lakegrid.operators import spatial as P

    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
    edges = spark.createDataFrame([(1, 1, *a, *b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)], "hylak_id int, lake_order int, x0 double, y0 double, x1 double, y1 double")
    points = N.lake_points(edges, P.polygon_bins(edges)).select("hylak_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    rim = [(-0.1, -0.1, 1.1, 0.2), (-0.1, 0.8, 1.1, 1.1), (-0.1, -0.1, 0.2, 1.1), (0.8, -0.1, 1.1, 1.1)]
    tiles = lambda t: spark.createDataFrame(t, "xmin double, ymin double, xmax double, ymax double")
    assert [r.complete for r in N.coverage_complete(points, tiles(rim)).collect()] == [False]
    assert [r.complete for r in N.coverage_complete(points, tiles([*rim, (0.1, 0.1, 0.9, 0.9)])).collect()] == [True]


def test_daily_science_there_and_back(spark, tmp_path):
    """Cells decoded from the files are the stored ones: values in 32 bits, missing ones, masks, bins from places; lines of a lake over the date line too."""
    bins = spark.createDataFrame([(1, 50000, c) for c in (100, 101, 103)] + [(1, 50002, 102), (2, 40000, 0), (2, 40000, 1), (2, 40001, -1)], "hylak_id long, bin_row int, bin_col long")
    n = isin.bins_in_row(F.col("bin_row"))
    bins = bins.withColumn("bin_col", F.pmod("bin_col", n).cast("long"))
    before = isin.rows_table(spark).select(F.col("row").alias("bin_row"), "before")
    bins = bins.join(before, "bin_row").withColumn("bin", isin.bin_key(F.col("before"), F.col("bin_col"))).drop("before")
    values = {x: F.when(F.col("bin_col") % 2 == 0, F.rand(k) / 10) for k, x in enumerate((*O.INDICES, *O.NINE, "footprint"))}
    cells = bins.withColumn("date_solar", F.lit("2024-08-01").cast("date")).withColumns(values)
    cells = cells.withColumns({"observed": F.col("bin_col") % 3 != 0, "scenes_valid": F.col("bin_col") * 100 % 300, "dn": B.ci_to_dn(F.col("ci_cyano"), F.col("ci_cyano").isNotNull()), "masks": (F.col("bin_col") * 37 % 4096).cast("int")})
    cells = spark.createDataFrame(cells.collect(), cells.schema)
    T.write_daily_science(cells, f"{tmp_path}/science")
    back = T.read_daily_science(spark, f"{tmp_path}/science")
    want = D.as_stored(cells).withColumn("masks", F.when(F.col("observed"), F.col("masks")).otherwise(-1)).withColumn("scenes_valid", F.least("scenes_valid", F.lit(254)))
    names = ["hylak_id", "bin_row", "bin_col", "bin", *O.INDICES, *O.NINE, "footprint", "observed", "dn", "masks", "scenes_valid"]
    assert sorted(map(repr, map(tuple, back.select(names).collect()))) == sorted(map(repr, map(tuple, want.select(names).collect())))
    from lakegrid.functions.masks import MASKS

    for r in back.select("masks", *MASKS).collect():
        assert all(r[m] == (r.masks >= 0 and bool(r.masks >> k & 1)) for k, m in enumerate(MASKS))


def test_no_stage_outgrows_the_code_limit(spark):
    """Footprints run as generated code: every stage's code compiles."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = O.reduce_bins(O.footprint_overlaps(O.neighbour_vectors(G.M.daily_inputs(G.masked(spark, SF))), ["scene_no", *(f"d_{c}" for c in (*O.INDICES, *O.NINE)), *O.FLAGS]))
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [stages.apply(k)._3().maxMethodCodeSize() for k in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 2 and all(0 < n < 65_536 for n in sizes)


def event_rows(spark, path, rows):
    spark.createDataFrame(rows, jobs.EVENTS).coalesce(1).write.mode("append").parquet(path)


def test_stream_readiness_is_the_batch_one(spark, tmp_path):
    """The last row that the stream sends for each key, over many small batches out of order, is what the batch rules give for all events; untouched keys send nothing."""
    import random

    from lakegrid.operators import progress as R

    rng, day0 = random.Random(3), datetime.date(2024, 8, 1)
    rows = [("status", rng.randrange(2), day0 + datetime.timedelta(s % 9), s, k, rng.choice(("done", "failed", "queued", "skipped_no_lakes", "done")), None) for k, s in enumerate(rng.choices(range(40), k=150))]
    home = {s: (r[1], r[2]) for r in rows for s in [r[3]]}
    rows = [(k, *home[s], s, e, st, g) for k, _, _, s, e, st, g in rows]
    rng.shuffle(rows)
    for i in range(0, len(rows), 50):
        event_rows(spark, str(tmp_path / "in"), rows[i : i + 50])
    sig = {}
    s = spark.readStream.schema(jobs.EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))

    def run():
        out = []
        jobs.readiness(s).writeStream.outputMode("update").foreachBatch(lambda b, n: out.extend((n, r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(300)
        return out

    for _, r in run():
        sig[r.state_id, r.day] = r
    merged = [("merge", *k, 0, 1000 + n, ("merged", "failed", "merging")[n % 3], r.signature if n % 2 else "other") for n, (k, r) in enumerate(sorted(sig.items())) if n % 4]
    event_rows(spark, str(tmp_path / "in"), merged)
    after = run()
    assert {(r.state_id, r.day) for _, r in after} == {(m[1], m[2]) for m in merged}
    for _, r in after:
        sig[r.state_id, r.day] = r
    latest = {}
    for r in rows:
        latest[r[3]] = max(latest.get(r[3], r), r, key=lambda x: x[4])
    scenes = spark.createDataFrame([(r[1], r[3], r[5], r[2]) for r in latest.values()], "state_id int, scene_id long, status string, day date")
    days = spark.createDataFrame(list(sig), "state_id int, day date")
    runs = spark.createDataFrame([(m[1], m[2], m[4], m[5], m[6]) for m in merged], "state_id int, day date, id long, state string, signature string")
    assert {tuple(r) for r in R.date_readiness(scenes, days, runs).collect()} == {tuple(r) for r in sig.values()}


def test_published_dates_leave_other_files_alone(spark, tmp_path):
    """Files of other dates and states keep their modification times; what is replaced is kept; stale partitions go; a repeated lake changes nothing."""
    d1, d2 = datetime.date(2024, 8, 1), datetime.date(2024, 8, 2)
    kind, at = "date_solar date, state_id int, hylak_id long, v double", str(tmp_path / "master")
    frame = lambda *rows: spark.createDataFrame(rows, kind)
    times = lambda: {str(p.relative_to(at)): p.stat().st_mtime_ns for p in (tmp_path / "master" / "current").rglob("*.parquet")}
    read = lambda path: sorted(tuple(r) for r in spark.read.schema(kind).parquet(path).select("date_solar", "state_id", "hylak_id", "v").collect())
    T.publish_dates(frame((d1, 1, 10, 0.1), (d1, 2, 20, 0.2), (d2, 1, 10, 0.3), (d2, 2, 20, 0.4)), at)
    first = times()
    assert T.publish_dates(frame((d1, 1, 10, 0.5)), at) == 1  # the whole date: state 2 has no lake any more
    assert read(f"{at}/current") == [(d1, 1, 10, 0.5), (d2, 1, 10, 0.3), (d2, 2, 20, 0.4)]
    assert read(f"{at}/versions/v1") == [(d1, 1, 10, 0.1), (d1, 2, 20, 0.2)]
    assert {k: v for k, v in times().items() if "2024-08-02" in k} == {k: v for k, v in first.items() if "2024-08-02" in k}
    second = times()
    T.publish_dates(frame((d2, 2, 20, 0.6), (d2, 2, 21, 0.7)), at, state_id=2)
    assert read(f"{at}/current") == [(d1, 1, 10, 0.5), (d2, 1, 10, 0.3), (d2, 2, 20, 0.6), (d2, 2, 21, 0.7)]
    assert {k: v for k, v in times().items() if "state_id=2" not in k} == {k: v for k, v in second.items() if "state_id=2" not in k}
    T.publish_dates(frame(), at, dates=spark.createDataFrame([(d1,)], "date_solar date"))  # a rerun that leaves nothing
    assert {r[0] for r in read(f"{at}/current")} == {d2}
    before = times()
    for bad in (lambda: T.publish_dates(frame((d2, 1, 10, 0.1), (d2, 2, 10, 0.2)), at), lambda: T.publish_dates(frame((d2, 1, 10, 0.1)), at, state_id=2)):
        with pytest.raises(Exception, match="twice|another state"):
            bad()
    assert times() == before


def test_stream_merges_what_changed(spark, tmp_path):
    """Ready dates are merged once; a late scene merges the dates it touches again, and no others."""
    day = lambda k: datetime.date(2024, 8, k)
    at, merged = str(tmp_path / "m"), []
    (tmp_path / "m" / "runs" / "none").mkdir(parents=True)

    def merge(dates):
        merged.append(sorted((r.state_id, r.day.day) for r in dates.collect()))
        return dates.select(F.col("day").alias("date_solar"), "state_id", F.col("state_id").cast("long").alias("hylak_id"), "signature")

    def run():
        merged.clear()
        events = jobs.status_and_merges(spark, str(tmp_path / "in"), at)
        jobs.remerge_stream(events, at, merge, lambda rows, dates: T.publish_dates(rows, f"{at}/master")).awaitTermination(300)
        return [x for m in merged for x in m]

    event_rows(spark, str(tmp_path / "in"), [("status", 1, day(5), 7, 1, "done", None), ("status", 2, day(20), 8, 2, "done", None), ("status", 2, day(21), 9, 3, "queued", None)])
    assert sorted(run()) == [(1, 4), (1, 5), (1, 6), (2, 19)]  # the 20th to 22nd wait
    assert run() == []  # its own runs are no reason to merge
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "m" / "master" / "current").rglob("*.parquet")}
    event_rows(spark, str(tmp_path / "in"), [("status", 2, day(21), 9, 4, "failed", None), ("status", 1, day(6), 10, 5, "done", None)])
    assert sorted(run()) == [(1, 5), (1, 6), (1, 7), (2, 20), (2, 21)]  # the 22nd has nothing to merge
    assert all(p.stat().st_mtime_ns == t for p, t in files.items() if p.exists() and ("08-04" in str(p) or "08-19" in str(p)))
    assert run() == []


def test_state_run_reads_few_blocks(spark, tmp_path):
    """The scan of scene bins is pruned by the blocks of the state's lakes."""
    bins = spark.createDataFrame([(s, r, c, r * 1000 + c) for s in (1, 2) for r in (100, 5003, 60000) for c in (1, 2)], "scene_no long, bin_row int, bin_col long, bin long")
    T.write_bin_blocks(bins, str(tmp_path / "b"))
    stored = spark.read.parquet(str(tmp_path / "b"))
    lake_bins = bins.select((F.col("bin_row") % 7).cast("long").alias("hylak_id"), "bin", "bin_row", "bin_col").distinct()
    days = lake_bins.select("hylak_id").distinct().withColumn("date_solar", F.lit("2024-08-01").cast("date")).withColumn("scene_no", F.lit(1).cast("long"))
    owners = lake_bins.select("hylak_id").distinct().withColumn("state_id", F.col("hylak_id").cast("int"))
    mine, own_days, seen, left_out = D.restrict_to_state(lake_bins, days, stored, owners, 100 % 7)
    assert left_out == 2 and {r.bin_row for r in mine.collect()} == {100} and own_days.count() == 1
    assert {r.bin_row for r in seen.collect()} == {100}
    assert "dynamicpruning" in seen._jdf.queryExecution().toString()


def test_raster_tiles_on_one_grid(spark):
    """Addresses count from the first tile; another cell size or an origin off its grid is an error."""
    from lakegrid.operators import nasa

    kind = "region string, tile string, x0 double, y0 double, dx double, dy double, width int, height int"
    tiles = [("CONUS", "1_1", 1000.0, 9000.0, 300.0, -300.0, 10, 10), ("CONUS", "1_2", 4000.0, 9000.0, 300.0, -300.0, 10, 10), ("CONUS", "2_1", 1000.0, 6000.0, 300.0, -300.0, 10, 10)]
    got = {r.tile: (r.row0, r.col0, r.xmin, r.xmax, r.ymin, r.ymax) for r in nasa.aligned_tiles(spark.createDataFrame(tiles, kind)).collect()}
    assert got == {"1_1": (0, 0, 1000.0, 4000.0, 6000.0, 9000.0), "1_2": (0, 10, 4000.0, 7000.0, 6000.0, 9000.0), "2_1": (10, 0, 1000.0, 4000.0, 3000.0, 6000.0)}
    for bad in (("CONUS", "9_9", 1000.0, 3000.0, 299.0, -300.0, 10, 10), ("CONUS", "9_9", 1100.0, 3000.0, 300.0, -300.0, 10, 10)):
        with pytest.raises(Exception, match="another grid"):
            nasa.aligned_tiles(spark.createDataFrame([*tiles, bad], kind)).collect()


def test_raster_choice_of_tiles(spark):
    """One tile that covers a lake alone, two together, the region's file, nothing."""
    from lakegrid.operators import nasa

    kind = "region string, tile string, x0 double, y0 double, dx double, dy double, width int, height int"
    tiles = nasa.aligned_tiles(spark.createDataFrame([("CONUS", "1_1", 0.0, 3000.0, 300.0, -300.0, 10, 10), ("CONUS", "1_2", 3000.0, 3000.0, 300.0, -300.0, 10, 10), ("CONUS", "ALL", 0.0, 3000.0, 300.0, -300.0, 40, 10)], kind))
    points = spark.createDataFrame([(1, 100.0, 100.0), (1, 200.0, 2900.0), (2, 2900.0, 50.0), (2, 3100.0, 50.0), (3, 5900.0, 10.0), (3, 7000.0, 10.0), (4, 5900.0, 10.0), (4, 90000.0, 10.0), (5, -90000.0, 10.0)], "hylak_id long, x double, y double")
    cover = nasa.tile_cover(points, tiles)
    chosen = sorted(tuple(r) for r in nasa.select_tiles(cover.filter("tile <> 'ALL' or covers")).collect())
    assert chosen == [(1, "1_1", 1), (2, "1_1", 2), (2, "1_2", 2), (3, "ALL", 3)]
    assert {r.hylak_id for r in cover.collect()} == {1, 2, 3, 4}


def test_windows_of_a_scene(spark):
    """Boxes that overlap through others are one window, clipped to the scene; too many, too large, too wide or no lakes give the whole scene."""
    scenes = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 0.0, 0.0, 10.0, 10.0), (3, -90.0, 0.0, 90.0, 10.0), (4, 0.0, 0.0, 10.0, 10.0), (5, 0.0, 0.0, 1.0, 1.0)], "scene_no long, xmin double, ymin double, xmax double, ymax double")
    lakes = spark.createDataFrame([(1, 0.5, 0.5, 1.0, 1.0), (2, 1.02, 0.5, 1.5, 1.0), (3, 1.52, 0.9, 2.0, 1.4), (4, 8.0, 8.0, 8.5, 8.5), (5, 9.8, 5.0, 10.5, 5.5), (6, 0.1, 0.1, 0.9, 0.9)], "hylak_id long, xmin double, ymin double, xmax double, ymax double")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (2, 1), (2, 4), (2, 5), (3, 1), (5, 6)], "scene_no long, hylak_id long")
    rows = P.plan_windows(scenes, lakes, pairs, 3.0, 3).collect()
    got = {s: sorted((round(r.xmin, 2), round(r.ymin, 2), round(r.xmax, 2), round(r.ymax, 2)) for r in rows if r.scene_no == s and r.xmin is not None) for s in range(1, 6)}
    assert got[1] == [(0.47, 0.47, 2.03, 1.43), (7.97, 7.97, 8.53, 8.53), (9.77, 4.97, 10.0, 5.53)]
    assert len(got[2]) == 3 and got[3] == got[4] == got[5] == []
    assert {r.scene_no for r in rows if r.xmin is None} == {3, 4, 5}
    few = P.plan_windows(scenes, lakes, pairs, 3.0, 2).collect()
    assert {r.scene_no for r in few if r.xmin is None} == {1, 2, 3, 4, 5}


def test_pixels_of_lakes_and_scenes_before_the_first_of_a_place(spark):
    """Scene bounds need no window, pixels are cut to lakes before theirs, and both give the rows of the plain way."""
    from lakegrid.plans.fixtures import VIEWS, view
    from lakegrid.plans.pixel_queries import lake_pixels, pixels, positions
    from lakegrid.operators.spatial import assign_lake

    sf = "/root/testdata/sf0.001"
    rows = lambda df: sorted(map(str, df.collect()))
    scenes = view(spark, sf, "scenes")
    assert "Window" not in scenes._jdf.queryExecution().optimizedPlan().toString()
    assert rows(scenes) == rows(spark.sql(VIEWS["scenes"].replace("//", "div"), pixels=view(spark, sf, "pixels")))
    plain = assign_lake(pixels(spark, sf), view(spark, sf, "lake_edges"))
    inside = lake_pixels(spark, sf)
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.rindex("Join")  # the plan is printed from its end: a join lies below the window
    assert rows(inside.select(sorted(inside.columns))) == rows(plain.filter("hylak_id is not null").select(sorted(plain.columns)))
    keys = ["scene_no", "source_row", "source_col", "lat", "lon"]
    assert rows(positions(spark, sf)) == rows(plain.select(keys))


def test_neighbours_and_medians_over_blocks_of_columns(spark):
    """One dealing of the pixels serves the neighbours in both directions, also over a block's border, and the columns' medians; no join on columns is left in the plan."""
    rows = [(1, r, c, 45.0 + r * 0.0026, -84.0 + c * 0.0037) for r in range(3) for c in (62, 63, 64, 65, 128, 190)]
    df = spark.createDataFrame(rows, "scene_no long, source_row long, source_col long, lat double, lon double")
    v = O.neighbour_vectors(df)
    got = {(r.source_row, r.source_col): r for r in v.collect()}
    assert len(got) == len(rows)
    for (row, col), r in got.items():
        step = {62: 63, 63: 64, 64: 65, 65: 64}.get(col)
        if step:
            s = 1 if step > col else -1
            other = got[row, step]
            assert abs(r.bx - s * (other.x - r.x)) < 1e-9 and abs(r.by - s * (other.y - r.y)) < 1e-9
        else:  # without neighbours in its row, as is its column: the median of the scene
            assert 280 < r.bx < 300
        other = got[min(row, 1) + 1 if row < 2 else 1, col]
        s = 1 if row < 2 else -1
        assert abs(r.ay - s * (other.y - r.y)) < 1e-9


def test_no_pixel_meets_its_scene_by_a_shuffle_twice(spark):
    """Pixels are dealt by blocks once, and daily cells keep their bins' places: plans of before had three exchanges of pixels and a second join of the bins."""
    written, own = [], O.stored
    O.stored = lambda df: (written.append(df), own(df))[1]
    try:
        O.neighbour_vectors(G.positions(spark, SF))
    finally:
        O.stored = own
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in written]
    assert max(p.split("Initial Plan")[-1].count("Exchange hashpartitioning") for p in plans if "Window" in p) == 1
    assert {"bin_row", "bin_col"} <= set(G.cells(spark, SF).columns)
