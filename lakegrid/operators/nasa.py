"""The external raster product: its cells in lakes, and its values paired with ours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import isin
from ..functions.bands import DETECTION_LIMIT, dn_to_ci
from ..functions.nulls import flag
from ..sources.tables import small, stored
from .spatial import assign_lake, lake_table

#: Published naming of daily granules: L<year><day of year>.L3m_DAY_<suite>_CI_cyano_CYAN_<region>_300m[_<tile>].tif, with a suite for each region.
SUITES = {"CONUS": "CYAN", "AK": "CYANAK"}


def cell_centres(tiles: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells with the centre (x, y) of each: tile origin plus (i + 0.5) steps."""
    return cells.join(tiles, ["region", "tile"]).withColumns({"x": F.col("x0") + (F.col("grid_col") + 0.5) * F.col("dx"), "y": F.col("y0") + (F.col("grid_row") + 0.5) * F.col("dy")})


def aligned_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles (region, tile, x0, y0, dx, dy, width, height) with the integer address (row0, col0) of their first cell on the grid of their region's first tile, and their bounds.

    Another cell size than that tile's, or an origin off its grid, is an error where the row is read.
    """
    w = Window.partitionBy("region").orderBy("tile").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {c: F.first(c).over(w) for c in ("x0", "y0", "dx", "dy")}
    col, row = (F.col("x0") - first["x0"]) / first["dx"], (F.col("y0") - first["y0"]) / first["dy"]
    fits = (F.abs(F.col("dx") - first["dx"]) <= 1e-8) & (F.abs(F.col("dy") - first["dy"]) <= 1e-8) & (F.abs(col - F.rint(col)) <= 1e-6) & (F.abs(row - F.rint(row)) <= 1e-6)
    on_grid = lambda v: F.when(fits, F.rint(v).cast("long")).otherwise(F.raise_error(F.concat(F.lit("another grid: tile "), F.col("tile"))).cast("long"))
    ends = F.col("x0") + F.col("width") * F.col("dx"), F.col("y0") + F.col("height") * F.col("dy")
    return tiles.withColumns({"row0": on_grid(row), "col0": on_grid(col), "xmin": F.least("x0", ends[0]), "xmax": F.greatest("x0", ends[0]), "ymin": F.least("y0", ends[1]), "ymax": F.greatest("y0", ends[1])})


def located_cells(tiles: DataFrame, cells: DataFrame, region: str = "CONUS") -> DataFrame:
    """Cells of one region's aligned tiles with their address (row, col) on the common grid and the longitude and latitude of their centre, by the inverse projection."""
    c = cell_centres(small(tiles.filter(F.col("region") == region)), cells)
    lon, lat = isin.unalbers(F.col("x"), F.col("y"), region)
    return c.select("tile", (F.col("row0") + F.col("grid_row")).alias("row"), (F.col("col0") + F.col("grid_col")).alias("col"), "dn", lon.alias("lon"), lat.alias("lat"))


#: Metres of the cells by which points and tiles meet.
TILE_CELL = 20_000.0


def tile_cover(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """Which tiles (tile, bounds) hold points of a lake (hylak_id, x, y): hylak_id, tile, covers (all of its points), together (all numbered tiles hold all of them).

    A point meets its cell's tiles as one array, and what is counted per point is added up per lake
    and tile before it is dealt, so points are gone through once and none is a group of its own.
    """
    reach = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / TILE_CELL), F.floor(F.col(high) / TILE_CELL)))
    t = tiles.withColumn("gx", reach("xmin", "xmax")).withColumn("gy", reach("ymin", "ymax"))
    near = small(stored(t.groupBy("gx", "gy").agg(F.collect_list(F.struct("tile", "xmin", "ymin", "xmax", "ymax")).alias("near"))))
    p = points.withColumns({"gx": F.floor(F.col("x") / TILE_CELL), "gy": F.floor(F.col("y") / TILE_CELL)}).join(near, ["gx", "gy"], "left")
    holding = F.filter("near", lambda t: F.col("x").between(t["xmin"], t["xmax"]) & F.col("y").between(t["ymin"], t["ymax"]))
    p = p.select("hylak_id", F.coalesce(F.transform(holding, lambda t: t["tile"]), F.array().cast("array<string>")).alias("held_by"))
    # a lake's points and those that numbered tiles hold are counted beside its tiles, without a tile's name
    counted = F.concat(F.transform("held_by", lambda t: F.struct(F.lit("tile").alias("what"), t.alias("tile"))), F.array(F.struct(F.when(F.exists("held_by", lambda t: t != "ALL"), "held").otherwise("not held").alias("what"), F.lit(None).cast("string").alias("tile"))))
    n = stored(p.select("hylak_id", F.explode(counted).alias("c")).groupBy("hylak_id", "c.what", "c.tile").agg(F.count("*").alias("n")))
    total = n.filter("what <> 'tile'").groupBy("hylak_id").agg(F.sum("n").alias("points"), F.sum(F.when(F.col("what") == "held", F.col("n")).otherwise(0)).alias("held"))
    return n.filter("what = 'tile'").join(total, "hylak_id").select("hylak_id", "tile", (F.col("n") == F.col("points")).alias("covers"), (F.col("held") == F.col("points")).alias("together"))


MEASURES = ("total_cells", "area_km2", "dn_zero", "dn_detected", "dn_land", "dn_no_data")


def lake_raster(edges: DataFrame, here: DataFrame, cells: DataFrame, chosen: DataFrame, region: str = "CONUS") -> DataFrame:
    """(hylak_id, row, col, dn, conflict, lon, lat): the cells of each lake's chosen tiles strictly inside it, each address once. here: aligned tiles; chosen (hylak_id, tile, choice)."""
    inside = assign_lake(located_cells(here, cells, region), edges, cells=lake_table(edges)).filter("hylak_id is not null").join(chosen, ["hylak_id", "tile"])
    return inside.groupBy("hylak_id", "row", "col").agg(F.min("dn").alias("dn"), (F.min("dn") < F.max("dn")).alias("conflict"), F.min("lon").alias("lon"), F.min("lat").alias("lat"))


def chosen_tiles(edges: DataFrame, bins: DataFrame, here: DataFrame, region: str = "CONUS") -> tuple[DataFrame, DataFrame]:
    """(cover, chosen) of each lake: which of a region's aligned tiles hold points of it, and which are to be read."""
    x, y = isin.albers(F.col("lon"), F.col("lat"), region)
    cover = stored(tile_cover(lake_points(edges, bins).select("hylak_id", x.alias("x"), y.alias("y")), here))
    return cover, stored(select_tiles(cover.filter("tile <> 'ALL' or covers")))


def raster_counts(edges: DataFrame, bins: DataFrame, tiles: DataFrame, cells: DataFrame, region: str = "CONUS") -> DataFrame:
    """Per lake the external raster's cells strictly inside it, by value class, and the coverage they rest on.

    Tiles are put on one grid; of each lake those are chosen that cover its outline (points
    0.01 degrees apart) and bins: one alone, else all together, else the region's whole file. Centres
    go back to longitude and latitude before they meet lakes. An address that several tiles hold counts
    once. status: complete; incomplete_coverage; overlap_conflict (tiles differ at an address);
    unavailable (no tile holds a point of it). All measures are null unless complete.
    """
    here = stored(aligned_tiles(tiles).filter(F.col("region") == region))
    cover, chosen = chosen_tiles(edges, bins, here, region)
    once = lake_raster(edges, here, cells, chosen, region)
    counts = histogram(once, F.bool_or("conflict").alias("conflict"))
    seen = cover.select("hylak_id").distinct().withColumn("seen", F.lit(True))
    out = edges.select("hylak_id").distinct().join(seen, "hylak_id", "left").join(chosen.groupBy("hylak_id").agg(F.min("choice").alias("choice"), F.count("*").alias("tiles")), "hylak_id", "left").join(counts, "hylak_id", "left")
    status = F.when(F.col("seen").isNull(), "unavailable").when(F.col("choice").isNull(), "incomplete_coverage").when(flag(F.col("conflict")), "overlap_conflict").otherwise("complete")
    out = out.withColumn("status", status)
    none = {m: F.coalesce(F.col(m), F.lit(0.0 if m == "area_km2" else 0)) for m in MEASURES}
    return out.select("hylak_id", "status", "choice", "tiles", *(F.when(F.col("status") == "complete", c).alias(m) for m, c in none.items()))


def coverage_status_counts(rows: DataFrame) -> DataFrame:
    """Lakes by coverage status."""
    return rows.groupBy("status").agg(F.count("*").alias("lakes"))


def parse_granules(entries: DataFrame, day: str) -> DataFrame:
    """Daily granules of a date (YYYYDDD) by name: region, tile (ALL for a region's whole file) and bounds with a margin of 100 m."""
    dots = F.split("name", r"\.")
    field = F.split(F.get(dots, F.lit(1)), "_")
    at = lambda i: F.get(field, F.lit(i))
    suited = F.lit(False)
    for region, suite in SUITES.items():
        suited = suited | ((at(6) == region) & (at(2) == suite))
    daily = (F.size(dots) == 3) & (F.get(dots, F.lit(0)) == f"L{day}") & (F.get(dots, F.lit(2)) == "tif") & (at(0) == "L3m") & (at(1) == "DAY") & (F.array_join(F.slice(field, 4, 3), "_") == "CI_cyano_CYAN") & (at(7) == "300m")
    numbered = at(8).rlike("^[0-9]+$") & at(9).rlike("^[0-9]+$") & (F.size(field) == 10)
    g = entries.filter(daily & suited & ((F.size(field) == 8) | numbered))
    g = g.withColumns({"region": at(6), "tile": F.when(F.size(field) == 8, "ALL").otherwise(F.concat_ws("_", at(8), at(9)))})
    return g.groupBy("name", "region", "tile").agg((F.min("x") - 100).alias("xmin"), (F.min("y") - 100).alias("ymin"), (F.max("x") + 100).alias("xmax"), (F.max("y") + 100).alias("ymax"))


def select_tiles(cover: DataFrame) -> DataFrame:
    """Per lake the files to read: one tile that covers it alone (smallest name) if there is one, else all tiles if together they do, else the region's whole file; never both. cover: hylak_id, tile, covers (alone), together (all tiles)."""
    w = Window.partitionBy("hylak_id")
    rank = F.when((F.col("tile") != "ALL") & F.col("covers"), 1).when((F.col("tile") != "ALL") & F.col("together"), 2).when(F.col("tile") == "ALL", 3)
    c = cover.withColumn("choice", rank).withColumn("best", F.min("choice").over(w)).filter("choice = best")
    c = c.withColumn("nth", F.row_number().over(Window.partitionBy("hylak_id").orderBy("tile")))
    return c.filter("choice = 2 or nth = 1").select("hylak_id", "tile", "choice")


def coverage_complete(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """Whether every point (hylak_id, x, y) of a lake, of its densified outline and of the bins inside it, lies in a tile; tiles meet points by cells of their own size."""
    size = 300_000.0
    t = tiles.withColumn("gx", F.explode(F.sequence(F.floor(F.col("xmin") / size), F.floor(F.col("xmax") / size)))).withColumn("gy", F.explode(F.sequence(F.floor(F.col("ymin") / size), F.floor(F.col("ymax") / size))))
    p = points.withColumns({"gx": F.floor(F.col("x") / size), "gy": F.floor(F.col("y") / size)})
    hit = p.join(t, ["gx", "gy"]).filter("x between xmin and xmax and y between ymin and ymax").select("hylak_id", "x", "y").distinct().withColumn("hit", F.lit(True))
    return points.join(hit, ["hylak_id", "x", "y"], "left").groupBy("hylak_id").agg(F.bool_and(F.coalesce("hit", F.lit(False))).alias("complete"))


def densify(edges: DataFrame, step: float = 0.01) -> DataFrame:
    """Points along each lake's edges, at most step degrees apart."""
    n = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))) / step)).cast("int")
    e = edges.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    t = F.col("k") / F.col("n")
    return e.select("hylak_id", (F.col("x0") + t * (F.col("x1") - F.col("x0"))).alias("lon"), (F.col("y0") + t * (F.col("y1") - F.col("y0"))).alias("lat"))


def lake_points(edges: DataFrame, bins: DataFrame, step: float = 0.01) -> DataFrame:
    """(hylak_id, lon, lat) of each lake's outline and of the centres of its bins (hylak_id, bin_row, bin_col)."""
    inside = bins.select("hylak_id", isin.centre_lon(F.col("bin_row"), F.col("bin_col")).alias("lon"), isin.centre_lat(F.col("bin_row")).alias("lat"))
    return densify(edges, step).unionByName(inside)


def dedupe_cells(cells: DataFrame) -> DataFrame:
    """One row per grid address; conflict where tiles give different values."""
    return cells.groupBy("grid_row", "grid_col").agg(F.min("dn").alias("dn"), F.min("lon").alias("lon"), F.min("lat").alias("lat"), (F.min("dn") < F.max("dn")).alias("conflict"))


def cells_in_lakes(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Cells with the lake that strictly contains their centre."""
    return assign_lake(cells, edges).filter("hylak_id is not null")


def histogram(cells: DataFrame, *more: Column) -> DataFrame:
    """Per lake: cells, their area, counts of the value classes, and more aggregates if given."""
    n = lambda c, name: F.count_if(c).alias(name)
    d = F.col("dn")
    return cells.groupBy("hylak_id").agg(F.count("*").alias("total_cells"), (F.count("*") * 0.09).alias("area_km2"), n(d == 0, "dn_zero"), n(d.between(1, 253), "dn_detected"), n(d == 254, "dn_land"), n(d == 255, "dn_no_data"), *more)


def pair_cells(nasa: DataFrame, ours: DataFrame) -> DataFrame:
    """Each external cell (hylak_id, bin, dn) with our value at its bin: indices of both (0 below detection), and why a cell isn't paired."""
    o = ours.select("hylak_id", "bin", F.col("ci_cyano").alias("ours"), F.lit(True).alias("has_bin"))
    p = nasa.join(o, ["hylak_id", "bin"], "left").withColumn("has_bin", F.coalesce("has_bin", F.lit(False)))
    kind = F.when(F.col("dn") > 253, "nasa land or no data").when(~F.col("has_bin"), "no bin").when(F.col("ours").isNull(), "bin without data").otherwise("paired")
    hit = flag(F.col("ours") >= DETECTION_LIMIT)
    return p.withColumns({"kind": kind, "nasa_ci": dn_to_ci(F.col("dn")), "our_ci": F.when(hit, F.col("ours")).otherwise(0.0)})


def pair_leftovers(pairs: DataFrame) -> DataFrame:
    n = lambda k, name: F.count_if(F.col("kind") == k).alias(name)
    return pairs.groupBy("hylak_id").agg(F.count("*").alias("nasa_cells"), n("nasa land or no data", "left_out_nasa"), n("no bin", "left_out_no_bin"), n("bin without data", "left_out_no_data"), n("paired", "paired"))


def pair_statistics(pairs: DataFrame, *keys: str) -> DataFrame:
    """Correlation (null for fewer than two pairs or a constant side), slope and intercept of ours on theirs."""
    x, y = "nasa_ci", "our_ci"
    g = pairs.filter("kind = 'paired'").groupBy(*keys).agg(F.count("*").alias("n"), F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"), F.covar_pop(F.col(x), F.col(y)).alias("cov"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"), F.avg(x).alias("mx"), F.avg(y).alias("my"))
    varies, both = (F.col("n") >= 2) & (F.col("x0") < F.col("x1")), (F.col("n") >= 2) & (F.col("x0") < F.col("x1")) & (F.col("y0") < F.col("y1"))
    slope = F.when(varies, F.try_divide(F.col("cov"), F.col("vx")))
    return g.select(*keys, "n", F.when(both, F.try_divide(F.col("cov"), F.sqrt(F.col("vx") * F.col("vy")))).alias("r"), slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))


def density_2d(pairs: DataFrame, low: float, high: float, bins: int = 70) -> DataFrame:
    """Counts of pairs over a log grid of both indices; zero has place 0 of its own."""
    import math

    place = lambda c: F.when(F.col(c) <= 0, 0).otherwise(F.greatest(F.lit(1), F.least(F.lit(bins), F.floor((F.log10(F.col(c)) - math.log10(low)) / (math.log10(high) - math.log10(low)) * bins) + 1))).cast("int")
    return pairs.filter("kind = 'paired'").groupBy(place("nasa_ci").alias("ix"), place("our_ci").alias("iy")).agg(F.count("*").alias("n"))


def find_lakes(lakes: DataFrame, values: DataFrame, text: str, limit: int = 30) -> DataFrame:
    """Lakes with an external value (values: hylak_id) whose name contains the text, whatever its case; largest first."""
    return lakes.join(values.select("hylak_id").distinct(), "hylak_id", "left_semi").filter(F.contains(F.lower("lake_name"), F.lit(text.lower()))).orderBy(F.desc("lake_area"), "hylak_id").limit(limit)


def pick_lake(lakes: DataFrame, spec: str) -> DataFrame:
    """The one lake of an id, else of an exact name, else whose name contains the text; none or several are an error."""
    tries = ([lakes.filter(F.col("hylak_id") == int(spec))] if spec.isdigit() else []) + [lakes.filter(F.lower("lake_name") == spec.lower()), lakes.filter(F.contains(F.lower("lake_name"), F.lit(spec.lower())))]
    for t in tries:
        n = t.limit(2).count()
        if n == 1:
            return t
        if n > 1:
            raise ValueError(f"several lakes match {spec!r}")
    raise ValueError(f"no lake matches {spec!r}")
