"""Statistics of lake pixels within a scene, and mapped views of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.isin import wrap
from ..functions.names import great_circle_m

BASES = {"ci": "candidate", "ci_cyano": "detected", "ndci": "valid_water", "mph": "valid_water", "fai": "valid_water"}


def dedupe_observations(pixels: DataFrame, order: list[str]) -> DataFrame:
    """The first observation of each lake and position (6 decimals, half to even), by the given order."""
    p = pixels.filter("hylak_id is not null and lat is not null and lon is not null").withColumns({"lat6": F.bround("lat", 6), "lon6": F.bround("lon", 6)})
    w = Window.partitionBy("hylak_id", "lat6", "lon6").orderBy(*order)
    return p.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth", "lat6", "lon6")


def summary(value: Column, name: str, keep: Column | None = None) -> list[Column]:
    """Count, mean, median, p10, p90 and max over present values, exact percentiles by linear interpolation."""
    v = (value if keep is None else F.when(keep, value)).cast("double")
    return [F.count(v).alias(f"{name}_valid"), F.avg(v).alias(f"{name}_mean"), F.median(v).alias(f"{name}_median"), F.percentile(v, 0.1).alias(f"{name}_p10"), F.percentile(v, 0.9).alias(f"{name}_p90"), F.max(v).alias(f"{name}_max")]


def lake_stats(pixels: DataFrame, *keys: str) -> DataFrame:
    """Per scene and lake: eight mask counts, the share of rescued among cloud-flagged, and five index summaries on their own bases."""
    n = lambda c, name: F.count_if(c).alias(name)
    counts = [F.count("*").alias("native_pixels"), n(F.col("valid_water"), "retained_pixels"), n(F.col("strict_valid"), "strict_pixels"), n(F.col("rescued"), "rescued_pixels"), n(F.col("cldice"), "cldice_pixels"), n(F.col("cloud_excluded"), "cloud_excluded_pixels"), n(F.col("ci_valid"), "ci_input_valid_pixels"), n(F.col("candidate"), "ci_candidate_pixels"), n(F.col("detected"), "ci_detection_pixels")]
    stats = [s for i, base in BASES.items() for s in summary(F.col(i), i, F.col(base))]
    out = pixels.groupBy(*keys, "hylak_id").agg(*counts, *stats)
    return out.withColumn("rescue_fraction", F.try_divide(F.col("rescued_pixels").cast("double"), F.col("cldice_pixels").cast("double")))


def window_stats(pixels: DataFrame, *keys: str) -> DataFrame:
    """The older form: percentages and fractions beside the counts, and the index summaries it had."""
    s = lake_stats(pixels, *keys)
    share = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return s.select(*keys, "hylak_id", "native_pixels", "retained_pixels", (100.0 * share("retained_pixels", "native_pixels")).alias("retained_percent"), "strict_pixels", "rescued_pixels", "cldice_pixels", "ci_input_valid_pixels", "ci_candidate_pixels", "ci_detection_pixels", share("ci_detection_pixels", "ci_input_valid_pixels").alias("detection_fraction_of_ci_valid"), share("ci_detection_pixels", "retained_pixels").alias("detection_fraction_of_retained"), *(f"ci_{k}" for k in ("mean", "median", "p10", "p90", "max")), *(f"ci_cyano_{k}" for k in ("mean", "median", "p90")), *(f"ndci_{k}" for k in ("mean", "median", "p90")), *(f"{i}_{k}" for i in ("mph", "fai") for k in ("mean", "median", "p10", "p90", "max")))


def grid_layout(pixels: DataFrame, key: str, metres: float = 300.0) -> DataFrame:
    """Regular lat/lon grid per key: steps from the median latitude, extents snapped outwards."""
    b = pixels.groupBy(key).agg(F.median("lat").alias("mid"), F.min("lat").alias("lat0"), F.max("lat").alias("lat1"), F.min("lon").alias("lon0"), F.max("lon").alias("lon1"))
    b = b.withColumns({"dlat": F.lit(metres / 111320.0), "dlon": metres / (111320.0 * F.greatest(F.cos(F.radians("mid")), F.lit(0.01)))})
    snap = {"south": F.floor(F.col("lat0") / F.col("dlat")) * F.col("dlat"), "north": F.ceil(F.col("lat1") / F.col("dlat")) * F.col("dlat"), "west": F.floor(F.col("lon0") / F.col("dlon")) * F.col("dlon"), "east": F.ceil(F.col("lon1") / F.col("dlon")) * F.col("dlon")}
    b = b.withColumns(snap)
    return b.withColumns({"rows": F.greatest(F.lit(1), F.rint((F.col("north") - F.col("south")) / F.col("dlat"))).cast("long"), "cols": F.greatest(F.lit(1), F.rint((F.col("east") - F.col("west")) / F.col("dlon"))).cast("long")}).select(key, "dlat", "dlon", "south", "west", "rows", "cols")


def support_cells(layout: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Grid cells (key, iy, ix, lat, lon, hylak_id) whose centre lies in a lake: listed from the lakes' own bounds, not from the whole grid."""
    from .spatial import assign_lake, box_join, lake_bounds

    boxes = layout.withColumns({"xmin": F.col("west"), "ymin": F.col("south"), "xmax": F.col("west") + F.col("cols") * F.col("dlon"), "ymax": F.col("south") + F.col("rows") * F.col("dlat")})
    pairs = box_join(boxes, lake_bounds(edges), key, "hylak_id").join(lake_bounds(edges), "hylak_id").join(layout, key)
    iy = F.sequence(F.greatest(F.lit(0), F.floor((F.col("ymin") - F.col("south")) / F.col("dlat"))), F.least(F.col("rows") - 1, F.floor((F.col("ymax") - F.col("south")) / F.col("dlat"))))
    ix = F.sequence(F.greatest(F.lit(0), F.floor((F.col("xmin") - F.col("west")) / F.col("dlon"))), F.least(F.col("cols") - 1, F.floor((F.col("xmax") - F.col("west")) / F.col("dlon"))))
    cells = pairs.select(key, "south", "west", "dlat", "dlon", F.explode(iy).alias("iy"), ix.alias("ixs")).withColumn("ix", F.explode("ixs")).select(key, "iy", "ix", (F.col("south") + (F.col("iy") + 0.5) * F.col("dlat")).alias("lat"), (F.col("west") + (F.col("ix") + 0.5) * F.col("dlon")).alias("lon")).distinct()
    return assign_lake(cells, edges).filter("hylak_id is not null")


def nearest_same_lake(cells: DataFrame, pixels: DataFrame, keys: list[str], id_: str, metres: float = 300.0) -> DataFrame:
    """Each cell with the id and distance of the nearest pixel of its lake within 600 m, or two steps of a grid of that many metres if that is more (ties: smallest id); cells without one stay. Chosen before any quality test.

    Both sides are dealt to rows as high as the radius, and each row to a whole number of
    columns, as wide as the radius at its poleward end, around the Earth; so the nine boxes
    about a cell hold all pixels within the radius, whatever row or side of the date line
    they are on. A cell goes to its three rows and a pixel to its three columns, which is
    fewer rows than cells in nine boxes each.
    """
    radius = max(600.0, 2.0 * metres)
    high = radius / 111000.0
    row = F.floor(F.col("lat") / high)
    columns = lambda gy: F.greatest(F.lit(3), F.floor(360.0 * F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(gy), F.abs(gy + 1)) * high))) / high))
    steps = F.array(*map(F.lit, (-1, 0, 1)))
    # a row's number of columns, a cosine, once for each row and not for each of the nine boxes
    placed = lambda df: df.withColumn("_n", columns(F.col("gy"))).withColumn("_g", F.floor((wrap(F.col("lon")) + 180.0) / 360.0 * F.col("_n")))
    around = placed(cells.withColumn("_row", row).withColumn("gy", F.explode(F.array(*(F.col("_row") + d for d in (-1, 0, 1))))))
    c = around.withColumn("gx", F.pmod("_g", "_n"))
    p = placed(pixels.withColumn("gy", row)).withColumn("_d", F.explode(steps)).select(*keys, "gy", F.pmod(F.col("_g") + F.col("_d"), "_n").alias("gx"), F.col(id_).alias("match"), F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    own = list(cells.columns)
    near = c.select(*own, "gy", "gx").join(p, [*keys, "gy", "gx"], "left").withColumn("metres", great_circle_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")))
    # cells without a pixel stay, as the join keeps them
    best = near.groupBy(*own).agg(F.min(F.when(F.col("metres") <= radius, F.struct("metres", "match"))).alias("m"))
    return best.select(*own, F.col("m.match").alias("match"), F.col("m.metres").alias("metres"))


def dedupe_targets(targets: DataFrame, keys: list[str]) -> DataFrame:
    """One row per target: matched before unmatched, then nearest."""
    w = Window.partitionBy(*keys).orderBy(F.col("match").isNull(), "metres", "match")
    return targets.withColumn("nth", F.row_number().over(w)).filter("nth = 1").drop("nth")


def swath_coverage(pixels: DataFrame, band: str, stride: int = 4) -> DataFrame:
    """Share of finite values among all, land and other pixels of a strided sample of rows and columns."""
    s = pixels.filter((F.col("source_row") % stride == 0) & (F.col("source_col") % stride == 0))
    land = F.coalesce(F.col("l2_flags").bitwiseAND(1) != 0, F.lit(False))
    part = lambda c: F.avg(F.when(c, F.col(band).isNotNull().cast("double")))
    return s.groupBy("scene_no").agg(F.count("*").alias("sampled"), part(F.lit(True)).alias("finite_all"), part(land).alias("finite_land"), part(~land).alias("finite_other"))
