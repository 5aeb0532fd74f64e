"""Daily merge of scene bins into one value per lake, bin and solar date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import DETECTION_LIMIT, ci_to_dn
from ..functions.nulls import flag
from .overlap import FLAGS, INDICES, NINE
from .scene import summary


#: Rows of the grid that a block of stored scene bins holds.
BLOCK_ROWS = 512


def merged_columns(scene_bins: DataFrame) -> DataFrame:
    """Scene bins with what a daily merge reads: means, flags and footprints, without the sums they come from."""
    return scene_bins.select([c for c in scene_bins.columns if not c.endswith(("_sum", "_valid_area"))])


def daily_cells(lake_bins: DataFrame, lake_days: DataFrame, scene_bins: DataFrame) -> DataFrame:
    """Per (date_solar, hylak_id, bin): the largest scene mean of each index and band, scenes with a valid value, flags seen in any scene, largest footprint.

    lake_bins (hylak_id, bin, whose other columns are kept); lake_days (date_solar, hylak_id, scene_no) the scenes used;
    scene_bins one row per (scene_no, bin) with means. Every bin of a lake gets a row, seen
    or not. Keys include the bin, so no lake is one group. A scene's bins meet the lakes that
    hold them before they meet the days, so nothing is multiplied by a scene's other lakes.
    """
    owned = scene_bins.join(lake_bins.select("hylak_id", "bin"), "bin")
    seen = owned.join(lake_days.select("date_solar", "hylak_id", "scene_no"), ["scene_no", "hylak_id"])
    most = [F.max(f"{i}_mean").alias(i) for i in INDICES] + [F.max(f"{b}_mean").alias(b) for b in NINE]
    any_ = [F.bool_or(f"{f}_any").alias(f) for f in FLAGS]
    if "masks" in scene_bins.columns:
        any_.append(F.bit_or("masks").alias("masks"))
    g = seen.groupBy("date_solar", "hylak_id", "bin").agg(*most, *any_, F.count("ci_cyano_mean").alias("scenes_valid"), F.max("footprint_area").alias("footprint"), F.lit(True).alias("observed"))
    days = lake_days.select("date_solar", "hylak_id").distinct()
    cells = days.join(lake_bins, "hylak_id").join(g, ["date_solar", "hylak_id", "bin"], "left")
    cells = cells.withColumns({f: flag(F.col(f)) for f in (*FLAGS, "observed")} | {"scenes_valid": F.coalesce("scenes_valid", F.lit(0))})
    if "masks" in scene_bins.columns:
        cells = cells.withColumn("masks", F.when(F.col("observed"), F.col("masks")).otherwise(-1))
    return cells.withColumn("dn", ci_to_dn(F.col("ci_cyano"), F.col("ci_cyano").isNotNull()))


def best_values(lake_bins: DataFrame, lake_days: DataFrame, scene_bins: DataFrame, index: str) -> DataFrame:
    """(hylak_id, bin, index): the largest value that daily_cells has of an index in a bin on any date, where it has one. No cells are listed for it, as the largest of a date's largest is the largest of all scenes."""
    valued = scene_bins.filter(F.col(f"{index}_mean").isNotNull()).select("scene_no", "bin", f"{index}_mean")
    owned = valued.join(lake_bins.select("hylak_id", "bin"), "bin")
    used = lake_days.select("scene_no", "hylak_id").distinct()
    return owned.join(used, ["scene_no", "hylak_id"]).groupBy("hylak_id", "bin").agg(F.max(f"{index}_mean").alias(index))


def restrict_to_state(lake_bins: DataFrame, lake_days: DataFrame, scene_bins: DataFrame, owners: DataFrame, state_id: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The inputs of daily_cells cut down to the lakes that a state owns, before anything heavy is joined, and how many lakes of lake_days were left out.

    owners (hylak_id, state_id). Where scene_bins is stored by block (bin_row div BLOCK_ROWS), only
    the blocks that the state's lakes reach are read: they are a small table, by which the
    scan's partitions are pruned when the query runs.
    """
    mine = owners.filter(F.col("state_id") == state_id).select("hylak_id")
    bins, days = lake_bins.join(mine, "hylak_id", "left_semi"), lake_days.join(mine, "hylak_id", "left_semi")
    left_out = lake_days.select("hylak_id").distinct().join(mine, "hylak_id", "left_anti").count()
    if "block" in scene_bins.columns:
        blocks = bins.select(F.floor(F.col("bin_row") / BLOCK_ROWS).cast("int").alias("block")).distinct()
        scene_bins = scene_bins.join(F.broadcast(blocks), "block", "left_semi").drop("block")  # of 135 blocks at most
    return bins, days, scene_bins, left_out


def as_stored(cells: DataFrame) -> DataFrame:
    """Cells with the values that the science layers keep: 32-bit numbers. Rows published from these are those rebuilt from the layers."""
    return cells.withColumns({x: F.col(x).cast("float").cast("double") for x in (*INDICES, *NINE, "footprint")})


def daily_lakes(cells: DataFrame) -> DataFrame:
    """One row per lake and date: cell counts and index statistics over its bins."""
    valid = F.col("ci_cyano").isNotNull()
    hit = flag(F.col("ci_cyano") >= DETECTION_LIMIT)
    n = lambda c, name: F.count_if(c).alias(name)
    counts = [F.count("*").alias("lake_cells"), n(F.col("valid_water"), "primary_retained_cells"), n(F.col("cloud_excluded"), "cloud_any_cells"), n(F.col("cloud_excluded") & valid, "cloud_with_valid_cells"), n(F.col("cloud_excluded") & ~valid, "cloud_without_valid_cells"), n(valid, "ci_input_valid_cells"), n(F.col("ci").isNotNull(), "ci_candidate_cells"), n(hit, "detectable_cells"), n(valid & ~hit, "non_detectable_cells"), n(~valid, "no_valid_data_cells"), n(F.col("scenes_valid") >= 2, "twice_valid_cells")]
    stats = [s for i in INDICES for s in summary(F.col(i), i)]
    return cells.groupBy("date_solar", "hylak_id").agg(*counts, *stats, F.avg(F.when(hit, F.col("ci_cyano"))).alias("ci_cyano_mean_detectable"))


def day_counts(status: DataFrame) -> DataFrame:
    """Lakes per date by status."""
    n = lambda s: F.count_if(F.col("day_status") == s).alias(s)
    return status.groupBy("date_solar").agg(F.count("*").alias("lakes"), *(n(s) for s in ("complete", "partial", "waiting", "unavailable")))


def _laid_out(cells: DataFrame, key: str) -> DataFrame:
    """Bins of each key with their place (iy, ix) and their line's first column (first)."""
    from ..functions import isin

    c = cells.select(key, "bin_row", "bin_col").distinct().withColumn("n", isin.bins_in_row(F.col("bin_row"))).withColumn("lon", isin.centre_lon(F.col("bin_row"), F.col("bin_col")))
    g = c.groupBy(key).agg(isin.central_meridian(F.col("lon")).alias("lon0"), F.max("bin_row").alias("rmax"))
    c = c.join(g, key)
    a = isin.RADIUS * F.cos(F.radians(isin.centre_lat(F.col("bin_row")))) * F.radians(360.0 / F.col("n"))
    c = c.withColumns({"a": a, "col0": F.least(F.floor((isin.wrap(F.col("lon0")) + 180.0) / 360.0 * F.col("n")), F.col("n") - 1), "b": F.col("n") * (180.0 + F.col("lon0")) / 360.0})
    half = F.floor(F.col("n") / 2)
    c = c.withColumn("j", F.pmod(F.col("bin_col") - F.col("col0") + half, "n") - half)
    c = c.withColumn("x", F.col("a") * (F.col("col0") + F.col("j") + 0.5 - F.col("b")))
    low = c.groupBy(key).agg((F.min("x") - 0.5 * isin.RADIUS * 3.141592653589793 / isin.N_ROWS).alias("xlo"))
    c = c.join(low, key).withColumn("j1", F.ceil(F.col("xlo") / F.col("a") - (F.col("col0") + 0.5 - F.col("b"))))
    first = c.groupBy(key, "bin_row").agg(F.least(F.min("j"), F.min("j1")).alias("j0"))
    c = c.join(first, [key, "bin_row"])
    return c.select(key, "bin_row", "bin_col", (F.col("rmax") - F.col("bin_row")).cast("long").alias("iy"), (F.col("j") - F.col("j0")).cast("long").alias("ix"), F.pmod(F.col("col0") + F.col("j0"), "n").cast("long").alias("first"))


def raster_layout(cells: DataFrame, key: str) -> DataFrame:
    """Place (iy, ix) of each bin in the rectangle of whole bins around a key's bins: north at the top, lines shifted so that columns line up about the central meridian, safe over the date line. cells: key, bin_row, bin_col."""
    return _laid_out(cells, key).drop("first")


def raster_lines(cells: DataFrame, key: str, wrapped: bool = True) -> DataFrame:
    """(key, iy, bin_row, first): the lines of each key's raster, from which every place's bin follows. Unless wrapped, columns of cells are those of polygon_bins counted on past 180 degrees, and so is the first one."""
    c = _laid_out(cells, key)
    if not wrapped:
        c = c.withColumn("first", F.col("bin_col") - F.col("ix"))
    return c.select(key, "iy", "bin_row", "first").distinct()


def raster_cells(places: DataFrame, lines: DataFrame, key: str, wrapped: bool = True) -> DataFrame:
    """places (key, iy, ix, ...) with their bin_row, bin_col and bin, from the lines alone."""
    from ..functions import isin

    rows = F.broadcast(isin.rows_table(places.sparkSession).select(F.col("row").alias("bin_row"), "n", "before"))
    c = places.join(lines, [key, "iy"]).join(rows, "bin_row")
    col = F.col("first") + F.col("ix")
    c = c.withColumn("bin_col", (F.pmod(col, "n") if wrapped else col).cast("long"))
    return c.withColumn("bin", isin.bin_key(F.col("before"), F.col("bin_col"))).drop("first", "n", "before")


def raster_geometry(cells: DataFrame) -> DataFrame:
    """Cells with the latitude and longitude of their bin's centre and its area."""
    from ..functions import isin

    return cells.withColumns({"latitude": isin.centre_lat(F.col("bin_row")), "longitude": isin.centre_lon(F.col("bin_row"), F.col("bin_col")), "bin_area": isin.bin_area(F.col("bin_row"))})
