"""Readers and writers: typed tables in, partitioned tables, CSV and JSON out."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one per scene, lake or day up to which a table is broadcast.
SMALL = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where that is unset, as in tests, one of its own is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: later plans read it in place of doing it again, and lost executors do no harm."""
    at = shared_folder(df.sparkSession)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if it has SMALL rows at most."""
    return F.broadcast(df) if df.count() <= SMALL else df


MIN_AREA = 1.3
BAD_NAME = r"[/\\\x00]|^\.{1,2}$|^\s*$"


def load_lakes(lakes: DataFrame, min_area: float = MIN_AREA) -> DataFrame:
    """Lakes of at least that area; a duplicate id is an error, raised where the row is read."""
    from pyspark.sql import Window

    kept = lakes.filter(F.col("lake_area") >= min_area)
    n = F.count("*").over(Window.partitionBy("hylak_id"))
    return kept.withColumn("hylak_id", F.when(n == 1, F.col("hylak_id")).otherwise(F.raise_error(F.concat(F.lit("duplicate lake "), F.col("hylak_id").cast("string"))).cast("bigint")))


def load_regions(regions: DataFrame) -> DataFrame:
    """Regions that have an id and a name."""
    return regions.filter("state_id is not null and trim(state_name) <> ''")


def read_swath(spark: SparkSession, path: str) -> DataFrame:
    """Swath pixels; r443 and cloud_albedo are optional."""
    df = spark.read.parquet(path)
    for c in ("r443", "cloud_albedo"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("float"))
    return df


def read_lake_pixels(spark: SparkSession, *paths: str) -> tuple[DataFrame, list[str]]:
    """Pixels of several files whose columns may differ, and the columns that some lack (filled with null). Rows without a position or place are dropped."""
    parts = [spark.read.parquet(p) for p in paths]
    every = set().union(*(p.columns for p in parts))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    located = out.filter("lat is not null and lon is not null and not isnan(lat) and not isnan(lon) and source_row >= 0 and source_col >= 0")
    return located, sorted(every - set.intersection(*(set(p.columns) for p in parts)))


def read_scene_bins(spark: SparkSession, path: str, schema: str = "lakegrid-bins-1") -> DataFrame:
    """Scene bins; files of another grid or layout are refused."""
    df = spark.read.parquet(path)
    if "grid_schema" not in df.columns or df.filter(~F.col("grid_schema").eqNullSafe(F.lit(schema))).limit(1).count():
        raise ValueError(f"not scene bins of {schema}: {path}")
    return df.drop("grid_schema")


def write_bin_blocks(bins: DataFrame, path: str) -> None:
    """Scene bins by blocks of grid rows, so that a run over few lakes reads few of them."""
    from ..operators.daily import BLOCK_ROWS

    bins.withColumn("block", F.floor(F.col("bin_row") / BLOCK_ROWS).cast("int")).repartition("block", "scene_no").sortWithinPartitions("block", "scene_no", "bin").write.partitionBy("block").parquet(path)


def write_scene_bins(bins: DataFrame, path: str, schema: str = "lakegrid-bins-1", date: str = "date_utc") -> None:
    bins.withColumn("grid_schema", F.lit(schema)).repartition(date, "scene_no").sortWithinPartitions("scene_no", "bin").write.partitionBy(date).parquet(path)


def write_lake_pixels(pixels: DataFrame, path: str, date: str = "date_utc") -> None:
    """By date, clustered by scene."""
    pixels.repartition(date, "scene_no").sortWithinPartitions("scene_no", "source_row", "source_col").write.partitionBy(date).parquet(path)


def region_path(country: Column, state: Column, day: Column) -> Column:
    """country/state/YYYY/MM/DD; an empty or unsafe name is an error."""
    safe = lambda c: F.when(c.isNull() | c.rlike(BAD_NAME), F.raise_error(F.lit("unsafe region name")).cast("string")).otherwise(F.trim(c))
    return F.concat_ws("/", safe(country), safe(state), F.date_format(day, "yyyy/MM/dd"))


#: The header of the published daily table, in its order; ours on the left.
_STATISTICS = {"valid": "valid_cells", "mean": "mean", "median": "median", "p10": "p10", "p90": "p90", "max": "max"}
DAILY_COLUMNS = {
    "date_solar": "date_solar", "hylak_id": "Hylak_id", "lake_name": "Lake_name", "lake_area": "Lake_area_km2", "states": "states", "state_ids": "state_ids",
    "latitude": "latitude", "longitude": "longitude", "day_status": "day_status", "within_pass_method": "within_pass_method", "satellites": "satellites",
    "scenes_used": "scenes_used", "scene_ids": "scene_ids", "scene_names": "scene_names", "failed_scenes": "failed_or_unavailable_scenes",
    "lake_cells": "Lake_cells", "primary_retained_cells": "primary_retained_cells",
    "cloud_any_cells": "Cloud_excluded_any_scene_cells", "cloud_with_valid_cells": "Cloud_excluded_with_valid_daily_CI_cells", "cloud_without_valid_cells": "Cloud_excluded_without_valid_daily_CI_cells",
    "ci_input_valid_cells": "ci_input_valid_cells", "ci_candidate_cells": "ci_candidate_cells",
    "detectable_cells": "CI_cyano_detectable_cells", "non_detectable_cells": "Non_detectable_cells", "no_valid_data_cells": "No_valid_data_cells",
    "twice_valid_cells": "Cells_valid_in_two_or_more_scenes", "external_detected": "NASA_CI_Cyano_detectable_cells",
    **{f"ci_{k}": f"CI_{v}" for k, v in _STATISTICS.items()},
    **{f"ci_cyano_{k}": f"CI_cyano_{v}" for k, v in _STATISTICS.items()}, "ci_cyano_mean_detectable": "CI_cyano_mean_detectable",
    **{f"ndci_{k}": f"NDCI_{v}" for k, v in _STATISTICS.items()},
    **{f"mph_{k}": f"MPH_{v}" for k, v in _STATISTICS.items()},
    **{f"fai_{k}": f"FAI_{v}" for k, v in _STATISTICS.items()},
}
METHOD = "area-weighted mean"


def daily_table(statistics: DataFrame, items: DataFrame, lakes: DataFrame, states: DataFrame, external: DataFrame) -> DataFrame:
    """The published daily table of 58 columns: merged lakes (complete or partial) with their attributes, scenes, counts and statistics.

    statistics as daily_lakes gives; items as lake_day_status takes; lakes (hylak_id, lake_name,
    lake_area, latitude, longitude); states as touching_states gives; external (date_solar,
    hylak_id, external_detected), which counts only where all passes used are on the UTC date itself.
    """
    from ..operators.catalogue import lake_day_status

    keys = ["date_solar", "hylak_id"]
    status = lake_day_status(items).filter(F.col("day_status").isin("complete", "partial"))
    names = items.filter("status = 'done'").groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("name")), ";").alias("scene_names"))
    t = statistics.join(status, keys).join(names, keys, "left").join(lakes, "hylak_id").join(states, "hylak_id", "left").join(external, keys, "left")
    own = {"within_pass_method": F.lit(METHOD), "external_detected": F.when(F.col("nasa_eligible"), F.col("external_detected")), "states": F.coalesce("states", F.lit("")), "state_ids": F.coalesce("state_ids", F.lit(""))}
    return t.select(*(own.get(c, F.col(c)).alias(published) for c, published in DAILY_COLUMNS.items()))


def write_daily_lakes(rows: DataFrame, path: str, keys: tuple[str, ...] = ("country", "state", "date_solar")) -> None:
    """One CSV folder per region and date, by lake, null as empty."""
    rows.repartition(*keys).sortWithinPartitions(*keys, "hylak_id").write.partitionBy(*keys).option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_daily_cells(cells: DataFrame, path: str, keys: tuple[str, ...] = ("country", "state", "date_solar")) -> None:
    cells.write.partitionBy(*keys).parquet(path)


#: What a float layer holds where there is nothing, the mask of bins that no pass saw, and the codes for no value.
FLOAT_FILL, UNSEEN, NO_DATA = -9999.0, -1, 255


def daily_science(cells: DataFrame, layout: DataFrame) -> DataFrame:
    """All layers of the daily product as a long raster (date_solar, hylak_id, iy, ix).

    32-bit bands, indices and footprint_area with fills in place of nulls; the twelve masks packed
    in their fixed order, -1 where no pass saw the bin; support and match masks; DN, and
    scenes_valid up to 254. Bins aren't stored: they follow from the lines of the layout.
    """
    from ..operators.overlap import INDICES, NINE

    c = cells.join(layout, ["hylak_id", "bin_row", "bin_col"])
    layers = {x: F.coalesce(F.col(x).cast("float"), F.lit(FLOAT_FILL).cast("float")) for x in (*NINE, *INDICES)}
    layers["masks"] = F.when(F.col("observed"), F.col("masks")).otherwise(UNSEEN).cast("short")
    layers |= {"lake_support_mask": F.lit(1).cast("byte"), "native_source_match_mask": F.col("observed").cast("byte")}
    layers["footprint_area"] = F.coalesce(F.col("footprint").cast("float"), F.lit(FLOAT_FILL).cast("float"))
    layers |= {"dn": F.col("dn").cast("short"), "scenes_valid": F.least("scenes_valid", F.lit(NO_DATA - 1)).cast("short")}
    return c.select("date_solar", "hylak_id", "iy", "ix", *(v.alias(k) for k, v in layers.items()))


def write_daily_science(cells: DataFrame, path: str) -> None:
    """The layers by date below path/layers, and the lines of each lake's raster below path/lines. cells: those of daily_cells with bin_row and bin_col."""
    from ..operators.daily import raster_layout, raster_lines

    bins = cells.select("hylak_id", "bin_row", "bin_col").distinct()
    daily_science(cells, raster_layout(bins, "hylak_id")).repartition("date_solar", "hylak_id").sortWithinPartitions("hylak_id", "iy", "ix").write.partitionBy("date_solar").parquet(f"{path}/layers")
    raster_lines(bins, "hylak_id").write.parquet(f"{path}/lines")


def read_daily_science(spark: SparkSession, path: str) -> DataFrame:
    """Daily cells decoded from stored layers alone: fills, codes and packed masks back to values and nulls, bins from places."""
    from ..functions.masks import MASKS, unpacked
    from ..functions.nulls import flag
    from ..operators.daily import raster_cells
    from ..operators.overlap import INDICES, NINE

    layers = spark.read.parquet(f"{path}/layers")
    cells = raster_cells(layers, spark.read.parquet(f"{path}/lines"), "hylak_id")
    value = lambda x: F.when(F.col(x) != F.lit(FLOAT_FILL).cast("float"), F.col(x).cast("double"))
    cells = cells.withColumns({x: value(x) for x in (*NINE, *INDICES)} | {"footprint": value("footprint_area"), "observed": F.col("native_source_match_mask") == 1})
    cells = cells.withColumn("ci_cyano", F.when(F.col("dn") != NO_DATA, F.col("ci_cyano")))
    return cells.withColumns({m: flag(unpacked(m)) for m in MASKS}).drop("footprint_area", "native_source_match_mask", "lake_support_mask")


def manifest(status: DataFrame, *regions: str) -> DataFrame:
    """Per date, and region where columns of regions are named: counts, and the lists of partial, waiting and unavailable lakes with their scenes."""
    pick = lambda s, *c: F.array_sort(F.collect_list(F.when(F.col("day_status") == s, F.struct("hylak_id", *c)))).alias(s)
    return status.groupBy("date_solar", *regions).agg(F.count("*").alias("lakes"), F.count_if(F.col("day_status") == "complete").alias("complete"), pick("partial", "failed_scenes"), pick("waiting", "missing_scenes"), pick("unavailable", "failed_scenes"))


def write_manifest(status: DataFrame, path: str, *regions: str) -> None:
    """One JSON record per region and date, in the region's and date's own folder."""
    manifest(status, *regions).write.partitionBy(*regions, "date_solar").json(path)


def replace_date(master: DataFrame, rows: DataFrame, lakes_only: bool = False) -> DataFrame:
    """master with the dates of rows (or, lakes_only, just their lakes' rows of those dates) replaced by rows; other dates stay. A (date, lake) twice in rows is an error."""
    from pyspark.sql import Window

    keys = ["date_solar", "hylak_id"] if lakes_only else ["date_solar"]
    kept = master.join(rows.select(*keys).distinct(), keys, "left_anti")
    n = F.count("*").over(Window.partitionBy("date_solar", "hylak_id"))
    once = rows.withColumn("hylak_id", F.when(n == 1, F.col("hylak_id")).otherwise(F.raise_error(F.lit("a lake twice on one date")).cast("bigint")))
    return kept.unionByName(once)


def append_scene(master: DataFrame, rows: DataFrame) -> DataFrame:
    """master with the scenes of rows added; a scene that is there already is an error."""
    there = rows.join(master.select("scene_no").distinct().withColumn("there", F.lit(True)), "scene_no", "left")
    fresh = there.withColumn("scene_no", F.when(F.col("there").isNull(), F.col("scene_no")).otherwise(F.raise_error(F.lit("scene is already there")).cast("bigint"))).drop("there")
    return master.unionByName(fresh.select(*master.columns))


def publish(df: DataFrame, folder: str, *keys: str) -> str:
    """Writes df as the next version below folder and returns its path; earlier versions stay as they are."""
    to = f"{folder}/v{_next_version(df.sparkSession, folder)}"
    (df.write.partitionBy(*keys) if keys else df.write).parquet(to)
    return to


def stale_partitions(written: DataFrame, now: DataFrame, keys: list[str], day, state_id: int | None = None) -> DataFrame:
    """Partitions of a date that a whole rerun no longer has; a rerun of one state leaves others alone."""
    old = written.filter(F.col("date_solar") == day)
    if state_id is not None:
        old = old.filter(F.col("state_id") == state_id)
    return old.select(*keys).distinct().join(now.select(*keys).distinct(), keys, "left_anti")


def _files(spark: SparkSession, folder: str):
    """Hadoop path and file system of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def publish_dates(rows: DataFrame, folder: str, state_id: int | None = None, dates: DataFrame | None = None) -> int:
    """Replaces whole dates of the master below folder/current by rows (date_solar, state_id, hylak_id, ...), and returns the version that keeps what they held.

    The master is partitioned by date and state. Only partitions of the dates of rows (and of dates,
    where a rerun may leave none) are written, by dynamic overwrite; files of other dates are
    neither read nor written. Partitions that a whole rerun no longer has are deleted; a run
    of one state_id leaves other states alone. A (date, lake) twice is an error before anything
    is written. What is replaced stays below folder/versions.
    """
    from pyspark.sql import Window

    spark, keys = rows.sparkSession, ["date_solar", "state_id"]
    n = F.count("*").over(Window.partitionBy("date_solar", "hylak_id"))
    once = rows.withColumn("hylak_id", F.when(n == 1, F.col("hylak_id")).otherwise(F.raise_error(F.lit("a lake twice on one date")).cast("bigint")))
    if state_id is not None:
        once = once.withColumn("state_id", F.when(F.col("state_id") == state_id, F.col("state_id")).otherwise(F.raise_error(F.lit("a row of another state"))))
    once = stored(once)
    current, (_, fs) = f"{folder}/current", _files(spark, folder)
    touched = once.select("date_solar").union(dates.select("date_solar")).distinct() if dates is not None else once.select("date_solar").distinct()
    version, stale = _next_version(spark, f"{folder}/versions"), []
    if fs.exists(_files(spark, current)[0]):
        old = spark.read.schema(once.schema).parquet(current)
        if state_id is not None:
            old = old.filter(F.col("state_id") == state_id)
        old = old.join(F.broadcast(touched), "date_solar", "left_semi")
        old.write.partitionBy(*keys).parquet(f"{folder}/versions/v{version}")
        stale = old.select(*keys).distinct().join(once.select(*keys).distinct(), keys, "left_anti").collect()  # partitions of the dates
    once.repartition(*keys).sortWithinPartitions(*keys, "hylak_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(current)
    for r in stale:
        fs.delete(_files(spark, f"{current}/date_solar={r.date_solar}/state_id={r.state_id}")[0], True)
    return version


def _next_version(spark: SparkSession, folder: str) -> int:
    path, fs = _files(spark, folder)
    have = [int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName()[1:].isdigit()] if fs.exists(path) else []
    return max(have, default=0) + 1


def write_pairs(pairs: DataFrame, path: str) -> None:
    """CSV of paired cells."""
    pairs.filter("kind = 'paired'").select("hylak_id", "grid_row", "grid_col", "lon", "lat", "bin", "dn", "nasa_ci", "our_ci").write.option("header", True).csv(path)
