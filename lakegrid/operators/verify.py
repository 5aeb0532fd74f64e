"""Checks of what was published, and the comparison of a rebuilt table with the stored one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def compare_tables(rebuilt: DataFrame, stored: DataFrame, keys: list[str], rel: float = 1e-9, absolute: float = 1e-12) -> DataFrame:
    """(keys, column, rebuilt, stored) of every difference: rows missing on a side, and values apart by more than the tolerances; null equals null."""
    values = [c for c in rebuilt.columns if c not in keys]
    kinds = dict(rebuilt.dtypes)
    a = rebuilt.select(*keys, F.struct(*values).alias("a"))
    b = stored.select(*keys, F.struct(*values).alias("b"))
    j = a.join(b, keys, "full_outer")

    def row(c):
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        same = x.eqNullSafe(y)
        if kinds[c] in ("double", "float"):
            same = same | F.coalesce(F.abs(x - y) <= absolute + rel * F.greatest(F.abs(x), F.abs(y)), F.lit(False))
        return F.when(F.col("a").isNotNull() & F.col("b").isNotNull() & ~same, F.struct(F.lit(c).alias("column"), x.cast("string").alias("rebuilt"), y.cast("string").alias("stored")))

    side = F.when(F.col("a").isNull(), F.struct(F.lit("(row)").alias("column"), F.lit(None).cast("string").alias("rebuilt"), F.lit("present").alias("stored"))).when(F.col("b").isNull(), F.struct(F.lit("(row)").alias("column"), F.lit("present").alias("rebuilt"), F.lit(None).cast("string").alias("stored")))
    return j.select(*keys, F.explode(F.array_compact(F.array(side, *map(row, values)))).alias("d")).select(*keys, "d.*")


def check_lake_rows(rows: DataFrame) -> DataFrame:
    """Rows whose detected, undetected and empty cells don't add up to the lake's."""
    return rows.filter("detectable_cells + non_detectable_cells + no_valid_data_cells <> lake_cells")


def check_histogram(rows: DataFrame) -> DataFrame:
    """Rows of the external counts whose classes don't add up, are negative, or come with an area that isn't a number."""
    return rows.filter("dn_zero + dn_detected + dn_land + dn_no_data <> total_cells or least(dn_zero, dn_detected, dn_land, dn_no_data) < 0 or area_km2 is null or isnan(area_km2)")


def verify_master(master: DataFrame, counts: DataFrame) -> DataFrame:
    """(scene_no, problem): a lake twice in a scene, or a scene whose rows differ in number from its stored count (0 for empty scenes)."""
    twice = master.groupBy("scene_no", "hylak_id").count().filter("count > 1").select("scene_no", F.lit("duplicate lake").alias("problem")).distinct()
    have = master.groupBy("scene_no").agg(F.count("*").alias("have"))
    off = have.join(counts, "scene_no", "full_outer").filter("coalesce(have, 0) <> coalesce(n_rows, 0)").select("scene_no", F.lit("row count").alias("problem"))
    return twice.union(off)


def validate_lake_pixels(pixels: DataFrame, scene: int, required: list[str]) -> DataFrame:
    """pixels, or an error if a column is missing, there are none, or they are of another scene."""
    missing = [c for c in required if c not in pixels.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    n, other = pixels.agg(F.count("*"), F.count_if(F.col("scene_no") != scene)).first()
    if not n or other:
        raise ValueError("no pixels" if not n else f"{other} pixels of another scene")
    return pixels


def rebuild_daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows from the stored science layers alone."""
    from ..sources.tables import read_daily_science
    from .daily import daily_lakes

    return daily_lakes(read_daily_science(spark, path))


def reproduce(spark: SparkSession, path: str, stored: DataFrame) -> DataFrame:
    """Differences between daily rows rebuilt from the science layers below path and the stored rows."""
    return compare_tables(rebuild_daily(spark, path), stored, ["date_solar", "hylak_id"])
