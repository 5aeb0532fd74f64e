"""The global equal-area grid of N_ROWS rows of bins of about 290 m."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_ROWS = 69120
#: Radius of the sphere with the ellipsoid's surface, metres.
RADIUS = 6371007.181
WIDEST = 2 * N_ROWS


def wrap(lon: Column) -> Column:
    """Degrees to [-180, 180)."""
    x = lon.cast("double") + 180.0
    return x - 360.0 * F.floor(x / 360.0) - 180.0


def bins_in_row(row: Column) -> Column:
    """Bins of a row: the equator's, shrunk by the row's latitude, rounded."""
    lat = (row.cast("double") + 0.5) * 180.0 / float(N_ROWS) - 90.0
    return F.floor(2.0 * N_ROWS * F.cos(F.radians(lat)) + 0.5).cast("long")


def rows_table(spark: SparkSession) -> DataFrame:
    """(row, n, before) of all N_ROWS rows: a table of fixed size."""
    t = spark.range(N_ROWS).select(F.col("id").cast("int").alias("row"), bins_in_row(F.col("id")).alias("n"))
    return t.withColumn("before", F.sum("n").over(Window.orderBy("row")) - F.col("n"))


def row_of(lat: Column) -> Column:
    """Row of a latitude, null off Earth."""
    r = F.floor((lat.cast("double") + 90.0) * N_ROWS / 180.0)
    return F.when((lat >= -90) & (lat <= 90), F.greatest(F.lit(0), F.least(F.lit(N_ROWS - 1), r))).cast("int")


def col_of(lon: Column, n: Column) -> Column:
    c = F.floor((wrap(lon) + 180.0) / 360.0 * n)
    return F.least(c, n - 1).cast("long")


def with_bin(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Adds bin_row, bin_col and bin (0 off Earth); the row table is of fixed size and so is broadcast."""
    rows = rows_table(df.sparkSession).select(F.col("row").alias("bin_row"), "n", "before")
    out = df.withColumn("bin_row", row_of(F.col(lat))).join(F.broadcast(rows), "bin_row", "left")
    out = out.withColumn("bin_col", col_of(F.col(lon), F.col("n")))
    return out.withColumn("bin", F.coalesce(bin_key(F.col("before"), F.col("bin_col")), F.lit(0)).cast("long")).drop("n", "before")


def bin_key(before: Column, col: Column) -> Column:
    return before + col + 1


def with_row_col(df: DataFrame, bin_: str = "bin") -> DataFrame:
    """Adds bin_row and bin_col of a bin number: an equi-join on the number's bucket of WIDEST bins, which few rows touch."""
    rows = rows_table(df.sparkSession).withColumn("bucket", F.explode(F.sequence(F.expr(f"before div {WIDEST}"), F.expr(f"(before + n) div {WIDEST}"))))
    out = df.withColumn("bucket", F.expr(f"{bin_} div {WIDEST}")).join(F.broadcast(rows), "bucket")
    out = out.filter((F.col("before") < F.col(bin_)) & (F.col(bin_) <= F.col("before") + F.col("n")))
    return out.withColumn("bin_row", F.col("row")).withColumn("bin_col", F.col(bin_) - F.col("before") - 1).drop("bucket", "row", "n", "before")


def centre_lat(row: Column) -> Column:
    return (row.cast("double") + 0.5) * 180.0 / float(N_ROWS) - 90.0


def centre_lon(row: Column, col: Column) -> Column:
    return (col.cast("double") + 0.5) * 360.0 / bins_in_row(row) - 180.0


def bin_area(row: Column) -> Column:
    """Square metres of a row's bins on the sphere."""
    top, low = F.sin(F.radians((row + 1).cast("double") * 180.0 / float(N_ROWS) - 90.0)), F.sin(F.radians(row.cast("double") * 180.0 / float(N_ROWS) - 90.0))
    return 2.0 * math.pi * RADIUS * RADIUS * (top - low) / bins_in_row(row)


def project(lon: Column, lat: Column, lon0: Column) -> tuple[Column, Column]:
    """Sinusoidal plane, metres."""
    return RADIUS * F.radians(wrap(lon - lon0)) * F.cos(F.radians(lat.cast("double"))), RADIUS * F.radians(lat.cast("double"))


def unproject(x: Column, y: Column, lon0: Column) -> tuple[Column, Column]:
    return wrap(lon0 + F.degrees(F.try_divide(x, RADIUS * F.cos(y / RADIUS)))), F.degrees(y / RADIUS)


def central_meridian(lon: Column) -> Column:
    """Circular mean of longitudes, an aggregate."""
    return F.degrees(F.atan2(F.avg(F.sin(F.radians(lon.cast("double")))), F.avg(F.cos(F.radians(lon.cast("double"))))))


#: Fixed values of the two Albers grids: standard parallels, origin.
ALBERS = {"CONUS": (29.5, 45.5, 23.0, -96.0), "AK": (55.0, 65.0, 50.0, -154.0)}
AXIS, FLATTENING = 6378137.0, 1 / 298.257222101


def _albers_constants(region: str) -> tuple[float, float, float, float, float]:
    p1, p2, p0, l0 = (math.radians(v) for v in ALBERS[region])
    e2 = 2 * FLATTENING - FLATTENING**2
    e = math.sqrt(e2)
    q = lambda p: (1 - e2) * (math.sin(p) / (1 - e2 * math.sin(p) ** 2) - math.log((1 - e * math.sin(p)) / (1 + e * math.sin(p))) / (2 * e))
    m = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return n, c, AXIS * math.sqrt(c - n * q(p0)) / n, l0, e


def albers(lon: Column, lat: Column, region: str = "CONUS") -> tuple[Column, Column]:
    """Ellipsoidal equal-area conic, metres."""
    n, c, rho0, l0, e = _albers_constants(region)
    s = F.sin(F.radians(lat.cast("double")))
    q = s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e)
    rho, theta = AXIS * F.sqrt(c - n * (1 - e * e) * q) / n, n * F.radians(wrap(lon.cast("double") - math.degrees(l0)))
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def unalbers(x: Column, y: Column, region: str = "CONUS") -> tuple[Column, Column]:
    """Inverse, by the series of geodetic in authalic latitude up to the sixth power of the eccentricity (under 1e-7 degrees)."""
    n, c, rho0, l0, e = _albers_constants(region)
    e2 = e * e
    pole = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
    rho2 = x * x + (rho0 - y) * (rho0 - y)
    beta = F.asin((c - rho2 * n * n / (AXIS * AXIS)) / n / pole)
    terms = ((2, e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040), (4, 23 * e2**2 / 360 + 251 * e2**3 / 3780), (6, 761 * e2**3 / 45360))
    phi = sum((k * F.sin(m * beta) for m, k in terms), beta)
    return wrap(math.degrees(l0) + F.degrees(F.atan2(x, rho0 - y)) / n), F.degrees(phi)
