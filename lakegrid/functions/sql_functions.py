"""The scalar functions as SQL functions, so that queries in SQL text stay native plans.

register(spark) creates them as temporary functions of the session. Each is one SQL expression, which
Spark writes into the plan: no Python, no call per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .bands import DETECTION_LIMIT, DN_INTERCEPT, DN_SLOPE
from .isin import N_ROWS, RADIUS
from .masks import FLAG_BITS
from .nulls import FILL

_BIT = " ".join(f"WHEN '{name}' THEN {bit}" for name, bit in FLAG_BITS.items())
_FLOAT_SUM = "(CAST(edge AS FLOAT) + CAST(red AS FLOAT))"
_UNIT = "POW(COS(RADIANS(lat0)) * COS(RADIANS(lon0)) - COS(RADIANS(lat1)) * COS(RADIANS(lon1)), 2) + POW(COS(RADIANS(lat0)) * SIN(RADIANS(lon0)) - COS(RADIANS(lat1)) * SIN(RADIANS(lon1)), 2) + POW(SIN(RADIANS(lat0)) - SIN(RADIANS(lat1)), 2)"

#: name: (parameters, type of the result, expression)
FUNCTIONS = {
    # values and bands
    "lg_to_null": ("x DOUBLE", "DOUBLE", f"CASE WHEN NOT (ISNAN(x) OR ABS(x) = DOUBLE('Infinity') OR x = {FILL}D) THEN x END"),
    "lg_flag_is_set": ("flags BIGINT, name STRING", "BOOLEAN", f"COALESCE(flags & CASE name {_BIT} ELSE 0 END <> 0, FALSE)"),
    "lg_ndci": ("red FLOAT, edge FLOAT", "FLOAT", f"CASE WHEN ABS({_FLOAT_SUM}) > 1e-8D THEN CAST(TRY_DIVIDE(CAST(CAST(edge AS FLOAT) - CAST(red AS FLOAT) AS DOUBLE), CAST({_FLOAT_SUM} AS DOUBLE)) AS FLOAT) END"),
    "lg_line_height": ("c DOUBLE, l DOUBLE, r DOUBLE, wc DOUBLE, wl DOUBLE, wr DOUBLE", "DOUBLE", "c - (l + (r - l) * ((wc - wl) / (wr - wl)))"),
    "lg_ci_to_dn": ("value DOUBLE, valid BOOLEAN", "INT", f"CASE WHEN NOT COALESCE(valid, FALSE) THEN 255 WHEN COALESCE(value >= {DETECTION_LIMIT!r}D, FALSE) THEN CAST(GREATEST(1D, LEAST(253D, RINT((LOG10(value) - ({DN_INTERCEPT}D)) / {DN_SLOPE}D))) AS INT) ELSE 0 END"),
    "lg_dn_to_ci": ("dn INT", "DOUBLE", f"CASE WHEN dn > 253 THEN NULL WHEN dn >= 1 THEN POW(10D, dn * {DN_SLOPE}D + ({DN_INTERCEPT}D)) ELSE 0D END"),
    # grid
    "lg_wrap": ("lon DOUBLE", "DOUBLE", "lon + 180D - 360D * FLOOR((lon + 180D) / 360D) - 180D"),
    "lg_bins_in_row": ("row INT", "BIGINT", f"CAST(FLOOR(2D * {N_ROWS} * COS(RADIANS((row + 0.5D) * 180D / {N_ROWS}D - 90D)) + 0.5D) AS BIGINT)"),
    "lg_row_of": ("lat DOUBLE", "INT", f"CASE WHEN lat >= -90 AND lat <= 90 THEN CAST(GREATEST(0, LEAST({N_ROWS - 1}, FLOOR((lat + 90D) * {N_ROWS} / 180D))) AS INT) END"),
    "lg_col_of": ("lon DOUBLE, n BIGINT", "BIGINT", "CAST(LEAST(FLOOR((lg_wrap(lon) + 180D) / 360D * n), n - 1) AS BIGINT)"),
    "lg_bin_key": ("before BIGINT, col BIGINT", "BIGINT", "before + col + 1"),
    "lg_centre_lat": ("row INT", "DOUBLE", f"(row + 0.5D) * 180D / {N_ROWS}D - 90D"),
    "lg_centre_lon": ("row INT, col BIGINT", "DOUBLE", "(col + 0.5D) * 360D / lg_bins_in_row(row) - 180D"),
    "lg_bin_area": ("row INT", "DOUBLE", f"2D * PI() * {RADIUS}D * {RADIUS}D * (SIN(RADIANS((row + 1) * 180D / {N_ROWS}D - 90D)) - SIN(RADIANS(row * 180D / {N_ROWS}D - 90D))) / lg_bins_in_row(row)"),
    # times and names
    "lg_solar_date": ("start TIMESTAMP_NTZ, lon DOUBLE", "DATE", "TO_DATE(TIMESTAMPADD(MICROSECOND, CAST(RINT(lg_wrap(lon) * 240e6D) AS BIGINT), start))"),
    "lg_iso_day": ("text STRING", "DATE", r"CASE WHEN text RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}|^[0-9]{8}' THEN TRY_TO_DATE(REGEXP_REPLACE(text, '^([0-9]{4})-?([0-9]{2})-?([0-9]{2}).*$', '$1-$2-$3'), 'yyyy-MM-dd') END"),
    "lg_window_id": ("west DOUBLE, south DOUBLE, east DOUBLE, north DOUBLE", "STRING", "CASE WHEN west IS NULL THEN 'FULL' ELSE CONCAT('W_', SUBSTRING(SHA1(FORMAT_STRING('%.6f,%.6f,%.6f,%.6f', west, south, east, north)), 1, 10)) END"),
    "lg_lake_label": ("name STRING, hylak_id BIGINT", "STRING", "COALESCE(NULLIF(TRIM(name), ''), CONCAT('(unnamed, Hylak_id ', CAST(hylak_id AS STRING), ')'))"),
    "lg_great_circle_m": ("lat0 DOUBLE, lon0 DOUBLE, lat1 DOUBLE, lon1 DOUBLE", "DOUBLE", f"6371000D * 2D * ASIN(LEAST(1D, SQRT({_UNIT}) / 2D))"),
}


def register(spark: SparkSession) -> None:
    """Creates the functions in the session, or creates them anew."""
    for name, (parameters, kind, expression) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {expression}")
