"""Quality masks of swath pixels and the values that lake pixels keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bands as B
from .nulls import flag

FLAG_BITS = {"LAND": 1, "CLDICE": 2, "HISATZEN": 4, "NAVFAIL": 8}
BRIGHT = 0.08
#: The twelve masks of the daily product in their fixed order; mask k is bit k of the packed column masks.
MASKS = ("valid_water", "strict_valid", "rescued", "cldice", "hisatzen", "navfail", "cloud_excluded", "ci_valid", "candidate", "detected", "mph_valid", "fai_valid")
RHOS = tuple(f"r{w}" for w in B.WAVELENGTHS)


def with_indices(pixels: DataFrame) -> DataFrame:
    """Adds the index family; r443 and cloud_albedo may be missing columns."""
    for c in ("r443", "cloud_albedo"):
        if c not in pixels.columns:
            pixels = pixels.withColumn(c, F.lit(None).cast("float"))
    c = F.col
    pixels = pixels.withColumns({"ss681": B.ss681(c("r620"), c("r665"), c("r681"), c("r709")), "ss665": B.ss665(c("r620"), c("r665"), c("r681"), c("r709"))})
    most, at = B.mph(c("r665"), c("r681"), c("r709"), c("r754"), c("r885"))
    r = {w: c(f"r{w}") for w in B.WAVELENGTHS}
    return pixels.withColumns({
        "ci": B.ci(c("ss681")), "ci_cyano": B.ci_cyano(c("ss681"), c("ss665")), "ndci": B.ndci(c("r665"), c("r709")),
        "fai": B.fai(c("r665"), c("r754"), c("r865")), "mph": most, "mph_peak_nm": at, "mci": B.mci(c("r681"), c("r709"), c("r754")),
        "clear_water": B.clear_water(r),
    }).withColumn("ci_adjacency", B.ci_adjacency(c("ss681"), c("clear_water"), c("mci")))


def with_masks(pixels: DataFrame, in_lake: Column | None = None, habs: bool = True, rescue: bool = False, bright: float | None = None) -> DataFrame:
    """Adds the masks. in_lake: default all. rescue and bright are off unless asked for."""
    c = F.col
    bit = lambda name: B.flag_is_set(c("l2_flags"), FLAG_BITS, name)
    r = {w: c(f"r{w}") for w in B.WAVELENGTHS}
    located = c("lat").isNotNull() & c("lon").isNotNull()
    out = pixels.withColumn("base", flag((F.lit(True) if in_lake is None else in_lake) & located & c("l2_flags").isNotNull()) & ~bit("LAND"))
    out = out.withColumn("cldice", c("base") & bit("CLDICE"))
    out = out.withColumn("cloud", B.cloud(r, c("cloud_albedo")) if habs else bit("CLDICE"))
    hard = bit("HISATZEN") | bit("NAVFAIL")
    saved = flag(c("base") & c("cloud") & ~hard & c("ci_cyano").isNotNull() & (c("fai") > 0) & (c("r754") > c("r490"))) if rescue else F.lit(False)
    out = out.withColumn("rescued", saved)
    out = out.withColumn("strict_valid", c("base") & ~c("cloud") & ~hard)
    out = out.withColumn("valid_water", c("strict_valid") | c("rescued"))
    out = out.withColumn("cloud_excluded", c("base") & c("cloud") & ~c("rescued"))
    if bright is not None:
        out = out.withColumn("valid_water", c("valid_water") & ~flag(c("r865") > bright))
    out = out.withColumn("ci_valid", c("valid_water") & c("ss681").isNotNull() & c("ss665").isNotNull() & ~c("ci_adjacency"))
    out = out.withColumn("candidate", c("ci_valid") & c("ci").isNotNull() & ~c("clear_water"))
    out = out.withColumn("detected", c("ci_valid") & c("ci_cyano").isNotNull() & ~c("clear_water"))
    out = out.withColumns({f"{x}_valid": c("valid_water") & c(x).isNotNull() for x in ("ndci", "mph", "fai")} | {"hisatzen": c("base") & bit("HISATZEN"), "navfail": c("base") & bit("NAVFAIL")})
    return out.withColumn("masks", packed(MASKS))


def packed(masks: tuple[str, ...]) -> Column:
    """Masks as bits of one number, the first one lowest."""
    return sum((F.when(F.col(m), 1 << k).otherwise(0) for k, m in enumerate(masks)), F.lit(0))


def unpacked(mask: str) -> Column:
    """One mask of the packed column; null where nothing was observed (-1)."""
    return F.when(F.col("masks") >= 0, F.col("masks").bitwiseAND(1 << MASKS.index(mask)) != 0)


def land_adjacent(pixels: DataFrame, steps: int) -> DataFrame:
    """Keys of pixels within so many 4-neighbour steps of land that are not land themselves."""
    land = pixels.filter(B.flag_is_set(F.col("l2_flags"), FLAG_BITS, "LAND")).select("scene_no", "source_row", "source_col").distinct()
    shifts = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-steps, steps + 1) for b in range(-steps, steps + 1) if abs(a) + abs(b) <= steps))
    near = land.select("scene_no", "source_row", "source_col", F.explode(shifts).alias("s")).select("scene_no", (F.col("source_row") + F.col("s.a")).alias("source_row"), (F.col("source_col") + F.col("s.b")).alias("source_col")).distinct()
    keys = ["scene_no", "source_row", "source_col"]
    return pixels.select(*keys).distinct().join(near, keys, "left_semi").join(land, keys, "left_anti")


def lake_pixel_values(pixels: DataFrame) -> DataFrame:
    """Values of in-lake located pixels, cloudy ones included, null where their own mask is false."""
    own = {"ci": "candidate", "ci_cyano": "detected", "ndci": "ndci_valid", "mph": "mph_valid", "fai": "fai_valid"}
    kept = pixels.filter("hylak_id is not null and lat is not null and lon is not null")
    return kept.withColumns({v: F.when(F.col(m), F.col(v)) for v, m in own.items()})


def daily_inputs(pixels: DataFrame) -> DataFrame:
    """Per pixel the five daily values: CI_cyano covers all valid water with 0 where nothing is detected; bands only where retained and all nine are there."""
    nine = [f"r{w}" for w in B.WAVELENGTHS if w != 443]
    whole = F.col("valid_water")
    for b in nine:
        whole = whole & F.col(b).isNotNull()
    value = F.when(F.col("candidate"), F.col("ci"))
    out = pixels.filter("lat is not null and lon is not null and source_row is not null and source_col is not null")
    out = out.withColumns({"d_ci": value, "d_ci_cyano": F.when(F.col("ci_valid"), F.when(flag(F.col("ss665") > 0) & F.col("candidate"), F.col("ci")).otherwise(F.lit(0.0).cast("float")))})
    out = out.withColumns({f"d_{x}": F.when(F.col(f"{x}_valid"), F.col(x)) for x in ("ndci", "mph", "fai")})
    return out.withColumns({f"d_{b}": F.when(whole, F.col(b)) for b in nine})
