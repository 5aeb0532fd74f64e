"""Times, names and small texts."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .isin import wrap

#: Published naming of Sentinel-3 products, fields at fixed places: mission, instrument, level and type, then sensing start and stop, creation, duration, cycle, relative orbit, frame, centre, class, timeliness and baseline. (first character from 0, length) of each field.
MISSIONS, FULL_RESOLUTION = ("S3A", "S3B"), "_OL_1_EFR____"
PLACES = {"satellite": (0, 3), "kind": (3, 13), "start": (16, 15), "stop": (32, 15), "created": (48, 15), "duration": (64, 4), "cycle": (69, 3), "orbit": (73, 3), "frame": (77, 4), "timeliness": (88, 2), "baseline": (91, 3)}
#: Preference among the versions of one acquisition.
TIMELINESS = {"NT": 0, "ST": 1, "NR": 2}
KM_PER_DEGREE = 111.32


def solar_time(start: Column, lon: Column) -> Column:
    """UTC plus 15 degrees of longitude an hour."""
    return F.timestamp_add("MICROSECOND", F.rint(wrap(lon) * 240e6).cast("long"), start)


def solar_date(start: Column, lon: Column) -> Column:
    return F.to_date(solar_time(start, lon))


def utc_window(day: Column, west: Column, east: Column) -> tuple[Column, Column]:
    """First and last UTC dates that a solar date can fall on between two longitudes."""
    first = F.timestamp_add("MICROSECOND", F.rint(-wrap(east) * 240e6).cast("long"), day.cast("timestamp_ntz"))
    last = F.timestamp_add("MICROSECOND", F.rint(-wrap(west) * 240e6).cast("long") + 86_400_000_000 - 1, day.cast("timestamp_ntz"))
    return F.to_date(first), F.to_date(last)


def utc_date(text: Column) -> Column:
    """Date in UTC of an ISO text; a text without zone is an error."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(text.isNull(), None).when(zoned, F.to_date(F.to_timestamp(text))).otherwise(F.raise_error(F.concat(F.lit("no time zone in "), text)).cast("date"))


def iso_day(text: Column) -> Column:
    """YYYY-MM-DD or YYYYMMDD to a date, else null."""
    dashed = F.regexp_replace(text, r"^(\d{4})-?(\d{2})-?(\d{2}).*$", "$1-$2-$3")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}|^\d{8}"), F.try_to_date(dashed, "yyyy-MM-dd"))


def _field(name: Column, key: str) -> Column:
    at, n = PLACES[key]
    return F.substring(name, at + 1, n)


def _sensed(name: Column) -> Column:
    """Whether a name begins as one of a full-resolution product, up to its times."""
    times = [_field(name, k).rlike("^[0-9]{8}T[0-9]{6}$") for k in ("start", "stop", "created")]
    return _field(name, "satellite").isin(*MISSIONS) & (_field(name, "kind") == FULL_RESOLUTION) & times[0] & times[1] & times[2]


def product(name: Column) -> dict[str, Column]:
    """Fields of a product name, null where it is none."""
    whole = _sensed(name) & _field(name, "timeliness").isin(*TIMELINESS) & _field(name, "baseline").rlike("^[0-9]{3}$") & F.substring(name, 95, 100).isin("", ".SEN3")
    return {f"p_{k}": F.when(whole, _field(name, k)) for k in ("satellite", "start", "stop", "created", "timeliness", "baseline")}


def timeliness_rank(t: Column) -> Column:
    out = F.when(t.isNull(), 9)
    for k, v in TIMELINESS.items():
        out = out.when(t == k, v)
    return out.otherwise(9)


def frame(name: Column) -> dict[str, Column]:
    """Place of a product in its orbit, null where the name has none."""
    keys = ("duration", "cycle", "orbit", "frame")
    whole = _sensed(name) & F.concat(*(_field(name, k) for k in keys)).rlike("^[0-9]{14}$")
    number = {k: F.when(whole, F.try_to_number(_field(name, k), F.lit("9999")).cast("int")) for k in keys}
    label = F.when(whole, F.concat(_field(name, "satellite"), F.lit("_R"), _field(name, "orbit"), F.lit("_F"), _field(name, "frame")))
    return {"platform": F.when(whole, _field(name, "satellite")), "duration_s": number["duration"], "cycle": number["cycle"], "relative_orbit": number["orbit"], "frame": number["frame"], "native_frame_id": label}


def window_id(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Name of a processing window; FULL for none."""
    text = F.format_string("%.6f,%.6f,%.6f,%.6f", west, south, east, north)
    return F.when(west.isNull(), "FULL").otherwise(F.concat(F.lit("W_"), F.substring(F.sha1(text), 1, 10)))


def expand_box(west: Column, south: Column, east: Column, north: Column, km: float) -> tuple[Column, Column, Column, Column]:
    middle = F.greatest(F.lit(-85.0), F.least(F.lit(85.0), (south + north) / 2.0))
    dlat, dlon = km / KM_PER_DEGREE, km / F.greatest(KM_PER_DEGREE * F.cos(F.radians(middle)), F.lit(1.0))
    return F.greatest(F.lit(-180.0), west - dlon), F.greatest(F.lit(-90.0), south - dlat), F.least(F.lit(180.0), east + dlon), F.least(F.lit(90.0), north + dlat)


def valid_box(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.coalesce((west >= -180) & (east <= 180) & (south >= -90) & (north <= 90) & (west < east) & (south < north), F.lit(False))


def great_circle_m(lat0: Column, lon0: Column, lat1: Column, lon1: Column) -> Column:
    """Metres on a sphere of 6371 km, from the chord."""
    unit = lambda a, o: (F.cos(F.radians(a)) * F.cos(F.radians(o)), F.cos(F.radians(a)) * F.sin(F.radians(o)), F.sin(F.radians(a)))
    chord = F.sqrt(sum(((a - b) * (a - b) for a, b in zip(unit(lat0, lon0), unit(lat1, lon1), strict=True)), F.lit(0.0)))
    return 6371000.0 * 2.0 * F.asin(F.least(F.lit(1.0), chord / 2.0))


def lake_label(name: Column, hylak_id: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(name), F.lit("")), F.concat(F.lit("(unnamed, Hylak_id "), hylak_id.cast("string"), F.lit(")")))


def lake_longitude(pour_lon: Column, inside_lon: Column) -> Column:
    return F.coalesce(F.when(pour_lon.between(-180, 180), pour_lon), inside_lon)


def scene_start(text: Column) -> Column:
    """One key of a JSON text."""
    return F.get_json_object(text, "$.start")


def transfer_rate(n_bytes: Column, seconds: Column) -> tuple[Column, Column]:
    """MiB, and MiB a second; null for no time."""
    mib = n_bytes / 1048576.0
    return F.round(mib, 3), F.round(F.when(seconds > 0, F.try_divide(mib, seconds.cast("double"))), 3)


def config_fingerprint(settings: dict) -> str:
    """Sixteen hex digits that name a set of settings, whatever their order."""
    return hashlib.sha1(json.dumps(settings, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def signature(scene: str, outcome: str) -> Column:
    """Aggregate: sixteen hex digits over the sorted (scene, outcome) pairs."""
    pairs = F.array_sort(F.collect_list(F.concat_ws("=", F.col(scene).cast("string"), F.col(outcome))))
    return F.substring(F.sha2(F.array_join(pairs, "|"), 256), 1, 16)
