"""Indices from Rayleigh-corrected reflectances, null where an input is missing.

The two-stage cyanobacteria index is single precision, the line heights double, as the
definitions they follow have it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import flag, real

#: index = 10 ** (DN * slope + intercept); DN 1 is the detection limit.
DN_SLOPE, DN_INTERCEPT = 0.011714, -4.1870866
DETECTION_LIMIT = 10 ** (DN_SLOPE + DN_INTERCEPT)
CLOUD_THRESHOLD, KD_MAX = 0.08, 0.31
WAVELENGTHS = (443, 490, 560, 620, 665, 681, 709, 754, 865, 885)


def nearest_band(columns: list[str], prefix: str, nm: float, tolerance: float = 12) -> str | None:
    """The column of the given prefix whose wavelength is nearest; ties by name; none beyond the tolerance."""
    found = [(abs(float(c[len(prefix) :]) - nm), c) for c in columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    best = min(found, default=None)
    return best[1] if best and best[0] <= tolerance else None


def flag_map(meanings: list[str], masks: list[int]) -> dict[str, int]:
    """Name to bit mask of a flag variable."""
    if len(meanings) != len(masks):
        raise ValueError("flag meanings and masks differ in number")
    return dict(zip(meanings, masks, strict=True))


def flag_is_set(flags: Column, bits: dict[str, int], name: str) -> Column:
    """Whether the named bit is set; false for a name the source doesn't have."""
    return flag(flags.bitwiseAND(bits[name]) != 0) if name in bits else F.lit(False)


def unpack_range(low: float | None, high: float | None, scale: float = 1.0, offset: float = 0.0) -> tuple[float, float]:
    """Valid range in physical units; open where a side is not given."""
    return (-float("inf") if low is None else low * scale + offset, float("inf") if high is None else high * scale + offset)


def spectral_shape(center: Column, left: Column, right: Column, wc: float, wl: float, wr: float) -> Column:
    """center - left - (right - left) (wc - wl) / (wr - wl), single precision."""
    c, a, b = (x.cast("float") for x in (center, left, right))
    return (c - a - (b - a) * real((wc - wl) / (wr - wl))).cast("float")


def ss681(r620: Column, r665: Column, r681: Column, r709: Column) -> Column:
    """Null unless all four bands are there."""
    return F.when(r620.isNotNull(), spectral_shape(r681, r665, r709, 681, 665, 709))


def ss665(r620: Column, r665: Column, r681: Column, r709: Column) -> Column:
    return F.when(r709.isNotNull(), spectral_shape(r665, r620, r681, 665, 620, 681))


def ci(ss_681: Column) -> Column:
    """Cyanobacteria index of candidates: where the 681 nm shape is negative."""
    return F.when(ss_681 < 0, -ss_681)


def ci_cyano(ss_681: Column, ss_665: Column) -> Column:
    """The index of detections: candidates with a positive 665 nm shape above the limit."""
    x = ci(ss_681)
    return F.when((ss_665 > 0) & (x.cast("double") > DETECTION_LIMIT), x)


def ndci(red: Column, edge: Column) -> Column:
    total = edge.cast("float") + red.cast("float")
    return F.when(F.abs(total) > 1e-8, F.try_divide((edge.cast("float") - red.cast("float")).cast("double"), total.cast("double")).cast("float"))


def line_height(center: Column, left: Column, right: Column, wc: float, wl: float, wr: float) -> Column:
    """Height of the center band above the line between the other two."""
    c, a, b = (x.cast("double") for x in (center, left, right))
    return c - (a + (b - a) * ((wc - wl) / (wr - wl)))


def fai(r665: Column, r754: Column, r865: Column) -> Column:
    return line_height(r754, r665, r865, 754, 665, 865)


def mph(r665: Column, r681: Column, r709: Column, r754: Column, r885: Column) -> tuple[Column, Column]:
    """Maximum peak height of 681, 709 and 754 nm above 665 to 885 nm, and the peak's wavelength (the first of equal ones)."""
    peaks = {w: line_height(c, r665, r885, w, 665, 885) for w, c in ((681, r681), (709, r709), (754, r754))}
    most = F.greatest(*peaks.values())
    at = F.when(most.isNull(), None)
    for w, h in peaks.items():
        at = at.when(h == most, float(w))
    return most, at


def mci(r681: Column, r709: Column, r754: Column) -> Column:
    a, b, c = (x.cast("double") for x in (r681, r709, r754))
    return b - a - (c - a) * (709.0 - 681.0) / (754.0 - 681.0)


def cloud(r: dict[int, Column], albedo: Column, low: float = -float("inf"), high: float = float("inf"), threshold: float = CLOUD_THRESHOLD) -> Column:
    """The bloom-aware cloud test over nine bands.

    Judged only where seven bands are non-negative. The turbidity signal is taken off the
    albedo (865 nm where it is missing or negative) before the threshold; scum with a green
    peak is no cloud, a very bright red is, and so is strong glint or an 865 nm value out of
    its valid range.
    """
    r = {w: c.cast("float") for w, c in r.items()}
    a = albedo.cast("float")
    within = lambda *ws: flag(sum((F.when(r[w] <= high, 0).otherwise(1) for w in ws), F.lit(0)) == 0)
    judged = F.lit(True)
    for w in (443, 560, 620, 665, 681, 709, 754):
        judged = judged & flag(r[w] >= 0)
    span, sums = real(754.0 - 443.0), real(620.0 + 665.0 + 681.0 - 3.0 * 443.0)
    slope = F.try_divide(r[754] - r[443], span).cast("float")
    turbid = (r[620] + r[665] + r[681] - real(3.0) * r[443] - (slope * sums).cast("float")).cast("float")
    turbid = F.when(within(443, 665, 620, 681, 754), turbid).otherwise(real(0.0))
    light = F.when(flag(a >= 0), a).otherwise(r[865])
    light = F.when(flag(turbid > 0), (light - real(3.0) * turbid).cast("float")).otherwise(light)
    out = flag(light.cast("double") > threshold)
    green = flag(r[560] > r[681])
    scum = within(754, 709, 681, 560)
    near = (r[754] + r[709]).cast("float")
    excess = (near - (r[665] + r[681]).cast("float")).cast("float")
    share = F.try_divide(excess.cast("double"), light.cast("double")).cast("float")
    out = out & ~(scum & within(443, 490) & flag(near > (r[443] + r[490]).cast("float")) & flag(light < real(0.1)) & green)
    out = out & ~(scum & within(665) & flag(excess > real(0.01)) & flag(light < real(0.15)) & green)
    out = out & ~(scum & within(665) & flag(share > real(0.1)) & green)
    out = out | (within(665) & flag(r[665] > real(0.1)) & flag(light > real(0.15)))
    inside = flag((r[865] >= low) & (r[865] <= high))
    out = out | (inside & flag((r[865] - a).cast("float") > real(0.25))) | ~inside
    return out & judged


def kd(r442: Column, r490: Column, red_a: Column, red_b: Column, r865: Column) -> Column:
    """Attenuation proxy; null where its denominator is 0, which no later test tells from infinite."""
    blue, red, far = (r442.cast("double") + r490.cast("double")) / 2, (red_a.cast("double") + red_b.cast("double")) / 2, r865.cast("double")
    return 0.7 * F.try_divide(red - far, blue - far)


def clear_water(r: dict[int, Column], most: float = KD_MAX) -> Column:
    """Clear water without algae, whose index counts as no detection."""
    d = {w: c.cast("double") for w, c in r.items()}
    first, second = kd(d[443], d[490], d[620], d[665], d[865]), kd(d[443], d[490], d[709], d[709], d[865])
    k = F.when(flag(second > first), second).otherwise(first)
    shape = d[560] - d[443] + (d[443] - d[620]) * (560.0 - 442.0) / (620.0 - 442.0)
    dark = flag(d[865] <= d[490]) | flag(d[865] <= d[665]) | flag(d[865] <= d[709])
    return flag(k < most) & flag(k > 0) & dark & flag(shape < 0.01)


def ci_adjacency(ss_681: Column, clear: Column, mci_: Column) -> Column:
    """Land adjacency: a positive index (0 in clear water) with a negative chlorophyll index."""
    return flag(F.when(clear, F.lit(0.0)).otherwise(-ss_681.cast("double")) > 0) & flag(mci_ < 0)


def ci_to_dn(value: Column, valid: Column) -> Column:
    """255 invalid, 0 valid below the limit, else 1 to 253."""
    raw = F.rint((F.log10(value.cast("double")) - DN_INTERCEPT) / DN_SLOPE)
    return F.when(~flag(valid), 255).when(flag(value.cast("double") >= DETECTION_LIMIT), F.greatest(F.lit(1.0), F.least(F.lit(253.0), raw)).cast("int")).otherwise(0)


def dn_to_ci(dn: Column) -> Column:
    """The index of a DN: 0 for 0, null above 253."""
    return F.when(dn > 253, None).when(dn >= 1, F.pow(F.lit(10.0), dn * DN_SLOPE + DN_INTERCEPT)).otherwise(0.0)
