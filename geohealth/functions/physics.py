"""Units, humidity, vegetation indices and sensor arithmetic, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Magnus coefficients, and the scale of stored indices.
MAGNUS_B, MAGNUS_C, INDEX_SCALE, NODATA = 17.625, 243.04, 10_000, -9999.0


def clean_nodata(value: Column, nodata: float = NODATA) -> Column:
    """NULL where the value is NaN or the nodata mark."""
    return F.when(~F.isnan(value) & (value != nodata), value)


def kelvin_to_c(t: Column) -> Column:
    return t - 273.15


def m_to_mm(depth: Column) -> Column:
    return depth * 1000


def relative_humidity(t: Column, td: Column) -> Column:
    """Percent, from temperature and dew point in °C; NULL where either is."""
    return 100 * F.exp(MAGNUS_B * MAGNUS_C * (td - t) / ((MAGNUS_C + td) * (MAGNUS_C + t)))


def wrap_longitude(lon: Column) -> Column:
    """To [-180, 180)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def ndvi(nir: Column, red: Column) -> Column:
    """(nir - red) / (nir + red) within [-1, 1]; NULL where the sum is 0 or the result is not a number."""
    ratio = F.try_divide(nir - red, nir + red)
    return F.when(~F.isnan(ratio), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ratio)))


def reflectance(dn: Column, bits: Column, black: Column, gain: Column, exposure_us: Column, adjust: Column, irradiance: Column) -> Column:
    """Of a digital number; NULL where it is 0."""
    full = F.pow(F.lit(2.0), bits)
    signal = (dn / full - black / full) / (gain * (exposure_us / 1e6))
    return F.when(dn != 0, signal * adjust / irradiance)


def sensor_ndvi(nir: Column, red: Column) -> Column:
    """From two reflectances: outside of [-1, 1] missing, scaled, a 16-bit integer (halves go to the even one)."""
    ratio = F.try_divide(nir - red, nir + red)
    return F.when(ratio.between(-1.0, 1.0), F.bround(ratio * INDEX_SCALE).cast("smallint"))


def vignette(x: Column, y: Column, cx: Column, cy: Column, k: list[Column]) -> Column:
    """1 + k0 r + k1 r^2 + ... with r from the optical centre."""
    r = F.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))
    return 1 + r * reduce(lambda inner, c: c + r * inner, reversed(k[:-1]), k[-1])


def gsd_m(height: Column, sensor_width: Column, pixels: Column, focal: Column) -> Column:
    """Metres of ground that a pixel covers."""
    return height * sensor_width / (pixels * focal)


def valid_area(north: Column, west: Column, south: Column, east: Column) -> Column:
    inside = north.between(-90, 90) & south.between(-90, 90) & west.between(-180, 180) & east.between(-180, 180)
    return F.coalesce(inside & (north > south) & (east > west), F.lit(False))
