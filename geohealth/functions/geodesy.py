"""World Mercator (EPSG:3395), footprints and affine transforms in closed form, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the WGS84 ellipsoid.
A, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(E2)


def dms_to_decimal(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    """Degrees, minutes and seconds; south and west are negative."""
    value = degrees + minutes / 60 + seconds / 3600
    return F.when(hemisphere.isin("S", "W"), -value).otherwise(value)


def mercator_x(lon: Column) -> Column:
    return A * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    return A * (0.5 * F.log((1 + s) / (1 - s)) - (ECC / 2) * F.log((1 + ECC * s) / (1 - ECC * s)))


def inverse_lon(x: Column) -> Column:
    return F.degrees(x / A)


def inverse_lat(y: Column, rounds: int = 6) -> Column:
    """Fixed-point iteration from the spherical latitude."""
    t = F.exp(-y / A)
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(rounds):
        s = ECC * F.sin(phi)
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), ECC / 2))
    return F.degrees(phi)


def offset(lat: Column, lon: Column, north_m: Column, east_m: Column) -> tuple[Column, Column]:
    """(lat, lon) after short ways north and east, by the radii of curvature at the point."""
    s2 = F.pow(F.sin(F.radians(lat)), 2)
    w = F.sqrt(1 - E2 * s2)
    meridian, prime = A * (1 - E2) / F.pow(w, 3), A / w
    return lat + F.degrees(north_m / meridian), lon + F.degrees(east_m / (prime * F.cos(F.radians(lat))))


def footprint(lat: Column, lon: Column, width: Column, height: Column, gsd_cm: Column) -> dict[str, Column]:
    """Mercator bounds of the points half a height north and south, and half a width east and west, of the centre."""
    dy, dx, none = gsd_cm * height / 200, gsd_cm * width / 200, F.lit(0.0)
    north, south = offset(lat, lon, dy, none)[0], offset(lat, lon, -dy, none)[0]
    east, west = offset(lat, lon, none, dx)[1], offset(lat, lon, none, -dx)[1]
    return {"xmin": mercator_x(west), "ymin": mercator_y(south), "xmax": mercator_x(east), "ymax": mercator_y(north)}


def pixel_to_map(gt: list[Column], px: Column, line: Column) -> tuple[Column, Column]:
    """Six coefficients of an affine transform applied to a pixel and line."""
    return gt[0] + px * gt[1] + line * gt[2], gt[3] + px * gt[4] + line * gt[5]


def rotate_affine(gt: list[Column], degrees: Column, px: Column, py: Column) -> list[Column]:
    """The transform turned by an angle about the map point of pixel (px, py)."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    x, y = pixel_to_map(gt, px, py)
    turn = lambda dx, dy: (c * dx - s * dy, s * dx + c * dy)
    (x0, y0), (a1, a4), (a2, a5) = turn(gt[0] - x, gt[3] - y), turn(gt[1], gt[4]), turn(gt[2], gt[5])
    return [x + x0, a1, a2, y + y0, a4, a5]


def bounds(gt: list[Column], width: Column, height: Column) -> dict[str, Column]:
    zero = F.lit(0.0)
    corners = [pixel_to_map(gt, x, y) for x in (zero, width) for y in (zero, height)]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return {"xmin": F.least(*xs), "ymin": F.least(*ys), "xmax": F.greatest(*xs), "ymax": F.greatest(*ys)}


def box_geojson(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A closed ring as a GeoJSON polygon."""
    ring = F.array(*[F.array(x, y) for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))])
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))
