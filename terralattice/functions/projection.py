"""Fixed-grid navigation as Column expressions.

Scan angles (x east, y north, radians) of a geostationary imager to geodetic
latitude / longitude in degrees and back, on an ellipsoid.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Projection:
    lon_origin: float = -75.0
    height: float = 35786023.0
    r_eq: float = 6378137.0
    r_pol: float = 6356752.31414

    @property
    def orbit(self) -> float:
        return self.height + self.r_eq

    @property
    def flat2(self) -> float:
        """Squared ratio of the semi-axes."""
        return (self.r_eq / self.r_pol) ** 2

    def as_struct(self) -> Column:
        return F.struct(F.lit(self.lon_origin).alias("lon_origin"), F.lit(self.height).alias("h"),
                        F.lit(self.r_eq).alias("req"), F.lit(self.r_pol).alias("rpol"))


def wrap_lon(lon: Column) -> Column:
    """Longitude into [-180, 180)."""
    return lon - F.lit(360.0) * F.floor((lon + F.lit(180.0)) / F.lit(360.0))


def reach(sin_x: Column, cos_x: Column, sin_y: Column, cos_y: Column, p: Projection) -> Column:
    """Distance from the satellite to the ellipsoid along a scan angle; NaN off the disk."""
    a = sin_x * sin_x + cos_x * cos_x * (cos_y * cos_y + F.lit(p.flat2) * sin_y * sin_y)
    b = F.lit(-2.0 * p.orbit) * cos_x * cos_y
    c = F.lit(p.orbit ** 2 - p.r_eq ** 2)
    return (-b - F.sqrt(b * b - F.lit(4.0) * a * c)) / (F.lit(2.0) * a)


def ground(distance: Column, sin_x: Column, cos_x: Column, sin_y: Column, cos_y: Column,
           p: Projection) -> tuple[Column, Column]:
    """(lat, longitude east of the sub-point), degrees, at a distance along a scan angle."""
    px, py, pz = distance * cos_x * cos_y, -distance * sin_x, distance * cos_x * sin_y
    inward = F.lit(p.orbit) - px
    lat = F.atan(F.lit(p.flat2) * pz / F.sqrt(inward * inward + py * py))
    return F.degrees(lat), F.degrees(-F.atan(py / inward))


def relative_latlon(x: Column, y: Column, p: Projection) -> tuple[Column, Column]:
    """(lat, longitude east of the sub-point), degrees; NaN off the disk."""
    trig = (F.sin(x), F.cos(x), F.sin(y), F.cos(y))
    return ground(reach(*trig, p), *trig, p)


def scan_to_latlon(x: Column, y: Column, p: Projection) -> tuple[Column, Column]:
    lat, dlon = relative_latlon(x, y, p)
    return lat, wrap_lon(dlon + F.lit(p.lon_origin))


def latlon_to_scan(lat: Column, lon: Column, p: Projection) -> tuple[Column, Column, Column]:
    """(x, y, visible) for geodetic degrees."""
    geo = F.atan(F.lit(1.0 / p.flat2) * F.tan(F.radians(lat)))
    ecc2 = 1.0 - 1.0 / p.flat2
    cg, sg = F.cos(geo), F.sin(geo)
    radius = F.lit(p.r_pol) / F.sqrt(F.lit(1.0) - F.lit(ecc2) * cg * cg)
    dlon = F.radians(wrap_lon(lon - F.lit(p.lon_origin)))
    px = F.lit(p.orbit) - radius * cg * F.cos(dlon)
    py = -radius * cg * F.sin(dlon)
    pz = radius * sg
    x = F.asin(-py / F.sqrt(px * px + py * py + pz * pz))
    y = F.atan(pz / px)
    visible = F.lit(p.orbit) * (F.lit(p.orbit) - px) >= py * py + F.lit(p.flat2) * pz * pz
    return x, y, visible
