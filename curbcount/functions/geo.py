"""Point text and state-plane coordinates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 ellipsoid and the New York Long Island state-plane zone in US survey
# feet, from the public EPSG definition 2263.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1 = 41.0 + 2.0 / 60.0
PARALLEL_2 = 40.0 + 40.0 / 60.0
ORIGIN_LAT = 40.0 + 10.0 / 60.0
ORIGIN_LONG = -74.0
FALSE_EASTING = 300000.0
FALSE_NORTHING = 0.0
SURVEY_FOOT = 1200.0 / 3937.0

LATITUDE_STEPS = 5

_NUMBER = r"([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
POINT_PATTERN = rf"(?i)^\s*POINT\s*\(\s*{_NUMBER}\s+{_NUMBER}\s*\)\s*$"


def point_x(wkt: Column | str) -> Column:
    return _ordinate(wkt, 1)


def point_y(wkt: Column | str) -> Column:
    return _ordinate(wkt, 2)


def _ordinate(wkt: Column | str, group: int) -> Column:
    wkt = F.col(wkt) if isinstance(wkt, str) else wkt
    return F.regexp_extract(wkt, POINT_PATTERN, group).try_cast("double")


class ConformalCone:
    """Constants of a Lambert conformal conic projection with two standard parallels.

    Computed once on the driver from the zone definition; tasks only see literals.
    """

    def __init__(self) -> None:
        flattening = 1.0 / INVERSE_FLATTENING
        self.ecc = math.sqrt(flattening * (2.0 - flattening))
        phi1, phi2, phi0 = (math.radians(d) for d in (PARALLEL_1, PARALLEL_2, ORIGIN_LAT))
        self.n = math.log(self._scale(phi1) / self._scale(phi2)) / math.log(
            self._colatitude(phi1) / self._colatitude(phi2)
        )
        self.radius = SEMI_MAJOR * self._scale(phi1) / (self.n * self._colatitude(phi1) ** self.n)
        self.origin_radius = self.radius * self._colatitude(phi0) ** self.n

    def _scale(self, phi: float) -> float:
        return math.cos(phi) / math.sqrt(1.0 - (self.ecc * math.sin(phi)) ** 2)

    def _colatitude(self, phi: float) -> float:
        """Tangent of half the conformal colatitude."""
        stretch = math.exp(self.ecc * math.atanh(self.ecc * math.sin(phi)))
        return math.tan(math.pi / 4.0 - phi / 2.0) * stretch

    def forward(self, long_deg: float, lat_deg: float) -> tuple[float, float]:
        """Degrees to feet; used to build test points."""
        rho = self.radius * self._colatitude(math.radians(lat_deg)) ** self.n
        theta = self.n * math.radians(long_deg - ORIGIN_LONG)
        east = FALSE_EASTING + rho * math.sin(theta)
        north = FALSE_NORTHING + self.origin_radius - rho * math.cos(theta)
        return east / SURVEY_FOOT, north / SURVEY_FOOT


def _offsets(x: Column, y: Column, cone: ConformalCone) -> tuple[Column, Column]:
    east = x * F.lit(SURVEY_FOOT) - F.lit(FALSE_EASTING)
    south = F.lit(cone.origin_radius + FALSE_NORTHING) - y * F.lit(SURVEY_FOOT)
    return east, south


def longitude(x: Column, y: Column) -> Column:
    """State-plane feet to degrees east."""
    cone = ConformalCone()
    east, south = _offsets(x, y, cone)
    return F.degrees(F.atan2(east, south) / F.lit(cone.n)) + F.lit(ORIGIN_LONG)


def latitude(x: Column, y: Column) -> Column:
    """State-plane feet to degrees north.

    The fixed-point iteration is unrolled; five steps leave less than 1e-12 degrees. Writing
    the eccentricity factor with ``atanh`` uses the previous step once, so the expression
    grows linearly with the number of steps.
    """
    cone = ConformalCone()
    east, south = _offsets(x, y, cone)
    rho = F.sqrt(east * east + south * south)
    t = F.pow(rho / F.lit(cone.radius), F.lit(1.0 / cone.n))
    phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t)
    for _ in range(LATITUDE_STEPS):
        squeeze = F.exp(F.lit(-cone.ecc) * F.atanh(F.lit(cone.ecc) * F.sin(phi)))
        phi = F.lit(math.pi / 2) - F.lit(2.0) * F.atan(t * squeeze)
    return F.degrees(phi)
