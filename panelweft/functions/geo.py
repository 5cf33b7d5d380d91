"""Areas on the sphere and the ellipsoid as plain column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelweft.functions.columns import as_col

# Sphere radius used for region areas; WGS84 ellipsoid.
SPHERE_RADIUS_KM = 6371.010
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563


def lune_excess(lon0, lat0, lon1, lat1) -> Column:
    """Signed area, on the unit sphere, between one great-circle edge and the
    equator. Summing it along a closed ring gives the ring's signed area."""
    lon0, lat0, lon1, lat1 = (as_col(c) for c in (lon0, lat0, lon1, lat1))
    # pmod keeps an edge across the antimeridian on its short side
    turn = F.radians(F.pmod(lon1 - lon0 + 180.0, F.lit(360.0)) - 180.0)
    t0, t1 = F.tan(F.radians(lat0) / 2), F.tan(F.radians(lat1) / 2)
    return 2 * F.atan2(F.tan(turn / 2) * (t0 + t1), 1 + t0 * t1)


def cell_area_km2(row, y_top: float, res_y: float, res_x: float) -> Column:
    """Area of a grid cell whose four sides are WGS84 geodesics.

    Zone area in closed form (authalic), plus the sliver between each
    parallel and the geodesic chord below it. A parallel at latitude p has
    geodesic curvature tan(p)/N, so over a chord of length L = N cos(p) dlon
    the sliver is curvature * L^3 / 12, always on the poleward side.
    """
    row = as_col(row)
    e2 = WGS84_F * (2 - WGS84_F)
    e = math.sqrt(e2)
    dlon = math.radians(res_x)

    def under(lat: Column) -> Column:
        s = F.sin(lat)
        zone = s / (1 - e2 * s * s) + F.log((1 + e * s) / (1 - e * s)) / (2 * e)
        n2 = F.lit(WGS84_A_KM**2) / (1 - e2 * s * s)
        sliver = n2 * s * F.pow(F.cos(lat), F.lit(2.0)) * (dlon**3 / 12)
        return zone * (WGS84_A_KM**2 * (1 - e2) / 2 * dlon) + sliver

    top = F.radians(F.lit(y_top) - row * F.lit(res_y))
    bottom = F.radians(F.lit(y_top) - (row + 1) * F.lit(res_y))
    return under(top) - under(bottom)


UNIT_BITS = 40  # outlines are judged in whole numbers of 2^-40 degrees


def snapped(degrees: Column) -> Column:
    """Whole numbers of 2^-40 degrees (a ten-thousandth of a millimetre)."""
    return F.floor(degrees * float(2**UNIT_BITS) + 0.5)


def unsnapped(units: Column) -> Column:
    """Degrees of snapped coordinates."""
    return units / float(2**UNIT_BITS)


def twice_area(x0, y0, x1, y1) -> Column:
    """Aggregate: twice the signed area between snapped edges, exact."""
    x0, y0, x1, y1 = (as_col(c).cast("decimal(19,0)") for c in (x0, y0, x1, y1))
    return F.sum(x0 * y1 - x1 * y0)
