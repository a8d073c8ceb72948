"""Great-circle distance, and grid cells for distance joins (GEO-01 to 04)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: Cells are wider than the radius by this much, so that rounding never parts neighbours.
MARGIN = 1.01


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    return F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.least(F.lit(1.0), _half_chord(lat1, lon1, lat2, lon2))
    return 2 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_asin_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), _half_chord(lat1, lon1, lat2, lon2))))


def valid(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


class Grid:
    """Bands of latitude as high as the radius; each band is cut by longitude into as many cells as stay as wide.

    Two points within the radius lie in cells that touch: in the same or a neighbouring band, and there in the same or a
    neighbouring cell by that band's own count, around the date line too.  Near the poles a band is one cell.
    """

    def __init__(self, radius_m: float):
        self.step = min(180.0, max(1e-4, math.degrees(radius_m / EARTH_M) * MARGIN))

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.step)

    def _cells(self, band: Column) -> Column:
        low, high = band * self.step - 90 - self.step, (band + 1) * self.step - 90 + self.step
        widest = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(high)))
        n = F.floor(360 * F.cos(F.radians(widest)) / self.step)
        return F.when(n < 3, F.lit(1)).otherwise(n).cast("bigint")

    def _cell(self, lon: Column, n: Column) -> Column:
        return F.pmod(F.floor((F.pmod(lon + 180, F.lit(360.0))) / 360 * n), n)

    def cell(self, lat: Column, lon: Column) -> Column:
        """struct(band, cell) of a point."""
        band = self.band(lat)
        return F.struct(band.alias("y"), self._cell(lon, self._cells(band)).alias("x"))

    def around(self, lat: Column, lon: Column) -> Column:
        """All cells that touch the point's, each once."""

        def in_band(dy: int) -> Column:
            band = self.band(lat) + dy
            n = self._cells(band)
            return F.array_distinct(F.array(*(F.struct(band.alias("y"), F.pmod(self._cell(lon, n) + dx, n).alias("x")) for dx in (-1, 0, 1))))

        return F.concat(*(in_band(dy) for dy in (-1, 0, 1)))
