"""S6 on stored data: a cell number on a space-filling curve.

Latitude and Longitude are each cut into ``2^BITS`` steps and the two numbers'
bits interleaved (Z order), so places that are near have numbers that mostly
are near.  A table sorted by the number keeps a place's surroundings in few
row groups, and a circle becomes a few ranges of numbers that the scan can
test against each row group's least and greatest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16  # steps of 2^-16: 306 m of latitude, 611 m of longitude at most
RANGES = 64  # of numbers that cover a circle
EARTH_M = 6_371_008.8

_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def step(value: float, low: float, width: float) -> int:
    """The step of a coordinate, as :func:`cell` has it."""
    return min(max(math.floor((value - low) / width * (1 << BITS)), 0), (1 << BITS) - 1)


def interleaved(lat_step: int, long_step: int) -> int:
    out = 0
    for x, at in ((long_step, 0), (lat_step, 1)):
        for b in range(BITS):
            out |= (x >> b & 1) << (2 * b + at)
    return out


def _spread(x: Column) -> Column:
    """A number's 16 bits moved to the even places."""
    for shift, keep in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(keep))
    return x


def cell(lat: str | Column = "Lat", long: str | Column = "Long") -> Column:
    """The cell number of a place; null where a coordinate is missing (or
    NaN, which stands nowhere)."""

    def steps(value: str | Column, low: float, width: float) -> Column:
        v = F.nanvl((F.col(value) if isinstance(value, str) else value).cast("double"), F.lit(None).cast("double"))
        n = F.floor((v - low) / width * (1 << BITS))
        return F.when(v.isNotNull(), F.least(F.greatest(n, F.lit(0)), F.lit((1 << BITS) - 1))).cast("long")

    return _spread(steps(long, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(steps(lat, -90.0, 180.0)), 1))


def boxes(lat: float, long: float, radius_m: float) -> list[tuple[float, float, float, float]]:
    """(south, north, west, east) of boxes that hold the circle: two where it
    crosses the 180th meridian, a whole cap where it holds a pole."""
    angle = radius_m / EARTH_M
    south, north = lat - math.degrees(angle), lat + math.degrees(angle)
    if south <= -90 or north >= 90 or angle >= math.pi / 2:
        return [(max(south, -90.0), min(north, 90.0), -180.0, 180.0)]
    half = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) * (1 + 1e-12) + 1e-9
    west, east = long - half, long + half
    south, north = south - 1e-9, north + 1e-9
    if half >= 180:
        return [(south, north, -180.0, 180.0)]
    if west < -180:
        return [(south, north, -180.0, east), (south, north, west + 360, 180.0)]
    if east > 180:
        return [(south, north, west, 180.0), (south, north, -180.0, east - 360)]
    return [(south, north, west, east)]


def covering(lat: float, long: float, radius_m: float, ranges: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of cell numbers (both ends in) that hold every cell of the
    circle's boxes, at most ``ranges``.  Squares of the curve that a box cuts
    are quartered while there is room; then what they hold is taken whole."""
    wanted = [(step(s, -90, 180), step(n, -90, 180), step(w, -180, 360), step(e, -180, 360)) for s, n, w, e in boxes(lat, long, radius_m)]

    def touch(y: int, x: int, size: int) -> int:
        """0: outside of all boxes, 2: inside one, 1: cut."""
        most = 0
        for s, n, w, e in wanted:
            if y + size > s and y <= n and x + size > w and x <= e:
                most = max(most, 2 if s <= y and y + size - 1 <= n and w <= x and x + size - 1 <= e else 1)
        return most

    done: list[tuple[int, int]] = []
    open_ = [(0, 0, 1 << BITS)]
    while open_ and len(done) + 4 * len(open_) <= 4 * ranges:
        nxt = []
        for y, x, size in open_:
            kind = touch(y, x, size)
            if kind == 2 or (kind and size == 1):
                done.append((interleaved(y, x), size * size))
            elif kind:
                h = size // 2
                nxt += [(y + dy, x + dx, h) for dy in (0, h) for dx in (0, h)]
        open_ = [q for q in nxt if touch(*q)]
    done += [(interleaved(y, x), size * size) for y, x, size in open_]
    merged: list[list[int]] = []
    for lo, n in sorted(done):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], lo + n - 1)
        else:
            merged.append([lo, lo + n - 1])
    while len(merged) > ranges:  # the smallest gap is taken in
        k = min(range(len(merged) - 1), key=lambda i: merged[i + 1][0] - merged[i][1])
        merged[k : k + 2] = [[merged[k][0], merged[k + 1][1]]]
    return [(a, b) for a, b in merged]
