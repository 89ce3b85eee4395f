"""Geohash encoding as plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the geohash alphabet.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def make_geohash(lon: Column, lat: Column, bits: int = 35) -> Column:
    """Geohash of ``bits`` bits (a multiple of 5, at most 60); NULL outside the globe."""
    if bits % 5 or not 0 < bits <= 60:
        raise ValueError("bits must be a multiple of 5 up to 60")
    x = _cell(lon, 180.0, (bits + 1) // 2)
    y = _cell(lat, 90.0, bits // 2)
    return F.concat(*[_letter(x, y, bits, first) for first in range(0, bits, 5)])


def _letter(x: Column, y: Column, bits: int, first: int) -> Column:
    """The letter for five bits of the hash, which takes longitude and latitude bits in turn."""
    code = F.lit(0).cast("bigint")
    for place in range(5):
        taken = (first + place) // 2
        cell, below = (x, (bits + 1) // 2 - 1 - taken) if (first + place) % 2 == 0 else (y, bits // 2 - 1 - taken)
        code = code.bitwiseOR(F.shiftleft(F.shiftright(cell, below).bitwiseAND(F.lit(1)), 4 - place))
    return F.substring(F.lit(ALPHABET), (code + 1).cast("int"), F.lit(1))


def _cell(degrees: Column, limit: float, bits: int) -> Column:
    cells = 1 << bits
    index = F.floor((degrees + limit) / (2 * limit) * cells).cast("bigint")
    return F.when(degrees.between(-limit, limit), F.least(index, F.lit(cells - 1).cast("bigint")))
