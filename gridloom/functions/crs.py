"""Coordinate systems from public formulas: geographic (4326), Web Mercator (3857) and UTM (326xx, 327xx)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _FLAT = 6378137.0, 1 / 298.257223563
_N = _FLAT / (2 - _FLAT)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_K0, _EAST = 0.9996, 500000.0
_E = math.sqrt(_FLAT * (2 - _FLAT))
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def _zone(epsg: int) -> tuple[float, float]:
    """Central meridian in radians and false northing."""
    zone = epsg % 100
    if epsg // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"EPSG:{epsg} is not supported")
    return math.radians(zone * 6 - 183), 10_000_000.0 if epsg // 100 == 327 else 0.0


def _atanh(x: Column) -> Column:
    return F.log((1 + x) / (1 - x)) / 2


def from_geographic(lon: Column, lat: Column, epsg: int) -> tuple[Column, Column]:
    """Degrees to metres (or degrees for 4326)."""
    if epsg == 4326:
        return lon, lat
    if epsg == 3857:
        return F.radians(lon) * _A, F.log(F.tan(F.radians(lat) / 2 + math.pi / 4)) * _A
    meridian, north = _zone(epsg)
    s = F.sin(F.radians(lat))
    t = F.sinh(_atanh(s) - _E * _atanh(_E * s))
    d = F.radians(lon) - meridian
    xi, eta = F.atan2(t, F.cos(d)), _atanh(F.sin(d) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _EAST + _K0 * _R * x, north + _K0 * _R * y


def to_geographic(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    if epsg == 4326:
        return x, y
    if epsg == 3857:
        return F.degrees(x / _A), F.degrees(2 * F.atan(F.exp(y / _A)) - math.pi / 2)
    meridian, north = _zone(epsg)
    xi0, eta0 = (y - north) / (_K0 * _R), (x - _EAST) / (_K0 * _R)
    xi, eta = xi0, eta0
    for j, b in enumerate(_BETA, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j, d in enumerate(_DELTA, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.lit(meridian) + F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def reproject(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    if source == target:
        return x, y
    return from_geographic(*to_geographic(x, y, source), target)
