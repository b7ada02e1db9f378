"""Column expressions: weights, complex numbers, angles, times and the sky."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDEREAL_DAY = 86164.0989
C_M_MHZ = 299.792458
LINE_MHZ = 1420.40575


def inv0(x: Column) -> Column:
    """1 / x, and 0 where x is 0."""
    return F.when(x == 0, 0.0).otherwise(1.0 / F.when(x != 0, x))


def cmul(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conj(a: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0], -a[1]


def abs2(a: tuple[Column, Column]) -> Column:
    return a[0] * a[0] + a[1] * a[1]


def cinv0(a: tuple[Column, Column]) -> tuple[Column, Column]:
    k = inv0(abs2(a))
    return a[0] * k, -a[1] * k


def cis(phase: Column) -> tuple[Column, Column]:
    return F.cos(phase), F.sin(phase)


def modulo(x: Column, n: float) -> Column:
    return x - n * F.floor(x / n)


def wrap(degrees: Column) -> Column:
    """An angle in [-180, 180)."""
    return modulo(degrees + 180.0, 360.0) - 180.0


def stellar_angle(t: Column, longitude: float = 0.0) -> Column:
    """Earth rotation angle in degrees at a longitude."""
    turns = 0.7790572732640 + 1.00273781191135448 * (t / 86400.0 - 10957.5)
    return modulo(360.0 * (turns - F.floor(turns)) + longitude, 360.0)


def sidereal_day(t: Column, t0: float) -> Column:
    return (t - t0) / SIDEREAL_DAY


def altitude(ha: Column, dec: Column, latitude: float) -> Column:
    """Degrees, from hour angle and declination in degrees."""
    a, h, lat = F.radians(dec), F.radians(ha), math.radians(latitude)
    return F.degrees(F.asin(F.sin(a) * math.sin(lat) + F.cos(a) * math.cos(lat) * F.cos(h)))


def sun(t: Column) -> tuple[Column, Column]:
    """Right ascension and declination of the Sun in degrees, by the low-precision almanac."""
    n = t / 86400.0 - 10957.5
    mean, anomaly = 280.460 + 0.9856474 * n, F.radians(357.528 + 0.9856003 * n)
    lam = F.radians(mean + 1.915 * F.sin(anomaly) + 0.020 * F.sin(2 * anomaly))
    eps = F.radians(23.439 - 4e-7 * n)
    ra = modulo(F.degrees(F.atan2(F.cos(eps) * F.sin(lam), F.cos(lam))), 360.0)
    return ra, F.degrees(F.asin(F.sin(eps) * F.sin(lam)))


def daytime(t: Column, latitude: float, longitude: float) -> Column:
    ra, dec = sun(t)
    return altitude(stellar_angle(t, longitude) - ra, dec, latitude) > -0.833


def fringe_phase(ha: Column, dec: Column, latitude: float, u: Column, v: Column) -> Column:
    """Radians; u and v in wavelengths, angles in degrees."""
    h, d, lat = F.radians(ha), F.radians(dec), math.radians(latitude)
    x = -F.cos(d) * F.sin(h)
    y = math.cos(lat) * F.sin(d) - math.sin(lat) * F.cos(d) * F.cos(h)
    return -2 * math.pi * (u * x + v * y)


def wavelength(mhz: Column) -> Column:
    return C_M_MHZ / mhz


def channel_mhz(freq_id: Column) -> Column:
    return 800.0 - 400.0 * freq_id / 1024.0


def channel_of(mhz: Column) -> Column:
    return F.round((800.0 - mhz) / 400.0 * 1024.0).cast("long")


def redshifted(z: Column) -> Column:
    return LINE_MHZ / (1 + z)


def beam_sigma(mhz: Column, dec: Column, pol: Column) -> Column:
    """Beam width in radians for polarisation X or Y."""
    return F.when(pol == "X", 14.87857614).otherwise(9.95746878) / mhz / F.cos(F.radians(dec))


def round_sig(x: Column, digits: int) -> Column:
    """A number cut to so many significant digits; 0 stays 0."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(F.when(x != 0, x)))))
    return F.when(x == 0, 0.0).otherwise(F.rint(x * scale) / scale)


def cosine_taper(d: Column) -> Column:
    """1 up to 0, 0 from 1, half a cosine between."""
    return F.when(d <= 0, 1.0).when(d >= 1, 0.0).otherwise(0.5 * (1 + F.cos(math.pi * d)))


def stream_id(shuffle: Column, crate: Column, slot: Column, link: Column) -> Column:
    return shuffle * 4096 + crate * 256 + slot * 16 + link
