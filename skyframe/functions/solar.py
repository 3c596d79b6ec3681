"""F-12: solar elevation as a closed-form Column expression.

Low-precision almanac formulas (public domain astronomy): mean anomaly,
ecliptic longitude, obliquity, right ascension, declination, Greenwich mean
sidereal time, hour angle. Accuracy is about 0.01 degree, so only samples
within a few minutes of sunrise or sunset can disagree with a full solver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: almanac coefficients and the night threshold.
J2000_NOON_UTC = "2000-01-01 12:00:00"
# Geometric elevation at which the refracted (apparent) elevation is 0 degrees
# (standard refraction at 1013.25 hPa and 12 degC).
APPARENT_HORIZON_DEG = -0.571



def _rad(x: Column) -> Column:
    return x * 2 * math.pi / 360.0


def _wrap(x: Column) -> Column:
    return F.pmod(x, F.lit(360.0))


def days_since_j2000(ts_utc) -> Column:
    t = F.col(ts_utc) if isinstance(ts_utc, str) else ts_utc
    return F.timestamp_diff("SECOND", F.lit(J2000_NOON_UTC).cast("timestamp_ntz"), t) / 86400.0


def solar_elevation(ts_utc, lat, lon) -> Column:
    """Geometric solar elevation in degrees for a UTC wall-clock timestamp
    (TIMESTAMP_NTZ) at latitude/longitude in degrees."""
    la = F.col(lat) if isinstance(lat, str) else lat
    lo = F.col(lon) if isinstance(lon, str) else lon
    d = days_since_j2000(ts_utc)
    g = _wrap(357.529 + 0.98560028 * d)
    q = _wrap(280.459 + 0.98564736 * d)
    ecl = q + 1.915 * F.sin(_rad(g)) + 0.020 * F.sin(_rad(2 * g))
    eps = 23.439 - 3.6e-7 * d
    ra = F.atan2(F.cos(_rad(eps)) * F.sin(_rad(ecl)), F.cos(_rad(ecl)))
    dec = F.asin(F.sin(_rad(eps)) * F.sin(_rad(ecl)))
    gmst = _wrap(280.46061837 + 360.98564736629 * d)
    ha = _rad(gmst + lo) - ra
    s = F.sin(_rad(la)) * F.sin(dec) + F.cos(_rad(la)) * F.cos(dec) * F.cos(ha)
    return F.degrees(F.asin(s))


def is_night(ts_utc, lat, lon) -> Column:
    """Apparent solar elevation <= 0."""
    return solar_elevation(ts_utc, lat, lon) <= APPARENT_HORIZON_DEG
