"""Column -> Column unit conversions (all JVM-side expressions).

F-1 coordinate decode, F-2 hourly packed units, F-3..F-6 wind, F-10 CF units,
F-11 display units, F-18 vendor scaling, D1/D2 daily units, F-23 magnitude.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CF_SOURCE

SECONDS_PER_HOUR = 3600.0
HOURS_PER_DAY = 24.0
MM_PER_M = 1000.0
CM2_PER_M2 = 1.0e4
JOULES_PER_CALORIE = 4.2


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c) -> Column:
    """Numeric view of a raw cell: strings and malformed cells -> NULL, NaN -> NULL."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


# ---------------------------------------------------------------------------
# F-1: sexagesimal DD.MMSS -> decimal degrees
# ---------------------------------------------------------------------------

def ddmmss_to_decimal(c, mode: str = "null") -> Column:
    """``DD.MMSS`` -> degrees: sign * (D + MM/60 + SS/3600), read from the value
    formatted to four decimals. Minutes or seconds >= 60 give NULL
    (``mode="null"``) or fail the query (``mode="raise"``); NULL stays NULL."""
    x = num(c)
    n = F.round(F.abs(x) * 10000).cast("long")
    d = F.floor(n / 10000).cast("long")
    mm = (F.floor(n / 100) % 100).cast("long")
    ss = (n % 100).cast("long")
    val = F.signum(x) * (d + mm / 60 + ss / 3600)
    bad = (mm >= 60) | (ss >= 60)
    if mode == "raise":
        return F.when(x.isNull(), F.lit(None).cast("double")) \
                .when(bad, F.raise_error(F.lit("invalid DD.MMSS value: minutes or seconds >= 60"))
                      .cast("double")) \
                .otherwise(val)
    return F.when(~bad, val)


# ---------------------------------------------------------------------------
# F-2: hourly packed units -> physical units
# ---------------------------------------------------------------------------

def scale(c, divisor: float) -> Column:
    return num(c) / divisor


# FIXED VALUES: units of the archive files.
HOURLY_DIVISORS = {
    "lhpa": 10.0,   # 0.1 hPa -> hPa
    "shpa": 10.0,   # 0.1 hPa -> hPa
    "kion": 10.0,   # 0.1 degC -> degC
    "stem": 10.0,   # 0.1 hPa -> hPa
    "rhum": 100.0,  # % -> 0..1
    "sped": 10.0,   # 0.1 m/s -> m/s
    "clod": 10.0,   # tenths -> 0..1
    "humd": 10.0,   # 0.1 degC -> degC
    "lght": 10.0,   # 0.1 h -> h
}


JOULES_PER_IRRADIANCE_UNIT = 1.0e4      # 0.01 MJ
PRECIPITATION_UNITS_PER_MM = 10.0


def irradiance_w_m2(c) -> Column:
    """0.01 MJ m-2 per hour -> W m-2."""
    return num(c) * JOULES_PER_IRRADIANCE_UNIT / SECONDS_PER_HOUR


def precip_m_s(c) -> Column:
    """0.1 mm per hour -> m s-1."""
    return num(c) / (PRECIPITATION_UNITS_PER_MM * MM_PER_M * SECONDS_PER_HOUR)


# ---------------------------------------------------------------------------
# F-3..F-6: wind
# ---------------------------------------------------------------------------

def code_to_math_angle(code) -> Column:
    """F-3: direction code (1 NNE .. 16 N, 0 N/A) -> angle the wind blows toward,
    counter-clockwise from east, in [0, 360). Code 0 maps to 270 like code 16."""
    return F.pmod(F.lit(-90.0) - num(code) * 22.5, F.lit(360.0)) + 0.0


def code_to_from_direction(code) -> Column:
    """F-5: direction code -> meteorological from-direction in degrees
    (0 -> NULL, k -> 22.5 k, 16 -> 0)."""
    k = num(code)
    return F.when(k != 0, F.pmod(k * 22.5, F.lit(360.0)))


def math_uv(speed, angle) -> tuple[Column, Column]:
    """F-4: components from speed and math angle: (s cos a, s sin a)."""
    r = F.radians(col(angle))
    return col(speed) * F.cos(r), col(speed) * F.sin(r)


def from_uv(speed, from_dir) -> tuple[Column, Column]:
    """F-6: components from speed and from-direction: (-s sin d, -s cos d).
    Calm (no direction, |s| <= 1e-6) gives (0, 0); other missing inputs NULL."""
    s, d = col(speed), col(from_dir)
    r = F.radians(d)
    calm = d.isNull() & s.isNotNull() & (F.abs(s) <= 1e-6)
    u = F.when(d.isNotNull() & s.isNotNull(), -s * F.sin(r)).when(calm, F.lit(0.0))
    v = F.when(d.isNotNull() & s.isNotNull(), -s * F.cos(r)).when(calm, F.lit(0.0))
    return u, v


def magnitude(a, b) -> Column:
    """F-23: sqrt(a^2 + b^2)."""
    return F.hypot(col(a), col(b))


# ---------------------------------------------------------------------------
# F-10 / F-11: CF and display units
# ---------------------------------------------------------------------------

WATER_DENSITY = 1000.0  # kg m-3


KELVIN_AT_0C = 273.15
PASCALS_PER_HPA = 100.0

CONVERSIONS = {
    "hpa_to_pa": lambda x: x * PASCALS_PER_HPA,
    "c_to_k": lambda x: x + KELVIN_AT_0C,
    "h_to_s": lambda x: x * SECONDS_PER_HOUR,
    "precip": lambda x: x * WATER_DENSITY,      # m s-1 of water -> kg m-2 s-1
}
# Physical unit of the archive reader -> CF unit, where they differ.
CF_CONVERSION = {"lhpa": "hpa_to_pa", "shpa": "hpa_to_pa", "stem": "hpa_to_pa", "kion": "c_to_k", "humd": "c_to_k",
                 "lght": "h_to_s", "kous": "precip"}


def cf_value(kind: str | None, x, compat: bool = False) -> Column:
    """``x`` after the conversion ``kind`` (none: unchanged). ``compat`` keeps
    precipitation in m s-1, as the literal reference does."""
    x = col(x).cast("double")
    if kind is None or (compat and kind == "precip"):
        return x
    return CONVERSIONS[kind](x)


def cf_columns(compat: bool = False) -> dict[str, Column]:
    """CF target name -> expression over the physical-unit columns."""
    return {name: cf_value(CF_CONVERSION.get(source), source, compat) for name, source in CF_SOURCE.items()}


def display_value(units: str, x) -> Column:
    """F-11: K -> degC, Pa -> hPa, anything else unchanged."""
    x = col(x)
    if units == "K":
        return x - KELVIN_AT_0C
    if units == "Pa":
        return x / PASCALS_PER_HPA
    return x


# ---------------------------------------------------------------------------
# Daily units
# ---------------------------------------------------------------------------

# FIXED VALUES: units of the daily archive files.
DAILY_DIVISORS = {
    "avrLhpa": 10.0, "avrShpa": 10.0, "minShpa": 10.0, "avrKion": 10.0, "maxKion": 10.0,
    "minKion": 10.0, "avrStem": 10.0, "avrRhum": 100.0, "avrSped": 10.0, "maxSped": 10.0,
    "maxSSpd": 10.0, "avrClod": 10.0, "daylght": 10.0, "amtEva": 10.0, "dayPrec": 10.0,
    "maxHPrc": 10.0, "maxMPrc": 10.0,
}
DAILY_ANGLES = ("maxMuki", "maxSMuk")
# Daily irradiance unit switch: 0.1 MJ m-2 from 1981, 1 cal cm-2 before.
DAILY_IRRADIANCE_MJ_FROM = 1981
JOULES_PER_DAILY_UNIT = 1.0e5           # 0.1 MJ


def daily_irradiance_w_m2(x, year) -> Column:
    x = num(x)
    joules = (F.when(col(year) >= DAILY_IRRADIANCE_MJ_FROM, x * JOULES_PER_DAILY_UNIT)
               .otherwise(x * JOULES_PER_CALORIE * CM2_PER_M2))
    return joules / SECONDS_PER_HOUR / HOURS_PER_DAY
