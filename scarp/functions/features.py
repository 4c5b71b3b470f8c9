"""Per-reading physics as column expressions (JVM-side, codegen'd, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed physical constants of the sensor model.
GRAVITY = 9.81                 # m/s^2
WATER_DENSITY = 1000.0         # kg/m^3
WGS84_A = 6378137.0            # semi-major axis, m
CENTRAL_MERIDIAN_DEG = 105.0   # projection's central meridian
FALSE_EASTING = 500000.0       # m
BASE_ACCELERATION = (0.0, 0.0, -9.81)  # resting IMU vector (x, y, z)

# Digits each packet field is rounded to before publishing.
PACKET_DIGITS = {
    "acceleration": 4, "angular_velocity": 4, "tilt": 2, "velocity": 4, "displacement": 6,
    "intensity": 2, "accumulated": 2, "water_level": 3, "pore_pressure": 2,
    "latitude": 8, "longitude": 8, "vn2000": 3,
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def speed_xy(vx, vy) -> Column:
    """Horizontal speed sqrt(vx^2 + vy^2); the z component is not used."""
    vx, vy = _c(vx), _c(vy)
    return F.sqrt(vx * vx + vy * vy)


def rms(*cols) -> Column:
    """Root mean square of the given components."""
    cs = [_c(c) for c in cols]
    total = cs[0] * cs[0]
    for c in cs[1:]:
        total = total + c * c
    return F.sqrt(total / float(len(cs)))


def tilt(ax, ay, az) -> tuple[Column, Column]:
    """(roll, pitch) in degrees from a gravity-dominated acceleration vector."""
    ax, ay, az = _c(ax), _c(ay), _c(az)
    roll = F.degrees(F.atan2(ay, az))
    pitch = F.degrees(F.atan2(-ax, F.sqrt(ay * ay + az * az)))
    return roll, pitch


def dynamic_acceleration(ax, ay, az, base=BASE_ACCELERATION) -> tuple[Column, Column, Column]:
    """Acceleration minus the resting (gravity) vector, per axis."""
    return _c(ax) - F.lit(base[0]), _c(ay) - F.lit(base[1]), _c(az) - F.lit(base[2])


def hydrostatic_pressure(level) -> Column:
    """Pressure in kPa of a water column ``level`` metres high: rho*g*h/1000."""
    return F.lit(WATER_DENSITY) * F.lit(GRAVITY) * _c(level) / 1000.0


def pressure_residual(pore_pressure, level) -> Column:
    """Measured pore pressure above (or below) the hydrostatic value."""
    return _c(pore_pressure) - hydrostatic_pressure(level)


def planar_xy(lat, lon) -> tuple[Column, Column]:
    """Simplified planar projection used by the GNSS sensors (metres).

    x = rad(lat)*a ; y = (rad(lon) - rad(lon0))*a*cos(rad(lat)) + false easting.
    """
    lat_r, lon_r = F.radians(_c(lat)), F.radians(_c(lon))
    x = lat_r * F.lit(WGS84_A)
    y = (lon_r - F.radians(F.lit(CENTRAL_MERIDIAN_DEG))) * F.lit(WGS84_A) * F.cos(lat_r) + F.lit(FALSE_EASTING)
    return x, y


def non_negative(x) -> Column:
    return F.greatest(F.lit(0.0), _c(x))


def packet_round(x, field: str) -> Column:
    """Round a value the way the publishing sensor rounds that packet field."""
    return F.round(_c(x), PACKET_DIGITS[field])
