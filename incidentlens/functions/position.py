"""Mean positions that do not depend on the order of summation.

``avg`` over doubles changes in its last digits with partitioning and retries.
Here a coordinate becomes a whole number of 2^-47 degrees, which is exact for
every double from 32 degrees on and within 1e-14 degrees below. Its three limbs of
18 bits are summed apart and joined once per group, so that a bigint sum holds
more than 10^13 positions anywhere on Earth.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 2.0**47
_BITS = 18
LIMBS = ("high", "middle", "low")


def is_position(lat: Column, lon: Column) -> Column:
    """Both coordinates are degrees: not NULL, NaN, infinite or beyond a full turn."""
    return F.coalesce((F.abs(lat) <= 360) & (F.abs(lon) <= 360), F.lit(False))


def limbs(degrees: Column) -> list[Column]:
    """A coordinate of a position as bigints, in the order of ``LIMBS``; NULL gives NULL."""
    units = F.floor(degrees * _UNITS)
    least = (1 << _BITS) - 1
    return [
        F.shiftright(units, 2 * _BITS),
        F.shiftright(units, _BITS).bitwiseAND(F.lit(least).cast("bigint")),
        units.bitwiseAND(F.lit(least).cast("bigint")),
    ]


def mean_degrees(sums: list[Column], located: Column) -> Column:
    """Mean in degrees from the summed limbs and the number of positions; NULL if none."""
    high, middle, low = [limb.cast("decimal(38,0)") for limb in sums]
    step = F.lit(1 << _BITS).cast("decimal(7,0)")
    total = (high * step + middle) * step + low
    return F.try_divide(total.cast("double"), located) / _UNITS
