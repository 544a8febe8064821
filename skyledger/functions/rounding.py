"""Decimal rounding of the exact binary value of a double.

Spark's ``round``/``bround`` round the shortest decimal that prints like the
double, so values such as 2.675 move the wrong way. Here the product with the
power of ten is known exactly as a double and its rounding error, which leaves
only one comparison with one half, and that is exact too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiplying by this and subtracting again leaves the upper 26 bits of a double.
_SPLIT = float(2**27 + 1)
#: Scaled values from here on are whole, and the double is its own nearest rounding.
_WHOLE = float(2**53)


def round_exact(value: Column, digits: int) -> Column:
    """Round half to even on the exact value; ``digits`` is 0 to 4."""

    size, scale = F.abs(value), float(10**digits)
    high = size * _SPLIT - (size * _SPLIT - size)
    scaled = size * scale
    # The scale has 14 bits at most, so both products are exact and this is what ``scaled`` lost.
    lost = (high * scale - scaled) + (size - high) * scale
    whole = F.floor(scaled)
    beyond_half = (scaled - whole.cast("double") - 0.5) + lost
    up = F.when(beyond_half > 0, 1).when(beyond_half < 0, 0).otherwise(F.pmod(whole, F.lit(2)))
    rounded = (whole + up).cast("double") / F.lit(scale)
    return F.when(scaled < _WHOLE, F.signum(value) * rounded).otherwise(value)
