"""Fixed ranges of numbers, in levels: what percentiles and ranks are counted by.

A value is mapped to a long in its order, by its logarithm in steps of 2**-30:
that is its narrow range, of which a thousand wide ones in each doubling hold
2**20 each. A narrow range spans less than a billionth of its values and so at
most 2**23 doubles. However the values lie, no running sum over the ranges of one
level meets more rows than that, whatever the number of rows behind them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits cut off the image for the wide and for the narrow range around a value.
WIDE, NARROW = 20, 0
_STEPS = 1 << 30
#: Above minus the least logarithm, so that images of positive values are positive.
_ZERO = 1100 * _STEPS
_LARGEST = 1.7976931348623157e308


def image(value: Column) -> Column:
    """Long that never falls as the double grows: 0 for both zeros, NaN highest, null for null."""
    size = F.abs(value)
    log = F.floor(F.log2(F.least(size, F.lit(_LARGEST))) * float(_STEPS))
    place = log + F.when(size > _LARGEST, _ZERO + 1).otherwise(_ZERO)
    return F.when(F.isnan(value), F.lit(2**62)).when(value < 0, -place).when(value > 0, place).when(value == 0, F.lit(0))


def within(image: Column, bits: int) -> Column:
    """Number of the range that an image lies in, with so many bits cut off; keeps the order."""
    return F.shiftright(image, bits)
