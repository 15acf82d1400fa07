from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = 2**56


def round_half_even(value: Column) -> Column:
    """Round a double to two decimals by its exact binary value, ties to even.

    Spark's ``round`` looks at the shortest decimal text of the double, where 2.675 is a tie; the
    number itself lies just below it. Here the size is rounded and the sign put back, and the fraction is scaled by a power of two, which loses
    nothing, so that hundredths and the distance to one half come from integers.
    """
    size = F.abs(value)
    whole = F.floor(size)
    scaled = (size - whole) * F.lit(float(_SCALE))
    hundredfold = F.floor(scaled) * 100
    cents = F.shiftright(hundredfold, 56)
    above_half = hundredfold - F.shiftleft(cents, 56) - _SCALE // 2
    # Values below 1/16 have bits beyond the scale, which only matter right at one half.
    above_half = above_half + (scaled - F.floor(scaled)) * 100
    up = (above_half > 0) | ((above_half == 0) & (cents % 2 == 1))
    rounded = (whole * 100 + cents + up.cast("bigint")) / 100
    return F.when(value < 0, -rounded).otherwise(rounded)
