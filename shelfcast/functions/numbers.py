"""Number functions that Spark's own round differently."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(x: Column, digits: int = 4) -> Column:
    """A double rounded by its exact binary value, ties to the even digit.

    Spark's ``round`` works on the shortest decimal text, half up: 2.00005 (just below
    the tie) gives 2.0001 there and 2.0 here.  The product with the power of ten is
    kept exactly as two doubles (the factor has few bits, so halves of the value times
    it are exact); from 2^53 up the neighbouring doubles are further apart than the
    digits, and the value stays as it is.  Null, NaN and infinities pass through.
    """
    if not 0 <= digits <= 8:
        raise ValueError("digits: 0 to 8")
    power = float(10**digits)
    size = F.abs(x)
    spread = size * F.lit(134217729.0)
    high = spread - (spread - size)
    product = size * F.lit(power)
    rest = (high * F.lit(power) - product) + (size - high) * F.lit(power)
    below = F.floor(product).cast("double")
    over = (product - below - F.lit(0.5)) + rest
    up = (over > 0) | ((over == 0) & (below % 2 == 1))
    rounded = F.signum(x) * ((below + F.when(up, 1.0).otherwise(0.0)) / F.lit(power))
    return F.when(size < F.lit(2.0**53 / power), rounded).otherwise(x)
