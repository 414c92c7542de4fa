"""Half-away-from-zero rounding of quotients in whole numbers.

``round(double)`` differs between engines at ties, so rates are kept as integer
hundredths (or tenths) until the last step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(num: Column, den: Column) -> Column:
    """Integer division that drops the remainder."""
    return F.call_function("div", num, den)


def rounded_quotient(num: Column, den: Column) -> Column:
    """``num / den`` as the nearest integer, ties away from zero; ``den`` > 0."""
    size = whole_div(2 * F.abs(num) + den, 2 * den)
    return F.when(num < 0, -size).otherwise(size)
