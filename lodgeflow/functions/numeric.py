"""Numeric semantics of the warehouse SQL (F-07, F-08, F-10, A-08, A-09).

* Integer / integer is a decimal with six fractional digits, rounded half
  away from zero, and only *then* multiplied by 100.  Casting both operands
  to DECIMAL(38,0) makes Spark produce exactly DECIMAL(38,6).
* AVG keeps six digits, MEDIAN three.
* Text cast to an integer rounds ('4.6' -> 5) instead of failing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC0 = "decimal(38,0)"
MEDIAN_TYPE = "decimal(38,3)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio6(num, den) -> Column:
    """``num / den`` as DECIMAL(38,6), half-up rounded; NULL if either is NULL."""
    return _col(num).cast(DEC0) / _col(den).cast(DEC0)


def pct6(num, den) -> Column:
    """``(num / den) * 100`` with the division rounded first (Q-04)."""
    return ratio6(num, den) * F.lit(100)


def pct_change(current, baseline) -> Column:
    """``((cur - base) / NULLIF(base, 0)) * 100`` (F-07, M-13, M-14)."""
    base = _col(baseline)
    return ratio6(_col(current) - base, F.nullif(base, F.lit(0))) * F.lit(100)


def rounding_int(text) -> Column:
    """Numeric text -> BIGINT, rounded half away from zero ('4.6' -> 5,
    '2.5' -> 3); text that is not a number becomes NULL (F-10, Q-11)."""
    return F.round(F.trim(_col(text)).try_cast("decimal(38,10)"), 0).cast("bigint")


def as_double(c) -> Column:
    """Decimal result exposed as DOUBLE for engine-neutral comparison."""
    return _col(c).cast("double")
