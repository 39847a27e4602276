"""Two ways to total doubles.

``PLAIN`` is ordinary double arithmetic: the last bits of a sum depend on the order in which
partitions arrive. ``Fixed(digits)`` totals whole units of ``10**-digits`` as bigint, so the same
rows give the same bits for every partitioning; use it for amounts that have that many decimals.
Both stay inside whole-stage code generation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _half_away(c: Column, digits: int) -> Column:
    """Whole units of ``10**-digits``; halves go away from zero."""
    units = F.floor(F.abs(c) * float(10**digits) + 0.5)
    return F.when(c < 0, -units).otherwise(units)


class Plain:
    def part(self, c: Column) -> Column:
        """Total of a group that is to be summed up further by ``whole``."""
        return F.sum(c)

    def whole(self, part: Column) -> Column:
        return F.sum(part)

    def total(self, c: Column) -> Column:
        return F.sum(c)

    def mean(self, c: Column) -> Column:
        return F.avg(c)

    def round(self, c: Column, digits: int) -> Column:
        return F.round(c, digits)


@dataclass(frozen=True)
class Fixed:
    digits: int = 2

    def _units(self, c: Column) -> Column:
        return _half_away(c, self.digits)

    def part(self, c: Column) -> Column:
        return F.sum(self._units(c))

    def whole(self, part: Column) -> Column:
        return F.sum(part) / float(10**self.digits)

    def total(self, c: Column) -> Column:
        return self.whole(self._units(c))

    def mean(self, c: Column) -> Column:
        return F.try_divide(self.total(c), F.count(c))

    def round(self, c: Column, digits: int) -> Column:
        return _half_away(c, digits) / float(10**digits)


PLAIN = Plain()


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def guarded_percent(top: Column, bottom: Column, math=PLAIN) -> Column:
    """Share in percent with two decimals; NULL unless the divisor is positive."""
    return F.when(bottom > 0, math.round(safe_ratio(top, bottom) * 100, 2))
