"""Cutting a scan into ranges of a numeric column."""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bounds:
    """partitionColumn, lower and upper bound, count. Bounds cut, they don't restrict."""

    column: str
    lower: int
    upper: int
    count: int

    @staticmethod
    def of(column: str | None, lower, upper, count) -> Bounds | None:
        """From options: all four or none."""
        given = {"partitionColumn": column, "partitionLowerBound": lower, "partitionUpperBound": upper, "partitionCount": count}
        if all(v is None for v in given.values()):
            return None
        if missing := [k for k, v in given.items() if v is None]:
            raise ValueError(f"partition options belong together; missing: {', '.join(missing)}")
        out = Bounds(column, int(lower), int(upper), int(count))
        if out.count <= 0:
            raise ValueError(f"partitionCount must be positive, is {out.count}")
        if out.lower >= out.upper:
            raise ValueError(f"partitionLowerBound {out.lower} must be less than partitionUpperBound {out.upper}")
        return out


def cut_points(lower: int, upper: int, count: int) -> list[int]:
    """Where the ranges after the first begin. Fewer ranges than asked for come of bounds that are closer together than that."""
    if lower > upper:
        raise ValueError(f"lower bound {lower} is above upper bound {upper}")
    n = count
    if 0 <= upper - lower < count:
        warnings.warn(f"{count} ranges don't fit between {lower} and {upper}; taking {upper - lower}", stacklevel=2)
        n = upper - lower
    if n <= 1:
        return []
    with localcontext() as context:
        context.prec = 60
        at18 = lambda x: (Decimal(x) / n).quantize(Decimal(1).scaleb(-18), ROUND_HALF_EVEN)
        stride = at18(upper) - at18(lower)
        near = lambda x: int(x.quantize(Decimal(1), ROUND_HALF_UP))
        return [max(lower, min(upper, near(lower + stride * i))) for i in range(1, n)]


def range_conditions(bounds: Bounds) -> list[Column]:
    """One condition for each range. Rows whose column is null are in none."""
    c, cuts = F.col(bounds.column), cut_points(bounds.lower, bounds.upper, bounds.count)
    if not cuts:
        return [c.isNotNull()]
    return [c < cuts[0], *[(c >= a) & (c < b) for a, b in zip(cuts, cuts[1:])], c >= cuts[-1]]


def range_ordinal(bounds: Bounds) -> Column:
    """The number of the range that a row belongs to; null where the column is null."""
    cuts, c = cut_points(bounds.lower, bounds.upper, bounds.count), F.col(bounds.column)
    out = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        out = F.when(c < cuts[i], i).otherwise(out)
    return F.when(c.isNotNull(), out)


def partitioned(df: DataFrame, bounds: Bounds, exact: bool = False) -> DataFrame:
    """df without rows whose column is null, to be worked on in ranges of the column (see range_ordinal).

    Spark already cuts a scan into tasks by its files, so the source is read
    once, with as many tasks as it has, whatever the number of ranges. `exact`
    gives one partition per range instead, at the price of a shuffle.
    """
    there = df.where(F.col(bounds.column).isNotNull())
    return there.repartitionById(len(range_conditions(bounds)), range_ordinal(bounds)) if exact else there
