"""Global row numbers and running sums without a single-task sort.

A total order is cut into ranges by a key of evenly spread values. Each
range's sums go through one small window (a row per range), and each range is
then ordered on its own, so no task holds more than a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one range should hold, and the most ranges there may be. With
#: more than ROWS_PER_RANGE * MOST_RANGES rows, the ranges grow instead.
ROWS_PER_RANGE = 4_000
MOST_RANGES = 1 << 16


def ranges_for(rows: int) -> int:
    return int(min(MOST_RANGES, max(1, -(-rows // ROWS_PER_RANGE))))


def hash_range(hashed: Column, ranges: int) -> Column:
    """The range of a signed 64-bit hash: its top 31 bits, unsigned, cut into equal parts that ascend with the unsigned hash."""
    top = F.shiftrightunsigned(hashed, 33).cast("long")
    return F.shiftrightunsigned(top * ranges, 31).cast("int")


def offsets(sums: DataFrame, group: list[str], at: str, value: str) -> DataFrame:
    """For a table with one row per (group, range): what the ranges before hold. group may be empty: then one task sees all ranges, at most MOST_RANGES rows."""
    w = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*group, at, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long").alias("before"))
