"""Aggregates over scans. Partial sums on the map side and the final ones after one exchange are the optimizer's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.filters import attribute


def minimum(name: str) -> Column:
    return F.min(attribute(name))


def maximum(name: str) -> Column:
    return F.max(attribute(name))


def count(name: str | None = None, distinct: bool = False) -> Column:
    """Of all rows, of the rows that have a value, or of the distinct values."""
    if name is None:
        return F.count(F.lit(1))
    return F.count_distinct(attribute(name)) if distinct else F.count(attribute(name))


def total(name: str, distinct: bool = False) -> Column:
    return F.sum_distinct(attribute(name)) if distinct else F.sum(attribute(name))


def mean(name: str, distinct: bool = False) -> Column:
    return F.expr(f"avg(DISTINCT {'.'.join(f'`{p}`' for p in name.split('.'))})") if distinct else F.avg(attribute(name))


def exact_total(name: str, scale: int = 2) -> Column:
    """The sum of a double as decimals, so that it doesn't depend on the order of the rows."""
    return F.sum(attribute(name).cast(f"decimal(18,{scale})")).cast("double")


def aggregate(df: DataFrame, by: list[str] | None = None, **aggregates: Column) -> DataFrame:
    """df grouped by columns; group columns come first, then the named aggregates. Without aggregates: the distinct groups."""
    keys = [attribute(b).alias(b.split(".")[-1]) for b in by or []]
    if not aggregates:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def grouping_sets(df: DataFrame, sets: list[list[str]], **aggregates: Column) -> DataFrame:
    """One result for several groupings, in one pass."""
    every = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in every]).agg(*[c.alias(n) for n, c in aggregates.items()])
