"""Joins, windows, sets and order over scans, with the choices that matter at scale in one place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOW = ("inner", "left", "right", "full", "left_semi", "left_anti", "cross")


def join(left: DataFrame, right: DataFrame, on, how: str = "inner", broadcast_rows: int | None = None) -> DataFrame:
    """A join. Whether a side is sent to all tasks is the optimizer's choice by its size; broadcast_rows states a bound on the right side's rows, and is checked here. A cross join needs such a bound, and is refused beyond it."""
    if how not in HOW:
        raise ValueError(f"Unknown join {how!r}; there are {', '.join(HOW)}")
    if how == "cross":
        if broadcast_rows is None or right.limit(broadcast_rows + 1).count() > broadcast_rows:
            raise ValueError("a cross join needs a bound on the rows of its right side that holds (broadcast_rows)")
        return left.crossJoin(F.broadcast(right))
    if broadcast_rows is not None:
        if right.limit(broadcast_rows + 1).count() > broadcast_rows:
            return left.join(right, on, how)
        right = F.broadcast(right)
    return left.join(right, on, how)


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int = 16, how: str = "inner") -> DataFrame:
    """An equi-join for a left side with very frequent keys: its rows of one key go to `salts` tasks, and the right side's rows to each of them."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join can't be {how}")
    a = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return a.join(b, [key, "_salt"], how).drop("_salt")


def row_number(df: DataFrame, by: list[str], order: list, name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))


def framed(df: DataFrame, by: list[str], order: list, start: int, end: int, **values: Column) -> DataFrame:
    """Aggregates over a frame of rows around each row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(start, end)
    return reduce(lambda d, item: d.withColumn(item[0], item[1].over(w)), values.items(), df)


def top(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in an order: each task keeps n, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_(a: DataFrame, b: DataFrame, duplicates: bool = False) -> DataFrame:
    return a.exceptAll(b) if duplicates else a.subtract(b)


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, *values: str) -> DataFrame:
    """left with the values of the latest right row of its key that is not later: one union and one window, no range join."""
    a = left.select(key, time, F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), *[F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values])
    b = right.select(key, time, F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns)).schema.fields[0].dataType).alias("_row"), *values)
    w = Window.partitionBy(key).orderBy(time, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(F.when(F.col("_side") == 0, F.struct(*values)), ignorenulls=True).over(w)
    return a.unionByName(b).withColumn("_seen", seen).where("_side = 1").select("_row.*", *[F.col(f"_seen.{v}").alias(v) for v in values])
