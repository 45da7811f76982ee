"""Sharding by a Feistel permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import table, text_or_empty, written
from docweave.llm.ordering import hash_range, offsets, ranges_for

ROUNDS = 8


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of x and a round key (multiply and shift)."""
    x = x ^ np.uint64(key)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def round_keys(seed: int) -> list[int]:
    with np.errstate(over="ignore"):
        base = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % (1 << 64))
        return [int(k) for k in _mix(base, 0)]


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The place of each number of [0, n) in a pseudo-random permutation of [0, n).

    A balanced Feistel network permutes [0, 4^h), the smallest such range
    that holds n; results from n on are sent through it again until they
    fall below n (cycle walking, under four rounds on average).
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift, keys = np.uint64((1 << half) - 1), np.uint64(half), round_keys(seed)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> shift, v & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(numbers.astype(np.uint64))
        while len(high := np.flatnonzero(out >= np.uint64(n))):
            out[high] = once(out[high])
    return out.astype(np.int64)


#: Numbers of one repeated row that one task writes out.
BLOCK = 1 << 16


def row_numbers(df: DataFrame, keys: list[str], name: str = "row_number", block: int = BLOCK) -> tuple[DataFrame, int]:
    """df's key columns with gapless numbers from 0, and the number of rows.

    Rows are numbered in the order of (unsigned hash of the keys, keys), so a rerun
    gives every row its number again wherever Spark puts it. Equal rows are
    counted before they are shuffled and numbered together; which of them has
    which number makes no difference.
    """
    n = df.count()
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_h"))
    ranges = ranges_for(n)
    distinct = hashed.groupBy("_h", *keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", hash_range(F.col("_h"), ranges))
    sums = distinct.groupBy("_range").agg(F.sum("_n").alias("_sum"))
    start = offsets(sums, [], "_range", "_sum")
    # unsigned, as the ranges are, so that the numbers don't depend on how many ranges there are
    inside = Window.partitionBy("_range").orderBy(F.col("_h").bitwiseXOR(F.lit(-1 << 63)), *keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = distinct.withColumn("_first", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    # start has at most MOST_RANGES rows of two numbers
    numbered = placed.join(F.broadcast(start), "_range").select(*keys, (F.col("_first") + F.col("before")).alias("_first"), "_n")
    numbered = written(numbered, "numbered")

    def each(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)).alias(name))

    out = each(numbered.where(F.col("_n") <= block))
    often = numbered.where(F.col("_n") > block)
    if not often.isEmpty():
        # rows that repeat very often are dealt out in blocks before they are written out
        at = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1, F.lit(block).cast("long"))).alias("_at")
        blocks = often.select(*keys, at, (F.col("_first") + F.col("_n")).alias("_end"))
        blocks = blocks.select(*keys, F.col("_at").alias("_first"), F.least(F.lit(block).cast("long"), F.col("_end") - F.col("_at")).alias("_n"))
        out = out.unionByName(each(blocks.repartition("_first")))
    return out, n


def shard_rows(df: DataFrame, keys: list[str], shards: int, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """The key columns of every row with its shard and slot.

    A row's place is the permuted row number p; its shard is p mod shards and
    its slot p div shards, so slots are gapless from 0 and shard sizes differ
    by one at most. (row number, n, shards, seed) suffice to compute both, and
    the place can be inverted. Null keys are values like any other; an empty
    table gives an empty one. Bring only the columns that tell rows apart:
    other columns aren't returned.
    """
    numbered, n = row_numbers(df, keys, block=block)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields if f.name != "row_number")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = permute(b["row_number"].to_numpy(), n, seed)
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keys], pa.array((p % shards).astype(np.int32)), pa.array(p // shards)], [*keys, "shard", "slot"])

    return numbered.mapInArrow(place, f"{fields}, shard int, slot long")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law `rows`."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        (F.octet_length(text_or_empty("text")) + 8).cast("long").alias("size"),
        F.crc32(text_or_empty("text").cast("binary")).alias("text_crc32"),
    )
    out = shard_rows(rows, ["id", "size", "text_crc32"], 24)
    return out.select(
        F.when(F.col("id") != "", F.col("id")).cast("long").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
