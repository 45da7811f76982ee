"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a shuffled order, over and over up to a
number of epochs. A queued document finishes at virtual time

    words of the source up to and with this document / target of the source

and the mix takes documents by finish time until the budget is spent, so at
any time all sources have served the same part of their targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.llm.common import NOT_WHITE, table, text_or_empty, written
from docweave.llm.ordering import MOST_RANGES, offsets, ranges_for

WEIGHTS = (5, 2, 1)
EPOCHS = 3


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NOT_WHITE)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) -> also weight, target.

    Sources in code point order, null last, have the weights in turn and
    share the sum of all sizes. No target exceeds epochs times its source's
    size; the excess is shared again by weight. In closed form: with sources
    by cap / weight, the first k are capped, and the others get the level
    (total - caps of the first k) / (weights of the others) times their
    weight. The table has one row per source and is handled in one task.
    """
    # binary order is code point order for UTF-8
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    named = sizes.withColumn("_k", F.row_number().over(by_name) - 1)
    weighed = named.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int")))
    caps = weighed.withColumn("_cap", F.col("source_size") * F.lit(epochs))
    by_fill = Window.orderBy(F.col("_cap") / F.col("weight"), "_k")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = caps.select(
        "*",
        F.sum("source_size").over(everything).alias("_total"),
        F.coalesce(F.sum("_cap").over(before), F.lit(0)).alias("_caps"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_rest"),
    ).withColumn("_level", (F.col("_total") - F.col("_caps")) / F.col("_rest"))
    fits = F.col("_level") <= F.col("_cap") / F.col("weight")
    leveled = filled.withColumn("_fits", F.min(F.when(fits, F.struct(F.col("_cap") / F.col("weight"), F.col("_k"), F.col("_level").alias("level")))).over(everything))
    level = F.col("_fits.level")
    return leveled.select(
        "source",
        "source_size",
        "weight",
        F.when(level.isNull(), F.col("_cap").cast("double")).otherwise(F.least(F.col("_cap").cast("double"), level * F.col("weight"))).alias("target"),
    )


def queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 29, ranges: int | None = None) -> DataFrame:
    """docs (with columns doc_id, source, size) as queued documents, one row per document and epoch: all columns of docs, source_size, target, epoch, finish, tie.

    The shuffle of a source is the order of md5(doc_id, or size where that is
    null, and seed), then size; the
    running sum over a source goes by ranges of that hash, so a source with a
    third of all rows is spread over as many tasks. Columns of the names above
    give way.
    """
    ranges = ranges or ranges_for(docs.count())
    docs = docs.drop("source_size", "target", "epoch", "finish", "tie")
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("size").cast("string"))), F.lit(str(seed))).cast("binary"))
    # the first 8 hexadecimal digits of the hash, cut into ranges in its order
    at = F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(ranges) / F.lit(1 << 32)).cast("int")
    hashed = docs.withColumn("tie", key).withColumn("_range", at)
    # null is a source of its own; <=> joins it
    sums = hashed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    starts = offsets(sums, ["source"], "_range", "_sum")
    goals = targets(sums.groupBy("source").agg(F.sum("_sum").alias("source_size")), weights, epochs)
    plan = starts.alias("s").join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(F.col("s.source").alias("_source"), F.col("s._range").alias("_at"), "before", "source_size", "target")
    inside = Window.partitionBy("source", "_range").orderBy("tie", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = hashed.withColumn("_run", F.sum("size").over(inside))
    placed = run.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at")))
    queued = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    through = F.col("epoch") * F.col("source_size") + F.col("before") + F.col("_run")
    return queued.withColumn("finish", F.when(F.col("target") > 0, through / F.col("target"))).drop("_source", "_at", "_range", "before", "_run")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 29) -> DataFrame:
    """The queued documents (see queue()) with `taken`: whether the mix takes that epoch of the document.

    The budget is the sum of all sizes. Queued documents are sorted by
    (finish, source, epoch, shuffle, size) over ranges of the finish time and
    taken while their running sum stays within the budget; the first document
    that would exceed it ends the mix, so a source's taken words differ from its
    target by about one document. Documents of sources without words are not
    taken. Null sources, repeated rows and empty texts are rows like any other;
    an empty table gives an empty one.
    """
    ranges = ranges_for(docs.count())
    queued = queue(docs, weights, epochs, seed, ranges)
    # all sources advance evenly in finish time, so equal steps of it hold about equal numbers of words
    steps = max(16, min(4 * ranges, MOST_RANGES))
    step = F.least(F.floor(F.col("finish") * steps), F.lit(4 * steps)).cast("int")
    ranged = written(queued.withColumn("_step", step), "queue")
    sums = ranged.where("_step is not null").groupBy("_step").agg(F.sum("size").alias("_sum"))
    total = docs.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("_budget")).scalar()
    # one row per step, 4 * MOST_RANGES at most: bounded, so it can be broadcast
    starts = offsets(sums, [], "_step", "_sum")
    opened = ranged.join(F.broadcast(starts), "_step", "left").withColumn("_budget", total)
    reached = F.coalesce(F.col("before") < F.col("_budget"), F.lit(False))
    order = [F.col("source").isNull(), F.col("source"), F.col("epoch"), F.col("tie"), F.col("size")]
    inside = Window.partitionBy("_step").orderBy("finish", *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # only the steps that the budget reaches are sorted; what lies beyond is not taken whatever its order
    sorted_part = opened.where(reached).withColumn("position", F.col("before") + F.sum("size").over(inside))
    rest = opened.where(~reached).withColumn("position", F.lit(None).cast("long"))
    out = sorted_part.unionByName(rest).withColumn("taken", F.coalesce(F.col("position") <= F.col("_budget"), F.lit(False)))
    return out.drop("_step", "before", "_budget")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("row_id"))
    mixed = mix(written(docs, "sizes"))
    per_document = mixed.groupBy("row_id", "doc_id", "size", "source_size", "target")
    return per_document.agg(F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken")).drop("row_id")


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null:' || coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)) || ':29') AS tie
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source
), w AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 3 AS cap FROM s
), f AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (SELECT arg_min(level, (ratio, k)) FROM f WHERE level <= ratio) * weight) AS target
  FROM f
), q AS (
  SELECT d.rid, d.doc_id, d.source, d.size, d.tie, g.source_size, g.target, e.epoch,
         CASE WHEN g.target > 0 THEN CAST(e.epoch * g.source_size + sum(d.size) OVER (PARTITION BY d.source, e.epoch ORDER BY d.tie, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) / g.target END AS finish
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source CROSS JOIN (SELECT unnest([0, 1, 2]) AS epoch) e
), p AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, epoch, tie, size ROWS UNBOUNDED PRECEDING) AS position FROM q WHERE finish IS NOT NULL
)
SELECT q.doc_id, q.size, q.source_size, q.target,
       CAST(coalesce(sum(q.size) FILTER (WHERE p.position <= (SELECT sum(size) FROM d)), 0) AS BIGINT) AS taken
FROM q LEFT JOIN p ON q.rid = p.rid AND q.epoch = p.epoch
GROUP BY q.rid, q.doc_id, q.size, q.source_size, q.target
"""
