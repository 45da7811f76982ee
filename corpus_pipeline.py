"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes
each stage's result as Parquet to the shared folder and reads it for the next.
All stages but the last return the columns of `documents`, and any further
ones of docs, whatever their names. Null ids and sources are values like any
other, null texts are empty, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import mixing, pieces, quality, repeats, simhash
from docweave.llm.common import table, text_or_empty, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep. Empty texts fail them; repeated rows are judged alike."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of least id, null last. Texts without words are near copies of each other, and a repeated row stays once."""
    return simhash.drop_near_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages that occur earlier; those of which no word is left go, and those that had none. n_chars is counted anew."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # further columns travel under names that clash with nothing
    rows = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(others)])
    done = repeats.remove_repeats(rows).where("n_words > n_removed")
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    old = {c: F.col(f"_c{i}") for i, c in enumerate(others)}
    return done.select(*[(old | new)[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; those without words are not taken. Of rows that are equal in all columns the mix takes some number, whichever they are."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    # 128 bits of all columns
    key = F.md5(F.to_json(F.struct(*others, F.md5(text_or_empty("text").cast("binary")).alias("_text"), F.col("text").isNull().alias("_null"))).cast("binary"))
    light = docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"), key.alias("_key"))
    mixed = mixing.mix(written(light, "sizes"))
    times = mixed.where("taken").groupBy("_key").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    once = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), key.alias("_key")).dropDuplicates(["_key"])
    return once.join(times, "_key").withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_all.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids; empty texts have none, and repeated rows all come back."""
    return pieces.encode(docs.select("doc_id", "source", "lang", text_or_empty("text").alias("text"))).drop("text")


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL can express neither the hashes of the quality model nor the SimHash components; tests/llm/ compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
