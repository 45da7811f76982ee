"""Pieces that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.sources.shared import fresh_path

#: The white space that separates words: U+0020 and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"
NOT_WHITE = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The words of a non-null text as an array, empty if there are none."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WHITE_RUN))


def let(value: Column, body) -> Column:
    """body(value), with the value computed once for each row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def count_upto(n: Column) -> Column:
    """[0, 1, ..., n - 1]; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: computed once, without lineage, safe against lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing reads any more."""
    for t in tables:
        delete_path(t.sparkSession, t.written_to.rsplit("/", 1)[0])


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
