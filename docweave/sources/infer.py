"""Schemas of JSON documents, inferred from a sample."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.sources.keyspace import INFER_LIMIT


def infer_schema(bodies: DataFrame, column: str = "body", limit: int | None = INFER_LIMIT) -> T.StructType:
    """The union of the fields of the first `limit` documents (None: of all), sorted by name. Documents without fields give an empty schema."""
    sample = bodies.select(F.col(column).alias("value")).where("value is not null")
    if limit is not None:
        sample = sample.limit(int(limit))
    spark = sample.sparkSession
    # Spark's own JSON inference over a Dataset of strings, without a detour through Python
    strings = getattr(sample._jdf, "as")(spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(strings).schema().json()))


def parsed(df: DataFrame, schema: T.StructType, column: str = "body", keep: list[str] | None = None) -> DataFrame:
    """df's kept columns and the fields of its JSON documents, typed by the schema; what a document lacks is null."""
    body = F.from_json(F.col(column), schema)
    kept = keep or []
    return df.select(*kept, body.alias("_doc")).select(*kept, *[F.col("_doc").getField(f.name).alias(f.name) for f in schema.fields])

