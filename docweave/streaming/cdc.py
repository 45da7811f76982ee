"""Change streams, and queries over streams.

A change stream reads the append-only log of a collection. Micro-batch offsets
are those of Spark's file source, kept in the query's checkpoint, which a
restart continues from whatever streamFrom says. Continuous processing isn't
available for this source; use a short processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators import kv
from docweave.sources.config import parse_duration
from docweave.sources.keyspace import Keyspace
from docweave.sources.shared import fresh_path
from docweave.sources.snapshot import LOG, Collection

META_DATA, STREAM_FROM = ("none", "basic", "full"), ("fromNow", "fromBeginning")


def stream_schema(streamMetaData: str = "basic", streamContent: bool = True) -> T.StructType:
    """The columns of a change stream under its options."""
    if streamMetaData not in META_DATA:
        raise ValueError(f"Unknown streamMetaData option of {streamMetaData}; there are {', '.join(META_DATA)}")
    fields = [T.StructField("id", T.StringType(), False), *([T.StructField("content", T.BinaryType())] if streamContent else []), T.StructField("deletion", T.BooleanType(), False)]
    if streamMetaData != "none":
        fields += [T.StructField("cas", T.LongType(), False), T.StructField("scope", T.StringType()), T.StructField("collection", T.StringType())]
    if streamMetaData == "full":
        fields += [T.StructField("timestamp", T.TimestampType(), False), T.StructField("vbucket", T.IntegerType(), False), T.StructField("xattrs", T.MapType(T.StringType(), T.StringType()))]
    return T.StructType(fields)


def collection_names(collection: str | None = None, collections: str | None = None, implicit: str | None = None) -> list[str]:
    """The collections that a stream is about, each once: the option `collection` and the comma-separated `collections`, or else the implicit one."""
    named = [c.strip() for c in [collection or "", *(collections or "").split(",")] if c.strip()]
    return list(dict.fromkeys(named or ([implicit] if implicit else [])))


def change_stream(
    source: Collection,
    streamFrom: str = "fromNow",
    streamMetaData: str = "basic",
    streamContent: bool = True,
    scope: str | None = None,
    collections: list[str] | None = None,
    maxFilesPerTrigger: int | None = None,
    numPartitions: int | None = None,
    flowControlBufferSize: int | None = None,
    mutationLogTimeout: str | None = None,
) -> DataFrame:
    """The mutations of a collection as a stream. fromNow skips what the log has when the stream is set up."""
    if streamFrom not in STREAM_FROM:
        raise ValueError(f"Unknown streamFrom option of {streamFrom}; there are {', '.join(STREAM_FROM)}")
    if numPartitions is not None and numPartitions <= 0:
        raise ValueError(f"numPartitions must be positive, is {numPartitions}")
    if mutationLogTimeout is not None:
        parse_duration(mutationLogTimeout)
    schema = stream_schema(streamMetaData, streamContent)
    reader = source.spark.readStream.schema(LOG)
    if maxFilesPerTrigger is not None:
        reader = reader.option("maxFilesPerTrigger", maxFilesPerTrigger)
    fs, log = source._fs(f"{source.path}/log")
    fs.mkdirs(log)
    out = reader.option("recursiveFileLookup", "true").parquet(f"{source.path}/log")
    if streamFrom == "fromNow":
        seen = source.log().agg(F.max("seqno")).first()[0]
        if seen is not None:
            out = out.where(F.col("seqno") > seen)
    if scope is not None:
        out = out.where(F.col("scope") == scope)
    if collections:
        out = out.where(F.col("collection").isin(*collections))
    if numPartitions is not None:
        out = out.repartition(numPartitions, "vbucket")
    return out.select(*schema.names)


def changes_of(rows: DataFrame, id_column: str, keyspace: Keyspace, streamMetaData: str = "basic", streamContent: bool = True, collection: Column | None = None, timestamp: Column | None = None) -> DataFrame:
    """Rows of any DataFrame, streaming or not, as changes: each is a mutation of the document that it is."""
    from docweave.sources.snapshot import vbucket

    schema, names = stream_schema(streamMetaData, streamContent), keyspace.with_defaults()
    key = F.col(id_column).cast("string")
    columns = {
        "id": key,
        "content": F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != id_column])).cast("binary"),
        "deletion": F.lit(False),
        "cas": F.abs(F.xxhash64(*rows.columns)),
        "scope": F.lit(names.scope),
        "collection": collection if collection is not None else F.lit(names.collection),
        "timestamp": timestamp if timestamp is not None else F.current_timestamp(),
        "vbucket": vbucket(key),
        "xattrs": F.create_map().cast("map<string,string>"),
    }
    return rows.select(*[columns[n].alias(n) for n in schema.names])


def file_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """One table of a folder as a stream."""
    kind = schema or spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(kind).option("pathGlobFilter", name).parquet(folder)


def counts(changes: DataFrame, *by: str) -> DataFrame:
    return changes.groupBy(*by).count()


def windowed(events: DataFrame, time: str, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Counts by tumbling or sliding windows (win_start, n); late: how long rows may be late."""
    marked = events.withWatermark(time, late) if late else events
    return marked.groupBy(F.window(F.col(time), size, slide or size)).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("win_start"), "n")


def sessions(events: DataFrame, time: str, gap: str, *by: str, late: str | None = None) -> DataFrame:
    """Counts by sessions, which end after a gap without rows."""
    marked = events.withWatermark(time, late) if late else events
    return marked.groupBy(*by, F.session_window(F.col(time), gap).alias("_w")).agg(F.count(F.lit(1)).alias("n")).select(*by, F.col("_w.start").alias("s_start"), "n")


def deduplicated(events: DataFrame, *by: str, time: str | None = None, late: str | None = None) -> DataFrame:
    """The first row of each key; with a watermark the keys are forgotten once they are late."""
    if time and late:
        return events.withWatermark(time, late).dropDuplicatesWithinWatermark(list(by))
    return events.select(*by).dropDuplicates(list(by))


def drained(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now and returns the result as a table.

    State and result lie in the shared folder: in append mode the result is a
    Parquet sink, in complete mode each micro-batch replaces it as a whole.
    """
    spark, home = stream.sparkSession, fresh_path(stream.sparkSession, "stream")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True)
    if mode == "complete":
        writer = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{home}/result"))
    else:
        writer = writer.format("parquet").option("path", f"{home}/result")
    query = writer.start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(stream.schema).parquet(f"{home}/result")


def apply_changes(changes: DataFrame, write: Callable[[DataFrame], object], remove: Callable[[DataFrame], object]) -> None:
    """A micro-batch of changes (id, content, deletion, cas) as mutations: the last change of each id counts; deletions are removed, all else is written."""
    newest = Window.partitionBy("id").orderBy(F.col("cas").desc())
    last = changes.withColumn("_n", F.row_number().over(newest)).where("_n = 1")
    kept = last.where("not deletion").select("id", F.col("content").cast("string").alias("body"))
    gone = last.where("deletion").select("id")
    if not kept.isEmpty():
        write(kept)
    if not gone.isEmpty():
        remove(gone)


def into(stream: DataFrame, write: Callable[[DataFrame], None], checkpoint: str):
    """Writes every micro-batch by a function of our own, such as a key/value mutation; exactly once if that is idempotent by key."""
    return stream.writeStream.foreachBatch(lambda df, _: write(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def replicate(changes: DataFrame, target: Collection, checkpoint: str):
    """Keeps a collection like the one that a change stream (with content and CAS) is of: documents are upserted, deletions removed."""
    return into(changes, lambda df: apply_changes(df, lambda x: kv.upsert(target, x), lambda x: kv.remove(target, x, ignore_if_not_found=True)), checkpoint)
