"""The document store behind the read and write operations.

A collection is a folder root/bucket/scope/collection with

    commits/<version>     what the version is made of, created only if it isn't there
    snapshot-<name>/      Parquet (id, body, cas): a state
    log/version=<v>/      Parquet: the mutations that led to version v

A mutation writes its snapshot and its part of the log under names of its own
and then creates the next commit. Two writers can't create the same one: the
second gets a CommitConflict and nothing of it is seen. The part of the log is
moved to where streams look only after the commit. Nothing that is being read
is ever overwritten.
"""

from __future__ import annotations

import contextlib
import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.sources.keyspace import Keyspace

STATE = T.StructType([T.StructField("id", T.StringType()), T.StructField("body", T.StringType()), T.StructField("cas", T.LongType())])
LOG = T.StructType(
    [
        T.StructField("seqno", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("deletion", T.BooleanType()),
        T.StructField("cas", T.LongType()),
        T.StructField("scope", T.StringType()),
        T.StructField("collection", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("vbucket", T.IntegerType()),
        T.StructField("xattrs", T.MapType(T.StringType(), T.StringType())),
    ]
)
#: Parts of the key space, a power of two.
VBUCKETS = 1024
#: CAS values of a version lie in a range of this size.
CAS_STEP = 1 << 32


def vbucket(id_column: Column, n: int = VBUCKETS) -> Column:
    """The part of the key space that an id belongs to, by the CRC-32 of its UTF-8 bytes."""
    return F.shiftright(F.crc32(id_column.cast("binary")), 16).bitwiseAND(F.lit(0x7FFF)).bitwiseAND(F.lit(n - 1)).cast("int")


class CommitConflict(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class Collection:
    """A collection of JSON documents under a root folder on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str, keyspace: Keyspace):
        self.spark, self.keyspace = spark, keyspace.with_defaults()
        self.path = f"{root.rstrip('/')}/{keyspace.path}"

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _list(self, name: str) -> list[str]:
        fs, where = self._fs(f"{self.path}/{name}")
        return [x.getPath().getName() for x in fs.listStatus(where)] if fs.exists(where) else []

    def exists(self) -> bool:
        return self.version() >= 0

    def version(self) -> int:
        """The number of the last commit; -1 if there is no collection."""
        return max((int(n) for n in self._list("commits") if n.isdigit()), default=-1)

    def _commit(self, version: int) -> dict:
        fs, where = self._fs(f"{self.path}/commits/{version}")
        stream = fs.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, version: int, facts: dict) -> None:
        """Creates a commit, complete and only if there is none of its number."""
        fs, temporary = self._fs(f"{self.path}/commits/.{version}-{uuid.uuid4().hex}")
        out = fs.create(temporary, False)
        out.write(bytearray(json.dumps(facts).encode()))
        out.close()
        _, final = self._fs(f"{self.path}/commits/{version}")
        try:
            if temporary.toUri().getScheme() in (None, "file"):
                # a local rename would replace the file
                os.link(temporary.toUri().getPath(), final.toUri().getPath())
                done = True
            else:
                done = not fs.exists(final) and fs.rename(temporary, final)
        except FileExistsError:
            done = False
        finally:
            if fs.exists(temporary):
                fs.delete(temporary, False)
        if not done:
            raise CommitConflict(f"another writer has committed version {version} of {self.keyspace.qualified}")

    def create(self) -> Collection:
        if not self.exists():
            name = f"snapshot-{uuid.uuid4().hex}"
            self.spark.createDataFrame([], STATE).write.parquet(f"{self.path}/{name}")
            with contextlib.suppress(CommitConflict):  # someone else has created it
                self._publish(0, {"snapshot": name})
        return self

    def drop(self) -> None:
        fs, where = self._fs(self.path)
        fs.delete(where, True)

    def state(self, version: int | None = None) -> DataFrame:
        """The documents: id, body, cas; of the current version or of another."""
        at = self.version() if version is None else version
        if at < 0:
            raise FileNotFoundError(f"there is no collection {self.keyspace.qualified}")
        return self.spark.read.schema(STATE).parquet(f"{self.path}/{self._commit(at)['snapshot']}")

    def staged(self, df: DataFrame) -> DataFrame:
        """df as a table of its own in the collection's folder, computed once."""
        path = f"{self.path}/.staged-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _show_log(self, version: int) -> None:
        """Moves a committed part of the log to where it is read; a part that its writer didn't move any more is moved by the next one who comes."""
        name = self._commit(version).get("log")
        fs, hidden = self._fs(f"{self.path}/{name}")
        _, shown = self._fs(f"{self.path}/log/version={version}")
        if name and fs.exists(hidden) and not fs.exists(shown):
            fs.mkdirs(shown.getParent())
            fs.rename(hidden, shown)

    def log(self) -> DataFrame:
        """All committed mutations so far, in no order; seqno has it."""
        last = self.version()
        if last > 0:
            self._show_log(last)
        fs, where = self._fs(f"{self.path}/log")
        if not fs.exists(where) or not fs.listStatus(where):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/log/version=*")

    def commit(self, state: DataFrame, changes: DataFrame, seen: int | None = None) -> int:
        """Makes `state` (id, body, cas) current; `changes` (id, body or null for a deletion, cas) go to the log. Returns the new version.

        seen: the version that both were made of; if another has been committed since, this raises CommitConflict and changes nothing.
        """
        old = self.version() if seen is None else seen
        mark, new = uuid.uuid4().hex, old + 1
        state.select("id", "body", "cas").write.parquet(f"{self.path}/snapshot-{mark}")
        entries = changes.select(
            F.col("cas").alias("seqno"),
            "id",
            F.col("body").cast("binary").alias("content"),
            F.col("body").isNull().alias("deletion"),
            "cas",
            F.lit(self.keyspace.scope).alias("scope"),
            F.lit(self.keyspace.collection).alias("collection"),
            F.current_timestamp().alias("timestamp"),
            vbucket(F.col("id")).alias("vbucket"),
            F.create_map().cast("map<string,string>").alias("xattrs"),
        )
        entries.write.parquet(f"{self.path}/.log-{mark}")
        if old > 0:
            self._show_log(old)
        self._publish(new, {"snapshot": f"snapshot-{mark}", "log": f".log-{mark}"})
        self._show_log(new)
        return new

    def load(self, documents: DataFrame, id_column: str) -> Collection:
        """Replaces the contents by the rows of a DataFrame as documents; null cells are left out of the bodies."""
        body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != id_column]))
        seen = self.create().version()
        rows = documents.select(F.col(f"`{id_column}`").cast("string").alias("id"), body.alias("body")).where("id is not null")
        staged = self.staged(rows.withColumn("cas", F.monotonically_increasing_id() + F.lit((seen + 1) * CAS_STEP) + 1))
        self.commit(staged, staged, seen)
        return self


class Store:
    """The collections under a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def collection(self, keyspace: Keyspace) -> Collection:
        return Collection(self.spark, self.root, keyspace)

    def create(self, keyspace: Keyspace) -> Collection:
        return self.collection(keyspace).create()

    def drop(self, keyspace: Keyspace) -> None:
        self.collection(keyspace).drop()
