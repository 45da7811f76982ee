"""One entry to everything: scans, raw statements, search and key/value operations on configured collections.

    db = Documents(spark)                       # or Documents(spark, "other connection")
    db.read(bucket="b", filter="type = 'airport'")
    db.upsert(df, collection="airports")
    db.query("SELECT country, count(*) AS n FROM airports GROUP BY country")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docweave.operators import kv, relational, search, subdoc
from docweave.operators.errors import in_turn, resolve_handler
from docweave.plans import statement
from docweave.sources.config import Connection, connect
from docweave.sources.keyspace import ID_FIELD, Keyspace
from docweave.sources.read import read, read_collection
from docweave.sources.snapshot import Collection, Store
from docweave.sources.write import mutate_parts, write
from docweave.streaming import cdc


class Documents:
    """The collections that a connection identifier leads to."""

    def __init__(self, spark: SparkSession, connectionIdentifier: str | None = None):
        self.spark, self.identifier = spark, connectionIdentifier

    @property
    def connection(self) -> Connection:
        return connect(self.spark, self.identifier)

    def collection(self, bucket: str | None = None, scope: str | None = None, collection: str | None = None) -> Collection:
        link = self.connection
        return Store(self.spark, link.root).collection(link.keyspace(bucket, scope, collection))

    # scans

    def read(self, kind: str = "query", schema=None, **options) -> DataFrame:
        if self.identifier is not None:
            options["connectionIdentifier"] = self.identifier
        return read(self.spark, kind, schema, **options)

    def write(self, df: DataFrame, mode: str = "errorifexists", bucket=None, scope=None, collection=None, **options) -> DataFrame:
        return write(df, self.collection(bucket, scope, collection), mode, **options)

    def stream(self, bucket=None, scope=None, collection=None, **options) -> DataFrame:
        return cdc.change_stream(self.collection(bucket, scope, collection), **options)

    # statements and search

    def _context(self, keyspace: Keyspace | None) -> Keyspace:
        where = (keyspace or Keyspace()).filled(Keyspace(self.connection.implicit.bucket, self.connection.implicit.scope)) if keyspace is None or keyspace.collection is None else keyspace
        if where.collection is not None:
            raise ValueError("A collection can't be part of a statement's keyspace; name it in the statement")
        return where.with_defaults()

    def query(self, text: str, keyspace: Keyspace | None = None, kind: str = "query") -> DataFrame:
        """A SELECT over stored collections. Names without dots are collections of the keyspace; names of three parts are bucket, scope and collection."""
        where = self._context(keyspace)
        tables: dict[str, DataFrame] = {}
        for name in statement.names(text):
            parts = name.split(".")
            full = [where.bucket, where.scope, *parts][-3:] if len(parts) < 3 else parts
            if len(full) == 3 and all(full):
                source = Store(self.spark, self.connection.root).collection(Keyspace(*full))
                if source.exists():
                    tables[name] = read_collection(source, kind)
        return statement.run(self.spark, text, tables)

    def analytics_query(self, text: str, keyspace: Keyspace | None = None) -> DataFrame:
        return self.query(text, keyspace, "analytics")

    def columnar_query(self, text: str, keyspace: Keyspace | None = None) -> DataFrame:
        return self.query(text, keyspace, "columnar")

    def search_query(self, query: str, field: str, limit: int | None = None, skip: int = 0, **where) -> DataFrame:
        """(id, score) of the documents whose field meets a query string."""
        return search.search(self.read(**where), query, field, ID_FIELD, limit, skip).withColumnRenamed(ID_FIELD, "id")

    # key/value

    def get(self, ids, strict: bool = True, **where) -> DataFrame:
        """(id, body, cas) of ids: a list of them or of Get records, or a DataFrame with a column id."""
        return kv.get(self.collection(**where).state(), self._ids(ids), strict)

    def lookup_in(self, ids, paths: dict[str, str], strict: bool = True, **where) -> DataFrame:
        """(id, cas and one column for each path) of ids."""
        return subdoc.lookup_in(self.get(ids, strict, **where), "body", paths)

    def _ids(self, ids) -> DataFrame:
        if isinstance(ids, DataFrame):
            return ids.select(F.col("id").cast("string").alias("id"))
        return self.spark.createDataFrame([(getattr(i, "id", i),) for i in ids], "id string")

    def _batch(self, rows) -> tuple[DataFrame, str | None]:
        return (rows, None) if isinstance(rows, DataFrame) else (kv.operations(self.spark, list(rows)), "ordinal")

    def upsert(self, rows, **where) -> DataFrame:
        """rows: records, or a DataFrame (id, body)."""
        batch, ordinal = self._batch(rows)
        return kv.upsert(self.collection(**where).create(), batch, ordinal=ordinal)

    def insert(self, rows, ignore_if_exists: bool = False, **where) -> DataFrame:
        batch, ordinal = self._batch(rows)
        return kv.insert(self.collection(**where).create(), batch, ignore_if_exists, ordinal=ordinal)

    def replace(self, rows, ignore_if_not_found: bool = False, **where) -> DataFrame:
        batch, ordinal = self._batch(rows)
        return kv.replace(self.collection(**where), batch, ignore_if_not_found, ordinal=ordinal)

    def remove(self, rows, ignore_if_not_found: bool = False, **where) -> DataFrame:
        batch, ordinal = self._batch(rows)
        return kv.remove(self.collection(**where), batch, ignore_if_not_found, ordinal=ordinal)

    def mutate_in(self, df: DataFrame | list[kv.MutateIn], semantics: str = "replace", bucket=None, scope=None, collection=None, **options) -> DataFrame:
        """Path operations, one for each column header of df (see operators.subdoc), or MutateIn records, whose CAS is checked unless it is 0; semantics: insert, replace or upsert of the document."""
        mode = {"insert": "subdocInsert", "replace": "subdocReplace", "upsert": "subdocUpsert"}.get(semantics)
        if mode is None:
            raise ValueError(f"Unknown store semantics {semantics!r}")
        if not isinstance(df, DataFrame):
            handler = options.get("errorHandler")
            rows = kv.part_operations(self.spark, list(df))
            return mutate_parts(self.collection(bucket, scope, collection).create(), rows, mode, in_turn(resolve_handler(handler)) if handler is not None else None, "ordinal")
        return write(df, self.collection(bucket, scope, collection), writeMode=mode, **options)


def measured(df: DataFrame, name: str = "scan") -> tuple[DataFrame, Observation]:
    """df, and what it yields once an action has run over it: resultCount, resultSize (bytes as JSON) and errorCount (rows without any value)."""
    seen = Observation(name)
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return df.observe(seen, F.count(F.lit(1)).alias("resultCount"), F.coalesce(F.sum(F.octet_length(row)), F.lit(0)).alias("resultSize"), F.count_if(row == "{}").alias("errorCount")), seen


__all__ = ["Documents", "measured", "relational"]
