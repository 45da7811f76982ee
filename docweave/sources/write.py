"""DataFrame sinks: save modes and write modes over key/value mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators import kv, subdoc
from docweave.operators.errors import in_turn, resolve_handler, to_collection
from docweave.sources.config import connect, parse_duration
from docweave.sources.keyspace import CAS_FIELD, ID_FIELD, Keyspace
from docweave.sources.profiles import profile
from docweave.sources.snapshot import Collection, Store

SAVE_MODES = ("overwrite", "errorifexists", "ignore", "append")
WRITE_MODES = ("replace", "subdocInsert", "subdocReplace", "subdocUpsert")


def save_operation(mode: str) -> tuple[str, bool]:
    """(operation, whether existing documents are passed over) of a save mode. append has no meaning for documents with ids and is refused."""
    normal = {"error": "errorifexists", "default": "errorifexists"}.get(mode.lower(), mode.lower())
    if normal == "append":
        raise ValueError("SaveMode.Append is not supported; use overwrite, ignore or errorifexists")
    if normal not in SAVE_MODES:
        raise ValueError(f"Unknown save mode {mode!r}")
    return ("upsert", False) if normal == "overwrite" else ("insert", normal == "ignore")


def write(
    df: DataFrame,
    collection: Collection,
    mode: str = "errorifexists",
    kind: str = "query",
    writeMode: str | None = None,
    idFieldName: str = ID_FIELD,
    casFieldName: str | None = None,
    durability: str | None = None,
    timeout: str | None = None,
    errorHandler=None,
    errorCollection: Collection | None = None,
) -> DataFrame:
    """Writes a DataFrame's rows as documents; id, cas and status of every row.

    All options are checked first, so a refused write changes nothing. A
    writeMode counts more than the save mode.
    """
    if not profile(kind).writable:
        raise ValueError(f"The {kind} profile is read-only")
    operation, ignore = save_operation(mode) if writeMode is None else ("", False)
    if writeMode is not None and writeMode not in WRITE_MODES:
        raise ValueError(f"Unknown write mode {writeMode!r}; there are {', '.join(WRITE_MODES)}")
    kv.check_durability(durability)
    if timeout is not None:
        parse_duration(timeout)
    handlers = [resolve_handler(errorHandler)] if errorHandler is not None else []
    if errorCollection is not None:
        handlers.append(to_collection(errorCollection, collection.keyspace))
    handler = in_turn(*handlers) if handlers else None  # which also keeps a failing one from stopping the write
    collection.create()
    if writeMode is not None and writeMode.startswith("subdoc"):
        return _write_parts(df, collection, writeMode, idFieldName, casFieldName, handler)
    batch = kv.documents(df, idFieldName, casFieldName)
    if writeMode == "replace":
        return kv.replace(collection, batch, on_error=handler)
    return kv.mutate(collection, batch.drop("cas"), operation, ignore=(kv.EXISTS,) if ignore else (), on_error=handler)


def _write_parts(df: DataFrame, collection: Collection, mode: str, id_field: str, cas_field: str | None, handler) -> DataFrame:
    """Path operations on stored documents. All but the addressed parts keeps its characters; documents that can't be changed are errors like others."""
    special = tuple(c for c in (id_field, cas_field, CAS_FIELD) if c)
    wanted = subdoc.specs(df.columns, special)
    cas = F.col(f"`{cas_field}`").cast("long") if cas_field else F.lit(0).cast("long")
    rows = df.select(F.col(f"`{id_field}`").cast("string").alias("id"), cas.alias("cas"), subdoc.specs_column(wanted).alias("specs"))
    return mutate_parts(collection, rows, mode, handler)


def mutate_parts(collection: Collection, rows: DataFrame, mode: str, handler=None, ordinal: str | None = None) -> DataFrame:
    """rows (id, cas, specs) of path operations; id, cas and status of every row. Of rows with the same id the last is applied (with subdocInsert the first)."""
    operation = {"subdocInsert": "insert", "subdocReplace": "replace", "subdocUpsert": "upsert"}[mode]

    def edited() -> DataFrame:
        known = collection.state().select(F.col("id").alias("_id"), "body")
        return subdoc.edit_documents(rows.join(known, rows["id"] == known["_id"], "left").drop("_id"))

    return kv.mutate(collection, edited, operation, on_error=handler, ordinal=ordinal)


def save(spark, df: DataFrame, mode: str = "errorifexists", bucket=None, scope=None, collection=None, connectionIdentifier=None, errorBucket=None, errorScope=None, errorCollection=None, **options) -> DataFrame:
    """Writes to the collection that options and configuration name."""
    link = connect(spark, connectionIdentifier)
    store = Store(spark, link.root)
    errors = store.collection(Keyspace(errorBucket, errorScope, errorCollection)) if errorBucket else None
    return write(df, store.collection(link.keyspace(bucket, scope, collection)), mode, errorCollection=errors, **options)
