"""Where rows that a mutation couldn't apply go."""

from __future__ import annotations

import importlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.sources.keyspace import Keyspace

log = logging.getLogger(__name__)
Handler = Callable[[DataFrame], None]
FIXED_MESSAGES = {
    "DocumentExistsException": "Document with the given id already exists",
    "DocumentNotFoundException": "Document with the given id not found",
    "CasMismatchException": "Document has changed since the given CAS value",
    "PathExistsException": "The path already exists in the document",
    "PathNotFoundException": "The path does not exist in the document",
    "PathMismatchException": "The path does not fit the structure of the document",
    "ValueInvalidException": "The value can't be used with this operation",
    "DocumentNotJsonException": "The document is no JSON",
}


def resolve_handler(handler) -> Handler:
    """A callable, or the dotted path of one or of a class of them; checked before anything is written."""
    if isinstance(handler, str):
        module, _, name = handler.rpartition(".")
        if not module:
            raise ValueError(f"Error handler {handler} is no dotted path")
        try:
            found = getattr(importlib.import_module(module), name)
        except ModuleNotFoundError as e:
            raise ValueError(f"Error handler {handler} could not be found") from e
        except AttributeError as e:
            raise ValueError(f"Error handler {handler} could not be found in its module") from e
        if isinstance(found, type):
            try:
                found = found()
            except TypeError as e:
                raise ValueError(f"Error handler {handler} must have a constructor without arguments") from e
        handler = found
    if not callable(handler):
        raise ValueError(f"Error handler {handler!r} must be callable")
    return handler


def error_documents(failed: DataFrame, keyspace: Keyspace, now=None) -> DataFrame:
    """Rows (id, status) as documents about errors: documentId, bucket, scope, collection, timestamp and error (class, simpleClass, message), under the key `id`."""
    names = keyspace.with_defaults()
    at = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    message = F.lit(None).cast("string")
    for status, text in FIXED_MESSAGES.items():
        message = F.when(F.col("status") == status, text).otherwise(message)
    where = f"{names.bucket}.{names.scope}.{names.collection}"
    return failed.select(
        F.concat(F.lit(f"error_{where}_"), F.col("id").cast("string"), F.lit("_"), F.unix_millis(at).cast("string")).alias("id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.col("id").cast("string").alias("documentId"),
        F.lit(names.bucket).alias("bucket"),
        F.lit(names.scope).alias("scope"),
        F.lit(names.collection).alias("collection"),
        F.struct(F.concat(F.lit("docweave."), "status").alias("class"), F.col("status").alias("simpleClass"), message.alias("message")).alias("error"),
    )


def to_collection(target, source: Keyspace) -> Handler:
    """A handler that upserts error documents into a collection."""
    from docweave.operators import kv

    def handle(failed: DataFrame) -> None:
        docs = error_documents(failed, source)
        if docs.limit(1).count():
            kv.upsert(target.create(), kv.documents(docs, "id").select("id", "body"))

    return handle


def to_json_lines(path: str, keyspace: Keyspace) -> Handler:
    """A handler that appends a line of JSON for each error."""
    names = keyspace.with_defaults()

    def handle(failed: DataFrame) -> None:
        failed.select(
            F.col("id").cast("string").alias("documentId"),
            F.col("status").alias("errorClass"),
            F.lit(names.bucket).alias("bucket"),
            F.lit(names.scope).alias("scope"),
            F.lit(names.collection).alias("collection"),
            F.current_timestamp().alias("timestamp"),
        ).write.mode("append").json(path)

    return handle


def in_turn(*handlers: Handler) -> Handler:
    """All handlers, one after the other, on errors that are computed once. A handler that fails is logged and stops neither the others nor the mutation."""

    def handle(failed: DataFrame) -> None:
        for h in handlers:
            try:
                h(failed)
            except Exception:
                log.exception("an error handler failed")

    return handle
