"""Raw statements: the part of the documents' query language that Spark SQL can run."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from docweave.functions.filters import rewrite
from docweave.sources.keyspace import CAS_FIELD, ID_FIELD, Keyspace

_NAME = re.compile(r"(?P<quoted>'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\")|(?P<lead>\b(?:from|join)\s+)(?P<name>(?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))*)", re.I)


class Unsupported(ValueError):
    """A statement that this engine doesn't run."""


def _plain(name: str) -> str:
    return ".".join(p.strip().strip("`") for p in re.split(r"\.(?=(?:[^`]*`[^`]*`)*[^`]*$)", name))


def names(text: str) -> list[str]:
    """The collection names that a statement reads, each once."""
    return list(dict.fromkeys(_plain(m["name"]) for m in _NAME.finditer(text) if m["quoted"] is None))


def translate(text: str, names: dict[str, str], id_field: str = ID_FIELD, cas_field: str = CAS_FIELD) -> str:
    """A SELECT as Spark SQL. names: collection names, as they are written, to views."""
    stripped = text.strip().rstrip(";")
    first = (re.match(r"\(*\s*(\w+)", stripped) or [None, ""])[1].lower()
    if first not in ("select", "with", "values"):
        raise Unsupported(f"only SELECT statements can be run as raw statements, not {first.upper() or 'nothing'}; documents are written by key/value operations")
    if re.match(r"select\s+(raw|value)\b", stripped, re.I):
        raise Unsupported("SELECT RAW and SELECT VALUE are not supported; select columns")

    def view(m: re.Match) -> str:
        if m["quoted"] is not None:
            return m[0]
        found = names.get(_plain(m["name"]))
        return f"{m['lead']}`{found}`" if found else m[0]

    return _NAME.sub(view, rewrite(stripped, id_field, cas_field))


def run(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, keyspace: Keyspace | None = None) -> DataFrame:
    """Runs a statement over named DataFrames.

    A keyspace is the context that names are relative to: `airport` then also
    stands for the table `bucket.scope.airport`. It may not name a collection.
    """
    if keyspace is not None and keyspace.collection is not None:
        raise ValueError("A collection can't be part of a statement's keyspace; name it in the statement")
    names, mark = {}, uuid.uuid4().hex
    for i, (name, df) in enumerate((tables or {}).items()):
        view = f"_statement_{mark}_{i}"
        df.createTempView(view)
        names[name] = view
        if keyspace is not None and keyspace.bucket and keyspace.scope:
            prefix = f"{keyspace.bucket}.{keyspace.scope}."
            if name.startswith(prefix):
                names.setdefault(name[len(prefix) :], view)
    try:
        # names are resolved here; the views aren't needed after that
        return spark.sql(translate(text, names))
    finally:
        for view in set(names.values()):
            spark.catalog.dropTempView(view)
