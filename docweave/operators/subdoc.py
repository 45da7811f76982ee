"""Operations on parts of documents, addressed by paths.

Column headers have the form `[operation:]path`, upsert where there is no
colon; operations are applied from left to right. There are two ways.

* mutate_in() works on documents as structs: paths are known when a plan is
  made, so every operation is compiled to struct and array expressions.
* edit_documents() works on documents as JSON texts of any shape: only the
  addressed part changes, all else keeps its characters, and a document that
  can't be changed gets a status instead of stopping the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.operators import jsontext

OPERATIONS = ("insert", "upsert", "remove", "replace", "arrayAppend", "arrayPrepend", "arrayInsert", "arrayAddUnique", "increment", "decrement")
MOST_OPERATIONS = 16
_INDEX = re.compile(r"^(.*)\[(-?\d+)\]$")


@dataclass(frozen=True)
class Spec:
    operation: str
    path: str
    column: str


def parse_header(name: str) -> Spec:
    """What a column header asks for."""
    head, colon, path = name.partition(":")
    if not colon:
        return Spec("upsert", name, name)
    for operation in OPERATIONS:
        if operation.lower() == head.lower():
            return Spec(operation, path, name)
    raise ValueError(f"Unsupported sub-document operation '{head}'")


def specs(columns: list[str], special: tuple[str, ...] = ()) -> list[Spec]:
    """The operations of a table's columns, checked before anything is written."""
    out = [parse_header(c) for c in columns if c not in special]
    if len(out) > MOST_OPERATIONS:
        raise ValueError(f"A maximum of {MOST_OPERATIONS} sub-document operations is allowed, there are {len(out)}")
    return out


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def _has(schema: T.DataType, path: str) -> bool:
    for p in path.split("."):
        if not isinstance(schema, T.StructType) or p not in schema.names:
            return False
        schema = schema[p].dataType
    return True


def _at(doc: Column, path: str) -> Column:
    for p in path.split("."):
        doc = doc.getField(p)
    return doc


def _set(doc: Column, schema: T.DataType, path: str, value: Column) -> Column:
    """doc with a value at a path; parents that the type lacks, or that are null, are made."""
    head, _, rest = path.partition(".")
    if not rest:
        return doc.withField(f"`{head}`", value)
    inner = schema[head].dataType if isinstance(schema, T.StructType) and head in schema.names else None
    if isinstance(inner, T.StructType):
        child = doc.getField(head)
        empty = F.lit(None).cast(inner)
        made = F.coalesce(child, F.struct(*[empty.getField(n).alias(n) for n in inner.names]))
        return doc.withField(f"`{head}`", _set(made, inner, rest, value))
    return doc.withField(f"`{head}`", _nested(rest, value))


def _nested(path: str, value: Column) -> Column:
    head, _, rest = path.partition(".")
    return F.struct((_nested(rest, value) if rest else value).alias(head))


def _error(kind: str, path: str) -> Column:
    return F.raise_error(F.lit(f"{kind}: {path}"))


def _values(value: Column, kind: T.DataType) -> Column:
    """One value or an array of them, as an array; an empty one is an error."""
    if isinstance(kind, T.ArrayType):
        return F.when(F.size(value) > 0, value).otherwise(_error("EmptyArray", ""))
    return F.array(value)


def _whole(value: Column, kind: T.DataType, path: str) -> Column:
    """Counters count whole numbers; fractions are cut off."""
    if isinstance(kind, T.NumericType):
        return value.cast("double").cast("long") if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)) else value.cast("long")
    raise ValueError(f"a counter needs a number, {path} gets {kind.simpleString()}")


def compile_one(doc: Column, schema: T.StructType, spec: Spec, value: Column, kind: T.DataType) -> Column:
    """doc (a struct of the schema) after one operation with a value of some type.

    insert meets an existing path, replace a missing one, and array operations
    something that is no array: these raise PathExists, PathNotFound and
    PathMismatch for the row when the result is computed.
    """
    path, operation = spec.path, spec.operation
    index = _INDEX.match(path) if operation == "arrayInsert" else None
    if index:
        path = index[1]
    present = _at(doc, path) if _has(schema, path) else None
    if operation == "upsert":
        return _set(doc, schema, path, value)
    if operation == "insert":
        checked = value if present is None else F.when(present.isNull(), value).otherwise(_error("PathExistsException", path))
        return _set(doc, schema, path, checked)
    if operation == "replace":
        if present is None:
            return F.when(F.lit(True), _error("PathNotFoundException", path)).otherwise(doc)
        return _set(doc, schema, path, F.when(present.isNotNull(), value).otherwise(_error("PathNotFoundException", path)))
    if operation == "remove":
        return doc.dropFields(_quoted(path)) if present is not None else F.when(F.lit(True), _error("PathNotFoundException", path)).otherwise(doc)
    if operation in ("increment", "decrement"):
        step = _whole(value, kind, path)
        old = F.coalesce(present.cast("long"), F.lit(0).cast("long")) if present is not None else F.lit(0).cast("long")
        return _set(doc, schema, path, old + step if operation == "increment" else old - step)
    if present is None:
        if operation == "arrayInsert":
            return F.when(F.lit(True), _error("PathNotFoundException", path)).otherwise(doc)
        return _set(doc, schema, path, F.array(value) if operation == "arrayAddUnique" else _values(value, kind))
    old = present
    if operation == "arrayAddUnique":
        made = F.when(old.isNull(), F.array(value)).when(F.array_contains(old, value), _error("PathExistsException", path)).otherwise(F.concat(old, F.array(value)))
        return _set(doc, schema, path, made)
    new = _values(value, kind)
    if operation == "arrayInsert":
        if not index:
            raise ValueError(f"arrayInsert needs an index, as in tags[1]; is {spec.path}")
        i = int(index[2])
        made = F.when((F.size(old) >= i) & (F.lit(i) >= 0), F.concat(F.slice(old, 1, i), new, F.slice(old, i + 1, F.size(old) + 1))).otherwise(_error("PathNotFoundException", spec.path))
        return _set(doc, schema, path, made)
    filled = F.coalesce(old, F.array().cast(_array_type(schema, path)))
    return _set(doc, schema, path, F.concat(filled, new) if operation == "arrayAppend" else F.concat(new, filled))


def _array_type(schema: T.DataType, path: str) -> T.DataType:
    for p in path.split("."):
        schema = schema[p].dataType
    return schema


def mutate_in(df, doc: str, operations: list[Spec], special: tuple[str, ...] = ()):
    """df with the struct column `doc` after all operations; each operation's value is the column of its header. A null cell of a removal leaves the path, other null cells leave it too: what isn't written has no effect."""
    out = df
    for spec in operations:
        schema, kind = out.schema[doc].dataType, out.schema[spec.column].dataType
        out = out.withColumn(doc, compile_one(F.col(doc), schema, spec, F.col(f"`{spec.column}`"), kind))
    return out.drop(*[s.column for s in operations])


SPECS = "array<struct<operation:string,path:string,cell:string>>"


def specs_column(wanted: list[Spec]) -> Column:
    """The operations of a row, each with its cell as {"v": value}, or {} for a null cell."""
    one = lambda s: F.struct(F.lit(s.operation).alias("operation"), F.lit(s.path).alias("path"), F.to_json(F.struct(F.col(f"`{s.column}`").alias("v"))).alias("cell"))
    return F.array(*[one(s) for s in wanted]).cast(SPECS)


def edit_text(body: str | None, operations: list[dict]) -> tuple[str | None, str | None]:
    """(document after the operations, None), or (the document as it was, status)."""
    text = "{}" if body is None else body
    try:
        for o in operations:
            found, _ = jsontext.items(o["cell"], 0)
            if found:  # a null cell has no effect
                text = jsontext.edit(text, o["operation"], o["path"], o["cell"][found[0][2] : found[0][3]])
    except jsontext.PathError as e:
        return body, e.status
    return text, None


def edit_documents(df: DataFrame, body: str = "body", operations: str = "specs", status: str = "failure") -> DataFrame:
    """df with documents (JSON texts; null is an empty one) after each row's operations (see specs_column) and the column `status`: null, or why the document is as it was."""
    kept = [c for c in df.columns if c not in (body, operations, status)]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [edit_text(t, o or []) for t, o in zip(b[body].to_pylist(), b[operations].to_pylist())]
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.string())], [*kept, body, status])

    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{body}`"), F.col(f"`{operations}`")).mapInArrow(work, f"{fields}`{body}` string, `{status}` string")


def lookup(body: str, path: str) -> Column:
    """A part of a JSON body as text."""
    return F.get_json_object(F.col(body), path if path.startswith("$") else f"$.{path}")


def exists(body: str, path: str) -> Column:
    return F.get_json_object(F.col(body), path if path.startswith("$") else f"$.{path}").isNotNull()


def count(body: str, path: str = "$") -> Column:
    """How many elements an array has, or fields an object."""
    part = F.col(body) if path == "$" else lookup(body, path)
    return F.coalesce(F.json_array_length(part), F.size(F.json_object_keys(part)))


def lookup_in(df, body: str, paths: dict[str, str]):
    """df's other columns and one column for each path."""
    return df.select(*[c for c in df.columns if c != body], *[lookup(body, p).alias(n) for n, p in paths.items()])
