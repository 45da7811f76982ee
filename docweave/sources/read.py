"""Scans of collections under the four profiles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import filters
from docweave.operators.partition import Bounds, partitioned
from docweave.sources.config import connect, parse_duration
from docweave.sources.infer import infer_schema, parsed
from docweave.sources.keyspace import CAS_FIELD, ID_FIELD, INFER_LIMIT, Keyspace
from docweave.sources.profiles import Profile, check_consistency, profile
from docweave.sources.snapshot import Collection

OPTIONS = (
    "bucket scope collection database dataset filter idFieldName casFieldName outputCas scanConsistency inferLimit timeout"
    " pushDownAggregate connectionIdentifier partitionColumn partitionLowerBound partitionUpperBound partitionCount"
).split()


@dataclass
class ReadOptions:
    """Options of a scan, by their names; unknown ones are refused."""

    values: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if unknown := sorted(set(self.values) - set(OPTIONS)):
            raise ValueError(f"Unknown options: {', '.join(unknown)}")
        check_consistency(self.values.get("scanConsistency"))
        if (t := self.values.get("timeout")) is not None:
            parse_duration(t)

    def get(self, name: str, default=None):
        return self.values.get(name, default)

    def flag(self, name: str, default: bool) -> bool:
        value = self.values.get(name, default)
        return value if isinstance(value, bool) else str(value).lower() == "true"

    def bounds(self) -> Bounds | None:
        return Bounds.of(*(self.get(f"partition{k}") for k in ("Column", "LowerBound", "UpperBound", "Count")))


def _check_keyspace(kind: Profile, options: ReadOptions) -> None:
    missing = [k for k in kind.required if not options.get(k)]
    if missing:
        raise ValueError(f"The {kind.name} profile needs the options {', '.join(kind.required)}; missing: {', '.join(missing)}")

def keyspace_of(spark: SparkSession, kind: Profile, options: ReadOptions) -> tuple[str, Keyspace]:
    """Root folder and keyspace of a scan."""
    link = connect(spark, options.get("connectionIdentifier"))
    if kind.implicit:
        return link.root, link.keyspace(options.get("bucket"), options.get("scope"), options.get("dataset") or options.get("collection"))
    return link.root, Keyspace(options.get("database"), options.get("scope"), options.get("collection"))


def read_frame(rows: DataFrame, kind: str = "query", id_column: str | None = None, cas: F.Column | None = None, **values) -> DataFrame:
    """A scan of a DataFrame whose rows are documents, under a profile.

    The user's filter comes first and meets id and CAS under their field
    names; then come the partition ranges. All of it is left to the optimizer,
    so filters and columns reach the files beneath.
    """
    p, options = profile(kind), ReadOptions(values)
    _check_frame(p, options)
    id_field, cas_field = options.get("idFieldName", ID_FIELD), options.get("casFieldName", CAS_FIELD)
    fields = [F.col(f"`{c}`") for c in rows.columns]
    shown = list(rows.columns)
    if id_column is not None:
        fields.append(F.col(f"`{id_column}`").cast("string").alias(id_field))
        if p.id_column:
            shown.append(id_field)
    if cas is not None:
        fields.append(cas.alias(cas_field))
        if p.cas_column and options.flag("outputCas", False):
            shown.append(cas_field)
    out = rows.select(*fields)
    if text := options.get("filter"):
        out = out.where(filters.text_filter(text, id_field, cas_field))
    bounds = options.bounds()
    if bounds is not None:
        out = partitioned(out, bounds)
    return out.select(*[F.col(f"`{c}`") for c in shown])


def _check_frame(kind: Profile, options: ReadOptions) -> None:
    if options.bounds() is not None and not kind.partitioned:
        raise ValueError(f"The {kind.name} profile has no partitioned scan")
    if not kind.cas_column and options.flag("outputCas", False):
        raise ValueError(f"The {kind.name} profile has no CAS column")
    if options.get("pushDownAggregate") is not None and not kind.aggregate_switch:
        raise ValueError(f"The {kind.name} profile has no switch for aggregates")


def read_collection(source: Collection, kind: str = "query", schema: T.StructType | str | None = None, **values) -> DataFrame:
    """A scan of stored documents. Without a schema it is inferred from the first inferLimit documents that the filter lets through."""
    p, options = profile(kind), ReadOptions(values)
    _check_frame(p, options)
    id_field, cas_field = options.get("idFieldName", ID_FIELD), options.get("casFieldName", CAS_FIELD)
    state = source.state()
    text, limit = options.get("filter"), int(options.get("inferLimit", INFER_LIMIT))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is None:
        whole = infer_schema(state, limit=limit)
        if text:
            # the filter may name any field, so it sees the documents with all that the sample has
            seen = parsed(state, whole, keep=["id", "cas", "body"]).withColumnsRenamed({"id": id_field, "cas": cas_field})
            schema = infer_schema(seen.where(filters.text_filter(text, id_field, cas_field)), limit=limit)
        else:
            schema = whole
    else:
        whole = schema
    extra = [f for f in whole.fields if f.name not in schema.names]
    body = T.StructType([f for f in [*schema.fields, *extra] if f.name not in (id_field, cas_field)])
    out = parsed(state, body, keep=["id", "cas"]).withColumnsRenamed({"id": id_field, "cas": cas_field})
    if text:
        out = out.where(filters.text_filter(text, id_field, cas_field))
    bounds = options.bounds()
    if bounds is not None:
        out = partitioned(out, bounds)
    shown = [f.name for f in schema.fields if f.name not in (id_field, cas_field)]
    if p.id_column or id_field in schema.names:
        shown.append(id_field)
    if p.cas_column and options.flag("outputCas", False):
        shown.append(cas_field)
    return out.select(*[F.col(f"`{c}`") for c in shown])


def read(spark: SparkSession, kind: str = "query", schema: T.StructType | str | None = None, **values) -> DataFrame:
    """A scan of the collection that options and configuration name."""
    p, options = profile(kind), ReadOptions(values)
    _check_keyspace(p, options)
    root, keyspace = keyspace_of(spark, p, options)
    return read_collection(Collection(spark, root, keyspace), kind, schema, **values)
