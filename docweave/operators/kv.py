"""Key/value operations on sets of documents.

A mutation joins the batch with the current state once, by id, and gives every
row of the batch a status; rows in status `ok` change the state, the others
are errors. Rows of one id in one batch are numbered by an explicit ordinal:
for an insert the first wins and the later ones meet an existing document; for
an upsert or replace the last wins.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.operators import subdoc
from docweave.sources.keyspace import CAS_FIELD, ID_FIELD
from docweave.sources.snapshot import CAS_STEP, Collection, CommitConflict, vbucket

OK, EXISTS, MISSING, CAS_MISMATCH = "ok", "DocumentExistsException", "DocumentNotFoundException", "CasMismatchException"
DURABILITIES = ("none", "majority", "majorityAndPersistToActive", "persistToMajority")


class MutationError(RuntimeError):
    """A mutation met documents that it can't change, and no one takes the errors."""

    def __init__(self, status: str, ids: list[str]):
        super().__init__(f"{status}: {', '.join(ids)}")
        self.status, self.ids = status, ids


@dataclass(frozen=True)
class Get:
    id: str


@dataclass(frozen=True)
class Insert:
    id: str
    content: str


@dataclass(frozen=True)
class Upsert:
    id: str
    content: str


@dataclass(frozen=True)
class Replace:
    id: str
    content: str
    cas: int = 0


@dataclass(frozen=True)
class Remove:
    id: str
    cas: int = 0


@dataclass(frozen=True)
class MutateIn:
    """Path operations on one document: (operation, path, value) each; values as JSON would have them."""

    id: str
    specs: tuple[tuple[str, str, object], ...]
    cas: int = 0


def part_operations(spark, rows: list[MutateIn]) -> DataFrame:
    """MutateIn records as rows (id, cas, specs, ordinal), checked before anything is written."""
    out = []
    for i, r in enumerate(rows):
        if len(r.specs) > subdoc.MOST_OPERATIONS:
            raise ValueError(f"A maximum of {subdoc.MOST_OPERATIONS} sub-document operations is allowed, {r.id} has {len(r.specs)}")
        out.append((r.id, r.cas, [(subdoc.parse_header(f"{o}:{p}").operation, p, json.dumps({"v": v}, separators=(",", ":"), ensure_ascii=False)) for o, p, v in r.specs], i))
    return spark.createDataFrame(out, f"id string, cas long, specs {subdoc.SPECS}, ordinal long")


def check_durability(value: str | None) -> str | None:
    """Known levels in any case; there is one copy of the state, so they make no difference."""
    if value is not None and value.lower() not in [d.lower() for d in DURABILITIES]:
        raise ValueError(f"Unknown durability level {value!r}; there are {', '.join(DURABILITIES)}")
    return value


def get(state: DataFrame, ids: DataFrame, strict: bool = True, id_column: str = "id") -> DataFrame:
    """The documents of the ids. `strict` makes a missing one an error when the result is computed; else it is left out."""
    wanted = ids.select(F.col(id_column).alias("_id")).distinct()
    if not strict:
        return state.join(wanted, state[id_column] == wanted["_id"]).drop("_id")
    found = wanted.join(state, wanted["_id"] == state[id_column], "left")
    known = F.when(F.col(id_column).isNull(), F.raise_error(F.concat(F.lit(f"{MISSING}: "), F.col("_id").cast("string")))).otherwise(F.col(id_column))
    return found.withColumn(id_column, known).drop("_id").select(*state.columns)


def by_locality(df: DataFrame, partitions: int, id_column: str = "id", n: int = 1024) -> DataFrame:
    """df with rows of one part of the key space in one partition."""
    return df.repartition(partitions, vbucket(F.col(id_column).cast("string"), n))


def _ordered(batch: DataFrame, last: bool, ordinal: str | None) -> DataFrame:
    """batch plus _turn: 1 for the row of its id that wins."""
    order = F.col(ordinal) if ordinal else F.monotonically_increasing_id()
    return batch.withColumn("_turn", F.row_number().over(Window.partitionBy("id").orderBy(order.desc() if last else order.asc())))


def classify(state: DataFrame, batch: DataFrame, operation: str, ordinal: str | None = None) -> DataFrame:
    """batch (id, further columns, cas for checked operations) plus `status` and `effective`: whether the row changes the state.

    state needs id and, for checked operations, cas. operation: insert,
    upsert, replace or remove. A cas of 0 or null isn't checked.
    """
    known = state.select(F.col("id").alias("_known"), *([F.col("cas").alias("_cas")] if "cas" in state.columns else [F.lit(None).cast("long").alias("_cas")]))
    turned = _ordered(batch, operation != "insert", ordinal)
    joined = turned.join(known, turned["id"] == known["_known"], "left")
    there = F.col("_known").isNotNull()
    if operation == "insert":
        status = F.when(there | (F.col("_turn") > 1), EXISTS)
    elif operation == "upsert":
        status = F.lit(None).cast("string")
    elif operation in ("replace", "remove"):
        status = F.when(~there, MISSING)
    else:
        raise ValueError(f"Unknown operation {operation!r}")
    if "cas" in batch.columns and operation != "insert":
        checked = F.coalesce(F.col("cas"), F.lit(0).cast("long"))
        status = F.coalesce(status, F.when(there & (checked != 0) & (checked != F.col("_cas")), CAS_MISMATCH))
    if "failure" in batch.columns:
        status = F.coalesce(status, F.col("failure"))
    done = joined.withColumn("status", F.coalesce(status, F.lit(OK)))
    return done.withColumn("effective", (F.col("status") == OK) & (F.col("_turn") == 1)).drop("_known", "_cas", "_turn")


def merged(state: DataFrame, classified: DataFrame, operation: str) -> DataFrame:
    """The state after the effective rows, with the columns of the state; the rows bring all of them but for a removal."""
    effective = classified.where("effective")
    rest = state.join(effective.select(F.col("id").alias("_gone")), state["id"] == F.col("_gone"), "left_anti")
    return rest if operation == "remove" else rest.unionByName(effective.select(*state.columns))


def apply(state: DataFrame, batch: DataFrame, operation: str, ordinal: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(state after the batch, batch with status): both lazy, so that state and result come of one plan each."""
    done = classify(state, batch, operation, ordinal)
    return merged(state, done, operation), done


def mutate(
    collection: Collection,
    batch: DataFrame | Callable[[], DataFrame],
    operation: str,
    ignore: tuple[str, ...] = (),
    ordinal: str | None = None,
    on_error=None,
    retries: int = 3,
) -> DataFrame:
    """Runs an operation against a stored collection and commits it; the batch with status and the new cas.

    batch: id, body (not for a removal), cas if checked, failure if rows may
    have failed before; or a function that makes it of the state as it is.
    Rows in a status of `ignore` are passed over. Others that aren't ok go to
    on_error (a function that takes the DataFrame), or stop the mutation
    before anything changes. Where another writer commits first, the batch is
    decided again on what that writer left, up to `retries` times.
    """
    for attempt in range(retries + 1):
        try:
            return _mutate(collection, batch() if callable(batch) else batch, operation, ignore, ordinal, on_error)
        except CommitConflict:
            if attempt == retries:
                raise
    raise AssertionError("unreachable")


def _mutate(collection: Collection, batch: DataFrame, operation: str, ignore: tuple[str, ...], ordinal: str | None, on_error) -> DataFrame:
    seen = collection.version()
    state = collection.state(seen)
    rows = batch.select(*[c for c in batch.columns if c in ("id", "body", "cas", "failure")], *([ordinal] if ordinal else []))
    # what is decided once, with its CAS, is read again and not computed again
    done = collection.staged(classify(state, rows, operation, ordinal).withColumn("_new", F.monotonically_increasing_id() + F.lit((seen + 1) * CAS_STEP) + 1))
    if not done.where("id is null").isEmpty():
        raise ValueError("a document without an id can't be written")
    failed = done.where(~F.col("status").isin(OK, *ignore))
    if on_error is None and (first := failed.select("status", "id").limit(10).collect()):
        raise MutationError(first[0]["status"], sorted(r["id"] for r in first))
    fresh = done.drop("cas").withColumnRenamed("_new", "cas")
    effective = fresh.where("effective")
    body = F.col("body") if operation != "remove" else F.lit(None).cast("string")
    rest = state.join(effective.select("id"), "id", "left_anti")
    after = rest if operation == "remove" else rest.unionByName(effective.select("id", "body", "cas"))
    collection.commit(after, effective.select("id", body.alias("body"), "cas"), seen)
    if on_error is not None:
        on_error(failed)
    return fresh.select("id", "cas", "status")


def upsert(collection: Collection, batch: DataFrame, **how) -> DataFrame:
    return mutate(collection, batch, "upsert", **how)


def insert(collection: Collection, batch: DataFrame, ignore_if_exists: bool = False, **how) -> DataFrame:
    return mutate(collection, batch, "insert", ignore=(EXISTS,) if ignore_if_exists else (), **how)


def replace(collection: Collection, batch: DataFrame, ignore_if_not_found: bool = False, **how) -> DataFrame:
    return mutate(collection, batch, "replace", ignore=(MISSING,) if ignore_if_not_found else (), **how)


def remove(collection: Collection, batch: DataFrame, ignore_if_not_found: bool = False, **how) -> DataFrame:
    return mutate(collection, batch, "remove", ignore=(MISSING,) if ignore_if_not_found else (), **how)


def operations(spark, rows: list) -> DataFrame:
    """Get, Insert, Upsert, Replace or Remove records of one kind as a batch, in their order."""
    if not rows:
        return spark.createDataFrame([], "id string, body string, cas long, ordinal long")
    if len({type(r) for r in rows}) > 1:
        raise ValueError("a batch has records of one kind")
    return spark.createDataFrame([(r.id, getattr(r, "content", None), getattr(r, "cas", 0), i) for i, r in enumerate(rows)], "id string, body string, cas long, ordinal long")


def documents(df: DataFrame, id_field: str = ID_FIELD, cas_field: str | None = None) -> DataFrame:
    """A DataFrame's rows as a batch (id, body, cas). Null cells are left out of bodies; id and CAS columns aren't part of them."""
    if id_field not in df.columns:
        raise ValueError(f"Could not find ID field {id_field} in {df.columns}")
    if cas_field is not None and cas_field not in df.columns:
        raise ValueError(f"Could not find CAS field {cas_field} in {df.columns}")
    fields = [F.col(f"`{c}`") for c in df.columns if c not in (id_field, cas_field, CAS_FIELD)]
    cas: Column = F.col(f"`{cas_field}`").cast("long") if cas_field else F.lit(0).cast("long")
    body = F.to_json(F.struct(*fields)) if fields else F.lit("{}")
    out = df.select(F.col(f"`{id_field}`").cast("string").alias("id"), body.alias("body"), cas.alias("cas"))
    if cas_field is not None and out.where("cas is null").limit(1).count():
        raise ValueError(f"CAS field {cas_field} has rows without a value")
    return out
