"""The registered queries, and the SQL that each must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.functions import filters as fl
from docweave.operators import aggregate as ag
from docweave.operators import errors, kv, partition, relational, search, subdoc
from docweave.plans import statement
from docweave.sources.config import Settings
from docweave.sources.infer import infer_schema, parsed
from docweave.sources.keyspace import Keyspace
from docweave.sources.read import read_collection, read_frame
from docweave.sources.shared import fresh_path
from docweave.sources.snapshot import Collection, Store, vbucket
from docweave.sources.write import write
from docweave.streaming import cdc

HERE = Keyspace("tables")


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _scan(name: str, *columns: str, kind: str = "query", id_column: str | None = None, **options):
    """A query that reads a table under a profile."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        out = read_frame(_t(spark, d, name), kind, id_column, **options)
        return out.select(*columns) if columns else out

    return query


def _where(name: str, condition, *columns: str):
    return lambda spark, d: read_frame(_t(spark, d, name)).where(condition()).select(*columns)


# aggregates


def _agg(name: str, by=None, **aggregates):
    return lambda spark, d: ag.aggregate(read_frame(_t(spark, d, name)), by, **{n: c() for n, c in aggregates.items()})


def _filter_null(spark: SparkSession, d: str) -> DataFrame:
    x = read_frame(_t(spark, d, "orders")).select(F.nullif("o_orderstatus", F.lit("P")).alias("x"))
    return x.agg(F.count_if(fl.is_null("x")).alias("n_null"), F.count_if(fl.is_not_null("x")).alias("n_not"))


def _null_safe(spark: SparkSession, d: str) -> DataFrame:
    rows = read_frame(_t(spark, d, "orders")).withColumn("x", F.nullif("o_orderstatus", F.lit("P")))
    return rows.where(fl.equal_null_safe("x", None)).select("o_orderkey")


def _bodies(spark: SparkSession, d: str) -> DataFrame:
    """events.props as documents: typed by a schema that is inferred from them."""
    events = _t(spark, d, "events").select("event_id", "user_id", F.col("props").alias("body"))
    return parsed(events, infer_schema(events), keep=["event_id", "user_id"])


def _infer(spark: SparkSession, d: str) -> DataFrame:
    return _bodies(spark, d).select("event_id", "k")


def _nested(spark: SparkSession, d: str) -> DataFrame:
    docs = _bodies(spark, d).select("event_id", F.struct("k").alias("props"))
    return docs.where(fl.greater("props.k", 50)).select("event_id")


PARTS = {"partitionColumn": "o_orderkey", "partitionLowerBound": 0, "partitionUpperBound": 15000, "partitionCount": 4}


def _partitioned_scan(spark: SparkSession, d: str) -> DataFrame:
    rows = read_frame(_t(spark, d, "orders"), **PARTS)
    part = partition.range_ordinal(partition.Bounds(PARTS["partitionColumn"], 0, 15000, 4))
    return ag.aggregate(rows.withColumn("part", part), ["part"], n=ag.count())


def _partitioned_agg(spark: SparkSession, d: str) -> DataFrame:
    return ag.aggregate(read_frame(_t(spark, d, "orders"), **PARTS), ["o_orderstatus"], n=ag.count(), mn=ag.minimum("o_orderkey"))


def _grouped(how: str):
    return lambda spark, d: getattr(read_frame(_t(spark, d, "lineitem")), how)("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


def _sets(spark: SparkSession, d: str) -> DataFrame:
    return ag.grouping_sets(read_frame(_t(spark, d, "lineitem")), [["l_returnflag"], ["l_linestatus"]], n=ag.count())


def _having(spark: SparkSession, d: str) -> DataFrame:
    by = ag.aggregate(read_frame(_t(spark, d, "orders")), ["o_custkey"], n=ag.count(), mx=ag.maximum("o_totalprice"))
    return by.where("n >= 3 and mx > 1000")


def _through(form: str, **options):
    """Rows written as JSON lines or CSV to the shared folder and read again with a schema."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = _t(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        path = fresh_path(spark, form)
        rows.write.format(form).options(**options).save(path)
        return spark.read.format(form).options(**options).schema(rows.schema).load(path)

    return query


def _scalars(spark: SparkSession, d: str) -> DataFrame:
    c = read_frame(_t(spark, d, "customer"))
    return c.select("c_custkey", F.upper("c_mktsegment").alias("u"), F.length("c_name").alias("n"), F.round(F.abs("c_acctbal")).alias("r"), F.coalesce(F.nullif("c_nationkey", F.lit(3)), F.lit(-1)).alias("k"))


# key/value


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("v"))


def _new(customers: DataFrame, value: str) -> DataFrame:
    return customers.where("id < 10").select((F.col("id") + 10000000).alias("id"), F.lit(value).alias("v"))


def _kv_get(spark: SparkSession, d: str) -> DataFrame:
    state = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    ids = spark.createDataFrame([(i,) for i in (1, 7, 42, 100)], "id long")
    return kv.get(state, ids).select(F.col("id").alias("c_custkey"), "c_name")


def _kv_insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d)
    batch = state.where("id < 200").select((F.col("id") + 100).alias("id"), F.lit("new").alias("v")).unionByName(_new(state, "new"))
    return kv.apply(state, batch, "insert", "id")[0]


def _kv_upsert(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d)
    batch = state.where("id % 10 = 0").select("id", F.lit("upd").alias("v")).unionByName(_new(state, "new"))
    return kv.apply(state, batch, "upsert", "id")[0]


def _kv_replace(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d)
    batch = state.where("id % 7 = 0").select("id", F.lit("rep").alias("v")).unionByName(_new(state, "rep"))
    return kv.apply(state, batch, "replace", "id")[0]


def _kv_replace_cas(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    customers = _t(spark, d, "customer")
    state = customers.select(key.alias("id"), (key + 1).alias("cas"))
    cas = F.when(key % 3 == 0, 0).when(key % 3 == 1, key + 1).otherwise(key + 2)
    batch = customers.select((key + F.when(key % 5 == 0, 10000000).otherwise(0)).alias("id"), cas.cast("long").alias("cas"))
    return ag.aggregate(kv.classify(state, batch, "replace", "id"), ["status"], n=ag.count())


def _kv_remove(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d).select("id")
    return kv.apply(state, state.where("id % 4 = 0"), "remove", "id")[0]


def _kv_error_documents(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d).where("id % 2 = 0").select("id")
    batch = _t(spark, d, "orders").select(F.col("o_custkey").alias("id")).distinct()
    failed = kv.classify(state, batch, "replace", "id").where(F.col("status") != kv.OK)
    return errors.error_documents(failed, HERE).select("documentId", F.col("error.simpleClass").alias("simpleClass"))


def _vbucket_partitions(spark: SparkSession, d: str) -> DataFrame:
    ids = _customers(spark, d).select(F.col("id").cast("string").alias("id"))
    return kv.by_locality(ids, 8).select("id", vbucket(F.col("id")).alias("vbucket"))


# parts of documents


def _lookup_in(spark: SparkSession, d: str) -> DataFrame:
    return subdoc.lookup_in(_t(spark, d, "events").select("event_id", "props"), "props", {"k": "k"})


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """events.props as whole documents, with every field that any of them has."""
    events = _t(spark, d, "events").select("event_id", "user_id", F.col("props").alias("body"))
    schema = infer_schema(events, limit=None)
    body = F.from_json("body", schema)
    return events.select("event_id", "user_id", F.struct(*[body.getField(f).alias(f) for f in schema.names]).alias("doc"))


def _with(docs: DataFrame, **columns) -> DataFrame:
    """docs after the operations that the column headers name."""
    named = {h.replace("__", ":"): c for h, c in columns.items()}
    return subdoc.mutate_in(docs.withColumns(named), "doc", [subdoc.parse_header(h) for h in named])


def _subdoc_upsert(spark: SparkSession, d: str) -> DataFrame:
    return _with(_documents(spark, d), z=F.col("user_id")).select("event_id", "doc.z", "doc.k")


def _subdoc_increment(spark: SparkSession, d: str) -> DataFrame:
    """Two operations on two copies of the documents, in one pass over them."""
    docs = _documents(spark, d).withColumns({"up": F.col("doc"), "increment:k": F.lit(2), "decrement:k": F.lit(1)})
    both = subdoc.mutate_in(subdoc.mutate_in(docs, "up", [subdoc.parse_header("increment:k")]), "doc", [subdoc.parse_header("decrement:k")])
    return both.select("event_id", F.col("up.k").alias("inc"), F.col("doc.k").alias("dec"))


def _subdoc_remove(spark: SparkSession, d: str) -> DataFrame:
    # a document needs a field; the one added here isn't counted
    docs = _with(_documents(spark, d).withColumn("doc", F.col("doc").withField("_keep", F.lit(1))), remove__k=F.lit(1))
    return docs.select("event_id", F.size(F.json_object_keys(F.to_json(F.col("doc")))).alias("n")).select("event_id", (F.col("n") - 1).cast("long").alias("n_keys"))


def _subdoc_arrays(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    docs = c.select("c_custkey", "c_name", "c_mktsegment", F.struct(F.array().cast("array<string>").alias("tags")).alias("doc"))
    done = _with(docs, arrayAppend__tags=F.col("c_name"))
    done = _with(done, arrayPrepend__tags=F.col("c_mktsegment"))
    done = done.withColumn("arrayInsert:tags[1]", F.array(F.lit("tagB"), F.lit("tagC")))
    return subdoc.mutate_in(done, "doc", [subdoc.parse_header("arrayInsert:tags[1]")]).select("c_custkey", "doc.tags")


def _subdoc_unique(spark: SparkSession, d: str) -> DataFrame:
    """A value that is there already is an error of its document, which then stays as it is."""
    c = _t(spark, d, "customer").select("c_custkey", F.lit('{"tags":["BUILDING"]}').alias("body"), F.col("c_mktsegment").alias("arrayAddUnique:tags"))
    done = subdoc.edit_documents(c.withColumn("specs", subdoc.specs_column([subdoc.parse_header("arrayAddUnique:tags")])))
    return done.select("c_custkey", F.from_json("body", "tags array<string>")["tags"].alias("tags"))


GOLDEN = '{"toRemove":1,"counter1":100,"counter2":50,"keepThis":"keep","tags":["tag1","tag2"],"moreTags":["tagA","tagD"],"nestedJson":{"foo":{"baz":"bux"}}}'


def _stored(spark: SparkSession, rows: DataFrame) -> Collection:
    """A collection of its own in the shared folder with some documents (id, body)."""
    out = Store(spark, fresh_path(spark, "store")).create(Keyspace("b", "s", "c"))
    kv.upsert(out, rows.select(F.col("id").cast("string").alias("id"), "body"))
    return out


def _named(customers: DataFrame) -> DataFrame:
    return customers.select("id", F.to_json(F.struct("v")).alias("body"))


def _read_names(collection: Collection) -> DataFrame:
    return read_collection(collection, schema="v string").select(F.col("__META_ID").cast("long").alias("id"), "v")


def _store_upsert(spark: SparkSession, d: str) -> DataFrame:
    """kv_upsert through a stored collection: written, mutated, committed and scanned."""
    state = _customers(spark, d)
    c = _stored(spark, _named(state))
    batch = state.where("id % 10 = 0").select("id", F.lit("upd").alias("v")).unionByName(_new(state, "new"))
    write(batch.withColumnRenamed("id", "__META_ID"), c, "overwrite")
    return _read_names(c)


def _store_remove(spark: SparkSession, d: str) -> DataFrame:
    state = _customers(spark, d)
    c = _stored(spark, _named(state))
    kv.remove(c, state.where("id % 4 = 0").select(F.col("id").cast("string").alias("id")))
    return _read_names(c)


def _store_ignore(spark: SparkSession, d: str) -> DataFrame:
    """Save mode Ignore: documents that exist stay as they are."""
    state = _customers(spark, d)
    c = _stored(spark, _named(state))
    write(state.where("id < 200").select((F.col("id") + 100).alias("__META_ID"), F.lit("new").alias("v")), c, "ignore")
    return _read_names(c)


def _store_changes(spark: SparkSession, d: str) -> DataFrame:
    """The change stream of a collection after an upsert and a removal."""
    state = _customers(spark, d)
    c = _stored(spark, _named(state.where("id < 500")))
    kv.remove(c, state.where("id < 100").select(F.col("id").cast("string").alias("id")))
    changes = cdc.drained(cdc.change_stream(c, "fromBeginning"), "append")
    return changes.groupBy("deletion").agg(F.count(F.lit(1)).alias("n"))


def _store_scan(spark: SparkSession, d: str) -> DataFrame:
    """A scan of stored documents with inferred types, a filter on a field and on the id, and a projection."""
    docs = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.to_json(F.struct("c_name", "c_acctbal", F.struct("c_nationkey").alias("at"))).alias("body"))
    out = read_collection(_stored(spark, docs), filter="c_acctbal > 1000 AND at.c_nationkey IN [1, 2, 3] AND META().id LIKE '1%'")
    return out.select(F.col("__META_ID").cast("long").alias("id"), "c_name")


def _store_statement(spark: SparkSession, d: str) -> DataFrame:
    """A raw statement over a stored collection."""
    docs = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.to_json(F.struct("c_mktsegment", "c_nationkey")).alias("body"))
    return statement.run(spark, "SELECT c_mktsegment, count(*) AS n FROM customers WHERE c_nationkey < 10 GROUP BY c_mktsegment", {"customers": read_collection(_stored(spark, docs), "analytics")})


def _parts(mode: str, header: str, value: str):
    """A path operation on stored documents, where every third document can't be changed."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        key = F.col("c_custkey")
        docs = _t(spark, d, "customer").select(key.alias("id"), F.to_json(F.struct(F.col("c_name").alias("name"), F.when(key % 3 == 0, F.lit("x")).alias("z"))).alias("body"))
        c = _stored(spark, docs)
        write(docs.select(F.col("id").alias("__META_ID"), F.lit(value).alias(header)), c, writeMode=mode, errorHandler=lambda failed: None)
        return c.state().select(F.col("id").cast("long").alias("id"), "body")

    return query


def _kv_subdoc_golden(spark: SparkSession, d: str) -> DataFrame:
    c = _stored(spark, spark.createDataFrame([("doc", GOLDEN)], "id string, body string"))
    cells = {
        "remove:toRemove": F.lit(True),
        "decrement:counter1": F.lit(1),
        "increment:counter2": F.lit(2),
        "arrayPrepend:tags": F.lit("tag0"),
        "arrayAppend:tags": F.lit("tag3"),
        "arrayInsert:moreTags[1]": F.array(F.lit("tagB"), F.lit("tagC")),
        "nestedJson.foo.baz": F.lit("bux2"),
    }
    write(spark.range(1).select(F.lit("doc").alias("__META_ID"), *[v.alias(n) for n, v in cells.items()]), c, writeMode="subdocReplace")
    return c.state().select("id", "body")


# streams


#: How late an event may come before the state of its window may go.
LATE = "7 days"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return cdc.file_stream(spark, d, "events.parquet", _t(spark, d, "events").schema)


def _cdc_count(spark: SparkSession, d: str) -> DataFrame:
    changes = cdc.changes_of(_events(spark, d), "event_id", HERE, collection=F.col("event_type"))
    return cdc.drained(cdc.counts(changes, "collection"))


def _tumbling(spark: SparkSession, d: str) -> DataFrame:
    return _naive(cdc.drained(cdc.windowed(_timed(spark, d), "ts", "1 day", late=LATE)), "win_start")


def _sliding(spark: SparkSession, d: str) -> DataFrame:
    return _naive(cdc.drained(cdc.windowed(_timed(spark, d), "ts", "12 hours", "6 hours", LATE)), "win_start")


def _session(spark: SparkSession, d: str) -> DataFrame:
    return _naive(cdc.drained(cdc.sessions(_timed(spark, d), "ts", "2 hours", "user_id", late=LATE)), "s_start")


def _timed(spark: SparkSession, d: str) -> DataFrame:
    """The events with times that a watermark can follow: the clock times as UTC, whatever the session's time zone."""
    return _events(spark, d).withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_utc_timestamp(F.col(c), F.current_timezone()).cast(T.TimestampNTZType()) for c in columns})


def _dedup(spark: SparkSession, d: str) -> DataFrame:
    return cdc.drained(cdc.deduplicated(_events(spark, d), "user_id", "event_type"), "append")


def _cdc_full(spark: SparkSession, d: str) -> DataFrame:
    changes = cdc.changes_of(_t(spark, d, "events"), "event_id", HERE, "full", timestamp=F.col("ts").cast("timestamp"))
    text = F.from_json(F.col("content").cast("string"), "event_type string, value double")
    # the CAS is a number of our own; all else can be told from the rows
    return changes.select("id", text["event_type"].alias("event_type"), text["value"].alias("value"), "deletion", (F.col("cas") >= 0).alias("has_cas"), "scope", "collection", F.col("timestamp").cast(T.TimestampNTZType()).alias("timestamp"), F.col("vbucket").between(0, 1023).alias("has_vbucket"), F.size("xattrs").alias("n_xattrs"))


# search, statements, settings


def _search(query: str, *columns: str):
    return lambda spark, d: search.search(_t(spark, d, "documents"), query, "text", "doc_id").select(*columns)


def _statement(spark: SparkSession, d: str) -> DataFrame:
    where = Keyspace("tables", "_default")
    return statement.run(spark, "select count(*) as count from `customer`", {"tables._default.customer": _t(spark, d, "customer")}, where)


def _error_handler(spark: SparkSession, d: str) -> DataFrame:
    """What the handler that writes lines of JSON has written."""
    state = _customers(spark, d).where("id % 2 = 0").select("id")
    failed = kv.classify(state, _customers(spark, d).select("id"), "insert", "id").where(F.col("status") != kv.OK)
    path = fresh_path(spark, "errors")
    errors.to_json_lines(path, HERE)(failed)
    return spark.read.schema("documentId string, errorClass string, bucket string, scope string, collection string").json(path)


def _config(spark: SparkSession, d: str) -> DataFrame:
    settings = Settings({"spark.docweave.root": "/plain", "spark.docweave.root:a": "/a", "spark.docweave.implicitBucket": "b", "spark.docweave.timeout": "10s", "spark.docweave.timeout:a": "5s"})
    rows = []
    for identifier in (None, "a", "file://user:pw@/dynamic?implicitBucket=c"):
        c = settings.connection(identifier)
        rows.append((identifier or "", c.root, c.keyspace().bucket, c.properties.get("timeout")))
    return spark.createDataFrame(rows, "identifier string, root string, bucket string, timeout string")


def _join(left: str, right: str, on: str, how: str, columns: list[str], where: str | None = None):
    def query(spark: SparkSession, d: str) -> DataFrame:
        b = _t(spark, d, right)
        return relational.join(_t(spark, d, left), b.where(where) if where else b, F.expr(on), how).select(*columns)

    return query


def _window_rank(spark: SparkSession, d: str) -> DataFrame:
    return relational.row_number(_t(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "rn")


def _window_frame(spark: SparkSession, d: str) -> DataFrame:
    return relational.framed(_t(spark, d, "orders"), ["o_custkey"], ["o_orderkey"], -2, 0, n3=F.count(F.lit(1))).select("o_orderkey", "n3")


def _key(spark: SparkSession, d: str, name: str, column: str, where: str = "true") -> DataFrame:
    return _t(spark, d, name).where(where).select(F.col(column).alias("k"))


QUERIES = {
    "scan_full": _scan("customer"),
    "scan_project": _scan("part", "p_partkey", "p_brand"),
    "scan_id_column": _scan("customer", "__META_ID", "c_name", id_column="c_custkey"),
    "infer_json_body": _infer,
    "user_filter_option": _scan("orders", "o_orderkey", "o_totalprice", filter="o_orderstatus = 'F'"),
    "filter_eq_range": _where(
        "lineitem",
        lambda: fl.all_of([fl.equal("l_returnflag", "R"), fl.greater_or_equal("l_quantity", 10), fl.less("l_quantity", 20), fl.greater("l_discount", 0.02), fl.less_or_equal("l_tax", 0.06)]),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    ),
    "filter_null_safe": _null_safe,
    "filter_in": _scan("orders", "o_orderkey", "o_orderpriority", filter="o_orderpriority IN ['1-URGENT', '2-HIGH']"),
    "filter_and_or_not": _where(
        "lineitem",
        lambda: fl.negated(fl.either(fl.equal("l_returnflag", "A"), fl.both(fl.equal("l_linestatus", "F"), fl.greater("l_quantity", 25)))),
        "l_orderkey",
        "l_linenumber",
    ),
    "filter_null": _filter_null,
    "filter_contains": _where("part", lambda: fl.contains("p_name", "ring"), "p_partkey", "p_name"),
    "filter_starts_ends": _where("part", lambda: fl.either(fl.starts_with("p_name", "s"), fl.ends_with("p_type", "Y")), "p_partkey"),
    "filter_nested_path": _nested,
    "filter_constants": _where("nation", lambda: fl.both(fl.always_true(), fl.negated(fl.always_false())), "n_name"),
    "agg_min_max": _agg("lineitem", mn=lambda: ag.minimum("l_shipdate"), mx=lambda: ag.maximum("l_linenumber")),
    "agg_count": _agg("lineitem", n=lambda: ag.count(), n_tax=lambda: ag.count("l_tax"), n_supp=lambda: ag.count("l_suppkey", True)),
    "agg_sum": _agg("lineitem", s_int=lambda: ag.total("l_linenumber"), s_qty=lambda: ag.exact_total("l_quantity")),
    "agg_sum_distinct": _agg("lineitem", s=lambda: ag.total("l_partkey", True)),
    "agg_avg": _agg("lineitem", ["l_returnflag"], a=lambda: ag.mean("l_linenumber"), ad=lambda: ag.mean("l_linenumber", True)),
    "agg_group_by": _agg("orders", ["o_orderstatus", "o_orderpriority"], n=lambda: ag.count(), mx=lambda: ag.maximum("o_orderdate")),
    "agg_not_pushable": _agg("lineitem", ["l_returnflag"], s=lambda: F.sum(F.col("l_linenumber") + 1)),
    "agg_having": _having,
    "source_json": _through("json"),
    "source_csv": _through("csv", header="true"),
    "scalar_functions": _scalars,
    "distinct": _agg("customer", ["c_nationkey", "c_mktsegment"]),
    "rollup": _grouped("rollup"),
    "cube": _grouped("cube"),
    "grouping_sets": _sets,
    "limit_ordered": lambda s, d: relational.top(read_frame(_t(s, d, "orders")), 25, F.col("o_totalprice").desc(), "o_orderkey").select("o_orderkey", "o_totalprice"),
    "partitioned_scan": _partitioned_scan,
    "partitioned_agg": _partitioned_agg,
    "kv_get": _kv_get,
    "kv_insert_ignore": _kv_insert_ignore,
    "kv_upsert": _kv_upsert,
    "kv_replace": _kv_replace,
    "kv_replace_cas": _kv_replace_cas,
    "kv_remove": _kv_remove,
    "kv_error_documents": _kv_error_documents,
    "vbucket_partitions": _vbucket_partitions,
    "lookup_in": _lookup_in,
    "subdoc_upsert": _subdoc_upsert,
    "subdoc_increment": _subdoc_increment,
    "subdoc_remove": _subdoc_remove,
    "subdoc_array_ops": _subdoc_arrays,
    "subdoc_add_unique": _subdoc_unique,
    "kv_subdoc_golden": _kv_subdoc_golden,
    "subdoc_insert": _parts("subdocReplace", "insert:z", "new"),
    "subdoc_replace": _parts("subdocUpsert", "replace:z", "new"),
    "store_scan": _store_scan,
    "store_statement": _store_statement,
    "store_upsert": _store_upsert,
    "store_remove": _store_remove,
    "store_insert_ignore": _store_ignore,
    "store_changes": _store_changes,
    "stream_cdc_count": _cdc_count,
    "stream_tumbling": _tumbling,
    "stream_sliding": _sliding,
    "stream_session": _session,
    "stream_dedup": _dedup,
    "stream_cdc_schema_full": _cdc_full,
    "search_terms": _search("the", "doc_id", "score"),
    "search_accents": _search("für", "doc_id", "score"),
    "search_prefix": _search("ou*", "doc_id"),
    "raw_statement": _statement,
    "error_handler_jsonl": _error_handler,
    "config_resolution": _config,
    "profile_analytics": _scan("supplier", "__META_ID", "s_name", kind="analytics", id_column="s_suppkey"),
    "profile_columnar": _scan("supplier", kind="columnar"),
    "profile_enterprise": _scan("supplier", "s_suppkey", "s_name", kind="enterprise-analytics", filter="s_acctbal > 0"),
    "join_inner": _join("orders", "customer", "o_custkey = c_custkey", "inner", ["o_orderkey", "c_name"]),
    "join_left": _join("customer", "orders", "o_custkey = c_custkey", "left", ["c_custkey", "o_orderkey"], "o_orderstatus = 'P'"),
    "join_semi": _join("customer", "orders", "o_custkey = c_custkey", "left_semi", ["c_custkey"]),
    "join_anti": _join("customer", "orders", "o_custkey = c_custkey", "left_anti", ["c_custkey"], "o_orderpriority = '1-URGENT'"),
    "window_rank": _window_rank,
    "window_frame": _window_frame,
    "set_union_all": lambda s, d: relational.union_all(_key(s, d, "nation", "n_regionkey"), _key(s, d, "region", "r_regionkey")),
    "set_intersect": lambda s, d: relational.intersect(_key(s, d, "customer", "c_nationkey"), _key(s, d, "supplier", "s_nationkey")),
    "set_except": lambda s, d: relational.except_(_key(s, d, "customer", "c_nationkey"), _key(s, d, "supplier", "s_nationkey", "s_acctbal > 5000")),
}

SQL = {
    "scan_full": """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
    "scan_project": """SELECT p_partkey, p_brand FROM part""",
    "scan_id_column": """SELECT CAST(c_custkey AS VARCHAR) AS __META_ID, c_name FROM customer""",
    "infer_json_body": """SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) AS k FROM events""",
    "user_filter_option": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""",
    "filter_eq_range": """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_quantity < 20 AND l_discount > 0.02 AND l_tax <= 0.06""",
    "filter_null_safe": """SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus,'P') IS NOT DISTINCT FROM NULL""",
    "filter_in": """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT','2-HIGH')""",
    "filter_and_or_not": """SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_returnflag = 'A' OR (l_linestatus = 'F' AND l_quantity > 25))""",
    "filter_null": """SELECT count(*) FILTER (WHERE x IS NULL) AS n_null, count(*) FILTER (WHERE x IS NOT NULL) AS n_not FROM (SELECT nullif(o_orderstatus,'P') AS x FROM orders)""",
    "filter_contains": """SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')""",
    "filter_starts_ends": """SELECT p_partkey FROM part WHERE starts_with(p_name,'s') OR suffix(p_type,'Y')""",
    "filter_nested_path": """SELECT event_id FROM events WHERE CAST(json_extract(props,'$.k') AS BIGINT) > 50""",
    "filter_constants": """SELECT n_name FROM nation WHERE TRUE AND NOT FALSE""",
    "agg_min_max": """SELECT min(l_shipdate) AS mn, max(l_linenumber) AS mx FROM lineitem""",
    "agg_count": """SELECT count(*) AS n, count(l_tax) AS n_tax, count(DISTINCT l_suppkey) AS n_supp FROM lineitem""",
    "agg_sum": """SELECT CAST(sum(l_linenumber) AS BIGINT) AS s_int, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS s_qty FROM lineitem""",
    "agg_sum_distinct": """SELECT CAST(sum(DISTINCT l_partkey) AS BIGINT) AS s FROM lineitem""",
    "agg_avg": """SELECT l_returnflag, avg(l_linenumber) AS a, avg(DISTINCT l_linenumber) AS ad FROM lineitem GROUP BY l_returnflag""",
    "agg_group_by": """SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_orderdate) AS mx FROM orders GROUP BY o_orderstatus, o_orderpriority""",
    "agg_not_pushable": """SELECT l_returnflag, CAST(sum(l_linenumber + 1) AS BIGINT) AS s FROM lineitem GROUP BY l_returnflag""",
    "agg_having": """SELECT o_custkey, count(*) AS n, max(o_totalprice) AS mx FROM orders GROUP BY o_custkey HAVING count(*) >= 3 AND max(o_totalprice) > 1000""",
    "source_json": """SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    "source_csv": """SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    "scalar_functions": """SELECT c_custkey, upper(c_mktsegment) AS u, length(c_name) AS n, round(abs(c_acctbal)) AS r, coalesce(nullif(c_nationkey, 3), -1) AS k FROM customer""",
    "distinct": """SELECT DISTINCT c_nationkey, c_mktsegment FROM customer""",
    "rollup": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
    "cube": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "grouping_sets": """SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus))""",
    "limit_ordered": """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25""",
    "partitioned_scan": """SELECT CASE WHEN o_orderkey < 3750 THEN 0 WHEN o_orderkey < 7500 THEN 1 WHEN o_orderkey < 11250 THEN 2 ELSE 3 END AS part, count(*) AS n FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1""",
    "partitioned_agg": """SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS mn FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderstatus""",
    "kv_get": """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (1, 7, 42, 100)""",
    "kv_insert_ignore": """WITH m AS (SELECT c_custkey + 100 AS id, 'new' AS v FROM customer WHERE c_custkey < 200 UNION ALL SELECT c_custkey + 10000000, 'new' FROM customer WHERE c_custkey < 10) SELECT c_custkey AS id, c_name AS v FROM customer UNION ALL SELECT id, v FROM m WHERE id NOT IN (SELECT c_custkey FROM customer)""",
    "kv_upsert": """WITH m AS (SELECT c_custkey AS id, 'upd' AS v FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey + 10000000, 'new' FROM customer WHERE c_custkey < 10) SELECT c_custkey AS id, c_name AS v FROM customer WHERE c_custkey NOT IN (SELECT id FROM m) UNION ALL SELECT id, v FROM m""",
    "kv_replace": """WITH m AS (SELECT c_custkey AS id, 'rep' AS v FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT c_custkey + 10000000, 'rep' FROM customer WHERE c_custkey < 10) SELECT c.c_custkey AS id, coalesce(m.v, c.c_name) AS v FROM customer c LEFT JOIN m ON c.c_custkey = m.id""",
    "kv_replace_cas": """SELECT status, count(*) AS n FROM (SELECT CASE WHEN c.id IS NULL THEN 'DocumentNotFoundException' WHEN m.cas <> 0 AND m.cas <> c.cas THEN 'CasMismatchException' ELSE 'ok' END AS status FROM (SELECT c_custkey + CASE WHEN c_custkey % 5 = 0 THEN 10000000 ELSE 0 END AS id, CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN c_custkey + 1 ELSE c_custkey + 2 END AS cas FROM customer) m LEFT JOIN (SELECT c_custkey AS id, c_custkey + 1 AS cas FROM customer) c ON m.id = c.id) GROUP BY status""",
    "kv_remove": """SELECT c_custkey AS id FROM customer WHERE c_custkey % 4 <> 0""",
    "kv_error_documents": """SELECT CAST(o_custkey AS VARCHAR) AS documentId, 'DocumentNotFoundException' AS simpleClass FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)""",
    "lookup_in": """SELECT event_id, json_extract_string(props,'$.k') AS k FROM events""",
    "subdoc_upsert": """SELECT event_id, CAST(json_extract(json_merge_patch(props, json_object('z', user_id)),'$.z') AS BIGINT) AS z, CAST(json_extract(props,'$.k') AS BIGINT) AS k FROM events""",
    "subdoc_increment": """SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) + 2 AS inc, CAST(json_extract(props,'$.k') AS BIGINT) - 1 AS dec FROM events""",
    "subdoc_remove": """SELECT event_id, len(json_keys(json_merge_patch(props, '{"k":null}'))) AS n_keys FROM events""",
    "subdoc_array_ops": """SELECT c_custkey, list_concat([c_mktsegment], list_concat(['tagB','tagC'], [c_name])) AS tags FROM customer""",
    "subdoc_add_unique": """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING') THEN ['BUILDING'] ELSE ['BUILDING', c_mktsegment] END AS tags FROM customer""",
    "kv_subdoc_golden": """SELECT 'doc' AS id, '{"counter1":99,"counter2":52,"keepThis":"keep","tags":["tag0","tag1","tag2","tag3"],"moreTags":["tagA","tagB","tagC","tagD"],"nestedJson":{"foo":{"baz":"bux2"}}}' AS body""",
    "subdoc_insert": """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '{"name":"' || c_name || '","z":"x"}' ELSE '{"name":"' || c_name || '","z":"new"}' END AS body FROM customer""",
    "subdoc_replace": """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '{"name":"' || c_name || '","z":"new"}' ELSE '{"name":"' || c_name || '"}' END AS body FROM customer""",
    "store_scan": """SELECT c_custkey AS id, c_name FROM customer WHERE c_acctbal > 1000 AND c_nationkey IN (1, 2, 3) AND CAST(c_custkey AS VARCHAR) LIKE '1%'""",
    "store_statement": """SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_nationkey < 10 GROUP BY c_mktsegment""",
    "store_upsert": """SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN 'upd' ELSE c_name END AS v FROM customer UNION ALL SELECT c_custkey + 10000000, 'new' FROM customer WHERE c_custkey < 10""",
    "store_remove": """SELECT c_custkey AS id, c_name AS v FROM customer WHERE c_custkey % 4 <> 0""",
    "store_insert_ignore": """SELECT c_custkey AS id, c_name AS v FROM customer UNION ALL SELECT c_custkey + 100, 'new' FROM customer WHERE c_custkey < 200 AND c_custkey + 100 NOT IN (SELECT c_custkey FROM customer)""",
    "store_changes": """SELECT false AS deletion, count(*) AS n FROM customer WHERE c_custkey < 500 UNION ALL SELECT true, count(*) FROM customer WHERE c_custkey < 100""",
    "config_resolution": """SELECT * FROM (VALUES ('', '/plain', 'b', '10s'), ('a', '/a', 'b', '5s'), ('file://user:pw@/dynamic?implicitBucket=c', 'file:///dynamic', 'c', '10s')) t(identifier, root, bucket, timeout)""",
    "error_handler_jsonl": """SELECT CAST(c_custkey AS VARCHAR) AS "documentId", 'DocumentExistsException' AS "errorClass", 'tables' AS bucket, '_default' AS scope, '_default' AS collection FROM customer WHERE c_custkey % 2 = 0""",
    "stream_cdc_schema_full": """SELECT CAST(event_id AS VARCHAR) AS id, event_type, value, false AS deletion, true AS has_cas, '_default' AS scope, '_default' AS collection, ts AS timestamp, true AS has_vbucket, 0 AS n_xattrs FROM events""",
    "stream_cdc_count": """SELECT event_type AS collection, count(*) AS count FROM events GROUP BY event_type""",
    "stream_tumbling": """SELECT time_bucket(INTERVAL '1 day', ts) AS win_start, count(*) AS n FROM events GROUP BY 1""",
    "stream_sliding": """SELECT win_start, count(*) AS n FROM (SELECT time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours' * i AS win_start FROM events, range(0,2) r(i)) GROUP BY 1""",
    "stream_session": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS nw FROM events), s AS (SELECT user_id, ts, sum(nw) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, min(ts) AS s_start, count(*) AS n FROM s GROUP BY user_id, sid""",
    "stream_dedup": """SELECT DISTINCT user_id, event_type FROM events""",
    "search_accents": """SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: x = 'für')) AS score FROM documents WHERE list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'für')""",
    "search_terms": """SELECT doc_id, len(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: x = 'the')) AS score FROM documents WHERE list_contains(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), 'the')""",
    "search_prefix": """SELECT doc_id FROM documents WHERE len(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{M}\\p{N}]+'), lambda x: starts_with(x,'ou'))) > 0""",
    "raw_statement": """SELECT count(*) AS count FROM customer""",
    "profile_analytics": """SELECT CAST(s_suppkey AS VARCHAR) AS __META_ID, s_name FROM supplier""",
    "profile_columnar": """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "join_inner": """SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
    "join_left": """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'""",
    "join_semi": """SELECT c_custkey FROM customer SEMI JOIN orders ON o_custkey = c_custkey""",
    "join_anti": """SELECT c_custkey FROM customer ANTI JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT'""",
    "window_rank": """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""",
    "window_frame": """SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3 FROM orders""",
    "set_union_all": """SELECT n_regionkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region""",
    "set_intersect": """SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier""",
    "set_except": """SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000""",
    "profile_enterprise": """SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0""",
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
