"""Collections on disk: scans, mutations, write modes, errors and change streams."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.operators import aggregate as ag
from docweave.operators import kv, partition
from docweave.sources.config import disconnect_all
from docweave.sources.keyspace import Keyspace
from docweave.sources.read import read, read_collection, read_frame
from docweave.sources.snapshot import CommitConflict
from docweave.sources.write import mutate_parts, save, write
from docweave.streaming import cdc


def contents(collection):
    return {r.id: json.loads(r.body) for r in collection.state().collect()}


@pytest.fixture
def stored(store, airports):
    return store.collection(Keyspace("b")).load(airports, "__META_ID")


@pytest.fixture
def pair(spark, store):
    c = store.create(Keyspace("b", "s", "pair"))
    write(spark.createDataFrame([("doc1", "initial"), ("doc2", "initial")], "__META_ID string, content string"), c)
    return c


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "__META_ID string, content string")


# scans


def test_scan_infers_a_union_of_fields(stored):
    df = read_collection(stored)
    assert df.columns == ["country", "elevation", "helipads", "iata", "lat", "lon", "name", "runways", "type", "__META_ID"]
    assert df.count() == 4 and df.where("helipads is null").count() == 3


def test_filter_by_id_and_fields(stored):
    assert read_collection(stored, filter="META().id = 'airport::sfo'").first().iata == "SFO"
    assert read_collection(stored, filter="country IN ['Austria', 'Germany'] AND elevation > 150").first().iata == "VIE"
    assert read_collection(stored, filter="type = 'airport'").limit(2).count() == 2


def test_aggregates(stored):
    df = read_collection(stored)
    assert ag.aggregate(df, mx=ag.maximum("elevation"), mn=ag.minimum("runways"), a=ag.mean("runways")).first() == (204, 2, 4.5)
    found = {r.country: (r.e, r.r) for r in ag.aggregate(df, ["country"], e=ag.maximum("elevation"), r=ag.minimum("runways")).collect()}
    assert len(found) == 3 and found["Austria"][0] == 183 and found["Germany"][1] == 4


def test_id_and_cas_columns(stored):
    assert "key" in read_collection(stored, idFieldName="key").columns
    df = read_collection(stored, outputCas=True)
    assert df.columns[-1] == "__META_CAS" and df.where("__META_CAS > 0").select("__META_CAS").distinct().count() == 4
    assert "mycas" in read_collection(stored, outputCas="true", casFieldName="mycas").columns
    assert "mycas" not in read_collection(stored, casFieldName="mycas").columns


def test_schema_of_our_own(stored):
    df = read_collection(stored, schema="name string, absent int")
    assert df.columns == ["name", "absent", "__META_ID"] and df.where("absent is null").count() == 4


def test_one_document_for_inference(spark, store):
    docs = spark.createDataFrame([("a", '{"name":"x"}', 1), ("b", '{"foo":"y"}', 2)], "id string, body string, cas long").coalesce(1)
    c = store.create(Keyspace("b", "s", "mixed"))
    c.commit(docs, docs)
    df = read_collection(c, inferLimit=1)
    assert len(df.columns) == 2 and df.count() == 2
    assert read_collection(c).columns == ["foo", "name", "__META_ID"]


def test_profiles_differ(stored):
    assert "__META_ID" in read_collection(stored, "analytics").columns
    assert "__META_ID" not in read_collection(stored, "columnar").columns
    for kind in ("analytics", "columnar", "enterprise-analytics"):
        with pytest.raises(ValueError):
            read_collection(stored, kind, outputCas=True)
        with pytest.raises(ValueError):
            read_collection(stored, kind, partitionColumn="elevation", partitionLowerBound=0, partitionUpperBound=10, partitionCount=2)


def test_configured_scan(spark, store, stored):
    spark.conf.set("spark.docweave.root", store.root)
    try:
        disconnect_all()
        assert read(spark, bucket="b").count() == 4
        with pytest.raises(ValueError, match="implicit bucket"):
            read(spark)
        with pytest.raises(ValueError, match="dataset"):
            read(spark, "analytics", bucket="b")
        with pytest.raises(ValueError, match="database"):
            read(spark, "columnar", scope="s")
        assert read(spark, "columnar", database="b", scope="_default", collection="_default").count() == 4
        disconnect_all()
        spark.conf.set("spark.docweave.implicitBucket", "b")
        assert read(spark, filter="elevation > 100").count() == 3
        save(spark, rows(spark, ("x", "y")), "overwrite", collection="other")
        assert read(spark, collection="other").first().content == "y"
    finally:
        spark.conf.unset("spark.docweave.root")
        spark.conf.unset("spark.docweave.implicitBucket")
        disconnect_all()


def test_partitioned_scan(spark):
    df = spark.range(0, 1000).select("id", F.when(F.col("id") % 100 == 0, None).otherwise(F.col("id")).alias("k"))
    out = read_frame(df, partitionColumn="k", partitionLowerBound=100, partitionUpperBound=500, partitionCount=10)
    assert out.rdd.getNumPartitions() == df.rdd.getNumPartitions()  # one scan
    assert out.count() == 990  # bounds cut and don't restrict; nulls go
    exact = partition.partitioned(df, partition.Bounds("k", 100, 500, 10), exact=True)
    assert exact.rdd.getNumPartitions() == 10 and exact.count() == 990
    sizes = [r["n"] for r in exact.groupBy(F.spark_partition_id()).agg(F.count("k").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) < 990
    assert read_frame(df, partitionColumn="k", partitionLowerBound=1, partitionUpperBound=2, partitionCount=1).count() == 990


# mutations


def test_save_modes(spark, store):
    c = store.collection(Keyspace("b", "s", "modes"))
    write(rows(spark, ("a", "1"), ("b", "1")), c)
    with pytest.raises(kv.MutationError, match="DocumentExistsException"):
        write(rows(spark, ("a", "2"), ("c", "2")), c)
    assert contents(c) == {"a": {"content": "1"}, "b": {"content": "1"}}
    write(rows(spark, ("a", "3"), ("c", "3")), c, "ignore")
    assert contents(c)["a"] == {"content": "1"} and contents(c)["c"] == {"content": "3"}
    write(rows(spark, ("a", "4")), c, "overwrite", durability="majority", timeout="10s")
    assert contents(c)["a"] == {"content": "4"}
    before = c.version()
    for how in ({"mode": "append"}, {"writeMode": "other"}, {"durability": "some"}, {"timeout": "x"}, {"kind": "columnar"}, {"errorHandler": "no.such.handler"}, {"errorHandler": 5}):
        with pytest.raises(ValueError):
            write(rows(spark, ("z", "1")), c, **how)
    assert c.version() == before


def test_null_cells_are_not_written(spark, store):
    c = store.collection(Keyspace("b", "s", "nulls"))
    write(spark.createDataFrame([("a", None, 1)], "__META_ID string, x string, y int"), c)
    assert contents(c) == {"a": {"y": 1}}
    with pytest.raises(ValueError):
        write(spark.createDataFrame([(None, "x")], "__META_ID string, x string"), c)
    with pytest.raises(ValueError):
        write(spark.createDataFrame([("x",)], "x string"), c)


def test_replace(spark, pair):
    write(rows(spark, ("doc1", "updated")), pair, writeMode="replace")
    assert contents(pair) == {"doc1": {"content": "updated"}, "doc2": {"content": "initial"}}
    with pytest.raises(kv.MutationError, match="DocumentNotFoundException"):
        write(rows(spark, ("doc1", "again"), ("nonexistent", "x")), pair, writeMode="replace")
    assert contents(pair)["doc1"] == {"content": "updated"}


def test_replace_with_cas(spark, pair):
    cas = {r.id: r.cas for r in pair.state().collect()}
    make = lambda a, b: spark.createDataFrame([("doc1", "new", a), ("doc2", "new", b)], "__META_ID string, content string, c long")
    with pytest.raises(kv.MutationError, match="CasMismatchException"):
        write(make(cas["doc1"], 5), pair, writeMode="replace", casFieldName="c")
    caught = []
    write(make(cas["doc1"], 5), pair, writeMode="replace", casFieldName="c", errorHandler=lambda failed: caught.extend(failed.collect()))
    assert [(r.id, r.status) for r in caught] == [("doc2", "CasMismatchException")]
    assert contents(pair) == {"doc1": {"content": "new"}, "doc2": {"content": "initial"}}
    assert {r.id: r.cas for r in pair.state().collect()}["doc1"] != cas["doc1"]
    for wrong in ("missing", "c"):
        with pytest.raises(ValueError):
            write(make(None, 1), pair, writeMode="replace", casFieldName=wrong, errorHandler=lambda failed: None)


def test_errors_become_documents(spark, store, pair):
    errors = store.collection(Keyspace("errors"))
    status = write(rows(spark, ("doc1", "x"), ("doc3", "x")), pair, errorCollection=errors)
    assert {r.id: r.status for r in status.collect()} == {"doc1": "DocumentExistsException", "doc3": "ok"}
    ((key, doc),) = contents(errors).items()
    assert key.startswith("error_b.s.pair_doc1_")
    assert (doc["documentId"], doc["bucket"], doc["scope"], doc["collection"], doc["error"]["simpleClass"]) == ("doc1", "b", "s", "pair", "DocumentExistsException")
    assert "doc3" in contents(pair)


def test_duplicates_in_a_batch(spark, store):
    c = store.create(Keyspace("b", "s", "dup"))
    batch = kv.operations(spark, [kv.Insert("d", '{"v":1}'), kv.Insert("d", '{"v":2}')])
    caught = []
    kv.insert(c, batch.drop("cas"), ordinal="ordinal", on_error=lambda failed: caught.extend(failed.collect()))
    assert contents(c) == {"d": {"v": 1}} and len(caught) == 1
    kv.upsert(c, kv.operations(spark, [kv.Upsert("d", '{"v":3}'), kv.Upsert("d", '{"v":4}')]), ordinal="ordinal")
    assert contents(c) == {"d": {"v": 4}}


def test_get_and_remove(spark, pair):
    ids = spark.createDataFrame([("doc1",), ("doc9",)], "id string")
    assert [r.id for r in kv.get(pair.state(), ids, strict=False).collect()] == ["doc1"]
    with pytest.raises(Exception, match="DocumentNotFoundException"):
        kv.get(pair.state(), ids).collect()
    with pytest.raises(kv.MutationError):
        kv.remove(pair, kv.operations(spark, [kv.Remove("doc9")]))
    kv.remove(pair, kv.operations(spark, [kv.Remove("doc1"), kv.Remove("doc9")]), ignore_if_not_found=True)
    assert set(contents(pair)) == {"doc2"}
    with pytest.raises(ValueError):
        kv.operations(spark, [kv.Remove("a"), kv.Get("b")])


def test_parts_of_documents(spark, store):
    c = store.collection(Keyspace("b", "s", "parts"))
    new = spark.createDataFrame([("docC", 3, "baz", 30.3)], "__META_ID string, `upsert:profile.version` int, `insert:name` string, `upsert:score` double")
    write(new, c, writeMode="subdocUpsert")
    assert contents(c) == {"docC": {"profile": {"version": 3}, "name": "baz", "score": 30.3}}
    more = spark.createDataFrame([("docC", 5, ["a"])], "__META_ID string, `increment:profile.version` int, `arrayAppend:tags` array<string>")
    write(more, c, writeMode="subdocReplace")
    assert contents(c)["docC"] == {"profile": {"version": 8}, "name": "baz", "score": 30.3, "tags": ["a"]}
    with pytest.raises(kv.MutationError):
        write(more, c, writeMode="subdocInsert")
    with pytest.raises(ValueError):
        write(spark.createDataFrame([("docC", 1)], "__META_ID string, `invalid:operation` int"), c, writeMode="subdocUpsert")
    with pytest.raises(Exception, match="PathExists"):
        write(spark.createDataFrame([("docC", "x")], "__META_ID string, `insert:name` string"), c, writeMode="subdocUpsert")
    with pytest.raises(Exception, match="PathNotFound"):
        write(spark.createDataFrame([("docC", "x")], "__META_ID string, `replace:nothing` string"), c, writeMode="subdocUpsert")


ids = st.sampled_from("abcd")
step = st.tuples(st.sampled_from(["insert", "upsert", "replace", "remove"]), st.lists(st.tuples(ids, st.integers(0, 9)), min_size=1, max_size=4))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(step, min_size=1, max_size=3))
def test_mutations_match_a_dictionary(spark, steps):
    state = spark.createDataFrame([("a", 0), ("b", 0)], "id string, v int")
    model = {"a": 0, "b": 0}
    for operation, batch in steps:
        df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(batch)], "id string, v int, ordinal int")
        state = kv.apply(state, df, operation, "ordinal")[0].select("id", "v")
        known = set(model)
        for k, v in batch:
            if operation == "insert" and k not in model or operation == "upsert" or operation == "replace" and k in known:
                model[k] = v
            elif operation == "remove":
                model.pop(k, None)
    assert {r.id: r.v for r in state.collect()} == model


# changes


def test_change_stream(spark, store, pair):
    kv.remove(pair, kv.operations(spark, [kv.Remove("doc1")]))
    everything = cdc.drained(cdc.change_stream(pair, "fromBeginning", "full"), "append")
    found = sorted((r.id, r.deletion, r.content is None) for r in everything.collect())
    assert found == [("doc1", False, False), ("doc1", True, True), ("doc2", False, False)]
    assert everything.select("scope", "collection").distinct().collect() == [("s", "pair")]
    assert cdc.drained(cdc.change_stream(pair), "append").count() == 0
    counts = cdc.drained(cdc.counts(cdc.change_stream(pair, "fromBeginning", numPartitions=2), "collection"))
    assert [tuple(r) for r in counts.collect()] == [("pair", 3)]
    assert cdc.drained(cdc.change_stream(pair, "fromBeginning", collections=["else"]), "append").count() == 0
    for wrong in ({"streamFrom": "x"}, {"streamMetaData": "x"}, {"numPartitions": 0}, {"mutationLogTimeout": "x"}):
        with pytest.raises(ValueError):
            cdc.change_stream(pair, **wrong)


def test_stream_into_a_collection(spark, store, pair, tmp_path):
    target = store.create(Keyspace("b", "s", "copy"))
    changes = cdc.change_stream(pair, "fromBeginning").select("id", F.col("content").cast("string").alias("body"))
    query = cdc.into(changes, lambda df: kv.upsert(target, df), f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert contents(target) == contents(pair)
    write(rows(spark, ("doc7", "late")), pair)
    cdc.into(changes, lambda df: kv.upsert(target, df), f"{tmp_path}/checkpoint").awaitTermination()
    assert "doc7" in contents(target)


MIXED = [("andy", '{"username":"Andy","age":32}'), ("order1", '{"value":2.670, "big":123456789012345678901234567890,"n":null}'), ("basket1", '{"itemIds":["order1","order2"],"value":"text"}'), ("bad", "no json"), ("flat", '{"z":{"deep":1}}')]


def test_sub_document_writes_keep_all_other_fields(spark, store):
    c = store.create(Keyspace("b", collection="mixed"))
    kv.upsert(c, spark.createDataFrame(MIXED, "id string, body string"))
    caught = []
    batch = spark.createDataFrame([(i, "y") for i, _ in MIXED] + [("none", "y")], "__META_ID string, `insert:z` string")
    write(batch, c, writeMode="subdocReplace", errorHandler=lambda failed: caught.extend((r.id, r.status) for r in failed.collect()))
    got = {r.id: r.body for r in c.state().collect()}
    want = {i: b[:-1] + ',"z":"y"}' if i not in ("bad", "flat") else b for i, b in MIXED}
    assert got == want
    assert sorted(caught) == [("bad", "DocumentNotJsonException"), ("flat", "PathExistsException"), ("none", "DocumentNotFoundException")]
    with pytest.raises(kv.MutationError):
        write(batch, c, writeMode="subdocReplace")
    assert {r.id: r.body for r in c.state().collect()} == want


def test_failed_paths_go_to_the_error_collection(spark, store):
    c, errors_ = store.create(Keyspace("b", collection="parts")), store.collection(Keyspace("b", collection="errors"))
    kv.upsert(c, spark.createDataFrame([("a", '{"t":1}')], "id string, body string"))
    calls = []

    def failing(failed):
        calls.append(failed.count())
        raise RuntimeError("handler")

    write(spark.createDataFrame([("a", 5)], "__META_ID string, `arrayAppend:t` int"), c, writeMode="subdocUpsert", errorHandler=failing, errorCollection=errors_)
    (row,) = [json.loads(r.body) for r in errors_.state().collect()]
    assert calls == [1] and row["documentId"] == "a" and row["error"]["simpleClass"] == "PathMismatchException"


def test_mutate_in_records_check_their_cas(spark, store):
    c = store.create(Keyspace("b", collection="records"))
    kv.upsert(c, spark.createDataFrame([("a", '{"n":1}'), ("b", '{"n":1}')], "id string, body string"))
    cas = {r.id: r.cas for r in c.state().collect()}
    rows = [kv.MutateIn("a", (("increment", "n", 2), ("arrayAppend", "t", [1, 2])), cas["a"]), kv.MutateIn("b", (("upsert", "n", 9),), cas["b"] + 1)]
    caught = []
    mutate_parts(c, kv.part_operations(spark, rows), "subdocReplace", lambda failed: caught.extend((r.id, r.status) for r in failed.collect()), "ordinal")
    assert {r.id: r.body for r in c.state().collect()} == {"a": '{"n":3,"t":[1,2]}', "b": '{"n":1}'} and caught == [("b", "CasMismatchException")]
    with pytest.raises(ValueError):
        kv.part_operations(spark, [kv.MutateIn("a", (("upsert", "n", 9),) * 17)])


def test_two_writers_on_one_version(spark, store):
    c = store.create(Keyspace("b", collection="race"))
    one = spark.createDataFrame([("a", "{}", 1)], "id string, body string, cas long")
    two = spark.createDataFrame([("b", "{}", 2)], "id string, body string, cas long")
    assert c.commit(one, one, 0) == 1
    with pytest.raises(CommitConflict):
        c.commit(two, two, 0)
    assert [r.id for r in c.state().collect()] == ["a"] == [r.id for r in c.log().collect()]
    # mutations decide again on what the other writer left
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: kv.upsert(c, spark.createDataFrame([(f"t{i}", "{}")], "id string, body string"), retries=20), range(3)))
    assert sorted(r.id for r in c.state().collect()) == ["a", "t0", "t1", "t2"] and c.log().count() == 4


def test_a_failed_commit_is_not_seen(spark, store, monkeypatch):
    c = store.create(Keyspace("b", collection="ghosts"))
    kv.upsert(c, spark.createDataFrame([("a", "{}")], "id string, body string"))
    monkeypatch.setattr(type(c), "_publish", lambda self, version, facts: (_ for _ in ()).throw(OSError("no space")))
    with pytest.raises(OSError):
        kv.upsert(c, spark.createDataFrame([("ghost", "{}")], "id string, body string"))
    monkeypatch.undo()
    assert [r.id for r in c.state().collect()] == ["a"] == [r.id for r in c.log().collect()]
    assert [r.id for r in cdc.drained(cdc.change_stream(c, "fromBeginning"), "append").collect()] == ["a"]
    kv.upsert(c, spark.createDataFrame([("b", "{}")], "id string, body string"))
    assert sorted(r.id for r in cdc.drained(cdc.change_stream(c, "fromBeginning"), "append").collect()) == ["a", "b"]


def test_replicas_lose_what_is_deleted(spark, store, tmp_path):
    source, target = store.create(Keyspace("b", collection="from")), store.create(Keyspace("b", collection="to"))
    kv.upsert(source, spark.createDataFrame([("a", '{"v":1}'), ("b", '{"v":1}'), ("c", '{"v":1}')], "id string, body string"))
    kv.upsert(source, spark.createDataFrame([("b", '{"v":2}')], "id string, body string"))
    run = lambda: cdc.replicate(cdc.change_stream(source, "fromBeginning"), target, f"file://{tmp_path}/checkpoint").awaitTermination()
    run()
    assert contents(target) == {"a": {"v": 1}, "b": {"v": 2}, "c": {"v": 1}}
    kv.remove(source, spark.createDataFrame([("a",)], "id string"))
    kv.upsert(source, spark.createDataFrame([("d", '{"v":4}')], "id string, body string"))
    run()
    assert contents(target) == {"b": {"v": 2}, "c": {"v": 1}, "d": {"v": 4}}
