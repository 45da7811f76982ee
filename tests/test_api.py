"""The single entry: configured collections, statements, search and key/value operations."""

import pytest

from docweave.api import Documents, measured
from docweave.operators import kv
from docweave.sources.config import disconnect_all
from docweave.sources.keyspace import Keyspace


@pytest.fixture
def db(spark, store, airports):
    spark.conf.set("spark.docweave.root", store.root)
    spark.conf.set("spark.docweave.implicitBucket", "travel")
    disconnect_all()
    out = Documents(spark)
    out.collection(collection="airports").load(airports, "__META_ID")
    yield out
    spark.conf.unset("spark.docweave.root")
    spark.conf.unset("spark.docweave.implicitBucket")
    disconnect_all()


def test_statements_over_collections(db):
    assert db.query("SELECT count(*) AS n FROM airports").first().n == 4
    assert db.query("SELECT a.iata FROM travel._default.`airports` a WHERE META().id = 'airport::vie'").first().iata == "VIE"
    assert "__META_ID" not in db.columnar_query("SELECT * FROM airports").columns
    assert "__META_ID" in db.analytics_query("SELECT * FROM airports").columns
    with pytest.raises(ValueError):
        db.query("SELECT 1", Keyspace("travel", "_default", "airports"))


def test_search_over_a_collection(db):
    assert {r.id: r.score for r in db.search_query("+airport fra*", "name", collection="airports").collect()}["airport::fra"] == 2


def test_key_value(db):
    where = {"collection": "notes"}
    db.upsert([kv.Upsert("a", '{"x":{"y":1}}'), kv.Upsert("b", '{"x":2}')], **where)
    db.insert([kv.Insert("a", "{}"), kv.Insert("c", "{}")], ignore_if_exists=True, **where)
    assert {r.id: r.body for r in db.get(["a", "c"], **where).collect()} == {"a": '{"x":{"y":1}}', "c": "{}"}
    assert db.lookup_in([kv.Get("a")], {"y": "x.y"}, **where).first().y == "1"
    cas = db.get(["a"], **where).first().cas
    with pytest.raises(kv.MutationError, match="CasMismatch"):
        db.replace([kv.Replace("a", "{}", cas + 1)], **where)
    db.replace([kv.Replace("a", '{"z":1}', cas), kv.Replace("q", "{}")], ignore_if_not_found=True, **where)
    db.remove([kv.Remove("b")], **where)
    assert sorted(r.id for r in db.get(["a", "b", "c"], strict=False, **where).collect()) == ["a", "c"]


def test_parts(db, spark):
    db.upsert([kv.Upsert("a", '{"n":1}')], collection="parts")
    db.mutate_in(spark.createDataFrame([("a", 5)], "__META_ID string, `increment:n` int"), collection="parts")
    assert db.get(["a"], collection="parts").first().body == '{"n":6}'
    with pytest.raises(ValueError):
        db.mutate_in(spark.createDataFrame([("a", 5)], "__META_ID string, n int"), "else", collection="parts")


def test_measures(db):
    df, seen = measured(db.read(collection="airports"))
    assert df.count() == 4 and seen.get["resultCount"] == 4 and seen.get["resultSize"] > 100


def test_mutate_in_records(db):
    where = {"collection": "notes"}
    db.upsert([kv.Upsert("a", '{"x":{"y":1},"z":[]}'), kv.Upsert("b", "{}")], **where)
    cas = {r.id: r.cas for r in db.get(["a", "b"], **where).collect()}
    got = db.mutate_in([kv.MutateIn("a", (("increment", "x.y", 2), ("arrayAppend", "z", {"k": None})), cas["a"])], **where)
    assert [(r.id, r.status) for r in got.collect()] == [("a", "ok")]
    assert [r.body for r in db.get(["a"], **where).collect()] == ['{"x":{"y":3},"z":[{"k":null}]}']
    with pytest.raises(kv.MutationError):
        db.mutate_in([kv.MutateIn("b", (("upsert", "q", 1),), cas["b"] + 1)], **where)
    assert db.upsert([], **where).count() == 0 and db.get(["b"], **where).first().body == "{}"
