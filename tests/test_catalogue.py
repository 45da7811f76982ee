"""Every registered query against its SQL, and what the rows-only ones must hold."""

import json
import zlib

import pytest

from docweave.plans import catalogue
from docweave.streaming import cdc


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_agrees_with_sql(name, spark, sf, duck, same):
    assert same(catalogue.QUERIES[name](spark, sf), duck.sql(catalogue.SQL[name])) > 0


def test_key_space_parts(spark, sf):
    rows = catalogue.QUERIES["vbucket_partitions"](spark, sf).collect()
    assert rows and all(r.vbucket == (zlib.crc32(r.id.encode()) >> 16) & 0x7FFF & 1023 for r in rows)


def test_golden_document(spark, sf):
    (row,) = catalogue.QUERIES["kv_subdoc_golden"](spark, sf).collect()
    assert json.loads(row.body) == {
        "counter1": 99,
        "counter2": 52,
        "keepThis": "keep",
        "tags": ["tag0", "tag1", "tag2", "tag3"],
        "moreTags": ["tagA", "tagB", "tagC", "tagD"],
        "nestedJson": {"foo": {"baz": "bux2"}},
    }


def test_full_stream_schema(spark, sf):
    assert dict(cdc.changes_of(spark.read.parquet(f"{sf}/events.parquet"), "event_id", catalogue.HERE, "full").dtypes)["content"] == "binary"


def test_settings(spark, sf):
    rows = [tuple(r) for r in catalogue.QUERIES["config_resolution"](spark, sf).collect()]
    assert rows == [("", "/plain", "b", "10s"), ("a", "/a", "b", "5s"), ("file://user:pw@/dynamic?implicitBucket=c", "file:///dynamic", "c", "10s")]


def test_registered_together():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_files(spark, sf):
    plan = catalogue.QUERIES["user_filter_option"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


def test_whole_documents_are_changed(spark, tmp_path):
    """Fields besides k, also those that only a late document has, are there after the operation."""
    rows = [(i, i, '{"k": 1}') for i in range(1100)] + [(2000, 5, '{"k": 2, "late": {"x": 1}, "more": 3}')]
    spark.createDataFrame(rows, "event_id long, user_id long, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    queries = catalogue.queries()
    assert {r.event_id: r.n_keys for r in queries["subdoc_remove"](spark, str(tmp_path)).where("event_id in (0, 2000)").collect()} == {0: 0, 2000: 2}
    assert [tuple(r) for r in queries["subdoc_upsert"](spark, str(tmp_path)).where("event_id = 2000").collect()] == [(2000, 5, 2)]
    assert [tuple(r) for r in queries["subdoc_increment"](spark, str(tmp_path)).where("event_id = 2000").collect()] == [(2000, 4, 1)]
