"""Search, statements, joins and sub-document expressions on small data."""

import pytest
from pyspark.sql import functions as F

from docweave.operators import relational, search, subdoc
from docweave.plans import statement
from docweave.sources.keyspace import Keyspace


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(1, "The quick brown fox", "a"), (2, "A brown, brown dog", "fox"), (3, "quickly done", None), (4, None, "the")], "id long, text string, title string")


@pytest.mark.parametrize(
    "query, hits",
    [
        ("brown", {1: 1, 2: 2}),
        ("quick*", {1: 1, 3: 1}),
        ("+brown -dog", {1: 1}),
        ('"brown dog"', {2: 1}),
        ("title:fox brown", {1: 1, 2: 3}),
        ("+title:the", {4: 1}),
        ("absent", {}),
    ],
)
def test_search(texts, query, hits):
    assert {r.id: r.score for r in search.search(texts, query).collect()} == hits


def test_search_pages(texts):
    assert [r.id for r in search.search(texts, "brown", limit=1).collect()] == [2]
    assert [r.id for r in search.search(texts, "brown", limit=1, skip=1).collect()] == [1]


def test_statement(spark, airports):
    where = Keyspace("b", "s")
    out = statement.run(spark, 'SELECT count(*) AS n FROM `airport` WHERE country IN ["Austria", "Germany"] AND META().id <> "x"', {"b.s.airport": airports}, where)
    assert out.first().n == 2
    with pytest.raises(ValueError):
        statement.run(spark, "SELECT 1", {}, Keyspace("b", "s", "c"))


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(1, "p"), (3, "q")], "k int, b string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, a.join(b, "k", how).collect()), key=str)
        assert sorted(map(tuple, relational.salted_join(a, b, "k", 4, how).collect()), key=str) == want
        assert sorted(map(tuple, relational.join(a, b, "k", how, broadcast_rows=1).collect()), key=str) == want
    with pytest.raises(ValueError):
        relational.join(a, b, "k", "sideways")
    with pytest.raises(ValueError):
        relational.salted_join(a, b, "k", 4, "full")


def test_as_of(spark):
    trades = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    quotes = spark.createDataFrame([("a", 2, 20), ("a", 4, 40), ("a", 6, 60), ("b", 9, 90)], "k string, t int, v int")
    assert {(r.k, r.t): r.v for r in relational.as_of(trades, quotes, "k", "t", "v").collect()} == {("a", 5): 40, ("a", 1): None, ("b", 9): 90}


def test_lookups(spark):
    df = spark.createDataFrame([('{"a":{"b":[1,2]},"c":"x"}',)], "body string")
    row = df.select(subdoc.lookup("body", "a.b").alias("v"), subdoc.exists("body", "c").alias("e"), subdoc.exists("body", "d").alias("m"), subdoc.count("body", "a.b").alias("n"), subdoc.count("body").alias("f")).first()
    assert tuple(row) == ("[1,2]", True, False, 2, 2)


def test_array_operations(spark):
    df = spark.createDataFrame([(1,)], "id int").select("id", F.struct(F.array(F.lit("a")).alias("tags"), F.lit(1.0).alias("n")).alias("doc"))
    run = lambda header, value: subdoc.mutate_in(df.withColumn(header, value), "doc", [subdoc.parse_header(header)]).first().doc
    assert run("arrayAddUnique:tags", F.lit("b")).tags == ["a", "b"]
    with pytest.raises(Exception, match="PathExists"):
        run("arrayAddUnique:tags", F.lit("a"))
    assert run("arrayAppend:fresh", F.lit(1)).fresh == [1]
    assert run("increment:n", F.lit(2.9)).n == 3
    assert run("decrement:fresh", F.lit(2)).fresh == -2
    with pytest.raises(ValueError):
        run("increment:n", F.lit("x"))
    with pytest.raises(Exception, match="PathNotFound"):
        run("arrayInsert:tags[7]", F.lit("x"))
    with pytest.raises(Exception, match="EmptyArray"):
        run("arrayAppend:tags", F.array().cast("array<string>"))
    assert "n" not in run("remove:n", F.lit(1)).asDict()


def test_cross_joins_need_a_bound(spark):
    a, b = spark.range(3), spark.range(4).withColumnRenamed("id", "k")
    for bound in (None, 3):
        with pytest.raises(ValueError):
            relational.join(a, b, None, "cross", bound)
    assert relational.join(a, b, None, "cross", 4).count() == 12


def test_words_of_any_script(spark):
    texts = spark.createDataFrame([(1, "Grün ist grün; ÜBER-grün"), (2, "gr n"), (3, "梦 über")], "id long, text string")
    assert {r.id: r.score for r in search.search(texts, "grün").collect()} == {1: 3}
    assert {r.id: r.score for r in search.search(texts, "über").collect()} == {1: 1, 3: 1}
    assert {r.id for r in search.search(texts, "梦 gr*").collect()} == {1, 2, 3}
