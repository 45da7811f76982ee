"""What needs no Spark job: keyspaces, settings, ranges, headers, query strings."""

import pytest

from docweave.functions.filters import rewrite
from docweave.operators import jsontext, partition, search, subdoc
from docweave.plans.statement import Unsupported, translate
from docweave.sources.config import ConfigError, Settings, parse_duration
from docweave.sources.keyspace import Keyspace
from docweave.sources.profiles import PROFILES, check_consistency, profile
from docweave.sources.read import ReadOptions
from docweave.sources.write import save_operation
from docweave.streaming import cdc


@pytest.mark.parametrize(
    "lower, upper, count, cuts",
    [
        (0, 1000, 3, [333, 667]),
        (1, 8, 2, [5]),
        (1, 8, 9, [2, 3, 4, 5, 6, 7]),
        (1000000, 2000000, 2, [1500000]),
        (1, 20000, 10, [2001, 4001, 6001, 8001, 10001, 12000, 14000, 16000, 18000]),
        (0, 15000, 4, [3750, 7500, 11250]),
        (0, 10, 1, []),
    ],
)
@pytest.mark.filterwarnings("ignore")
def test_cut_points(lower, upper, count, cuts):
    assert partition.cut_points(lower, upper, count) == cuts


@pytest.mark.parametrize("options", [("c", 0, 10, None), ("c", None, 10, 2), (None, 0, 10, 2), ("c", 0, 10, 0), ("c", 10, 10, 2), ("c", 11, 10, 2)])
def test_bounds_are_checked(options):
    with pytest.raises(ValueError):
        partition.Bounds.of(*options)


def test_no_bounds():
    assert partition.Bounds.of(None, None, None, None) is None


def test_keyspace():
    assert Keyspace().is_empty and not Keyspace("a").is_empty
    assert Keyspace("a").table_name == "a"
    assert Keyspace("a", "s", "c").table_name == "a:s:c"
    assert Keyspace("a", "s", "c").qualified == "`a`.`s`.`c`"
    assert Keyspace("a").path == "a/_default/_default"
    assert Keyspace("a", "s").query_context == "default:`a`.`s`"
    assert Keyspace(None, "s").filled(Keyspace("b", "t", "u")) == Keyspace("b", "s", "u")
    for wrong in (Keyspace(), Keyspace("a/b"), Keyspace("..")):
        with pytest.raises(ValueError):
            _ = wrong.path


BASE = {"spark.docweave.root": "/data"}


def test_settings_in_layers():
    s = Settings(BASE | {"spark.docweave.root:x": "/x", "spark.docweave.root:a:b": "/ab", "spark.docweave.implicitBucket": "b", "spark.docweave.username:x": "u", "spark.docweave.password:x": "p"})
    assert s.connection().root == "/data"
    x = s.connection("x")
    assert (x.root, x.username, x.implicit.bucket) == ("/x", "u", "b")
    assert s.connection("a:b").root == "/ab"
    assert s.connection("unknown").root == "/data"
    uri = s.connection("hdfs://me:se%2Fcret@host/data?implicitScope=s&io=1")
    assert (uri.root, uri.username, uri.password, uri.implicit.scope, uri.implicit.bucket) == ("hdfs://host/data", "me", "se/cret", "s", "b")
    assert uri.properties == {"io": "1"}


def test_settings_that_contradict():
    with pytest.raises(ConfigError, match="root is needed"):
        Settings({}).connection()
    with pytest.raises(ConfigError, match="root:x is needed"):
        Settings({}).connection("x")
    for extra in ({"username": "u"}, {"password": "p"}, {"keyStorePath": "k"}, {"username": "u", "password": "p", "keyStorePath": "k", "keyStorePassword": "p", "keyStoreType": "t"}, {"authentication": "required"}):
        with pytest.raises(ConfigError):
            Settings(BASE | {f"spark.docweave.{k}": v for k, v in extra.items()}).connection()
    with pytest.raises(ConfigError, match="implicit bucket"):
        Settings(BASE).connection().keyspace()


def test_properties_are_handed_through():
    s = Settings(BASE | {"spark.docweave.timeout.kv": "1s", "spark.docweave.timeout.kv:x": "2s", "spark.docweave.other:y": "1"})
    assert s.connection().properties == {"timeout.kv": "1s"}
    assert s.connection("x").properties == {"timeout.kv": "2s"}


def test_secure_settings_fall_back_alike():
    s = Settings(BASE | {"spark.ssl.enabled": "true", "spark.ssl.insecure:x": "true"})
    assert s.connection("x").secure and s.connection("x").insecure and not s.connection().insecure


def test_durations():
    assert parse_duration("10s") == 10 and parse_duration("100 ms") == 0.1 and parse_duration("2 minutes") == 120
    for wrong in ("", "10", "s", "10 parsecs"):
        with pytest.raises(ConfigError):
            parse_duration(wrong)


def test_profiles():
    assert set(PROFILES) == {"query", "analytics", "columnar", "enterprise-analytics"}
    assert [p.name for p in PROFILES.values() if p.writable] == ["query"]
    with pytest.raises(ValueError):
        profile("other")
    assert check_consistency(None) == "notBounded" and check_consistency("requestPlus") == "requestPlus"
    with pytest.raises(ValueError, match="Unknown scanConsistency of maybe"):
        check_consistency("maybe")
    for wrong in ({"nonsense": 1}, {"scanConsistency": "x"}, {"timeout": "soon"}):
        with pytest.raises(ValueError):
            ReadOptions(wrong)


@pytest.mark.parametrize(
    "text, sql",
    [
        ("a IN [1, 2]", "a IN (1, 2)"),
        ("a in ['x]', \"y\"] AND b = '[META().id]'", "a in ('x]', \"y\") AND b = '[META().id]'"),
        ("META().id = 'a' OR meta( c ).cas > 1", "`__META_ID` = 'a' OR `__META_CAS` > 1"),
        ("array_contains([1, [2]], a[0])", "array_contains(array(1, array(2)), a[0])"),
        ("`odd [name]` = 'it''s'", "`odd [name]` = 'it''s'"),
    ],
)
def test_rewrite(text, sql):
    assert rewrite(text) == sql


@pytest.mark.parametrize("text", ["a IN [1", "a]"])
def test_rewrite_refuses(text):
    with pytest.raises(ValueError):
        rewrite(text)


def test_statements():
    names = {"b.s.airport": "v"}
    assert translate("SELECT * FROM `b`.s.`airport` WHERE x = 'from b.s.airport';", names) == "SELECT * FROM `v` WHERE x = 'from b.s.airport'"
    for wrong in ("DELETE FROM a", "INSERT INTO a (KEY, VALUE) VALUES ('a', {})", "SELECT VALUE f()", "select raw x from a", ""):
        with pytest.raises(Unsupported):
            translate(wrong, names)


def test_headers():
    parse = lambda h: (subdoc.parse_header(h).operation, subdoc.parse_header(h).path)
    assert parse("a.b") == ("upsert", "a.b")
    assert parse("ARRAYAPPEND:tags") == ("arrayAppend", "tags")
    assert parse("insert:a:b") == ("insert", "a:b")
    with pytest.raises(ValueError, match="Unsupported sub-document operation 'foo'"):
        subdoc.parse_header("foo:path")
    assert len(subdoc.specs([f"upsert:p{i}" for i in range(16)] + ["id"], ("id",))) == 16
    with pytest.raises(ValueError, match="16"):
        subdoc.specs([f"upsert:p{i}" for i in range(17)])


DOC = '{"a":1, "n":null ,"big":123456789012345678901234567890,"f":2.50,"s":"x\\u0041","tags":["b", 1e3],"o":{"p":{"q":[ {"r":1},{"r":2} ]}}}'


@pytest.mark.parametrize(
    "operation, path, value, old, new",
    [
        ("upsert", "z", '"y"', "}}}", '}},"z":"y"}'),
        ("upsert", "f", "[1]", "2.50", "[1]"),
        ("upsert", "x.y.z", "1", "}}}", '}},"x":{"y":{"z":1}}}'),
        ("upsert", "o.p.q[1].r", "null", '"r":2', '"r":null'),
        ("upsert", "o.p.q[-1].r", "7", '"r":2', '"r":7'),
        ("insert", "o.p.new", "{}", "]}}}", '],"new":{}}}}'),
        ("replace", "n", "0", "null", "0"),
        ("remove", "a", "1", '"a":1, ', ""),
        ("remove", "o", "1", ',"o":{"p":{"q":[ {"r":1},{"r":2} ]}}', ""),
        ("remove", "tags[0]", "1", '"b", ', ""),
        ("increment", "big", "5", "890,", "895,"),
        ("decrement", "a", "2.9", '"a":1', '"a":-1'),
        ("increment", "c", "3", "}}}", '}},"c":3}'),
        ("arrayAppend", "tags", "[true,false]", "1e3]", "1e3,true,false]"),
        ("arrayPrepend", "tags", '"0"', '["b"', '["0","b"'),
        ("arrayInsert", "tags[1]", "[[1]]", '"b", ', '"b", [1],'),
        ("arrayInsert", "tags[2]", "9", "1e3", "1e3,9"),
        ("arrayAddUnique", "tags", '"c"', "1e3", '1e3,"c"'),
        ("arrayAddUnique", "t2", "[1]", "}}}", '}},"t2":[[1]]}'),
    ],
)
def test_only_the_addressed_part_changes(operation, path, value, old, new):
    assert DOC.count(old) == 1 and jsontext.edit(DOC, operation, path, value) == DOC.replace(old, new)


@pytest.mark.parametrize(
    "operation, path, value, status",
    [
        ("insert", "a", "1", "PathExistsException"),
        ("arrayAddUnique", "tags", "1e3", "PathExistsException"),
        ("replace", "zz", "1", "PathNotFoundException"),
        ("remove", "o.x", "1", "PathNotFoundException"),
        ("upsert", "tags[7]", "1", "PathNotFoundException"),
        ("arrayInsert", "tags[9]", "1", "PathNotFoundException"),
        ("arrayInsert", "tags", "1", "PathMismatchException"),
        ("upsert", "a.b", "1", "PathMismatchException"),
        ("arrayAppend", "a", "1", "PathMismatchException"),
        ("increment", "f", "1", "PathMismatchException"),
        ("increment", "a", '"x"', "ValueInvalidException"),
        ("arrayAppend", "tags", "[]", "ValueInvalidException"),
        ("arrayPrepend", "tags", '[1,"x"]', "ValueInvalidException"),
        ("arrayAppend", "tags", "[1,1.5]", "ValueInvalidException"),
    ],
)
def test_paths_that_cannot_be_changed(operation, path, value, status):
    assert subdoc.edit_text(DOC, [{"operation": operation, "path": path, "cell": f'{{"v":{value}}}'}]) == (DOC, status)


def test_documents_that_are_no_json():
    for text in ("", "no", "[1", '{"a" 1}', "{", '{"a":'):
        assert subdoc.edit_text(text, [{"operation": "upsert", "path": "z", "cell": '{"v":1}'}]) == (text, "DocumentNotJsonException")
    assert subdoc.edit_text(None, [{"operation": "upsert", "path": "z", "cell": '{"v":1}'}, {"operation": "upsert", "path": "y", "cell": "{}"}]) == ('{"z":1}', None)
    assert subdoc.edit_text('{"a":[1,2]}', [{"operation": "arrayAppend", "path": "a", "cell": '{"v":[3,4]}'}]) == ('{"a":[1,2,3,4]}', None)


def test_query_strings():
    a, b, c, d = search.parse('+one -two* title:three "a Phrase"')
    assert (a.sign, a.words) == ("+", ("one",)) and (b.sign, b.prefix) == ("-", True)
    assert (c.field, c.words) == ("title", ("three",)) and d.words == ("a", "phrase")
    for wrong in ("", "***", '"open'):
        with pytest.raises(ValueError):
            search.parse(wrong)


def test_save_modes():
    assert save_operation("overwrite") == ("upsert", False)
    assert save_operation("Ignore") == ("insert", True)
    assert save_operation("error") == ("insert", False)
    for wrong in ("append", "else"):
        with pytest.raises(ValueError):
            save_operation(wrong)


def test_stream_options():
    assert cdc.stream_schema("none").names == ["id", "content", "deletion"]
    assert cdc.stream_schema("basic", False).names == ["id", "deletion", "cas", "scope", "collection"]
    assert cdc.stream_schema("full").names == ["id", "content", "deletion", "cas", "scope", "collection", "timestamp", "vbucket", "xattrs"]
    with pytest.raises(ValueError):
        cdc.stream_schema("some")
    assert cdc.collection_names("a", "b, a,,c", "d") == ["a", "b", "c"] and cdc.collection_names(implicit="d") == ["d"]
