import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from rivulet.functions import text as text_functions
from rivulet.functions.scalar import REGISTRY as fn
from rivulet.operators import chunks, rules, schemas, shaping, vectors
from rivulet.operators.predicates import Predicate, Route, filter_rows, split
from rivulet.sources.tables import Collections, decode_json


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("x")).first().x


def test_predicates(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "id int, s string")
    got = {r.id: (r.outcome, r.reason, r.eval_error) for r in filter_rows(df, [Predicate("s", "gt", "3")], keep_all=True).collect()}
    assert got[1][0] == "pass" and got[2][0] == "evalError" and got[3] == ("blocked", 'field "s" not found', "")
    assert filter_rows(df, [Predicate("s", "gt", "3"), Predicate("id", "lt", "9")], pass_missing=True).count() == 2
    assert filter_rows(df, [], "or").count() == 3
    assert [r.id for r in filter_rows(df, [Predicate("s", "eq", "5.0")]).collect()] == [1]
    both = filter_rows(df, [Predicate("id", "gt", "7"), Predicate("s", "contains", "y")], "or", keep_all=True).where("id = 2").first()
    assert both.reason == '2.0000 is not > 7.0000; "x" does not contain "y"'
    for bad in (("", "eq", "1"), ("a", "near", "1"), ("a", "regex", "(?=x)")):
        with pytest.raises(ValueError):
            Predicate(*bad)


def test_routes(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x")], "id int, s string")
    routes = [Route("n", (Predicate("s", "gt", "3"),), priority=1), Route("all_rest", (Predicate("id", "gt", "0"),), priority=2)]
    assert sorted((r.id, r.route) for r in split(df, routes).collect()) == [(1, "n"), (2, "all_rest"), (2, "evalError")]
    assert sorted((r.id, r.route) for r in split(df, routes[:1], tap=True).collect()) == [(1, "all"), (1, "n"), (2, "all"), (2, "evalError"), (2, "unmatched")]


@pytest.mark.parametrize(
    ("name", "args", "want"),
    [
        ("string.padLeft", ("abc", 5, "xy"), "xxabc"), ("string.padLeft", ("abcdef", 3), "abcdef"), ("string.mask", ("4111222233", 2, 2), "41******33"), ("string.mask", ("ab", 1, 1), "ab"),
        ("string.truncate", ("hello world", 8), "hello..."), ("string.truncate", ("hello", 2), ".."), ("string.isBlank", (" \n\t",), True), ("string.isNumeric", ("-1.5",), True), ("string.isNumeric", ("1e5",), False),
        ("string.camelCase", ("hello world_foo-bar",), "helloWorldFooBar"), ("string.snakeCase", ("helloWorldFoo",), "hello_world_foo"), ("string.regexExtract", ("id=42", "id=(\\d+)"), "42"),
        ("util.base64UrlEncode", ("a?>b" * 30,), None), ("datetime.addBusinessDays", ("2024-01-05", 1), "2024-01-08T00:00:00Z"), ("datetime.addBusinessDays", ("2024-01-08", -1), "2024-01-05T00:00:00Z"),
        ("datetime.addBusinessDays", ("2024-01-06", 1), "2024-01-08T00:00:00Z"), ("datetime.addBusinessDays", ("2024-01-07", -1), "2024-01-05T00:00:00Z"), ("datetime.addBusinessDays", ("2024-01-03", 8), "2024-01-15T00:00:00Z"),
        ("datetime.quarter", ("2024-05-01T00:00:00Z",), 2), ("datetime.isWeekend", ("2024-01-06T23:00:00-05:00",), True), ("math.sign", (-3.0,), -1.0),
    ],
)
def test_functions(spark, name, args, want):
    got = one(spark, fn[name](F.lit(args[0]), *args[1:]))
    if name == "util.base64UrlEncode":
        import base64

        want = base64.urlsafe_b64encode(args[0].encode()).decode().rstrip("=")
    assert got == want


def test_array_functions_and_errors(spark):
    assert one(spark, fn["array.sort"](F.col("a")), a=["10", "9", "1"]) == ["1", "9", "10"]
    assert one(spark, fn["array.sort"](F.col("a")), a=["10", "9", "x"]) == ["10", "9", "x"]
    assert one(spark, fn["array.unique"](F.col("a")), a=[1, 2, 1]) == ["1", "2"]
    assert one(spark, fn["util.hmacSha256"](F.col("m"), "k" * 80), m="hi") == hmac.new(b"k" * 80, b"hi", hashlib.sha256).hexdigest()
    for bad in (fn["math.sqrt"](F.lit(-1)), fn["math.log"](F.lit(0)), fn["array.min"](F.array(F.lit("x")))):
        with pytest.raises(Exception, match="negative|positive|numbers"):
            one(spark, bad)


def test_clean_text_and_elements(spark):
    t = "A &amp;lt; b&#160;\x00\nmail me@x.org\nhttps://x.y/z\n\n\n\nBC\n\n7.5.0\n\nthis line is far longer than twenty bytes"
    assert one(spark, fn["text.cleanText"](F.col("t")), t=t) == "A &lt; b\nmail [email] BC\n\n7.5.0\n\nthis line is far longer than twenty bytes"
    e = '[{"type":"Title","text":"T"},{"type":"Footer","text":"f"},{"type":"Table","text":"x","metadata":{"text_as_html":"<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>"}}]'
    assert text_functions.parse_elements(e) == "T\n\na: 1 | b: 2"


def test_chunks(spark):
    assert one(spark, chunks.fixed(F.col("t"), 4, 1), t="abcdefghij") == ["abcd", "defg", "ghij"]
    assert one(spark, chunks.paragraphs(F.col("t")), t="a\r\n\r\nb\n\n\n\nc") == ["a", "b", "c"]
    assert one(spark, chunks.headings(F.col("t")), t="pre\n# A\nx\n## B\ny") == ["pre", "# A\nx", "## B\ny"]
    assert chunks.pack_sentences("One. Two! Three?  Four", 9) == ["One. Two!", "Three?", "Four"]
    df = spark.createDataFrame([("d", "x" * 8000)], "id string, text string")
    assert [r.chunk_id for r in chunks.chunk(df, "paragraph").collect()] == ["d-chunk-0", "d-chunk-1", "d-chunk-2"]
    with pytest.raises(ValueError):
        chunks.chunk(df, "fixed", size=5, overlap=5)


def test_rules(spark, tmp_path):
    (tmp_path / "r.yaml").write_text("- {id: a, severity: ERROR, message: 'no handler in {{.id}}', scope: '$.resources', match: {type: missing, path: handler}}\n- {id: a, severity: INFO, match: {type: exists}}\n")
    (tmp_path / "bad.yaml").write_text("id: b\n")
    found, warnings = rules.load_rules(str(tmp_path))
    assert [r["id"] for r in found] == ["a"] and len(warnings) == 2
    df = spark.createDataFrame([("f", '{"resources":[{"id":"x"},{"id":"y","handler":"h"}],"tags":["p","p"],"headers":{"Authorization":"abc"},"n":"q"}')], "name string, doc string")
    more = [
        {"id": "dup", "severity": "WARNING", "match": {"type": "duplicate_values", "path": "tags"}}, {"id": "cred", "severity": "ERROR", "match": {"type": "credential_header_literal", "path": "headers"}},
        {"id": "num", "severity": "ERROR", "match": {"type": "greater_than", "path": "n", "value": 1}}, {"id": "none", "severity": "GOOD", "match": {"type": "none_contain", "path": "headers", "keys": ["cookie"]}},
        {"id": "cnt", "severity": "INFO", "match": {"type": "count_exceeds", "path": "tags", "value": 1}}, {"id": "empty", "severity": "INFO", "match": {"type": "none_of", "conditions": []}},
    ]
    got = {(r.rule_id, r.severity, r.message) for r in rules.evaluate(df, found + more, "name", "doc").collect()}
    assert got == {("a", "ERROR", "no handler in x"), ("dup", "WARNING", "dup"), ("cred", "ERROR", "cred"), ("num", "INFO", "rule num could not be evaluated"), ("none", "GOOD", "none"), ("cnt", "INFO", "cnt")}
    assert one(spark, rules.key_values(F.col("t")), t="a = 1\n# c\n\nb=x=y\na=2") == {"b": "x=y", "a": "2"}


def test_shaping(spark):
    m = F.create_map(F.lit("a"), F.lit('x "y"'), F.lit("b"), F.lit(""))
    assert one(spark, shaping.logfmt(m)) == 'a="x \\"y\\"" b=""'
    assert one(spark, shaping.mask_fields(m, ["A"], partial=True)) == {"a": "x \"***", "b": ""}
    assert one(spark, shaping.xml_filter(F.col("x"), ["/a/b", "/a/c"], "or"), x="<a><b/></a>") == "<a><b/></a>"
    assert one(spark, shaping.used_variables(F.col("t")), t="{{.a}} {{b}} {{a}}") == ["a", "b"]
    assert one(spark, shaping.content_flags(F.col("t"))["complexity"], t="Subject: hi\nDear x\n- a\n1. b\nRest:") == "moderate"


def test_schemas():
    avro = {"type": "record", "name": "U", "fields": [{"name": "id", "type": "long"}, {"name": "e", "type": ["null", "string"], "default": None}, {"name": "t", "type": {"type": "array", "items": "string"}}]}
    js = schemas.avro_to_json_schema(avro)
    assert js == {"type": "object", "properties": {"id": {"type": "integer"}, "e": {"type": "string"}, "t": {"type": "array", "items": {"type": "string"}}}, "title": "U", "required": ["id", "t"]}
    back = schemas.json_schema_to_avro(js)
    assert back["fields"][0] == {"name": "id", "type": "long"} and back["fields"][1]["type"] == ["null", "string"]
    assert schemas.json_schema_to_spark(js).simpleString() == "struct<id:bigint,e:string,t:array<string>>"
    assert '<xs:element name="e" type="xs:string" minOccurs="0"/>' in schemas.avro_to_xsd(avro)


def test_vectors_and_collections(spark, tmp_path):
    df = spark.createDataFrame([("a", [1.0, 0.0], "x", 1), ("b", [0.0, 1.0], "y", 2), ("c", [1.0, 1.0], "y", 3)], "id string, vector array<double>, kind string, n int")
    assert [r.id for r in vectors.vector_search(df, [1.0, 0.1], 2).collect()] == ["a", "c"]
    assert [r.id for r in vectors.vector_search(df, [1.0, 0.1], 3, filters={"kind": "y", "n": {"$gt": 2}}).collect()] == ["c"]
    assert vectors.delete(df, "id").count() == 3 and vectors.delete(df, "id", ["a"]).count() == 2
    store = Collections(spark, str(tmp_path / "c"))
    store.create("v", 2)
    store.write("v", df)
    store.write("v", df.where("id <> 'a'"))
    assert store.names() == ["v"] and store.read("v").count() == 2
    with pytest.raises(Exception, match="dimensions"):
        store.write("v", df.withColumn("vector", F.array(F.lit(1.0))))
    store.drop("v")
    assert not store.exists("v")


def test_malformed_messages(spark):
    good, bad = decode_json(spark.createDataFrame([('{"a": 1}',), ("{oops",)], "value string"), "a int")
    assert [r.a for r in good.collect()] == [1] and bad.count() == 1


def test_delete_keeps_null_ids_and_values_keep_their_digits(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "id string, n int")
    assert sorted(r.n for r in vectors.delete(df, "id", ["a"]).collect()) == [2, 3]
    assert one(spark, rules.key_values(F.col("t")), t="x = 01\n b = 21 ") == {"x": "01", "b": "21"}
