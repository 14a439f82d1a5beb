"""Pushdown, models, files, schemas, templates, section chunks, streams' handlers."""

import io
import json
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.functions import signing
from rivulet.functions import text as text_functions
from rivulet.functions.scalar import REGISTRY as fn
from rivulet.operators import chunks, index, models, predicates, rules, schemas, shaping, vectors, windows
from rivulet.operators.predicates import Predicate
from rivulet.sources import files
from rivulet.sources.tables import decode_json, kafka_options, send_rows
from rivulet.streaming.windows import dedup_stream, fire

S = 1_000_000


def one(spark, column, **row):
    return spark.createDataFrame([row] if row else [{"_": 1}]).select(column.alias("x")).first().x


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    for p, shown in ((Predicate("value", "gt", "50"), "GreaterThan(value,50.0)"), (Predicate("user_id", "lt", "10.5"), "LessThan(user_id,11)"), (Predicate("event_type", "eq", "click"), "EqualTo(event_type,click)"), (Predicate("event_type", "startsWith", "cl"), "StringStartsWith(event_type,cl)")):
        got = predicates.filter_rows(e, [p])
        assert shown in plan(got)
        slow = e.where(predicates.evaluate(e, [p]).passed)
        assert got.count() == slow.count() > 0
    both = [Predicate("value", "gte", "90"), Predicate("user_id", "neq", "3")]
    for mode in ("and", "or"):
        assert predicates.filter_rows(e, both, mode).count() == e.where(predicates.evaluate(e, both, mode).passed).count()
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert "In(label, [1,2])" in plan(v.where(vectors.metadata_filter({"label": {"$in": [1, 2]}}, dict(v.dtypes)))).replace("In(label, [2,1])", "In(label, [1,2])")


def test_plain_and_full_filters_agree(spark):
    df = spark.createDataFrame([(None, "a", 1), (2.0, None, None), (2.5, "b", 3), (-1.0, "7", 4)], "v double, s string, n int")
    for p in [Predicate("v", o, "2") for o in ("eq", "neq", "gt", "gte", "lt", "lte")] + [Predicate("n", o, "2.5") for o in ("eq", "neq", "gt", "gte", "lt", "lte")] + [Predicate("s", o, "b") for o in ("eq", "neq", "contains", "regex")] + [Predicate("none", "eq", "1"), Predicate("s", "gt", "1"), Predicate("s", "eq", "7")]:
        for skip in (False, True):
            for mode in ("and", "or"):
                some = [p, Predicate("v", "lt", "9")]
                fast, slow = predicates.filter_rows(df, some, mode, skip), df.where(predicates.evaluate(df, some, mode, skip).passed)
                assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect())), (p, mode, skip)


def test_sliding_time_by_arrival(spark):
    rows = [("k", i, ms, v) for i, (ms, v) in enumerate([(0, 1.0), (0, 2.0), (500, 4.0), (1200, 8.0), (100, 16.0), (1600, 32.0)])]
    df = spark.createDataFrame(rows, "k string, i int, ms long, v double")
    got = {r.i: r.value_out for r in windows.sliding_time(df, 1000, "v", "k", "ms", order=["i"]).collect()}
    assert got == {0: 1.0, 1: 3.0, 2: 7.0, 3: 12.0, 4: 28.0, 5: 56.0}  # the head leaves when too old; 100 ms behind 1200 ms stays
    tied = df.where("i < 4")
    for f in ("sum", "count", "avg"):
        a, b = (sorted((r.i, r.value_out) for r in windows.sliding_time(tied, 1000, "v", "k", "ms", f, order=["i"], ascending=x).collect()) for x in (False, True))
        assert a == b


def test_state_of_windows_and_buckets(spark):
    w = windows.AnchoredWindow(windows.Settings(10_000, "sum", max_buffer=2))
    for i, v in enumerate([1.0, 2.0, 4.0]):
        w.add(i * S, v, f"m{i}")
    again = windows.AnchoredWindow(w.settings, **json.loads(json.dumps(w.saved())))
    assert (w.value(), again.value(), again.size, again.dropped) == (6.0, 6.0, 2, 1)
    assert again.add(3 * S, 9.0, "m2") is None and again.size == 2  # m2 is still held, m0 left with its value
    plain = windows.AnchoredWindow(windows.Settings(10_000, "avg"))
    for v in (1.0, 2.0, 6.0):
        plain.add(0, v)
    assert plain.value() == 3.0 and not plain.kept
    assert windows.token_bucket([0, 0, 0], 1, 1, S) == [True, True, False]
    store = windows.SeenStore(10 * S, 2)
    assert [store.add(t, i) for t, i in ((0, "a"), (1, "b"), (2, "a"), (3, "c"), (4, "a"))] == [True, True, False, True, True]
    df = spark.createDataFrame([(i, f"u{i % 3}") for i in range(9)], "n int, u string")
    kept, beyond = windows.admit_keys(df, "u", ["n"], 2)
    assert {r.u for r in kept.collect()} == {"u0", "u1"} and beyond.count() == 3


def test_smart_chunks():
    table = "<table><thead><tr><th>Property</th><th>DEV</th><th>PRD</th></tr></thead><tbody><tr><td>Host</td><td>a</td><td>-</td></tr></tbody></table>"
    form = "<table><tr><td>Name</td><td>Otto</td></tr><tr><td>Town</td><td>Ulm</td></tr></table>"
    told = "<table><thead><tr><th>Key</th><th>Notes</th></tr></thead><tbody><tr><td>k1</td><td>please fill in</td></tr></tbody></table>"
    parts = [
        {"type": "Title", "text": "Intro"}, {"type": "NarrativeText", "text": "First."}, {"type": "ListItem", "text": "point"}, {"type": "Header", "text": "skipped"},
        {"type": "Table", "text": "x", "metadata": {"text_as_html": table}}, {"type": "Table", "text": "x", "metadata": {"text_as_html": form}}, {"type": "Table", "text": "x", "metadata": {"text_as_html": told}},
        {"type": "Table", "text": "only text"}, {"type": "Title", "text": "Intro"}, {"type": "NarrativeText", "text": "a" * 1000}, {"type": "NarrativeText", "text": "b" * 1000},
    ]
    got = text_functions.smart_chunks(json.dumps(parts), "/in/spec.v2.pdf").split("\n\n")
    top = "[Document: spec.v2] [Section: Intro]\n"
    assert got == [
        "[Document: spec.v2]\nSection heading: Intro", top + "First.\n• point", top + "Host (DEV): a", top + "Form fields:\n- Name: Otto\n- Town: Ulm", top + "Table:\nName | Otto\nTown | Ulm",
        top + "Table:\nColumns: Key\nKey: k1", top + "Table:\nonly text", top + "a" * 1000, top + "b" * 1000,
    ]
    long = {"type": "Table", "metadata": {"text_as_html": "<table>" + "".join(f"<tr><td>r{i}</td><td>{'v' * 150}</td><td>z</td></tr>" for i in range(90)) + "</table>"}}
    pieces = text_functions.smart_chunks(json.dumps([long])).split("\n\n")
    assert len(pieces) > 2 and pieces[1].startswith("Table (continued):") and all(len(p.encode()) <= 6100 for p in pieces)
    assert text_functions.smart_chunks("") == "" and text_functions.smart_chunks(None) is None and text_functions.smart_chunks("[]") == ""


def test_models(spark):
    docs = spark.createDataFrame([("a", "rivers flow to the sea\n\nbread is baked in ovens"), (None, "stars shine at night"), ("c", " ")], "id string, text string")
    store = models.ingest(docs, models.HashEmbedder(32))
    rows = {r.id: r for r in store.collect()}
    assert {"a-chunk-0", "a-chunk-1"} < set(rows) and len(rows) == 3 and all(len(r.vector) == 32 for r in rows.values())
    assert models.ingest(docs, models.HashEmbedder(32), base=store).count() == 3
    answer = models.rag(store, "bread ovens", models.HashEmbedder(32), lambda q, c: f"{q}: {len(c)}", top_k=1).first()
    assert answer.sources == ["a-chunk-1"] and "bread" in answer.context and answer.answer.startswith("bread ovens: ")
    ranked = models.rerank(store.select("id", "content"), "stars night", models.OverlapScorer(), 1).collect()
    assert [(r.content, r["rank"], r.rerank_score) for r in ranked] == [("stars shine at night", 1, 1.0)]
    tries = []

    def flaky(texts):
        tries.append(1)
        if len(tries) < 3:
            raise ConnectionError
        return texts

    assert models.with_retry(flaky, wait_s=0)(["x"]) == ["x"] and len(tries) == 3
    with pytest.raises(Exception, match="dimensions"):
        vectors.checked(store, 5).collect()
    with pytest.raises(Exception, match="needs an id"):
        vectors.checked(store.withColumn("id", F.lit(" ")), 32).collect()
    assert json.loads(vectors.format_context(store.select("id", "content", F.lit(0.5).alias("score")), "json").first().context)[0]["score"] == 0.5
    assert [r.fallback_reason for r in vectors.hybrid(store, [1.0] * 32, [], 1).collect()] == ["no query text; dense results"]


def docx(paragraphs):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>" for t in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Top</w:t></w:r></w:p>{body}</w:body></w:document>')
    return out.getvalue()


def pdf(pages):
    streams = [zlib.compress(("BT " + " T* ".join(f"({x}) Tj" for x in p) + " ET").encode()) for p in pages]
    return b"%PDF-1.4\n" + b"".join(b"1 0 obj\n<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream\nendobj\n" % (len(s), s) for s in streams)


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("plain é")
    (tmp_path / "b.docx").write_bytes(docx(["one", "two"]))
    (tmp_path / "c.pdf").write_bytes(pdf([["Head 1", "first hyphen-", "ated \\(x\\)", "foot"], ["Head 2", "second", "foot"], ["Head 3", "third", "foot"]]))
    (tmp_path / "d.doc").write_bytes(b"old")
    (tmp_path / "e.bin").write_bytes(b"\0\1")
    got = {r.name: (r.text, r.error) for r in files.read_texts(spark, str(tmp_path)).collect()}
    assert got["a.txt"] == ("plain é", None) and got["b.docx"][0] == "# Top\n\none\n\ntwo"
    assert got["c.pdf"][0] == "first hyphenated (x)\n\nsecond\n\nthird"
    assert got["d.doc"][0] is None and "not supported" in got["d.doc"][1] and "not a text" in got["e.bin"][1]


def test_schemas_both_ways():
    s = {"title": "U", "type": "object", "required": ["id"], "properties": {"id": {"type": "integer", "minimum": 1}, "n": {"type": ["string", "null"]}, "t": {"type": "array", "items": {"type": "string", "maxLength": 5}, "minItems": 2}, "d": {"type": "string", "format": "date"}, "e": {"type": "string", "enum": ["x", "y"]}}}
    back = schemas.xsd_to_json_schema(schemas.json_schema_to_xsd(s))  # two items at least must be there
    assert back["required"] == ["id", "t"] and back["properties"] == s["properties"]
    merged = schemas.xsd_to_json_schema(schemas.json_schema_to_xsd({"type": "object", "properties": {"a": {"allOf": [{"type": "string"}, {"minLength": 2}]}, "c": {"oneOf": [{"type": "string"}, {"type": "integer"}]}}}))
    assert merged["properties"]["a"] == {"type": "string", "minLength": 2} and len(merged["properties"]["c"]["oneOf"]) == 2
    xsd = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:complexType name="B"><xs:sequence><xs:element name="x" type="xs:int"/></xs:sequence></xs:complexType>
    <xs:complexType name="N"><xs:complexContent><xs:extension base="B"><xs:sequence><xs:element name="self" type="N" minOccurs="0"/></xs:sequence><xs:attribute name="k" use="required"/></xs:extension></xs:complexContent></xs:complexType>
    <xs:element name="r" type="N"/></xs:schema>"""
    js = schemas.xsd_to_json_schema(xsd)
    assert js["properties"] == {"x": {"type": "integer"}, "self": {"type": "object"}, "@k": {"type": "string"}} and set(js["required"]) == {"x", "@k"}
    assert [f["type"] for f in schemas.xsd_to_avro(xsd, optional="strict")["fields"]][0] == "long" and schemas.xsd_to_avro(xsd, optional="permissive")["fields"][0]["type"] == ["null", "long"]
    with pytest.raises(ValueError):
        schemas.xsd_to_json_schema("<xs:schema xmlns:xs='http://www.w3.org/2001/XMLSchema'/>")


def test_signature():
    # the published example of a plain GET
    got = signing.sign("GET", "https://example.amazonaws.com/", {}, b"", "AKIDEXAMPLE", "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLEKEY", "us-east-1", "service", "20150830T123600Z")
    assert got["authorization"].endswith("Signature=5fa00fa31553b73ebf1942676e86291e8372ff2a2260956d9b8aae1d763fbf31")


def test_templates_and_shapes(spark):
    t = F.col("t")
    assert one(spark, shaping.render('{{t | upper | truncate 3}} {{title .t}} {{reverse .t}} {{now | length}}', {"t": t}), t="ab cd").startswith("AB ... Ab Cd dc ba ")
    assert one(spark, shaping.render("<b>{{.t}}</b>", {"t": t}, escape=True), t="<a> & 'b'") == "<b>&lt;a&gt; &amp; &#39;b&#39;</b>"
    assert shaping.date_pattern("02 Jan 2006 15:04") == "dd MMM yyyy HH:mm"
    kinds = {'{"a": 1}': "application/json", "{x}": "text/plain", "<a/>": "application/xml", "x <html>": "text/html", "Subject: x": "message/rfc822", "# h": "text/markdown", "x": "text/plain"}
    assert {k: one(spark, shaping.content_type(t), t=k) for k in kinds} == kinds
    long = "Subject: x\nHello\nBest regards\n1. a\nA:\nB:\nC:\n" + "\n" * 15
    assert one(spark, shaping.content_flags(t)["complexity"], t=long) == "highly-complex"


def test_rule_documents(spark):
    assert [one(spark, rules.parser_of(F.col("n")), n=n) for n in ("a/b.JSON", "x.yml", "y.properties", "z.log")] == ["json", "yaml", "kv", "lines"]
    assert one(spark, rules.as_json(F.col("t"), "kv"), t="a=1\nb=2") == '{"a":"1","b":"2"}' and one(spark, rules.as_json(F.col("t"), "lines"), t="x\ny") == '["x","y"]'
    assert json.loads(one(spark, rules.as_json(F.col("t"), "yaml"), t="a: [1, {b: c}]")) == {"a": [1, {"b": "c"}]} and one(spark, rules.as_json(F.col("t"), "yaml"), t="a: [") is None
    assert one(spark, rules.xml_values(F.col("t"), "/a/b"), t="<a><b>1</b><b>2</b></a>") == ["1", "2"]
    docs = spark.createDataFrame([("d/one", '{"k": 1}'), ("d/two", "{}")], "n string, doc string")
    made = [{"id": "z", "severity": "ERROR", "message": "a|b\nc", "match": {"type": "exists", "path": "k"}}, {"id": "g", "severity": "GOOD", "match": {"type": "exists", "path": "k"}}]
    found = rules.evaluate(docs, made, "n", "doc")
    bad, good = rules.split_findings(found)
    assert (bad.count(), good.count()) == (1, 1)
    got = {r.n: r for r in rules.report(docs, found, "n").collect()}
    assert "| ERROR | z | a\\|b c |" in got["d/one"].report and "### Strengths\n\n- **g** — g\n" in got["d/one"].report and got["d/two"].report.endswith("**Info:** 0\n\n")


def test_chunks_keep_metadata(spark):
    df = spark.createDataFrame([("d", "x" * 4000 + "\n\ny", "m")], "id string, text string, meta string")
    got = chunks.chunk(df, "paragraph", keep=["meta"]).collect()
    assert [(len(r.chunk), r.meta) for r in got] == [(3500, "m"), (500, "m"), (1, "m")]


def test_handlers_and_stream_dedup(spark, tmp_path):
    df = spark.createDataFrame([(1, "closed"), (2, "late"), (3, "closed")], "n int, kind string")
    got = {}
    fire(df, {k: lambda b, k=k: got.__setitem__(k, b.count()) for k in ("closed", "late", "error", "all")})
    assert got == {"closed": 2, "late": 1, "error": 0, "all": 3}
    rows = spark.createDataFrame([(i, f"id{i % 4}", f"2024-01-01 00:00:{i:02}") for i in range(20)], "n int, id string, t string").withColumn("ts", F.col("t").cast("timestamp_ntz")).drop("t")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = dedup_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "id", "ts", 8000, "n")
    q = stream.writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)  # state timeouts keep it alive
    q.stop()
    want = {r.n for r in windows.dedup_ttl(rows, "id", "ts", 8000, ["n"]).collect()}
    assert {r.n for r in spark.table("firsts").collect()} == want == {0, 1, 2, 3, 8, 9, 10, 11, 16, 17, 18, 19}
    few = windows.dedup_ttl(rows, "id", "ts", 8000, ["n"], max_entries=2)
    assert few.count() > len(want)


def test_index(spark, tmp_path):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16))
    x = centres[rng.integers(0, 20, 1500)] + 0.3 * rng.standard_normal((1500, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(9000, None), (9001, [1.0])], "id long, vector array<double>")
    for metric in index.METRICS:
        path = str(tmp_path / metric)
        index.build(df, path, 16, metric=metric)
        q = (centres[3] + 0.1).tolist()
        exact = [r.id for r in vectors.vector_search(df.where("size(vector) = 16"), q, 10, metric=metric).collect()]
        assert [r.id for r in index.search(spark, path, q, 10, 16).collect()] == exact
        few = index.search(spark, path, q, 10, 4)
        assert len({r.id for r in few.collect()} & set(exact)) >= 9 and "PartitionFilters: [__cell" in plan(few).replace("PartitionFilters: [isnotnull(__cell", "PartitionFilters: [__cell")
    index.build(df.limit(0), str(tmp_path / "none"))


def test_dates_in_any_zone(spark):
    def seen():
        t = F.lit("2024-03-30T23:30:00Z")
        return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate([fn["datetime.startOfDay"](t), fn["datetime.quarter"](F.lit("2024-04-01")), fn["datetime.fromEpoch"](F.lit(1711841400000)), fn["datetime.addBusinessDays"](t, 1), fn["datetime.toEpoch"](F.lit("2024-03-30 23:30:00")), fn["datetime.isBefore"](F.lit("2024-03-30"), t)])]).first()

    want, zone = seen(), spark.conf.get("spark.sql.session.timeZone")
    assert want[:4] == ("2024-03-30T00:00:00Z", 2, "2024-03-30T23:30:00Z", "2024-04-01T23:30:00Z") and want[4:] == (1711841400000, True)
    try:
        for z in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert seen() == want, z
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_source_options_and_sinks(spark, tmp_path):
    assert kafka_options("h:9092", ["a", "b"], "g", True, 10, "sticky")["kafka.partition.assignment.strategy"].endswith("StickyAssignor")
    with pytest.raises(ValueError):
        kafka_options("h", [" "])
    messages = spark.createDataFrame([('{"a": 1}',), ("{oops",)], "value string")
    with pytest.raises(Exception, match="malformed"):
        decode_json(messages, "a int", on_error="retry")[0].collect()
    out = str(tmp_path)

    def keep(rows):
        with open(f"{out}/{rows[0]['n']}", "w") as f:
            f.write(json.dumps(rows))

    send_rows(spark.range(5).selectExpr("id as n", "'x' as s").coalesce(1), keep)
    assert json.loads(open(f"{out}/0").read())[4] == {"n": 4, "s": "x"}
