"""Vectors of names, hashes, quoting, snapshots, events and validation."""

import json

import pytest
from pyspark.sql import functions as F

from changeflow import model
from changeflow.functions import hashing, masking, naming, quoting
from changeflow.operators import apply, evolution, imports
from changeflow.operators.validate import Rules
from changeflow.plans import schemas
from changeflow.sinks import destinations, objects
from changeflow.sources import catalog, feed, registry, snapshot


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values()) or (0,)], list(values) or ["x"]) if None not in values.values() else spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("y")).first()["y"]


def test_hashes(spark):
    # fixed values: what must come out whoever computes it
    for text, want in (("", "ef46db3751d8e999"), ("hello", "26c7827d889f6da3"), ("hello42true", "d481b75d0fa4abff"), ("hello42true<nil>", "a668199a6b3fc355"), ("<nil>", "7c5b4e400f80bf7c")):
        assert one(spark, hashing.hash64(F.col("t")), t=text) == want
    rows = spark.createDataFrame([(t,) for t in ("", "a.b.c", "order.NONE.NONE.1", "é")], "k string")
    placed = hashing.with_kafka_partition(rows, F.col("k"), 7).withColumn("want", hashing.modulo(hashing.hash64(F.col("k")), 7)).collect()
    assert all(r["partition"] == r["want"] for r in placed)
    for text, n, want in (("", 10, 1), ("1", 1, 0), ("1", 2, 0), ("1", 3, 1), ("1 2 3 4", 10, 5)):
        assert one(spark, hashing.modulo(F.col("t"), n), t=text) == want


def test_names(spark):
    key = lambda prefix, path=None: naming.object_key(prefix, F.lit("table"), F.lit(500_000_000), F.lit("pk"), F.lit(path) if path else None)
    assert one(spark, key("withprefix/", "a/b/c")) == "withprefix/a/b/c"
    assert one(spark, key("withprefix/")) == "withprefix/table/500000-pk.json"
    assert one(spark, key("")) == "table/500000-pk.json"
    assert one(spark, naming.seconds(F.lit(-1))) == -1
    for mail, want in (("user@example.com", "us**@exa****.com"), ("another.user@example.com", "anothe******@exa****.com"), ("hello", "hello")):
        assert one(spark, naming.mask_email(F.col("m")), m=mail) == want


def test_quoting(spark):
    q = lambda f, t: one(spark, f(F.col("t")), t=t)
    assert q(quoting.quote_postgres, "plain") == "'plain'" and q(quoting.quote_postgres, "it's") == "$_H_$it's$_H_$" and q(quoting.quote_postgres, None) == "null" and q(quoting.quote_postgres, "a\x00b") == "'ab'"
    assert q(quoting.quote_mysql, "2024-01-02T03:04:05.120Z") == "'2024-01-02 03:04:05.12'" and q(quoting.quote_mysql, "a'b\\") == "'a\\'b\\\\'"
    assert q(quoting.quote_sqlserver, '{"a":"b"}') == "'{\\\"a\\\":\\\"b\\\"}'" and q(quoting.quote_sqlserver, "it's") == "'it''s'"
    assert q(quoting.quote_snowflake, "NULL") == "NULL" and q(quoting.quote_snowflake, "a'\\") == "'a''\\\\'"
    assert one(spark, quoting.number_text(F.col("x")), x=1e6) == "1000000" and one(spark, quoting.number_text(F.col("x")), x=1.5) == "1.5"


def test_snapshot_names(spark):
    # fixed values: the form of a file's name and the time in it
    good = snapshot.parse_name(F.lit("202407242003015854988560000000000-a-1-2-00f-labor_rate-14a.ndjson.gz"))
    r = one(spark, good)
    assert (r["table"], r["ns"]) == ("labor_rate", 1721851381585498856)
    assert one(spark, snapshot.parse_name(F.lit("notes.txt"))) is None
    assert one(spark, snapshot.parse_name(F.lit("202413992003015854988560000000000-a-1-2-00f-x-1.ndjson.gz"))) is None


def test_snapshot_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "202407242003015854988560000000000-a-1-2-00f-user-2.ndjson.gz", "wt") as f:
        f.write('{"id":"1","Name":"A","companyId":"c","locationId":null}\n{"id":"2","age":"x"}\n')
    (tmp_path / ".DS_Store").write_text("x")
    versions = spark.createDataFrame([("user", "v9")], "table string, version string")
    e = snapshot.to_events(snapshot.scan(spark, str(tmp_path)), versions)
    got = [(r["key"], r["modelVersion"], r["companyId"], r["locationId"], r["timestamp"], r["imported"]) for r in e.orderBy("key").collect()]
    assert got == [(["1"], "v9", "c", None, 1721851381585, True), (["2"], "v9", None, None, 1721851381585, True)]
    assert snapshot.to_events(snapshot.scan(spark, str(tmp_path)), versions, legacy_tenant=True).filter("locationId = 'c'").count() == 1
    assert [tuple(r) for r in snapshot.typed_rows(e, {"id": "int", "name": "string", "age": "int"}).orderBy("id").collect()] == [(1, "A", None), (2, None, None)]
    assert snapshot.unknown_tables(e, versions.filter("false")).count() == 1


def test_events(spark):
    lines = [
        json.dumps({"operation": "UPDATE", "id": "e", "table": "order", "key": ["r", "7"], "after": '{"id":"9","x":null}', "before": '{"id":"8"}', "diff": [], "timestamp": 5, "mvccTimestamp": "1.0", "region": "gone"}),
        json.dumps({"operation": "INSERT", "table": "order", "timestamp": 1, "mvccTimestamp": "1", "key": ["1"]}), json.dumps({"operation": "DELETE", "table": "order", "before": '{"id":"123"}'}),
        "{broken", json.dumps({"operation": "INSERT", "table": "t"}), json.dumps({"operation": "INSERT", "table": "t", "key": ["1"], "after": "not json"}),
    ]
    d = model.decode(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["pk"], r["error"]) for r in d] == [("7", None), ("1", None), ("123", None), ("", "bad json"), ("", "no primary key"), ("1", "bad row image")]
    assert d[0]["object"] == {"id": "9", "x": None} and d[1]["object"] is None
    text = json.loads(model.decode(spark.createDataFrame([(lines[0],)], "value string")).select(model.event_json().alias("j")).first()["j"])
    assert "diff" not in text and "region" not in text and "companyId" not in text and list(text)[:4] == ["operation", "id", "table", "key"]


@pytest.fixture
def rules(tmp_path):
    (tmp_path / "config.json").write_text(json.dumps({"labor": {"schema": "labor.json", "path": "{{.table}}/received/{{.table}}_{{.mvccTimestamp}}_{{.id}}.json"}}))
    (tmp_path / "base.json").write_text(json.dumps({"type": "object", "properties": {"operation": {"enum": ["INSERT", "UPDATE", "DELETE"]}, "locationId": {"type": "string", "minLength": 1}}, "required": ["operation", "locationId"]}))
    (tmp_path / "model.json").write_text(json.dumps({"type": "object", "properties": {"id": {"type": "string"}, "completed": {"type": "boolean"}, "startDate": {"type": "string", "format": "date-time"}}, "required": ["id", "completed", "startDate"]}))
    both = {"properties": {"before": {"$ref": "file:///model.json"}, "after": {"allOf": [{"$ref": "file:///model.json"}, {"properties": {"completed": {"const": True}}}]}, "diff": {"contains": {"anyOf": [{"const": "completed"}]}}}, "required": ["before", "after", "diff"]}
    (tmp_path / "labor.json").write_text(json.dumps({"allOf": [{"$ref": "file:///base.json"}], "properties": {"table": {"const": "labor"}}, "required": ["table"], "anyOf": [both]}))
    return Rules(str(tmp_path))


def test_validation(spark, rules):
    image = lambda done=True, date="2021-01-01T00:00:00Z": json.dumps({"id": "1", "completed": done, "startDate": date})
    rows = [
        ("UPDATE", "999", "labor", ["1"], "loc", image(False), image(), ["completed"]), ("UPDATE", "2", "labor", ["1"], "loc", image(False), image(date="x2021-01-01"), ["completed"]), ("UPDATE", "3", "labor", ["1"], "loc", image(), image(False), ["completed"]),
        ("UPDATE", "4", "labor", ["1"], "", image(), image(), ["completed"]), ("UPDATE", "5", "labor", ["1"], "loc", None, image(), ["completed"]), ("UPDATE", "6", "labor", ["1"], "loc", image(), image(), ["other"]),
        ("UPDATE", "7", "other", ["1"], "loc", image(), image(), ["completed"]), ("UPDATE", "8", "labor", ["1"], None, image(), image(), ["completed"]), ("UPDATE", "9", "labor", ["1"], "loc", "{bad", image(), ["completed"]),
    ]
    df = spark.createDataFrame(rows, "operation string, id string, table string, key array<string>, locationId string, before string, after string, diff array<string>")
    df = df.select("*", *[F.lit(None).cast("string").alias(c) for c in ("modelVersion", "companyId", "userId")], F.lit(1).cast("long").alias("timestamp"), F.lit("123456789").alias("mvccTimestamp"))
    assert [(r["id"], r["validated_path"]) for r in rules.validate(df).collect()] == [("999", "labor/received/labor_123456789_999.json")]
    for unknown in ("unevaluatedProperties", "nope", "check"):
        with pytest.raises(ValueError, match="not supported"):
            rules.check({unknown: False}, F.lit(None))


@pytest.mark.parametrize(("schema", "good", "bad"), [
    ({"pattern": "b+c"}, ['"abbcd"', "5", "null"], ['"ac"', '"BC"']), ({"maxLength": 2}, ['"éé"', "[1,2,3]"], ['"abc"']), ({"multipleOf": 0.1}, ["0.3", "7", '"x"'], ["0.25"]),
    ({"exclusiveMinimum": 1, "exclusiveMaximum": 3}, ["2", "1.5", '"0"'], ["1", "3", "4"]), ({"type": "integer"}, ["1", "2.0", "-3"], ["2.5", '"1"', "true"]), ({"type": ["null", "array"]}, ["null", "[]"], ["{}", "0"]),
    ({"minItems": 1, "maxItems": 2}, ["[1]", "[1,[2,3]]", "{}"], ["[]", "[1,2,3]"]), ({"uniqueItems": True}, ['[1,"1",true]', "[]"], ["[1,2,1]", '[{"a":1},{"a":1}]']), ({"items": {"type": "string"}}, ['["a"]', "[]", "3"], ['["a",1]']),
    ({"prefixItems": [{"const": 1}, {"type": "string"}], "items": {"type": "boolean"}}, ["[1]", '[1,"a",true]', "[]"], ["[2]", "[1,1]", '[1,"a",3]']), ({"contains": {"minimum": 5}}, ["[1,6]"], ["[1]", "[]"]),
    ({"properties": {"a": {"type": "string"}}, "additionalProperties": False}, ['{"a":"x"}', "{}", "[1]"], ['{"b":1}', '{"a":"x","c":null}', '{"a":1}']),
    ({"properties": {"a": True}, "patternProperties": {"^x-": {"type": "integer"}}, "additionalProperties": {"type": "string"}}, ['{"a":[],"x-1":5,"z":"t"}'], ['{"x-1":"5"}', '{"z":1}']),
    ({"propertyNames": {"pattern": "^[a-z]+$", "maxLength": 3}}, ['{"abc":1}', "1"], ['{"A":1}', '{"abcd":1}']), ({"minProperties": 1, "maxProperties": 2}, ['{"a":1}', "[]"], ["{}", '{"a":1,"b":2,"c":3}']),
    ({"dependentRequired": {"a": ["b", "odd name"]}}, ['{"b":1}', '{"a":1,"b":2,"odd name":3}'], ['{"a":1,"b":2}']), ({"required": ["a"]}, ['{"a":null}', "7"], ['{"b":1}']),
    ({"oneOf": [{"minimum": 5}, {"multipleOf": 2}]}, ["4", "7"], ["3", "8"]), ({"not": {"enum": [1, "a", None, {"k": [1]}]}}, ["2", '"b"', "{}"], ["1", '"a"', "null", '{"k":[1]}']),
    ({"if": {"properties": {"k": {"const": 1}}, "required": ["k"]}, "then": {"required": ["a"]}, "else": {"required": ["b"]}}, ['{"k":1,"a":2}', '{"k":2,"b":2}', '{"b":1}'], ['{"k":1,"b":2}', '{"k":2,"a":2}']),
    ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, ['"x"', "3"], ["2"]), (True, ["1"], []), ({"allOf": [False]}, [], ["1"]),
])
def test_schema_keywords(spark, schema, good, bad):
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").withColumn("v", F.parse_json("t"))
    assert {r["t"]: r["ok"] for r in df.select("t", Rules(rules={}).check(schema, F.col("v")).alias("ok")).collect()} == dict.fromkeys(good, True) | dict.fromkeys(bad, False)


def test_destinations(spark):
    assert destinations.parse("postgresql://u:p%40@h/db?sslmode=disable").options == {"url": "jdbc:postgresql://h:5432/db", "user": "u", "password": "p@", "sslmode": "disable"}
    assert destinations.parse("mssql://u:p@h:1/?database=d").options["url"] == "jdbc:sqlserver://h:1;databaseName=d"
    for bad in ("mysql://h", "kafka://h:1", "nope://x", "snowflake://u:p@h/db"):
        with pytest.raises(ValueError):
            destinations.parse(bad)


def events_of(spark, rows):
    """Decoded INSERTs from (id, table, key, milliseconds, commit time)."""
    lines = [json.dumps({"operation": "INSERT", "id": i, "table": t, "key": [k], "timestamp": ms, "mvccTimestamp": at, "companyId": "env", "after": json.dumps({"id": k, "companyId": "img", "n": i})}) for i, t, k, ms, at in rows]
    return model.decode(spark.createDataFrame([(x,) for x in lines], "value string"))


def files_below(folder):
    return {str(p.relative_to(folder)): json.loads(p.read_text())["id"] for p in sorted(folder.rglob("*")) if p.is_file()}


def test_file_destination(spark, tmp_path):
    out = tmp_path / "out"
    destinations.write(f"file://{out}", events_of(spark, [("a", "t", "1", 1000, "1"), ("b", "t", "1", 1001, "2"), ("c", "t", "2", 1000, "1"), ("d", "u", "1", 61_000, "1")]))
    assert files_below(out) == {"t/1-1.json": "b", "t/1-2.json": "c", "u/61-1.json": "d"}
    destinations.write(f"file://{out}", events_of(spark, [("e", "t", "1", 1999, "3"), ("b", "t", "1", 1001, "2"), ("f", "t", "3", 1000, "1")]))  # over what is there
    assert files_below(out) == {"t/1-1.json": "e", "t/1-2.json": "c", "t/1-3.json": "f", "u/61-1.json": "d"}
    whole = json.loads((out / "t/1-1.json").read_text())
    assert list(whole)[:3] == ["operation", "id", "table"] and whole["after"] == '{"id": "1", "companyId": "img", "n": "e"}'
    dry = destinations.write(f"file://{tmp_path}/none", events_of(spark, [("a", "t", "1", 1000, "1")]), dry_run=True)
    assert dry.select("path").first()[0] == "t/1-1.json" and not (tmp_path / "none").exists()


def test_objects_stay_below_their_root(spark, tmp_path):
    rows = spark.createDataFrame([("../x.json", "{}")], "path string, value string")
    with pytest.raises(Exception, match="leads out of the destination"):
        objects.put(rows, objects.Store(str(tmp_path / "in")))
    assert not (tmp_path / "x.json").exists()
    assert objects.put(spark.createDataFrame([(f"a/{i}.json", str(i)) for i in range(50)], "path string, value string").repartition(3), objects.Store(str(tmp_path / "in"))) == 50
    assert sorted(int(p.read_text()) for p in (tmp_path / "in/a").iterdir()) == list(range(50))


def test_object_names_below_a_prefix(spark):
    events = events_of(spark, [("a", "t", "1", 500_000_000, "1"), ("b", "t", "2", 500_000_000, "1")]).withColumn("validated_path", F.when(F.col("pk") == "2", "ok/2.json"))
    got = destinations.prepare(destinations.parse("s3://bucket/with/prefix/?region=eu-central-1"), events)
    assert {r["path"] for r in got.collect()} == {"with/prefix/t/500000-1.json", "with/prefix/ok/2.json"}


def test_event_hub_rows(spark):
    rows = destinations.write("eventhub://ns.example.net/;SharedAccessKeyName=k;SharedAccessKey=s;EntityPath=hub", events_of(spark, [("a", "t", "1", 1000, "1")]), dry_run=True).first()
    assert (rows["message_id"], rows["content_type"], rows["properties"], rows["partition_key"]) == ("a", "application/json", {"objectId": "dbchange.t.INSERT.img.NONE.1"}, "t.img.NONE.1")
    assert json.loads(bytes(rows["body"]))["id"] == "a"
    with pytest.raises(NotImplementedError, match="dry run"):
        destinations.write("eventhub://ns.example.net/;EntityPath=hub", events_of(spark, [("a", "t", "1", 1000, "1")]))


def test_kafka_rows_are_in_order(spark):
    events = events_of(spark, [(str(i), "t", str(i % 5), 1000, f"{i * 7 % 40}.0") for i in range(40)])
    got = destinations.write("kafka://h:9092/topic?partitions=3", events, dry_run=True).select("partition", F.get_json_object(F.col("value").cast("string"), "$.mvccTimestamp").cast("double").alias("at"), F.spark_partition_id().alias("task")).collect()
    last = {}
    for r in got:
        assert last.get((r["task"], r["partition"]), -1) <= r["at"]
        last[r["task"], r["partition"]] = r["at"]
    assert len(got) == 40 and {r["partition"] for r in got} <= {0, 1, 2}


def test_reachable(tmp_path):
    import socket

    with socket.create_server(("127.0.0.1", 0)) as server:
        port = server.getsockname()[1]
        assert destinations.reachable(f"kafka://127.0.0.1:{port}/t") is None and destinations.reachable(f"postgres://127.0.0.1:{port}/d") is None
    assert destinations.reachable(f"mysql://127.0.0.1:{port}/d", 1.0) is not None
    assert destinations.reachable(f"file://{tmp_path}/new") is None and destinations.reachable("file:///nowhere/at/all") is not None


def test_object_stores():
    o = lambda url: destinations.parse(url).options
    assert (o("s3://b")["bucket"], o("s3://b")["prefix"], o("s3://b")["region"], o("s3://b").get("endpoint")) == ("b", "", "us-west-2", None)
    mine = o("s3://localhost:4566/b/some/where/?region=eu-west-1&access-key-id=k&max-retries=2")
    assert mine == {"region": "eu-west-1", "access-key-id": "k", "max-retries": "2", "bucket": "b", "prefix": "some/where", "endpoint": "http://localhost:4566"}
    assert o("s3://127.0.0.1:9000/b")["endpoint"] == "http://127.0.0.1:9000"
    assert (o("s3://storage.googleapis.com/b/p/q/")["endpoint"], o("gs://b/p")["bucket"], o("gs://b/p")["endpoint"]) == ("https://storage.googleapis.com", "b", "https://storage.googleapis.com")
    with pytest.raises(ValueError, match="bucket"):
        o("s3://localhost:4566/")
    store = objects.Store("b", tuple(sorted((k, v) for k, v in mine.items() if k not in ("bucket", "prefix"))))
    assert "s3" in store.open().type_name


@pytest.mark.parametrize("scheme,values,url,wrong", [
    ("postgres", {"Hostname": "h", "Database": "d", "Username": "me", "Password": "p@s"}, "postgres://me:p%40s@h:5432/d", {}),
    ("mssql", {"Hostname": "h", "Database": "d", "Port": "1444"}, "sqlserver://h:1444/d", {}),
    ("mysql", {"Port": "x"}, None, {"Database": "is required", "Hostname": "is required", "Port": "is not a number"}),
    ("mysql", {"Hostname": "h", "Database": "d", "Port": 99_999}, None, {"Port": "is not a port"}),
    ("s3", {"Bucket": "b", "Prefix": "/p/", "Region": "eu-west-1"}, "s3://b/p?region=eu-west-1", {}),
    ("s3", {"Bucket": "b", "Endpoint": "http://localhost:4566"}, "s3://localhost:4566/b", {}),
    ("kafka", {"Hostname": "h", "Topic": "t"}, "kafka://h:9092/t", {}),
    ("snowflake", {"Hostname": "acc", "Database": "d", "Schema": "s"}, "snowflake://acc/d/s", {}),
    ("eventhub", {"Connection String": "Endpoint=sb://x/;EntityPath=h"}, "eventhub://x/;EntityPath=h", {}),
    ("eventhub", {"Connection String": "Endpoint=sb://x/"}, None, {"Connection String": "has no EntityPath"}),
    ("file", {}, None, {"Directory": "is required"}),
])
def test_forms(scheme, values, url, wrong):
    got = destinations.check(scheme, values)
    assert got == (url, wrong)
    if url:
        assert destinations.parse(url).scheme == destinations.ALIASES.get(scheme, scheme)


def test_registry(spark, tmp_path):
    doc = {"table": "order", "modelVersion": "v1", "required": ["id"], "primaryKeys": ["id"], "properties": {"id": {"type": "string"}, "status": {"type": "array", "nullable": False, "items": {"type": "string", "enum": ["a"]}}, "at": {"type": "string", "format": "date-time", "nullable": True}}}
    (tmp_path / "order.json").write_text(json.dumps(doc))
    got = {r["column"]: (r["type"], r["required"], r["is_pk"], r["enum"], r["nullable"]) for r in registry.read(spark, str(tmp_path)).collect()}
    assert got == {"id": ("string", True, True, False, False), "status": ("array", False, False, True, False), "at": ("string", False, False, False, True)}


def test_masks():
    cases = {
        "https://bob:hunter22@db.internal.test:5433/sales/eu?ssl=on&a=1&a=22": "https://b**:hunt****@db.internal.test:5433/sale****?a=1,**&ssl=o*",
        "kafka://only-host.test": "kafka://only-host.test", "mysql://u@h/": "mysql://*@h", "mysql://u@h/x": "mysql://*@h/*",
    }
    for url, want in cases.items():
        assert masking.mask_url(url) == want
    assert masking.mask_arguments(["ann.lee@mail.test", "word", "http://[bad", "abc.def-1.g_h"]) == ["ann****@ma**.test", "word", "http:******", "abc.de*******"]
    assert masking.mask_arguments(["äbc.def.ghi"]) == ["äbc.def.ghi"]


def test_small_helpers():
    import base64

    assert masking.user_text("postgres://me:p%40@h/d") == "me:p@" and masking.user_text("postgres://me@h/d") == "me" and masking.user_text("postgres://h/d") == ""
    token = ".".join(["e30", base64.urlsafe_b64encode(json.dumps({"iss": "https://old.test"}).encode()).decode().rstrip("="), "x"])
    assert masking.issuer(token) == "https://old.test" and masking.issuer(token, {"https://old.test": "https://new.test"}) == "https://new.test"
    for bad in ("", "a.b", "a.e30.c"):
        with pytest.raises(ValueError, match="issuer"):
            masking.issuer(bad)
    assert masking.file_uri("/tmp/a/../b/", "c.json") == "file:///tmp/b/c.json" and masking.file_uri("x", "y").startswith("file:///")
    assert [masking.is_localhost(h) for h in ("localhost:1", "u@127.0.0.5", "[::1]:9", "0.0.0.0", "example.com", "localhost.example.com")] == [True, True, True, True, False, False]


def test_html_in_paths(spark):
    t = naming.path_template("a/{{.x}}", F.col, html=True)
    assert one(spark, t, x="<b>&\"+'") == "a/&lt;b&gt;&amp;&#34;&#43;&#39;"


def test_migrations_on_catalog_tables(spark, tmp_path):
    schema = spark.createDataFrame(schemas.SCHEMA_ROWS, schemas.SCHEMA_DDL)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS evo LOCATION '{tmp_path}/evo'")
    try:
        old = schema.filter("table = 'order' and version = 'v1'")
        assert len(evolution.migrate(spark, "evo", old, evolution.reconcile(old, catalog.scan(spark, "evo")))) == 1
        plan = evolution.reconcile(schema.filter("not (table = 'order' and version = 'v1')"), catalog.scan(spark, "evo"))
        evolution.migrate(spark, "evo", schema, plan)
        there = {(r["table"], r["column"]): r["type"] for r in catalog.scan(spark, "evo").collect()}
        assert there[("order", "count")] == "bigint" and there[("customer", "active")] == "boolean" and [f.name for f in spark.table("evo.customer").schema][:2] == ["region", "id"]
        assert evolution.reconcile(schema, catalog.scan(spark, "evo")).count() == 0
    finally:
        spark.sql("DROP DATABASE IF EXISTS evo CASCADE")


def test_imports(spark, tmp_path):
    import gzip

    def put(name, *rows):
        with gzip.open(tmp_path / f"202407242003015854988560000000000-a-1-2-00f-{name}-2.ndjson.gz", "wt") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)

    put("order", {"id": "1", "TOTAL": 5.5, "count": 3}, {"id": "2", "createdDate": "2024-01-02T03:04:05Z"})
    put("customer", {"region": "r", "id": "9", "active": True})
    lines, schema = snapshot.scan(spark, str(tmp_path)), spark.createDataFrame(schemas.SCHEMA_ROWS, schemas.SCHEMA_DDL)
    versions = spark.createDataFrame([("order", "v2"), ("customer", "v1"), ("labor", "v1")], "table string, version string")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS imp LOCATION '{tmp_path}/imp'")
    try:
        with pytest.raises(ValueError, match="customer"):
            imports.load(spark, "imp", lines, schema, versions.filter("table <> 'customer'"))
        assert not spark.catalog.tableExists("imp.order")
        assert {tuple(r) for r in imports.load(spark, "imp", lines, schema, versions, only=["order"]).collect()} == {("order", "v2", 2)}
        assert not spark.catalog.tableExists("imp.customer")
        for _ in range(2):  # again from an empty table
            assert {tuple(r) for r in imports.load(spark, "imp", lines, schema, versions).collect()} == {("order", "v2", 2), ("customer", "v1", 1), ("labor", "v1", 0)}
        assert [(r["id"], r["total"], r["count"]) for r in spark.table("imp.order").orderBy("id").collect()] == [("1", 5.5, 3), ("2", None, None)]
    finally:
        spark.sql("DROP DATABASE IF EXISTS imp CASCADE")


def test_strategies(spark):
    target = spark.createDataFrame([(1, "a", 5)], "pk int, v string, ts int")
    records = spark.createDataFrame([(1, "UPDATE", ["v"], 1, "b", 4)], "pk int, op string, diff array<string>, seq int, v string, ts int")
    of = lambda s: apply.by_strategy(s, target, records, "pk", ["v", "ts"], "seq", "ts").first()["v"]
    assert of("") == of("standard") == "b" and of("after") == "a"
    with pytest.raises(ValueError, match="strategy"):
        of("newest")


def test_feed_files(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text(json.dumps({"operation": "INSERT", "table": "t", "key": ["1"]}) + "\n{bad\n")
    events = feed.read(spark, str(tmp_path))
    assert feed.good(events).count() == 1 and feed.bad(events).first()["error"] == "bad json"
    query = feed.stream(spark, str(tmp_path), 1).writeStream.format("memory").queryName("fed").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "_c")).start()
    query.awaitTermination()
    assert spark.table("fed").count() == 2


def test_literals_of_any_double(spark):
    """Shortest digits as Python's own, in plain and in exponent form."""
    import random
    import struct

    from changeflow.plans.schemas import _DOUBLES, _double_texts

    r = random.Random(7)
    some = [struct.unpack("d", r.randbytes(8))[0] for _ in range(6000)] + [float(f"{r.randint(1, 99)}e{r.randint(-320, 308)}") for _ in range(1500)] + [r.randint(0, 10**9) / 1000 for _ in range(500)] + _DOUBLES + [-0.0, 2e23, 2e-3]
    df = spark.createDataFrame([(x,) for x in some], "x double").select("x", quoting.number_text(F.col("x")).alias("plain"), quoting.exponent_text(F.col("x")).alias("short"))
    for r_ in df.collect():
        assert (r_["plain"], r_["short"]) == _double_texts(r_["x"]), r_["x"]


def test_typed_images(spark):
    text = '{"a":1,"b":"1","c":null,"d":true,"e":{"x":[1,2.50]},"f":1.5e-18,"g":"2024-03-05T06:07:08Z","h":12345678901234567890,"i":[]}'
    df = spark.createDataFrame([(text,)], "t string").select(model.parse_typed(F.col("t")).alias("m"))
    literal = lambda d: {c: df.select(quoting.quote_variant(F.try_element_at("m", F.lit(c)), d)).first()[0] for c in "abcdefghiz"}
    assert literal("postgres") == {"a": "1", "b": "'1'", "c": "null", "d": "true", "e": '$_H_${"x":[1,2.5]}$_H_$', "f": "0.0000000000000000015", "g": "'2024-03-05T06:07:08Z'", "h": "12345678901234567000", "i": "'[]'", "z": "null"} | {"e": literal("postgres")["e"]}
    my = literal("mysql")
    assert (my["a"], my["b"], my["d"], my["f"], my["g"], my["h"], my["z"]) == ("1", "'1'", "1", "1.5e-18", "'2024-03-05 06:07:08'", "1.2345678901234567e+19", "NULL")


def test_typed_images_keep_whole_numbers(spark):
    numbers = ["999999", "1000000", "-7000000", "9007199254740993", "9223372036854775807", "0"]
    df = spark.createDataFrame([(f'{{"n":{n}}}',) for n in numbers], "t string").select(F.try_element_at(model.parse_typed(F.col("t")), F.lit("n")).alias("n"))
    for d in quoting.DIALECTS:
        assert [r[0] for r in df.select(quoting.quote_variant(F.col("n"), d)).collect()] == numbers


def test_an_import_reads_its_files_once(spark, tmp_path):
    """However many tables there are: bytes of text that stages read are those of the files."""
    import gzip

    rows = [(f"t{i}", "v1", "id", "string", None, False, True, True, 1, False) for i in range(5)]
    for i in range(5):
        with gzip.open(tmp_path / f"202407242003015854988560000000000-s-1-2-0f-t{i}-1.ndjson.gz", "wt") as f:
            f.writelines(json.dumps({"id": f"{i}-{k}", "x": "y" * 50}) + chr(10) for k in range(2000))
    size = sum(f.stat().st_size for f in tmp_path.iterdir())
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._jvm.java.util.ArrayList
    quantiles = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = lambda: {(s.stageId(), s.attemptId()): s for s in (lambda x: [x.apply(i) for i in range(x.size())])(store.stageList(none(), False, False, quantiles, none()))}
    before = set(stages())
    spark.sql("CREATE DATABASE IF NOT EXISTS once")
    try:
        versions = spark.createDataFrame([(f"t{i}", "v1") for i in range(5)], "table string, version string")
        done = imports.load(spark, "once", snapshot.scan(spark, str(tmp_path)), spark.createDataFrame(rows, schemas.SCHEMA_DDL), versions)
        assert {(r["table"], r["rows"]) for r in done.collect()} == {(f"t{i}", 2000) for i in range(5)}
        read = [s.inputBytes() for k, s in stages().items() if k not in before and s.inputBytes() > size / 2]
        assert len(read) == 1 and abs(read[0] - size) < size / 10
        bad = spark.createDataFrame([*rows[:4], ("t4", "v1", "no column", "string", None, False, True, True, 1, False)], schemas.SCHEMA_DDL)
        assert imports.load(spark, "once", snapshot.scan(spark, str(tmp_path)), bad, versions).count() == 5
    finally:
        spark.sql("DROP DATABASE once CASCADE")


def test_mask_url_column(spark):
    """The column form and the driver's give the same."""
    urls = [
        "https://bob:hunter22@db.internal.test:5433/sales/eu?ssl=on&a=1&a=22", "kafka://only-host.test", "mysql://u@h/", "mysql://u@h/x", "HTTP://h/p#top", "s3://b/k?x=&&y", "ftp://a:b:c@d@h/%20é?q=%C3%A9+z&q=2#f?g", "http://u:@h?k=v",
    ]
    rows = spark.createDataFrame([(u,) for u in [*urls, "no url", "", None]], "u string").select("u", naming.mask_url(F.col("u")).alias("m")).collect()
    assert {r["u"]: r["m"] for r in rows} == {u: masking.mask_url(u) for u in urls} | {"no url": "no url", "": "", None: None}
