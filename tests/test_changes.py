"""Collapse and application, against step-by-step folds in Python."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import apply, batches, blocks, collapse, filters



@pytest.fixture(autouse=True)
def many_blocks(monkeypatch):
    """Small tables have one block; here they have as many as large ones."""
    monkeypatch.setattr(blocks, "ROWS_A_BLOCK", 5)


SCHEMA = "pk int, seq long, op string, diff array<string>, a int, b int, ts int"
COLS = ["a", "b", "ts"]


def feed(seed, n=400, keys=12):
    r = random.Random(seed)
    some = lambda: r.choice([None, 1, 2, 3, 4, 5, 6])
    return [(r.randrange(keys), i, r.choices(["INSERT", "UPDATE", "DELETE"], [2, 6, 1])[0], r.choice([None, [], ["a"], ["b"], ["a", "b"], ["ts", "zz"]]), some(), some(), some()) for i in range(n)]


def start(seed, keys=12):
    r = random.Random(seed)
    return [(k, r.randrange(9), None if r.random() < 0.3 else 7, r.choice([None, 2, 4])) for k in range(keys + 3) if r.random() < 0.5]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, seed):
    return spark.createDataFrame(start(seed), "pk int, a int, b int, ts int"), spark.createDataFrame(feed(seed), SCHEMA)


def fold(seed, rule):
    state = {k: {"a": a, "b": b, "ts": ts} for k, a, b, ts in start(seed)}
    for pk, _, op, diff, a, b, ts in feed(seed):
        if op == "DELETE":
            state.pop(pk, None)
        else:
            rule(state, pk, op, diff or [], {"a": a, "b": b, "ts": ts})
    return sorted(((k, v["a"], v["b"], v["ts"]) for k, v in state.items()), key=repr)


def upsert(state, pk, op, diff, new):
    if op == "UPDATE" and pk in state:
        state[pk] |= {c: new[c] for c in COLS if c in diff}
    elif pk in state:
        state[pk] |= new
    else:
        state[pk] = dict(new)


def replace(state, pk, op, diff, new):
    state[pk] = dict(new)


def coercing(state, pk, op, diff, new):
    if pk in state:
        state[pk] |= {c: new[c] for c in COLS if not diff or c in diff}
    else:
        state[pk] = new | {"a": 0 if new["a"] is None else new["a"]}


def newer(state, pk, op, diff, new):
    if pk not in state:
        state[pk] = dict(new)
    elif new["ts"] is not None and state[pk]["ts"] is not None and new["ts"] > state[pk]["ts"]:
        state[pk] |= new


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("block", [7, 1_000_000])
def test_rules_match_a_fold(spark, seed, block, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS_A_BLOCK", block)
    target, changes = frames(spark, seed)
    assert rows(apply.changed_columns_upsert(target, changes, "pk", COLS, "seq")) == fold(seed, upsert)
    assert rows(apply.replace_rows(target, changes, "pk", COLS, "seq")) == fold(seed, replace)
    assert rows(apply.coercing_merge(target, changes, "pk", COLS, "seq", {"a": 0})) == fold(seed, coercing)
    assert rows(apply.merge_if_newer(target, changes, "pk", COLS, "seq", "ts")) == fold(seed, newer)


def naive_collapse(records):
    out = []
    for pk, seq, op, diff, *values in records:
        diff = diff or []
        if op == "DELETE":
            out = [[op, list(diff), values]]
        elif op == "UPDATE" and out and out[-1][0] == "UPDATE":
            out[-1][1] += [d for d in diff if d not in out[-1][1]]
            out[-1][2] = values
        else:
            out.append([op, list(dict.fromkeys(diff)), values])
    return out


@pytest.mark.parametrize("seed", range(3))
def test_collapse_and_standard_strategy(spark, seed):
    target, changes = frames(spark, seed)
    got = collapse.collapse(changes, ["pk"], "seq", COLS)
    by_key = {}
    for r in got.orderBy("pk", "grp").collect():
        by_key.setdefault(r["pk"], []).append([r["op"], r["diff"], [r["a"], r["b"], r["ts"]]])
    events = feed(seed)
    want = {k: naive_collapse([e for e in events if e[0] == k]) for k in {e[0] for e in events}}
    assert by_key == want
    state = {k: {"a": a, "b": b, "ts": ts} for k, a, b, ts in start(seed)}
    for pk, records in want.items():
        for op, diff, values in records:
            new = dict(zip(COLS, values, strict=True))
            if op == "DELETE":
                state.pop(pk, None)
            elif op == "UPDATE":
                if pk in state:
                    state[pk] |= {c: new[c] for c in COLS if c in diff}
            else:
                newer(state, pk, op, diff, new)
    applied = apply.update_or_merge(target, got.withColumnRenamed("last_seq", "seq"), "pk", COLS, "seq", "ts")
    assert rows(applied) == sorted(((k, v["a"], v["b"], v["ts"]) for k, v in state.items()), key=repr)


def test_object_collapse_vectors(spark):
    r = [("user", "0", "UPDATE", ["name"], {"name": "Sally"}, 1), ("user", "1", "UPDATE", ["orders"], {"orders": "10"}, 2), ("user", "0", "UPDATE", ["age"], {"age": "34"}, 3),
         ("user", "1", "UPDATE", ["favoriteColor"], {"favoriteColor": "blue"}, 4), ("user", "0", "UPDATE", ["age"], {"age": "33"}, 5), ("vehicle", "0", "INSERT", None, {"vin": "x"}, 6)]
    df = spark.createDataFrame(r, "table string, id string, op string, diff array<string>, object map<string,string>, seq long")
    got = {(x["table"], x["id"]): (x["diff"], x["object"]) for x in collapse.collapse_objects(df, ["table", "id"], "seq").collect()}
    assert got == {("user", "0"): (["name", "age"], {"name": "Sally", "age": "33"}), ("user", "1"): (["orders", "favoriteColor"], {"orders": "10", "favoriteColor": "blue"}), ("vehicle", "0"): ([], {"vin": "x"})}


def test_no_list_grows_with_the_changes_of_a_key(spark):
    n = 3000
    changes = spark.range(n).selectExpr("1L as pk", "id as seq", "'UPDATE' as op", "array(if(id % 2 = 0, 'b', 'a'), 'ts') as diff", "id as a", "id * 2 as b", "id as ts", "map('a', cast(id as string), 'k' || id % 3, 'x') as object")
    got = collapse.collapse(changes, ["pk"], "seq", COLS).first()
    assert (got["op"], got["diff"], got["n"], got["first_seq"], got["last_seq"], got["a"], got["b"]) == ("UPDATE", ["b", "ts", "a"], n, 0, n - 1, n - 1, 2 * n - 2)
    objects = collapse.collapse_objects(changes, ["pk"], "seq")
    assert objects.first()["object"] == {"a": str(n - 1), "k0": "x", "k1": "x", "k2": "x"}
    target = spark.createDataFrame([(1, 5, 5, 0), (None, 7, 7, 7)], "pk long, a long, b long, ts long")
    inserts = changes.selectExpr("if(seq % 10 = 9, null, pk) as pk", "seq", "if(seq % 7 = 3, 'UPDATE', 'INSERT') as op", "diff", "a", "b", "if(seq % 7 = 3, 1, ts) as ts")
    applied = apply.update_or_merge(target, inserts, "pk", COLS, "seq", "ts")
    assert sorted(map(tuple, applied.collect()), key=repr) == sorted([(1, 2998, 5996, 2998), (None, 7, 7, 7), (None, 2999, 5978, 1)], key=repr)
    # what is collected is made of rows that are combined by name before
    for plan in (x._jdf.queryExecution().optimizedPlan().toString() for x in (collapse.collapse(changes, ["pk"], "seq", COLS), objects, applied)):
        assert "collect_list" not in plan or "_name" in plan.split("collect_list", 1)[1]


def test_sort_by_commit_time(spark):
    df = spark.createDataFrame([("1.0", "John", 1), ("3.0", "Sally", 2), ("2.0", "Tim", 3), (None, "No", 4), ("1720732611708587506.0000000001", "B", 5), ("1720732611708587506.0000000000", "A", 6)], "mvccTimestamp string, name string, n int")
    assert [r["name"] for r in collapse.sort_by_mvcc(df, "n").orderBy("seq_key").collect()] == ["No", "John", "Tim", "Sally", "A", "B"]
    assert [r["name"] for r in collapse.sort_by_mvcc(df, "n", "double").orderBy("seq_key").collect()][-2:] == ["B", "A"]


def test_delete_keys_differ(spark):
    target = spark.createDataFrame([("1",), ("gcp",)], "id string")
    gone = spark.createDataFrame([("DELETE", ["gcp", "1"]), ("UPDATE", ["x", "x"]), ("DELETE", [])], "op string, key array<string>")
    assert [r[0] for r in apply.delete_by_key(target, gone, "id", which="first").collect()] == ["1"]
    assert [r[0] for r in apply.delete_by_key(target, gone, "id", which="last").collect()] == ["gcp"]


def test_seen_inserts(spark):
    hour = lambda h: f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00"
    r = [("t", "1", "INSERT", 0, hour(0)), ("t", "1", "INSERT", 0, hour(0)), ("t", "1", "INSERT", 1, hour(5)), ("t", "1", "DELETE", 2, hour(6)), ("t", "1", "INSERT", 2, hour(6)), ("t", "1", "INSERT", 3, hour(7)), ("t", "2", "INSERT", 0, hour(0)), ("t", "2", "INSERT", 4, hour(30))]
    df = spark.createDataFrame(r, "table string, id string, op string, flush long, ts string").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("n", F.monotonically_increasing_id())
    got = [x["seen"] for x in batches.seen_insert_guard(df, "flush", "ts").orderBy("n").collect()]
    assert got == [False, False, True, False, True, False, False, False]


def test_filters(spark):
    with pytest.raises(ValueError, match="no access"):
        filters.of_tenants(spark.range(1), ["a"], ["b"])
    df = spark.createDataFrame([("UPDATE", []), ("UPDATE", None), ("UPDATE", ["updatedDate"]), ("UPDATE", ["meta", "updatedDate"]), ("UPDATE", ["meta"]), ("INSERT", [])], "op string, diff array<string>")
    assert [tuple(r) for r in filters.without_trivial_updates(df).collect()] == [("UPDATE", ["meta"]), ("INSERT", [])]
    one = spark.createDataFrame([({"id": "1", "foo": "x"}, ["id"], "UPDATE"), ({"id": "1", "foo": "x"}, ["id"], "DELETE")], "o map<string,string>, c array<string>, op string")
    assert [r[0] for r in one.select(filters.known_properties(F.col("o"), F.col("c"), F.col("op"))).collect()] == [{"id": "1"}, {"id": "1", "foo": "x"}]


@pytest.mark.parametrize("order", ["seq", "stamp", "text"])
def test_runs_of_one_hot_key_and_of_no_key(spark, order):
    """Runs, batches and gaps over blocks equal those of a walk in order; orders may be small, huge, or no numbers."""
    r = random.Random(5)
    events = [(None if r.random() < 0.3 else 1 if r.random() < 0.9 else 2, i, 10**18 + i * 7919, f"{i:05}", r.choices(["INSERT", "UPDATE", "DELETE"], [2, 9, 0.2])[0], r.choice([None, "x", "y"])) for i in range(600)]
    df = spark.createDataFrame(events, "k int, seq long, stamp long, text string, op string, v string").repartition(5)
    groups = {}
    for e in events:
        groups.setdefault(e[0], []).append(e)
    want_islands, want_runs, want_batches = set(), set(), set()
    for k, rows_ in groups.items():
        last = max((e[1] for e in rows_ if e[4] == "DELETE"), default=-1)
        grp, before = 0, None
        for e in rows_:
            if e[1] >= last:
                grp += not (e[4] == "UPDATE" and before == "UPDATE")
                before = e[4]
                want_islands.add((k, e[1], grp))
        run, value = 0, object()
        for i, e in enumerate(rows_):
            run += e[5] != value
            value = e[5]
            want_runs.add((k, e[1], run))
            want_batches.add((k, e[1], i // 7))
    assert {tuple(x) for x in collapse.islands(df, ["k"], order).select("k", "seq", "grp").collect()} == want_islands
    assert {tuple(x) for x in batches.runs(df, F.col("v"), order, ["k"]).select("k", "seq", "run").collect()} == want_runs
    assert {tuple(x) for x in batches.flush_batches(df, order, 7, ["k"]).select("k", "seq", "batch_id").collect()} == want_batches
    gaps = {tuple(x) for x in batches.sequence_gaps(df, "seq", ["k"]).select("k", "seq", "expected").collect()}
    assert gaps == {(k, b[1], a[1] + 1) for k, rows_ in groups.items() for a, b in zip(rows_, rows_[1:], strict=False) if b[1] != a[1] + 1}
    means = {(x["k"], x["seq"]): x["mean"] for x in batches.running_average(df.withColumn("n", F.lit(2)), "seq", "n", order, ["k"]).collect()}
    for k, rows_ in groups.items():
        total = 0
        for i, e in enumerate(rows_, 1):
            total += e[1]
            assert abs(means[k, e[1]] - total / (2 * i)) < 1e-9


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,10)", "double", "timestamp", "timestamp_ntz", "date", "string", "struct<a:bigint,b:string>"])
def test_blocks_are_even_whatever_the_order_is(spark, monkeypatch, kind):
    """One outlier, skewed values and any type that can be ordered leave no block above twice the mean; order is kept."""
    monkeypatch.setattr(blocks, "ROWS_A_BLOCK", 1000)
    monkeypatch.setattr(blocks, "SAMPLED", 400)
    n = "if(id = 0, 0, 1720000000 + cast(pow(id, 1.7) as bigint))"
    of = {"string": f"lpad(cast({n} as string), 12, '0')", "timestamp": f"timestamp_seconds({n})", "timestamp_ntz": f"cast(timestamp_seconds({n}) as timestamp_ntz)", "date": "date_add(date'1900-01-01', cast(if(id = 0, -400000, id * 2) as int))"}
    of["struct<a:bigint,b:string>"] = f"named_struct('a', {n}, 'b', 'x')"
    df = spark.range(20_000).selectExpr("cast(null as int) as k", f"{of.get(kind, f'cast({n} as {kind})')} as o")
    dealt = blocks.Blocks(df, ["k"], "o")
    found = dealt.rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("low"), F.max("o").alias("high")).orderBy("_block").collect()
    assert dealt.many and len(found) >= 15 and max(r["n"] for r in found) <= 2 * 20_000 / len(found)
    assert all(a["high"] < b["low"] for a, b in zip(found, found[1:], strict=False))


def test_small_tables_have_no_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS_A_BLOCK", 250_000)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("blocks", "")
    dealt = blocks.Blocks(spark.range(1000).withColumn("k", F.col("id") % 3), ["k"], "id")
    assert not dealt.many and "_block" not in dealt.rows.columns and not list(jobs.getJobIdsForGroup("blocks"))
    plan = collapse.islands(spark.range(1000).selectExpr("id % 3 as k", "id as seq", "'UPDATE' as op"), ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_standard_strategy_is_one_plan_of_the_jvm(spark):
    target, changes = frames(spark, 1)
    plan = apply.update_or_merge(target, collapse.collapse(changes, ["pk"], "seq", COLS).withColumnRenamed("last_seq", "seq"), "pk", COLS, "seq", "ts")._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "Python" not in plan


def test_large_catalogs_are_not_sent_to_all_tasks(spark, monkeypatch):
    from changeflow.operators import evolution, filters

    monkeypatch.setattr(filters, "SMALL_ROWS", 10)
    have = spark.range(300).select(F.concat(F.lit("t"), F.floor(F.col("id") / 3).cast("string")).alias("table"), F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("column"))
    schema = have.select("table", F.lit("v1").alias("version"), "column", F.lit("string").alias("type"), F.lit(None).cast("string").alias("format"), F.lit(False).alias("enum"))
    there = have.filter("table != 't5' and not (table = 't7' and column = 'c1')")
    missing = evolution.missing_columns(schema, there)
    out = evolution.add_columns(schema, missing, "postgres")
    for df, want in ((missing, [("t7", "c1")]), (evolution.missing_tables(schema, there), [("t5",)]), (out.select("table", "column"), [("t7", "c1")])):
        assert [tuple(r) for r in df.collect()] == want
    for df in (missing, evolution.missing_tables(schema, there)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
