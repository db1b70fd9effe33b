"""The upsert as a stream: same rows as in one batch, no batch applied twice, migrations before what needs them."""

import random

import pytest
from pyspark.sql import functions as F

from changeflow.operators import apply, batches
from changeflow.sinks import buckets
from changeflow.streaming import metrics, runner, seen

from .test_changes import COLS, SCHEMA, feed, rows


def fold(target, new):
    return apply.changed_columns_upsert(target, new, "pk", COLS, "seq")


TARGET = "pk int, a int, b int, ts int"


def parts_of(spark, changes, path, n=4):
    for i in range(n):
        changes.filter(f"seq >= {i * 100} and seq < {(i + 1) * 100}").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def logged(spark, tmp_path, changes, rule=fold):
    return runner.LoggedTable(spark, str(tmp_path / "t"), TARGET, changes.schema, rule, "pk", 8)


def test_stream_equals_batch(spark, tmp_path):
    changes = spark.createDataFrame(feed(1), SCHEMA)
    table = logged(spark, tmp_path, changes)
    assert table.read().count() == 0 and table.pending() == []
    runner.start(parts_of(spark, changes, str(tmp_path / "in")), table, str(tmp_path / "c")).awaitTermination()
    empty = spark.createDataFrame([], TARGET)
    want = rows(fold(empty, changes))
    assert rows(table.read()) == want
    (stream, last), *_ = table.ledger.last().items()
    assert last >= 3 and table.ledger.entries().agg({"rows": "sum"}).first()[0] == 400
    runner.apply_batch(table, stream=stream)(changes.limit(5), last)  # a replay changes nothing
    assert rows(table.read()) == want
    at = tmp_path / f"t/changes/stream={stream}/batch={last + 1}"
    at.mkdir()  # an attempt that wrote a part and failed
    (at / "part-0.parquet").write_text("half")
    assert rows(table.read()) == want
    assert table.settle() and rows(table.read()) == want and table.pending() == []
    runner.apply_batch(table, stream=stream)(changes.filter("seq < 3"), last)  # nor does one after the batch is settled
    assert rows(table.read()) == want and table.settle() == []
    more = changes.filter("seq >= 390").withColumn("seq", changes["seq"] + 1000)
    runner.apply_batch(table, stream=stream)(more, last + 1)  # over what the failed attempt has left
    assert rows(table.read()) == rows(fold(fold(empty, changes), more))
    again = logged(spark, tmp_path, changes)  # as after a restart
    assert again.settle() and again.settle() == [] and rows(again.read()) == rows(fold(fold(empty, changes), more))


def test_two_streams_into_one_table(spark, tmp_path):
    """Each has batches from 0 on: none is taken for the other's, before and after the table is settled."""
    changes = spark.createDataFrame(feed(2), SCHEMA)
    table = logged(spark, tmp_path, changes)
    for i in (0, 1):
        stream = parts_of(spark, changes.filter(f"seq % 2 = {i}"), str(tmp_path / f"in{i}"))
        runner.start(stream, table, str(tmp_path / f"c{i}")).awaitTermination()
        if i == 0:
            table.settle()
    assert len(table.ledger.last()) == 2
    # the second stream's changes come after what the first has settled
    empty = spark.createDataFrame([], TARGET)
    assert rows(table.read()) == rows(fold(fold(empty, changes.filter("seq % 2 = 0")), changes.filter("seq % 2 = 1")))
    changes.filter("seq % 2 = 1 and seq < 50").coalesce(1).withColumn("seq", changes["seq"] + 1000).write.mode("append").parquet(str(tmp_path / "in1"))
    before = table.ledger.entries().count()
    runner.start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in1")), table, str(tmp_path / "c1")).awaitTermination()
    assert table.ledger.entries().count() == before + 1 and len(table.ledger.last()) == 2  # the same checkpoint is the same stream


def test_a_fold_that_failed_half_way_goes_on(spark, tmp_path):
    """With a rule that can't be applied twice: it counts changes."""
    changes = spark.createDataFrame([(i % 40, i, "UPDATE", [], 1, 0, 0) for i in range(200)], SCHEMA)

    def counted(old, new):
        return old.unionByName(new.select("pk", "a", "b", "ts")).groupBy("pk").agg(F.sum("a").cast("int").alias("a"), F.max("b").alias("b"), F.max("ts").alias("ts"))

    table = logged(spark, tmp_path, changes, counted)
    runner.apply_batch(table, stream="s")(changes.filter("seq < 100"), 0)
    table.settle()
    runner.apply_batch(table, stream="s")(changes.filter("seq >= 100"), 1)
    put, full = table.target._put, table.target.folded

    def half(rows_, buckets, number):  # some buckets are written, then the driver is lost
        put(full(table._changes([("s", 1)]).filter(table.target.bucket().isin(buckets[:3])), counted, buckets[:3]), buckets[:3], number)
        raise OSError("lost")

    table.target._put = half
    with pytest.raises(OSError, match="lost"):
        table.settle()
    again = logged(spark, tmp_path, changes, counted)
    assert len(again.settle()) == 8 - 3 - (8 - len(again.target.touched(changes)))
    assert rows(again.target.read()) == [(k, 5, 0, 0) for k in sorted(range(40), key=lambda k: repr((k, 5, 0, 0)))] and again.settle() == []


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    target = buckets.BucketedTarget(spark, str(tmp_path / "t"), TARGET, "pk", 16)
    target.begin(spark.range(1000).selectExpr("cast(id as int) as pk", "1 as a", "2 as b", "3 as ts"))
    files = lambda: {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    changes = spark.createDataFrame([(7, 1, "UPDATE", ["a"], 50, 0, 0), (8, 2, "DELETE", [], 0, 0, 0), (2000, 3, "INSERT", [], 5, 5, 5)], SCHEMA)
    touched = target.touched(changes)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = target.folded(changes, fold, touched)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan[: plan.index("FileScan")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in scan and "Bucketed: true" in plan  # from the join down to the target's scan
    assert target.apply(changes, fold, 1) == touched and len(touched) <= 3
    assert len(before - files()) <= 2 * len(touched) and len(before & files()) >= 13
    got = {r["pk"]: r["a"] for r in target.read().collect()}
    assert len(got) == 1000 and got[7] == 50 and got[2000] == 5 and 8 not in got
    assert target.apply(changes.withColumn("a", F.lit(99)), fold, 1) == []  # that write is done
    assert target.apply(spark.createDataFrame([(k, k, "DELETE", [], 0, 0, 0) for k in [*range(1000), 2000]], SCHEMA), fold, 2) and target.read().count() == 0
    spark.sql(f"DROP TABLE {target.name}")
    assert buckets.BucketedTarget(spark, str(tmp_path / "t"), TARGET, "pk", 16).read().count() == 0  # found again by its files


def test_seen_inserts_of_a_stream(spark, tmp_path):
    """State over restarts equals the batch form; it is in RocksDB, and its size is in the progress."""
    r = random.Random(3)
    events = [("t", str(r.randrange(12)), r.choices(["INSERT", "UPDATE", "DELETE"], [5, 3, 1])[0], i, f"2024-01-{1 + i // 60:02d} {i * 24 // 60 % 24:02d}:{i % 60:02d}:00") for i in range(240)]
    df = spark.createDataFrame(events, "table string, id string, op string, seq long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    progress = []
    for flush in range(4):
        df.filter(f"seq >= {60 * flush} and seq < {60 * flush + 60}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = seen.start(seen.with_seen(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "ts"), str(tmp_path / "out"), str(tmp_path / "c"))
        assert query.awaitTermination(120)
        progress += query.recentProgress
    want = batches.seen_insert_guard(df.withColumn("flush", (F.col("seq") / 60).cast("int")), "flush", "ts").drop("flush")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select(want.columns)) == rows(want) and got.filter("seen").count() > 20
    state = [p.stateOperators[0] for p in progress if p.stateOperators]
    assert 0 < state[-1].numRowsTotal <= 12 and "rocksdbPutCount" in state[-1].customMetrics


def test_seen_inserts_share_state_by_buckets(spark, tmp_path):
    """Many keys take few rows of state; large ids and null ones stay what they are."""
    r = random.Random(4)
    ids = [None, *[(1 << 60) + i for i in range(300)]]
    events = [("t", r.choice(ids), r.choices(["INSERT", "UPDATE", "DELETE"], [5, 3, 1])[0], i, f"2024-01-0{1 + i // 1000} 0{i // 500 % 2}:{i % 60:02d}:00") for i in range(4000)]
    df = spark.createDataFrame(events, "table string, id long, op string, seq long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for flush in range(4):
        df.filter(f"seq >= {1000 * flush} and seq < {1000 * flush + 1000}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = seen.start(seen.with_seen(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), "ts", buckets=16), str(tmp_path / "out"), str(tmp_path / "c"))
        assert query.awaitTermination(120)
    want = batches.seen_insert_guard(df.withColumn("flush", (F.col("seq") / 1000).cast("int")), "flush", "ts").drop("flush")
    got = spark.read.parquet(str(tmp_path / "out")).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.filter("seen").count() > 100
    assert 0 < [p.stateOperators[0] for p in query.recentProgress if p.stateOperators][-1].numRowsTotal <= 17


def test_seen_guard_runs_in_eight_batches():
    from changeflow.plans import streams

    assert "seq * 8 //" in streams.ORACLES["stream_seen_guard"]


def test_cuts_at_migrations(spark):
    changes = spark.createDataFrame(feed(2, 50), SCHEMA)
    plan = spark.createDataFrame([("t", "v2", 20, "add_columns", ["x"]), ("u", "v1", 35, "create", [])], "table string, version string, first_seq long, action string, columns array<string>")
    parts = runner.split_at_migrations(changes, plan, "seq")
    assert [(m, c.count()) for m, c in parts] == [([], 20), ([("t", "add_columns", ["x"])], 15), ([("u", "create", [])], 15)]
    assert [m for m, _ in runner.split_at_migrations(changes, plan.limit(0), "seq")] == [[]]


def test_migrations_come_before_what_needs_them(spark, tmp_path):
    """Parts are flushed in order, each behind its migrations, and the event that brings a version has the new columns in its diff."""
    events = spark.createDataFrame(
        [("t", "v1", 1, ["a"]), ("t", "v1", 2, ["a"]), ("t", "v2", 3, ["a"]), ("u", "v1", 4, []), ("t", "v2", 5, ["a"]), ("t", "v3", 6, None)], "table string, modelVersion string, seq long, diff array<string>"
    )
    schemas = spark.createDataFrame([("t", v, c) for v, cols in (("v1", "a"), ("v2", "abc"), ("v3", "ac")) for c in cols] + [("u", "v1", "x")], "table string, version string, column string")
    log = []
    moves = runner.Migrations(schemas, lambda *step: log.append(step), {"t": "v1"})
    runner.migrated(events, moves, lambda part, i: log.append((i, [(r["seq"], r["diff"]) for r in part.orderBy("seq").collect()])))
    assert log == [
        (0, [(1, ["a"]), (2, ["a"])]), ("t", "add_columns", ["b", "c"]), (1, [(3, ["a", "b", "c"])]), ("u", "create", []), (2, [(4, []), (5, ["a"])]), (3, [(6, None)]),
    ]
    assert moves.current == {"t": "v3", "u": "v1"}
    table = runner.LoggedTable(spark, str(tmp_path / "t"), "id long", events.schema, lambda old, new: old, "id", 2)
    moves.current = {"t": "v1"}
    runner.apply_batch(table, moves, "s")(events, 0)
    moves.current = {"t": "v1"}  # as after a restart
    log.clear()
    runner.apply_batch(table, moves, "s")(events.filter("seq > 5"), 1)
    assert moves.current == {"t": "v3", "u": "v1"} and not log
    log.clear()
    runner.migrated(events, moves, lambda part, i: log.append(i))
    assert not any(isinstance(x, tuple) and x[1] == "create" for x in log)


def test_progress_of_a_stream(spark, tmp_path):
    import time

    changes = spark.createDataFrame(feed(3, 60), SCHEMA)
    changes.write.parquet(str(tmp_path / "in"))
    seen = metrics.Progress()
    spark.streams.addListener(seen)
    try:
        table = logged(spark, tmp_path, changes)
        runner.start(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), table, str(tmp_path / "c")).awaitTermination()
        until = time.time() + 30
        while not sum(r[3] for r in seen.rows) and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    got = seen.frame(spark)
    assert got.agg({"events": "sum"}).first()[0] == 60 and got.filter("seconds > 0").count() > 0
    sums = batches.histogram(got, "events", batches.FLUSH_COUNTS, ["query"]).filter("le = 100").first()
    assert sums["n"] == sums["count"]
