"""The change source: ranges of lines, offsets, redelivery; events that are set aside."""

import gzip
import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from changeflow import model
from changeflow.sinks import objects
from changeflow.sources import changes, generator
from changeflow.streaming import guard, runner


@pytest.mark.parametrize("chunk", [3, 1 << 20])
def test_a_line_is_in_one_range(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(changes, "CHUNK", chunk)
    r = random.Random(1)
    for n in range(12):
        raw = b"".join(bytes(r.choices(b"ab ", k=r.choice([0, 1, 5, 30]))) + b"\n" for _ in range(n)) + (b"last" if n % 2 else b"")
        path = str(tmp_path / "x")
        (tmp_path / "x").write_bytes(raw)
        whole = [line for line in raw.split(b"\n")[: None if n % 2 else -1]]
        for _ in range(8):
            cuts = sorted({0, len(raw), *(r.randint(0, len(raw)) for _ in range(r.randint(0, 6)))})
            found = [x for a, b in zip(cuts, cuts[1:], strict=False) for x in changes.lines(path, a, b)]
            assert [line for _, line in found] == whole
            assert all(raw[p : p + len(line)] == line for p, line in found)


def test_offsets_and_redelivery(tmp_path):
    for name, n in (("a", 10), ("b.gz", 7), ("c", 25)):
        (tmp_path / name).write_bytes(b"x" * n)
    options = {"path": str(tmp_path), "state": str(tmp_path / ".state/s.json"), "maxbytes": "12", "splitbytes": "5"}
    one = changes.ChangeReader(options)
    zero, first = one.initialOffset(), dict(one.latestOffset())
    assert first == {"file": "b.gz", "at": 7}  # a compressed file is taken whole
    assert [(p.file, p.begin, p.end, p.deliveries) for p in one.partitions(zero, first)] == [("a", 0, 5, 1), ("a", 5, 10, 1), ("b.gz", 0, None, 1)]
    assert [p.deliveries for p in one.partitions(zero, first)] == [1, 1, 1]  # planned twice in one run
    again = changes.ChangeReader(options)  # restarted before the batch was done
    assert [p.deliveries for p in again.partitions(zero, first)] == [2, 2, 2]
    second = dict(again.latestOffset())
    assert second == {"file": "c", "at": 12}
    assert [(p.begin, p.end, p.deliveries) for p in again.partitions(first, second)] == [(0, 5, 1), (5, 10, 1), (10, 12, 1)]
    last = changes.ChangeReader(options)  # goes on behind what was planned, whatever Spark asks for first
    assert [dict(last.latestOffset()) for _ in range(3)] == [{"file": "c", "at": 24}, {"file": "c", "at": 25}, {"file": "c", "at": 25}]
    assert last.partitions(second, second) == []


def event(i, table="order", **more):
    return json.dumps({"operation": "INSERT", "id": str(i), "table": table, "key": [str(i)], "modelVersion": "v1", "timestamp": i, "mvccTimestamp": str(i)} | more)


def put(tmp_path, rows):
    (tmp_path / "in").mkdir(exist_ok=True)
    for k in range(2):
        text = "".join(r + "\n" for r in rows[k::2]).encode()
        (tmp_path / f"in/{k}.ndjson{'.gz' * k}").write_bytes(gzip.compress(text) if k else text)


def test_good_bad_and_unknown_add_up(spark, tmp_path):
    rows = [event(i) for i in range(40)] + ["{half", "", "[]"] + [event(i, "ghost") for i in range(5)] + [event(9, key=[], id="")]
    put(tmp_path, rows)
    out, versions = [], spark.createDataFrame([("order", "v1")], "table string, version string")
    lines = changes.stream(spark, str(tmp_path / "in"), str(tmp_path / "s/s.json"))
    run = guard.sorting(lambda good, batch: out.extend(r["pk"] for r in good.collect()), versions, str(tmp_path / "aside"))
    runner.begin(lines, run, str(tmp_path / "c")).awaitTermination(100)
    counts = spark.read.parquet(str(tmp_path / "aside/counts")).agg(*(F.sum(c).alias(c) for c in ("good", "bad", "unknown"))).first()
    assert sorted(out, key=int) == [str(i) for i in range(40)] and tuple(counts) == (40, 4, 5)
    aside = spark.read.parquet(str(tmp_path / "aside/rows"))
    assert aside.count() + len(out) == len(rows) and {r["why"] for r in aside.collect()} == {"bad json", "no primary key", "unknown table"}
    strict = guard.sorting(lambda good, batch: out.append("applied"), versions, str(tmp_path / "strict"), strict=True)
    with pytest.raises(StreamingQueryException, match="unknown tables"):
        runner.begin(changes.stream(spark, str(tmp_path / "in"), str(tmp_path / "s2/s.json")), strict, str(tmp_path / "c2")).awaitTermination(100)
    assert "applied" not in out


def test_a_poison_event_is_set_aside_after_its_deliveries(spark, tmp_path):
    """Two runs fail, the third finds what fails and goes on; nothing else is lost, nothing comes twice."""
    put(tmp_path, [str(i) for i in range(30)])
    seen = []

    def prepare(rows):
        return rows.withColumn("n", F.when(F.col("value").isin("13", "20"), F.raise_error(F.lit("poison"))).otherwise(F.col("value")).cast("int"))

    def flush(rows, batch):
        seen.append((batch, sorted(r["n"] for r in rows.collect()), {r["deliveries"] for r in rows.collect()}))

    run = guard.guarded(prepare, flush, str(tmp_path / "aside"), tries=3)
    start = lambda: runner.begin(changes.stream(spark, str(tmp_path / "in"), str(tmp_path / "s/s.json")), run, str(tmp_path / "c")).awaitTermination(100)
    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="poison"):
            start()
    assert seen == []
    start()
    assert seen == [(0, [i for i in range(30) if i not in (13, 20)], {3})]
    assert {r["value"] for r in spark.read.parquet(str(tmp_path / "aside")).collect()} == {"13", "20"}
    (tmp_path / "in/2.ndjson").write_text("100\n101\n")
    start()
    start()  # the first run of a source that has just been started may only learn that its last batch was done
    assert [s[1] for s in seen[1:]] == [[100, 101]]


def batches_of(rows, cut=3):
    import pyarrow as pa

    return [pa.RecordBatch.from_pydict({"path": [p for p, _ in part], "value": [v for _, v in part]}) for part in (rows[i : i + cut] for i in range(0, len(rows), cut))]


def there(folder):
    return {str(f.relative_to(folder)): f.read_text() for f in folder.rglob("*") if f.is_file() and objects.HIDDEN not in f.parts}


def test_a_killed_task_leaves_nothing_that_is_seen(spark, tmp_path):
    store = objects.Store(str(tmp_path))
    writer = objects.ObjectWriter(store, "run")

    def killed():
        yield from batches_of([("a/1.json", "lost")])
        raise MemoryError

    with pytest.raises(MemoryError):
        writer.write(killed())
    kept = [writer.write(iter(batches_of([(f"a/{i}.json", f"v{i}") for i in range(k, k + 4)]))) for k in (0, 4)]
    assert there(tmp_path) == {}
    writer.commit(kept)
    assert there(tmp_path) == {} and objects.unpublished(store) == ["run"]
    first = tmp_path / objects.HIDDEN / "run" / kept[0].attempt
    (tmp_path / "a").mkdir()
    (first / "0").rename(tmp_path / "a/0.json")  # a publication that was lost after its first object
    assert objects.put(spark.createDataFrame([("b", "w"), ("a/2.json", "newer")], "path string, value string"), store) == 2
    assert there(tmp_path) == {f"a/{i}.json": f"v{i}" for i in range(8)} | {"b": "w", "a/2.json": "newer"} and objects.unpublished(store) == []


def test_errors_of_all_tasks_come_together(spark, tmp_path):
    store = objects.Store(str(tmp_path))
    (tmp_path / "keep").write_text("old")
    rows = spark.createDataFrame([(f"ok/{i}", "x") for i in range(8)] + [("../out", "x"), ("/etc/y", "x"), ("keep", "new")], "path string, value string").repartition(4)
    with pytest.raises(Exception, match="leads out") as e:
        objects.put(rows, store)
    assert "../out" in str(e.value) and "/etc/y" in str(e.value)
    assert there(tmp_path) == {"keep": "old"} and objects.unpublished(store) == []
    assert objects.put(rows.filter("path not like '%out' and path not like '/%'"), store) == 9 and there(tmp_path)["keep"] == "new"
    assert objects.put(rows.limit(0), store) == 0


def test_generated_events_don_t_depend_on_partitioning(spark):
    made = lambda rows, **more: {r["key"][0]: tuple(r) for r in generator.customer_updates(rows, "id", 3, 1_700_000_000, **more).collect()}
    whole = made(spark.range(200))
    assert made(spark.range(200).repartition(7).orderBy(F.desc("id"))) == whole and len(whole) == 200
    assert made(spark.range(50, 60)) == {k: v for k, v in whole.items() if 50 <= int(k[8:]) < 60}
    assert made(spark.range(5)) != {r["key"][0]: tuple(r) for r in generator.generate(spark, 5, 4, 1_700_000_000).collect()}
    later = generator.generate(spark, 200, 3, 1_700_000_000, shift_days=2, tenant=("c", "l"))
    decoded = model.decode(later.select(model.event_json().alias("value")))
    assert decoded.filter("error is not null").count() == 0 and {tuple(r) for r in decoded.select("companyId", "locationId", "timestamp").distinct().collect()} == {("c", "l", 1_700_172_800_000)}
    images = [json.loads(r["after"]) for r in later.collect()]
    assert 100 < sum("lastTimeOrderWorked" in i for i in images) < 180 and all(i["createdDate"] <= i.get("lastTimeOrderWorked", "9") <= "9" for i in images)
    assert all(("dotNumber" in i) == (i["customerType"] == "Fleet") for i in images)
