from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leaguespark.operators import snapshot
from leaguespark.sources.versions import VersionedTable
from leaguespark.streaming import incremental

DAY = datetime(2026, 1, 1)


def arrive(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def test_latest_reads_new_captures_only_and_equals_a_full_load(spark, tmp_path):
    schema, folder, work = "k string, at long, v string, batch int", f"{tmp_path}/in", f"{tmp_path}/work"
    load = lambda where: incremental.latest(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder), ["k"], ["at"], ["v", "batch"], where)
    rest = {f"k{i}": ("same", 7) for i in range(30)}
    first = [("a", 1, "a1", 7), ("b", 5, "b5", 7), (None, 1, "n1", 7), *[(k, 1, *v) for k, v in rest.items()]]
    arrive(spark, folder, "one", first, schema)
    assert {r.k: (r.v, r.batch) for r in load(work).collect()} == {"a": ("a1", 7), "b": ("b5", 7), None: ("n1", 7)} | rest
    before = VersionedTable(spark, f"{work}/table", ["k"]).newest()
    arrive(spark, folder, "two", [("a", 2, "a2", 8), ("b", 4, "late", 8), ("c", None, "c", 8)], schema)
    found = {r.k: (r.v, r.batch) for r in load(work).collect()}
    assert found == {"a": ("a2", 8), "b": ("b5", 7), "c": ("c", 8), None: ("n1", 7)} | rest
    after = VersionedTable(spark, f"{work}/table", ["k"]).newest()
    assert after["token"] == "batch-1" and any(after["buckets"].get(b) == f for b, f in before["buckets"].items())  # what has no new key stays where it is
    assert load(work).count() == 34 and VersionedTable(spark, f"{work}/table", ["k"]).newest() == after  # nothing new, nothing written
    assert {r.k: (r.v, r.batch) for r in load(f"{tmp_path}/full").collect()} == found


def test_a_batch_that_is_sent_again_changes_nothing(spark, tmp_path, monkeypatch):
    """The commit is made, then the run is lost before its checkpoint is: the batch comes again."""
    schema, folder, work = "k string, at long, v string", f"{tmp_path}/in", f"{tmp_path}/work"
    load = lambda: incremental.latest(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder), ["k"], ["at"], ["v"], work)
    arrive(spark, folder, "one", [("a", 1, "a1")], schema)
    update = VersionedTable.update

    def lost(self, *args):
        update(self, *args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "update", lost)
        try:
            load()
            raise AssertionError("it should have been lost")
        except Exception as e:
            assert "lost" in str(e)
    table = VersionedTable(spark, f"{work}/table", ["k"])
    assert table.newest()["token"] == "batch-0"
    version = table.newest()["version"]
    assert [tuple(r) for r in load().collect()] == [("a", "a1")] and table.newest()["version"] == version


def test_source_takes_the_file_it_is_given(spark, tmp_path):
    for name in ("x.parquet", "x.parquet.bak", "xx.parquet"):
        spark.createDataFrame([(name,)], "n string").coalesce(1).write.parquet(f"{tmp_path}/made-{name}")
        next(p for p in (tmp_path / f"made-{name}").iterdir() if p.suffix == ".parquet").rename(tmp_path / name)
    out = f"{tmp_path}/out"
    incremental.run(incremental.source(spark, f"{tmp_path}/x.parquet"), out, lambda batch, n: batch.write.mode("append").parquet(f"{out}/rows"))
    assert [r.n for r in spark.read.parquet(f"{out}/rows").collect()] == ["x.parquet"]
    spark.range(2).write.parquet(f"{tmp_path}/folder")
    incremental.run(incremental.source(spark, f"{tmp_path}/folder"), f"{out}2", lambda batch, n: batch.write.mode("append").parquet(f"{out}2/rows"))
    assert spark.read.parquet(f"{out}2/rows").count() == 2


def test_state_is_bounded_and_late_rows_are_counted(spark, tmp_path):
    schema, folder, work = "k int, at timestamp, batch string", f"{tmp_path}/in", f"{tmp_path}/work"
    read = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    late = []
    for day in range(0, 300, 20):  # fifteen runs, each with a hundred new keys
        arrive(spark, folder, f"d{day}", [(day * 100 + i, DAY + timedelta(days=day), "mine") for i in range(100)], schema)
        rows, n = incremental.ingest_counted(read(), ["k"], work, "at")
        late.append(n)
    assert rows.count() == 1500 and sum(late) == 0 and set(rows.columns) == {"k", "at", "batch"}
    newest = DAY + timedelta(days=280)
    arrive(spark, folder, "limit", [(-1, newest - timedelta(days=59), "in time"), (-2, newest - timedelta(days=62), "too late"), (28000, newest, "again")], schema)
    query_rows, n = incremental.ingest_counted(read(), ["k"], work, "at")
    assert n == 1 and {r.k for r in query_rows.filter("k < 0").collect()} == {-1} and query_rows.count() == 1501
    once = read().withWatermark("at", "60 days").dropDuplicatesWithinWatermark(["k"])
    arrive(spark, folder, "last", [(-5, newest, "x")], schema)
    query = incremental.run(once, work, lambda batch, number: batch.count())
    assert incremental.state_rows(query) <= 800  # the keys of 120 days, of 1,502


def test_late_sheets_fill_absent_scores_once(spark, tmp_path):
    schema, folder, work = "id long, s_dom int, s_ext int, at timestamp", f"{tmp_path}/in", f"{tmp_path}/work"
    sheets = lambda: spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    matchs = spark.createDataFrame([(1, None, None), (2, 5, 6), (3, None, 7), (4, None, None), (5, None, None)], "id long, score_dom int, score_ext int")
    run = lambda table: {r.id: (r.score_dom, r.score_ext) for r in incremental.fill_scores_counted(sheets(), table, work, "at")[0].collect()}
    arrive(spark, folder, "one", [(1, 7, 8, DAY), (2, 0, 0, DAY), (3, 1, None, DAY), (9, 1, 1, DAY), (5, 3, 3, DAY + timedelta(days=100))], schema)
    assert run(matchs) == {1: (7, 8), 2: (5, 6), 3: (None, 7), 4: (None, None), 5: (3, 3)}
    assert run(matchs) == {1: (7, 8), 2: (5, 6), 3: (None, 7), 4: (None, None), 5: (3, 3)}  # a run without sheets keeps what is filled
    arrive(spark, folder, "two", [(1, 9, 9, DAY + timedelta(days=99)), (4, 2, 2, DAY + timedelta(days=30)), (3, 4, 4, DAY + timedelta(days=45))], schema)
    more = matchs.unionByName(spark.createDataFrame([(6, 1, 1)], matchs.schema)).filter("id <> 5").unionByName(spark.createDataFrame([(5, 0, 0)], matchs.schema))
    found, late = incremental.fill_scores_counted(sheets(), more, work, "at")
    # Sheet 4 is 70 days older than the newest one, sheet 3 only 55; a score of another source counts, a sheet never overwrites.
    assert late == 1 and {r.id: (r.score_dom, r.score_ext) for r in found.collect()} == {1: (7, 8), 2: (5, 6), 3: (4, 4), 4: (None, None), 5: (0, 0), 6: (1, 1)}


def test_append_rows_tells_what_becomes_of_each(spark):
    schema = "i int, k string, g string"
    old = spark.createDataFrame([(1, "a", None), (2, None, None)], schema)
    batch = spark.createDataFrame([(3, "a", None), (4, "b", None), (5, "b", None), (6, None, None), (7, None, "x")], schema)
    assert {r.i: r.outcome for r in snapshot.append_rows(old, batch, ["k", "g"], ["i"]).collect()} == {3: "duplicate", 4: "inserted", 5: "duplicate", 6: "duplicate", 7: "inserted"}
    assert snapshot.append_rows(old, batch.limit(0), ["k"], ["i"]).count() == 0 and F.lit(1) is not None
