import time
from datetime import datetime, timedelta
from threading import Thread

import pytest
from pyspark.sql import functions as F

from leaguespark.operators import ledger
from leaguespark.sources.versions import VersionedTable
from leaguespark.streaming import claims, incremental, timers

T0 = datetime(2026, 1, 1, 12)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def states(entries):
    return {r.run_id: r for r in ledger.fold(entries).collect()}


def test_fold(spark):
    rows = [
        ("a", 0, at(0), "open", "load", "S", 3, None), ("a", 1, at(1), "total", "load", "S", 9, None), ("a", 2, at(2), "pages", "load", "S", 2, None), ("a", 2, at(2), "pages", "load", "S", 2, None), ("a", 3, at(3), "pages", "load", "S", 1, None),
        ("a", 4, at(4), "step", "load", "S", 1, "one"), ("a", 5, at(4), "step", "load", "S", 2, "two"), ("a", 6, at(5), "error", "load", "S", None, None), ("a", 7, at(6), "stats", "load", "S", None, "{}"), ("a", 8, at(7), "rows", "load", "S", 70, None),
        ("b", 0, at(0), "open", "x", None, None, None), ("b", 1, at(9), "success", "x", None, None, None), ("b", 2, at(9), "failed", "x", None, None, "later"), ("b", 3, at(8), "step", "x", None, 4, "four"),
        ("c", 5, at(3), "pages", None, None, None, None), (None, 0, at(0), "open", "x", None, None, None),
    ]
    found = states(spark.createDataFrame(rows, ledger.ENTRY))
    a, b, c = found["a"], found["b"], found["c"]
    assert (a.status, a.pages_total, a.pages, a.steps_total, a.step_index, a.current_step, a.errors, a.rows_read, a.stats) == ("running", 9, 3, 3, 2, "two", 1, 70, "{}")
    assert (a.started_at, a.last_activity_at, a.finished_at) == (at(0), at(5), None)  # rows and statistics are no sign of life
    assert (b.status, b.finished_at, b.error_message, b.current_step, b.step_index) == ("success", at(9), None, None, 4)
    assert (c.status, c.job, c.started_at, c.pages) == ("running", None, None, 0) and set(found) == {"a", "b", "c"}
    assert ledger.fold(spark.createDataFrame([], ledger.ENTRY)).count() == 0


def test_runs_write_what_happens(spark, tmp_path):
    log = ledger.RunLog(spark, str(tmp_path / "log"))
    with log.run("good", "S", steps=2) as run:
        run.step(1, "read")
        run.total(10)
        for _ in range(3):
            run.pages()
        counted = run.observed(spark.range(7).withColumn("v", F.col("id")), bad=F.count_if(F.col("v") > 4))
        counted.write.format("noop").mode("overwrite").save()
        assert run.measure() == {"rows": 7, "bad": 2}
        for n in range(100, 600, 100):
            run.rows(n, every=3600)  # held back, and written with the next entry
        assert log.runs().filter("job = 'good'").first().rows_read == 7
    with pytest.raises(ValueError, match="broken"):
        with log.run("bad") as run:
            run.error()
            raise ValueError("broken")
    with pytest.raises(KeyboardInterrupt):
        with log.run("cut") as run:
            run.pages(5)
            raise KeyboardInterrupt
    found = {r.job: r for r in log.runs().collect()}
    assert [(found[j].status, found[j].error_message) for j in ("good", "bad", "cut")] == [("success", None), ("failed", "broken"), ("partial", "interrompu (KeyboardInterrupt)")]
    good = found["good"]
    assert (good.pages, good.pages_total, good.rows_read, good.steps_total) == (3, 10, 500, 2) and '"bad": 2' in good.stats
    assert [(r.job, r.saison, r.since) for r in ledger.resume_points(log.runs()).collect()] == [("good", "S", good.started_at)]


def test_silent_runs_are_reaped_once(spark, tmp_path):
    log = ledger.RunLog(spark, str(tmp_path / "log"))
    rows = [("old", 0, at(0), "open", "j", None, None, None), ("alive", 0, at(0), "open", "j", None, None, None), ("alive", 1, at(110), "pages", "j", None, 1, None), ("done", 0, at(0), "open", "j", None, None, None), ("done", 1, at(1), "success", "j", None, None, None)]
    log.append(rows)
    now = F.lit(at(150))
    log.append(ledger.reap(log.runs(), now, 2))
    assert ledger.reap(log.runs(), now, 2).count() == 0
    found = {r.run_id: r for r in log.runs().collect()}
    assert (found["old"].status, found["old"].finished_at, found["alive"].status, found["done"].status) == ("failed", at(150), "running", "success")
    assert ledger.reap(log.runs(), now, 2, by="started_at").first().run_id == "alive"


def test_a_missing_sign_of_life_fires_the_timer(spark, tmp_path):
    schema, folder, work = ledger.ENTRY, f"{tmp_path}/in", f"{tmp_path}/work"
    batches = [
        [("a", 0, at(0), "open"), ("b", 0, at(0), "open"), ("c", 0, at(1), "open"), ("d", 0, at(2), "open")],
        [("a", 1, at(50), "pages"), ("b", 1, at(20), "success"), ("c", 1, at(30), "step"), (None, 0, at(0), "open")],
        [("a", 9, at(65), "pages")],
        [("a", 2, at(100), "pages"), ("d", 1, at(70), "pages"), ("c", 2, at(95), "success")],
        [("z", 0, at(161), "open")],
    ]
    lost = []
    for i, rows in enumerate(batches):
        spark.createDataFrame([(*r, "j", None, None, None) for r in rows], schema).coalesce(1).write.parquet(f"{folder}/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        incremental.run(timers.lost_runs(stream, 3600), work, lambda batch, n: lost.extend(batch.collect()))
    # d was lost when the log went past its hour, came back and was lost again; c ended in the batch that went past its hour.
    assert sorted((r.run_id, r.last_activity_at, r.lost_at) for r in lost) == [("a", at(100), at(160)), ("d", at(2), at(62)), ("d", at(70), at(130))]


def test_timers_by_the_clock(spark, tmp_path):
    """The log falls silent altogether: only the clock can tell."""
    schema, folder = ledger.ENTRY, f"{tmp_path}/in"
    spark.createDataFrame([("a", 0, at(0), "open", "j", None, None, None), ("b", 0, at(0), "open", "j", None, None, None), ("b", 1, at(1), "failed", "j", None, None, None)], schema).coalesce(1).write.parquet(f"{folder}/0")
    stream, lost = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder), []
    query = timers.lost_runs(stream, 2, by_clock=True).writeStream.foreachBatch(lambda batch, n: lost.extend(batch.collect())).option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="1 second").start()
    assert ledger.wait_for(lambda: bool(lost), 60)
    query.stop()
    assert [r.run_id for r in lost] == ["a"]


def test_pauses_grow_and_end(spark, tmp_path):
    schema, folder, work, out = "domain string, id long, at timestamp, blocked boolean", f"{tmp_path}/in", f"{tmp_path}/work", {}
    files = [[("d", 1, at(0), True), ("d", 2, at(1), True), (None, 9, at(0), None)], [("d", 3, at(2), True), ("d", 4, at(2), False), ("d", 5, at(3), True), ("e", 6, at(0), True)]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        incremental.run(timers.pauses(stream, 60, 150), work, lambda batch, n: out.update({r.id: (r.blocks, r.pause_until) for r in batch.collect()}))
    second = timedelta(seconds=1)
    assert out == {1: (1, at(0) + 60 * second), 2: (2, at(1) + 120 * second), 3: (3, at(2) + 150 * second), 4: (0, None), 5: (1, at(3) + 60 * second), 6: (1, at(0) + 60 * second), 9: (0, None)}


@pytest.fixture
def queue(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "delivered" if i == 0 else "pending", i % 2, at(i - 20), None, None, None, None) for i in range(40)]
    found = VersionedTable(spark, str(tmp_path / "queue"), ["id"], buckets=4)
    found.replace(spark.createDataFrame(rows, claims.QUEUE))
    return found


def test_claims_are_disjoint_and_come_back(spark, queue):
    active = spark.createDataFrame([("s0", True), ("s1", True), ("s2", False)], "subscription_id string, active boolean")
    taken = {}

    def worker(name):
        taken[name] = {r.id for r in claims.claim(queue, name, T0, active, limit=4).collect()}

    threads = [Thread(target=worker, args=(n,)) for n in ("w1", "w2", "w3")]
    [t.start() for t in threads]
    [t.join() for t in threads]
    every = [i for ids in taken.values() for i in ids]
    due = {i for i in range(1, 21) if i % 3 < 2}
    assert len(every) == len(set(every)) == 12 and set(every) == set(sorted(due)[:12])
    # A worker that asks again gets its claim again, not another one.
    assert {r.id for r in claims.claim(queue, "w1", T0, active, limit=4).collect()} == taken["w1"]
    # w2 is lost; its lease runs out after five minutes.
    assert not taken["w2"] & {r.id for r in claims.claim(queue, "w4", at(4), active).collect()}
    assert taken["w2"] <= {r.id for r in claims.claim(queue, "w5", at(6), active).collect()}
    # What w2 finds out after all changes nothing.
    late = spark.createDataFrame([(i, 200, None) for i in taken["w2"]], "id long, http int, error string")
    assert claims.settle(queue, "w2", late, at(7)) is None
    assert {r.status for r in queue.read().filter(F.col("id").isin(*taken["w2"])).collect()} == {"pending"}


def test_settling(spark, queue):
    claims.claim(queue, "w", T0, limit=None)
    answers = spark.createDataFrame([(1, 204, None), (2, 500, None), (3, None, "timeout"), (30, 200, None)], "id long, http int, error string")
    claims.settle(queue, "w", answers, at(1))
    claims.settle(queue, "w", answers, at(1))  # sent again
    found = {r.id: r for r in queue.read().collect()}
    assert (found[1].status, found[1].attempts, found[1].delivered_at, found[1].claim) == ("delivered", 2, at(1), None)
    assert (found[2].status, found[2].attempts, found[2].next_attempt_at, found[2].last_error) == ("pending", 1, at(2), "HTTP 500")
    assert (found[3].next_attempt_at, found[3].last_error, found[3].last_status) == (at(6), "timeout", None)
    assert found[30].status == "pending" and found[4].claim == "w"


def test_failures_in_a_row(spark):
    subscriptions = spark.createDataFrame([("a", 28, True), ("b", 29, True), ("c", 5, True), ("d", 0, False)], "subscription_id string, failures int, active boolean")
    answers = spark.createDataFrame([("a", at(1), False), ("b", at(1), False), ("c", at(1), False), ("c", at(2), True), ("c", at(3), False), ("zz", at(1), False)], "subscription_id string, at timestamp, ok boolean")
    assert {tuple(r) for r in claims.failures(subscriptions, answers).collect()} == {("a", 29, True), ("b", 30, False), ("c", 1, True), ("d", 0, False)}
    assert time.monotonic() > 0


def test_open_runs_share_states(spark, tmp_path, monkeypatch):
    """Python is called once a slot: the state has a row a slot, however many runs are open; silent entries only move the time on."""
    monkeypatch.setattr(timers, "SLOTS", 3)
    folder, lost = f"{tmp_path}/in", []
    runs = [(f"r{i}", 0, at(0), "open", "j", None, None, None) for i in range(40)] + [("r7", 1, at(1), "success", "j", None, None, None)]
    for i, rows in enumerate([runs, [("r8", 1, at(59), "rows", "j", None, None, None), ("z", 0, at(61), "rows", "j", None, None, None), ("r9", 1, at(61), "pages", "j", None, None, None)]]):
        spark.createDataFrame(rows, ledger.ENTRY).coalesce(1).write.parquet(f"{folder}/{i}")
        stream = spark.readStream.schema(ledger.ENTRY).option("recursiveFileLookup", "true").parquet(folder)
        query = incremental.run(timers.lost_runs(stream, 3600, silent=("rows",)), f"{tmp_path}/work", lambda batch, n: lost.extend(batch.collect()))
        assert incremental.state_rows(query) == (3 if i == 0 else 1)
    assert sorted((r.run_id, r.lost_at) for r in lost) == sorted((f"r{i}", at(60)) for i in range(40) if i not in (7, 9))


def test_a_log_is_sorted_once_for_both_groupings(spark):
    at = datetime(2024, 1, 1)
    rows = [("r", 0, at, "open", "job", "s", 2, None), ("r", 1, at, "pages", "job", "s", 3, None), ("r", 1, at, "pages", "job", "s", 3, None), ("r", 1 << 21, at, "pages", "job", "s", 4, None)]
    found = ledger.fold(spark.createDataFrame(rows, ledger.ENTRY))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert [(r.run_id, r.job, r.saison, r.pages, r.status) for r in found.collect()] == [("r", "job", "s", 7, "running")]
    assert text.count("Sort [") == 2 and text.count("Exchange ") == 2
