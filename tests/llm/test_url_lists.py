from datetime import datetime

from pyspark.sql import functions as F

from leaguespark.llm import queries, url_lists

DAY = lambda d, h=0: datetime(2024, 1, d, h)
ENTRIES = [
    ("bad", "x.com", True, "add", DAY(5)), ("bad", "x.com", True, "add", DAY(6)), ("bad", "x.com", True, "remove", DAY(10)), ("bad", "x.com", True, "add", DAY(20)),
    ("ok", "good.x.com", False, "add", DAY(1)), ("tie", "t.org", True, "add", DAY(3)), ("tie", "t.org", True, "remove", DAY(3)),
    ("bad", None, True, "add", DAY(1)), ("bad", "y.com", True, None, DAY(1)), ("late", "x.com", True, "remove", DAY(2)),
]


def judged(spark, captures):
    entries = spark.createDataFrame(ENTRIES, "list string, host string, blocks boolean, action string, at timestamp")
    rows = spark.createDataFrame([(i, u, t, "z") for i, (u, t) in enumerate(captures)], "page_id long, url string, fetched_at timestamp, host string")
    found = url_lists.judge(rows, entries)
    assert found.columns[:4] == rows.columns
    return {r.page_id: (r["__host"], r["__active"], r["__blocked"]) for r in found.collect()}


CAPTURES = [
    ("http://x.com/a", DAY(4, 23)), ("http://x.com/a", DAY(5)), ("https://u:p@WWW.X.com:80/q", DAY(9, 23)), ("http://x.com", DAY(10)), ("http://x.com.", DAY(25)),
    ("http://good.x.com/", DAY(6)), ("http://a.good.x.com/", DAY(6)), ("http://notx.com/", DAY(6)), ("http://t.org", DAY(3)), (None, DAY(6)), ("no url", DAY(6)), ("http://x.com/", None),
]
WANT = [("x.com", [], False), ("x.com", ["bad"], True), ("www.x.com", ["bad"], True), ("x.com", [], False), ("x.com", ["bad"], True), ("good.x.com", ["bad", "ok"], False), ("a.good.x.com", ["bad", "ok"], False), ("notx.com", [], False), ("t.org", [], False), (None, [], False), (None, [], False), ("x.com", [], False)]


def test_captures_meet_the_entries_of_their_time(spark):
    assert judged(spark, CAPTURES) == dict(enumerate(WANT))


def test_large_lists_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(url_lists, "BROADCAST_HOSTS", 0)
    assert judged(spark, CAPTURES) == dict(enumerate(WANT))


def test_empty_tables(spark):
    entries = queries.url_entries(spark)
    rows = spark.createDataFrame([(1, "http://casino-win.example.com", DAY(20))], "page_id long, url string, fetched_at timestamp")
    assert url_lists.judge(rows.limit(0), entries).count() == 0
    assert [r["__blocked"] for r in url_lists.judge(rows, entries.limit(0)).collect()] == [False]
    assert url_lists.keep_allowed(rows, entries).count() == 0 and url_lists.keep_allowed(rows, entries).columns == rows.columns
    assert url_lists.intervals(entries).filter(F.col("valid_until") <= F.col("valid_from")).isEmpty()
