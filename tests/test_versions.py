import pytest
from pyspark.sql import functions as F

from leaguespark.sources.versions import Conflict, VersionedTable

SCHEMA = "id long, name string, score int, seen timestamp"


@pytest.fixture
def table(spark, tmp_path):
    found = VersionedTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    found.replace(spark.createDataFrame([(i, f"n{i}", i, None) for i in range(20)], SCHEMA), token="first")
    return found


def rows(df):
    return {r.id: (r.name, r.score) for r in df.collect()}


def test_versions_are_whole_and_old_ones_stay_readable(spark, table):
    new = spark.createDataFrame([(3, None, 30), (50, "new", 5), (4, "four", None)], "id long, name string, score int")
    assert table.merge(new, overwrite=["score"], coalesce=["name"]) == 1
    assert rows(table.read(0))[3] == ("n3", 3)
    found = rows(table.read())
    assert found[3] == ("n3", 30) and found[50] == ("new", 5) and found[4] == ("four", None) and len(found) == 21
    assert table.read().schema.simpleString() == "struct<id:bigint,name:string,score:int,seen:timestamp>"


def test_only_touched_buckets_are_written(spark, table):
    before = table.newest()["buckets"]
    touched = str(spark.createDataFrame([(3,)], "id long").select(table.bucket()).first()[0])
    table.append(spark.createDataFrame([(3, "ignored", 0, None)], SCHEMA))
    after = table.newest()["buckets"]
    assert {b for b in after if after[b] != before[b]} == {touched}


def test_a_lost_writer_leaves_the_version_before(spark, table, monkeypatch):
    """Killed between writing the rows and publishing them."""
    new = spark.createDataFrame([(99, "x", 1, None)], SCHEMA)

    def lost(self, manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", lost)
        with pytest.raises(KeyboardInterrupt):
            table.append(new, token="b1")
    assert table.versions() == [0] and 99 not in rows(table.read())
    assert table.append(new, token="b1") == 1 and rows(table.read())[99] == ("x", 1)
    gone = table.drop_old(keep=1, older_than_ms=-1)
    assert gone and table.versions() == [1] and len(rows(table.read())) == 21


def test_a_draft_that_was_never_renamed_is_no_version(spark, table):
    table._write("versions/.half", '{"version":')
    assert table.versions() == [0] and len(rows(table.read())) == 20


def test_tokens_are_committed_once(spark, table):
    more = spark.createDataFrame([(1, 1)], "id long, score int")
    for _ in range(3):
        assert table.merge(more, token="batch-7", increments={"score": 10}) == 1
    assert rows(table.read())[1] == ("n1", 11)
    assert table.replace(more, token="first") == 0


def test_two_writers(spark, table, monkeypatch):
    """The second to publish fails, or starts anew over the first one's rows."""
    before = table.newest()
    table.append(spark.createDataFrame([(60, "a", 1, None)], SCHEMA))
    with pytest.raises(Conflict):
        table._commit(table.read(0), before, {}, None)
    stale, real = [before], VersionedTable.newest
    monkeypatch.setattr(VersionedTable, "newest", lambda self: stale.pop() if stale else real(self))
    table.append(spark.createDataFrame([(61, "b", 1, None)], SCHEMA))
    assert {60, 61} <= set(rows(table.read()))


def test_null_keys_empty_batches_and_deletes(spark, table):
    table.append(spark.createDataFrame([(None, "null", 1, None), (None, "null", 1, None)], SCHEMA))
    assert sum(r.id is None for r in table.read().collect()) == 1
    count = table.read().count()
    table.append(spark.createDataFrame([], SCHEMA))
    assert table.read().count() == count
    everything = table.read().select("id")
    table.delete(everything.filter("id IS NOT NULL"))
    assert [r.id for r in table.read().collect()] == [None]
    with pytest.raises(ValueError):
        VersionedTable(spark, table.path + "x", ["id"]).read()
    assert not VersionedTable(spark, table.path + "x", ["id"]).exists() and F.lit(1) is not None
