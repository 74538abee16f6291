"""Capture and merge queries: latest version by key, deduplicating append, upserts, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.operators import merge, snapshot
from leaguespark.plans.base import Registry, table

_reg = Registry()
QUERIES, ORACLES = _reg.queries, _reg.oracles


def _newest() -> list[Column]:
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]


@_reg.add("S1_latest_snapshot", """
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""")  # fmt: skip
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return snapshot.latest_by_key(rows, ["user_id"], _newest()).drop("ts")


@_reg.add("S2_scan_filters", """
    SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type IN ('click', 'purchase')
""")  # fmt: skip
def scan_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    since = F.lit("2024-01-15").cast("timestamp_ntz" if dict(table(spark, sf_dir, "events").dtypes)["ts"] == "timestamp_ntz" else "timestamp")
    return snapshot.scan_filters(table(spark, sf_dir, "events"), since, ["click", "purchase"], "event_type", "ts").select("event_id", "user_id", "event_type")


@_reg.add("S3_distinct_keys", "SELECT event_type, count(DISTINCT user_id) AS keys FROM events GROUP BY event_type")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.countDistinct("user_id").alias("keys"))


@_reg.add("K1_append_dedup", """
    WITH d AS (SELECT lang, sha256(coalesce(text, '')) AS h, doc_id FROM documents),
    old AS (SELECT DISTINCT lang, h FROM d WHERE doc_id % 2 = 0),
    new AS (SELECT DISTINCT lang, h FROM d WHERE NOT coalesce(doc_id % 2 = 0, false)),
    kept AS (SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.lang = n.lang AND o.h = n.h))
    SELECT (SELECT count(*) FROM kept) AS inserted, (SELECT count(*) FROM d WHERE NOT coalesce(doc_id % 2 = 0, false)) - (SELECT count(*) FROM kept) AS duplicates
""")  # fmt: skip
def append_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with even ids stand for the table, all others for the batch."""
    docs = table(spark, sf_dir, "documents").select("lang", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("hash"), "doc_id")
    return snapshot.append_outcome(docs.filter("doc_id % 2 = 0"), docs.filter("NOT coalesce(doc_id % 2 = 0, false)"), ["lang", "hash"])


@_reg.add("K1_append_rows", """
    SELECT doc_id, lang, CASE WHEN NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id % 2 = 0 AND o.lang IS NOT DISTINCT FROM d.lang AND coalesce(o.text, '') = coalesce(d.text, ''))
           AND row_number() OVER (PARTITION BY lang, coalesce(text, '') ORDER BY doc_id) = 1 THEN 'inserted' ELSE 'duplicate' END AS outcome
    FROM documents d WHERE NOT coalesce(doc_id % 2 = 0, false)
""")  # fmt: skip
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each row of the batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("hash"))
    return snapshot.append_rows(docs.filter("doc_id % 2 = 0"), docs.filter("NOT coalesce(doc_id % 2 = 0, false)"), ["lang", "hash"], ["doc_id"]).drop("hash")


@_reg.add("K3_merge_outcomes", """
    WITH old AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0),
    new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders),
    j AS (SELECT CASE WHEN o.o_orderkey IS NULL THEN 'inserted' WHEN o.o_orderstatus IS DISTINCT FROM n.status OR o.o_orderpriority IS DISTINCT FROM coalesce(n.priority, o.o_orderpriority) THEN 'updated' ELSE 'noop' END AS outcome
          FROM new n LEFT JOIN old o USING (o_orderkey))
    SELECT outcome, count(*) AS n FROM j GROUP BY outcome
""")  # fmt: skip
def merge_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    new = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 6 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    merged = merge.merge(orders.filter("o_orderkey % 2 = 0"), new, ["o_orderkey"], overwrite=["o_orderstatus"], coalesce=["o_orderpriority"])
    return merge.outcomes(merged)


@_reg.add("K5_insert_ignore", """
    SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, 'NEW' FROM customer WHERE c_custkey % 3 <> 0
""")  # fmt: skip
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return merge.insert_ignore(rows.filter("c_custkey % 3 = 0"), rows.withColumn("c_mktsegment", F.lit("NEW")), ["c_custkey"])


@_reg.add("K9_majority_value", """
    SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY o_custkey, o_orderpriority
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) = 1
""")  # fmt: skip
def majority_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.most_frequent(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority")


@_reg.add("K11_dead_letters", """
    SELECT o_orderkey, concat_ws(',', CASE WHEN NOT o_totalprice < 300000 THEN 'price' END, CASE WHEN NOT o_orderstatus IN ('F', 'O') THEN 'status' END) AS reasons
    FROM orders WHERE NOT (o_totalprice < 300000 AND o_orderstatus IN ('F', 'O'))
""")  # fmt: skip
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"price": F.col("o_totalprice") < 300000, "status": F.col("o_orderstatus").isin("F", "O")}
    return merge.split_valid(table(spark, sf_dir, "orders"), rules)[1].select("o_orderkey", F.array_join("reasons", ",").alias("reasons"))


@_reg.add("K14_retention", """
    SELECT user_id, count(*) FILTER (nth > 3) AS expired, count(*) FILTER (nth <= 3) AS kept
    FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS nth FROM events) GROUP BY user_id
""")  # fmt: skip
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot.retention(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], _newest(), keep=3)
    return rows.groupBy("user_id").agg(F.count_if("expired").alias("expired"), F.count_if(~F.col("expired")).alias("kept"))


@_reg.add("K21_cascade_delete", """
    SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'P') GROUP BY l_orderkey
""")  # fmt: skip
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = merge.delete_cascade({"lines": (table(spark, sf_dir, "lineitem"), "l_orderkey")}, table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'"), "o_orderkey")
    return left["lines"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@_reg.add("T2_change_events", """
    SELECT event_id, user_id, before, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
    WHERE before IS NOT NULL AND before <> event_type
""")  # fmt: skip
def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf_dir, "events").withColumn("before", before).filter("before <> event_type").select("event_id", "user_id", "before", "event_type")
