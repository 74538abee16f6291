"""Leases over a queue of deliveries: several workers claim, no lock is held.

The queue is a versioned table.  A claim picks the deliveries that have been due the
longest and puts their next attempt off by the lease, all in one commit; of two
workers that pick at once, one publishes first and the other picks again from what
is left, so no delivery is claimed by two.  A worker that is lost does nothing
further: its deliveries are due again when the lease has run out.  What a worker
found out is settled under its claim only, so an answer that comes after the lease
ran out and another worker took the delivery changes nothing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.operators import matches
from leaguespark.sources.versions import VersionedTable

#: Columns of the queue.
QUEUE = "id long, subscription_id string, status string, attempts int, next_attempt_at timestamp, claim string, last_status int, last_error string, delivered_at timestamp"
LEASE = timedelta(minutes=5)
CLAIM = 100


def claim(queue: VersionedTable, name: str, now: datetime, subscriptions: DataFrame | None = None, limit: int | None = CLAIM, lease: timedelta = LEASE) -> DataFrame:
    """The deliveries that this claim (a name no other claim has) took: the longest due ones of active subscriptions (subscription_id, active), at most ``limit`` (a bounded batch), or all."""

    def due(rows: DataFrame) -> DataFrame:
        open_ = rows.filter((F.col("status") == "pending") & (F.col("next_attempt_at") <= F.lit(now)))
        if subscriptions is not None:
            open_ = open_.join(subscriptions.filter("active").select("subscription_id").distinct(), "subscription_id", "left_semi")
        picked = (open_ if limit is None else open_.orderBy("next_attempt_at", "id").limit(limit)).select(*rows.columns)
        return picked.withColumns({"next_attempt_at": F.lit(now + lease).cast("timestamp"), "claim": F.lit(name)})

    queue.change(due, token=f"claim-{name}")
    return queue.read().filter(F.col("claim") == name)


def settle(queue: VersionedTable, name: str, answers: DataFrame, now: datetime) -> int | None:
    """The answers (id, http, error) to a claim's deliveries: delivered, put off by the ladder of waits, or failed for good."""

    def settled(rows: DataFrame) -> DataFrame:
        own = rows.filter((F.col("claim") == name) & (F.col("status") == "pending"))
        found = own.join(answers.select(F.col("id").alias("a_id"), "http", "error"), F.col("id") == F.col("a_id"))
        ok = F.coalesce(F.col("http").between(200, 299), F.lit(False))
        step = matches.next_delivery(F.col("status"), F.col("attempts"), ok)
        error = F.when(~ok, F.substring(F.coalesce("error", F.concat(F.lit("HTTP "), F.col("http").cast("string"))), 1, 500))
        at = F.lit(now).cast("timestamp")
        found = found.withColumn("s", step).withColumns({
            "status": F.col("s.status"), "attempts": F.col("attempts") + 1, "last_status": F.col("http").cast("int"), "last_error": error, "claim": F.lit(None).cast("string"),
            "delivered_at": F.when(ok, at).otherwise(F.col("delivered_at")), "next_attempt_at": F.coalesce(F.timestamp_add("SECOND", F.col("s.wait"), at), F.col("next_attempt_at")),
        })
        return found.select(*rows.columns)

    return queue.change(settled, token=f"settle-{name}")


def failures(subscriptions: DataFrame, answers: DataFrame) -> DataFrame:
    """(subscription_id, failures, active) after answers (subscription_id, at, ok) in order: a success sets the count of failures in a row back; too many switch a subscription off.

    Only what comes after a subscription's last success counts, so no order within a key is needed but that success.
    """
    last = answers.groupBy("subscription_id").agg(F.max(F.when(F.col("ok"), F.col("at"))).alias("good"))
    counted = answers.join(last, "subscription_id").filter(F.col("good").isNull() | (F.col("at") > F.col("good")))
    after = counted.groupBy("subscription_id").agg(F.count_if(~F.col("ok")).alias("bad"))
    joined = subscriptions.join(last, "subscription_id", "left").join(after, "subscription_id", "left")
    n = F.when(F.col("good").isNull(), F.col("failures")).otherwise(F.lit(0)) + F.coalesce("bad", F.lit(0))
    return joined.select("subscription_id", n.cast("long").alias("failures"), (F.col("active") & (n < matches.MAX_FAILURES)).alias("active"))
