"""Ledgers, timers and claims over the league's runs and logs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.operators import ledger
from leaguespark.plans.league import EVENTS_NOW, League
from leaguespark.sources.versions import VersionedTable
from leaguespark.streaming import claims, incremental, timers

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]

#: What the runs would have written: opened, counted, stepped, failed here and there, ended unless they still run.
_ENTRIES = """
    SELECT CAST(id AS STRING) AS run_id, CAST(0 AS BIGINT) AS seq, started_at AS at, 'open' AS kind, job, saison, CAST(3 AS BIGINT) AS n, CAST(NULL AS STRING) AS text FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 1, started_at + INTERVAL 1 MINUTE, 'total', job, saison, pages * 2, NULL FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 2, started_at + INTERVAL 2 MINUTE, 'pages', job, saison, pages, NULL FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 3, started_at + INTERVAL 3 MINUTE, 'pages', job, saison, id % 3, NULL FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 4, started_at + INTERVAL 4 MINUTE, 'step', job, saison, 1, 'lecture' FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 5, started_at + INTERVAL 5 MINUTE, 'step', job, saison, 2, 'ecriture' FROM {runs} WHERE id % 2 = 0
    UNION ALL SELECT CAST(id AS STRING), 6, started_at + INTERVAL 6 MINUTE, 'error', job, saison, NULL, NULL FROM {runs} WHERE status IN ('failed', 'partial')
    UNION ALL SELECT CAST(id AS STRING), 7, started_at + INTERVAL 20 MINUTE, 'rows', job, saison, id % 1000, NULL FROM {runs}
    UNION ALL SELECT CAST(id AS STRING), 8, finished_at, status, job, saison, NULL, CASE WHEN status = 'failed' THEN 'panne' END FROM {runs} WHERE status <> 'running'"""


def _log(t: T) -> ledger.RunLog:
    """The entries as a log, some of them written twice."""
    rows = t.sql(_ENTRIES).withColumn("at", F.col("at").cast("timestamp"))
    log = ledger.RunLog(rows.sparkSession, f"{incremental.work_dir(rows.sparkSession)}/log")
    log.append(rows)
    log.append(rows.filter("seq < 3"))
    return log


@_reg.add("K13_run_states", "SELECT CAST(id AS VARCHAR) AS run_id, job, saison, started_at, finished_at, status, id % 1000 AS rows_read, CASE WHEN status = 'failed' THEN 'panne' END AS error_message FROM {runs}")
def run_states(t: T) -> DataFrame:
    return _log(t).runs().select("run_id", "job", "saison", F.col("started_at").cast("timestamp_ntz").alias("started_at"), F.col("finished_at").cast("timestamp_ntz").alias("finished_at"), "status", "rows_read", "error_message")


@_reg.add("K13_resume_points", "SELECT job, saison, max(started_at) AS since FROM {runs} WHERE status = 'success' GROUP BY job, saison")
def resume_points(t: T) -> DataFrame:
    return ledger.resume_points(_log(t).runs()).withColumn("since", F.col("since").cast("timestamp_ntz"))


@_reg.add("K27_cron_states", """
    SELECT CAST(id AS VARCHAR) AS run_id, job, CAST(3 AS BIGINT) AS steps_total, CAST(1 + CAST(id % 2 = 0 AS INTEGER) AS BIGINT) AS step_index, CASE WHEN status = 'running' THEN CASE WHEN id % 2 = 0 THEN 'ecriture' ELSE 'lecture' END END AS current_step,
           CAST(CAST(status IN ('failed', 'partial') AS INTEGER) AS BIGINT) AS errors, status FROM {runs}""")
def cron_states(t: T) -> DataFrame:
    return _log(t).runs().select("run_id", "job", "steps_total", "step_index", "current_step", "errors", "status")


@_reg.add("K28_scrape_states", """
    SELECT CAST(id AS VARCHAR) AS run_id, job, pages * 2 AS pages_total, CAST(pages + id % 3 AS BIGINT) AS pages, status,
           coalesce(finished_at, started_at + CASE WHEN id % 2 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 4 MINUTE END) AS last_activity_at FROM {runs}""")
def scrape_states(t: T) -> DataFrame:
    return _log(t).runs().select("run_id", "job", "pages_total", "pages", "status", F.col("last_activity_at").cast("timestamp_ntz").alias("last_activity_at"))


_OPEN = "SELECT *, started_at + CASE WHEN id % 2 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 4 MINUTE END AS seen FROM {runs} WHERE status = 'running'"


@_reg.add("K17_reaped_ledger", f"SELECT CAST(id AS VARCHAR) AS run_id, CASE WHEN status = 'running' AND started_at + CASE WHEN id % 2 = 0 THEN INTERVAL 5 MINUTE ELSE INTERVAL 4 MINUTE END < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 12 HOUR THEN 'failed' ELSE status END AS status FROM {{runs}}")
def reaped_ledger(t: T) -> DataFrame:
    """Silent runs are ended by an entry of their own; reaping again finds none."""
    log = _log(t)
    for _ in range(2):
        log.append(ledger.reap(log.runs(), F.lit(EVENTS_NOW).cast("timestamp"), 12).select("run_id", "seq", "at", "kind", "job", "saison", "n", "text"))
    return log.runs().select("run_id", "status")


@_reg.add("T8_lost_runs", f"SELECT CAST(id AS VARCHAR) AS run_id, seen AS last_activity_at, seen + INTERVAL 12 HOUR AS lost_at FROM ({_OPEN}) WHERE seen + INTERVAL 12 HOUR < (SELECT max(greatest(coalesce(finished_at, started_at), started_at + INTERVAL 20 MINUTE)) FROM {{runs}})")
def lost_runs(t: T) -> DataFrame:
    """The log read as a stream: a timer of twelve hours for each open run."""
    log = _log(t)
    spark = log.spark
    folder = incremental.work_dir(spark)
    # Rows counted in silence are no sign of life, but they move the time on.
    stream = spark.readStream.schema(ledger.ENTRY).parquet(log.path)
    incremental.run(timers.lost_runs(stream, 12 * 3600, silent=("rows",)), folder, lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out/__batch={number}"))
    found = spark.read.parquet(f"{folder}/out").drop("__batch")
    return found.select("run_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("last_activity_at", "lost_at")])


@_reg.add("T7_pauses", """
    SELECT id, blocks, CASE WHEN status <> 200 THEN requested_at + to_seconds(CAST(least(blocks * 60, 300) AS INTEGER)) END AS pause_until FROM (
      SELECT id, status, requested_at, CAST(sum(CASE WHEN status <> 200 THEN 1 ELSE 0 END) OVER (PARTITION BY domaine, suite ORDER BY requested_at, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS blocks FROM (
        SELECT id, status, requested_at, coalesce(key_prefix, 'ip') AS domaine, sum(CASE WHEN status <> 200 THEN 0 ELSE 1 END) OVER (PARTITION BY coalesce(key_prefix, 'ip') ORDER BY requested_at, id ROWS UNBOUNDED PRECEDING) AS suite FROM {api_logs}))""")  # fmt: skip
def pauses(t: T) -> DataFrame:
    """The log arrives in four files, one after the other in time."""
    rows = t("api_logs").select(F.coalesce("key_prefix", F.lit("ip")).alias("domain"), "id", F.col("requested_at").cast("timestamp").alias("at"), (F.col("status") != 200).alias("blocked"))
    spark, folder = rows.sparkSession, incremental.work_dir(rows.sparkSession)
    begin, end = rows.agg(F.unix_timestamp(F.min("at")), F.unix_timestamp(F.max("at"))).first()
    for i in range(4):
        quarter = F.least(F.floor((F.unix_timestamp("at") - begin) * 4 / max(1, (end or 0) - (begin or 0))), F.lit(3)) == i
        rows.filter(quarter).coalesce(1).write.parquet(f"{folder}/in/{i}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
    incremental.run(timers.pauses(stream, 60, 300), folder, lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out/__batch={number}"))
    return spark.read.parquet(f"{folder}/out").select("id", "blocks", F.col("pause_until").cast("timestamp_ntz").alias("pause_until"))


def _progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load writes its progress and the metrics it observes into the ledger while it runs."""
    folder = incremental.work_dir(spark)
    log = ledger.RunLog(spark, f"{folder}/log")
    stream = incremental.source(spark, f"{sf_dir}/events.parquet").observe("lues", F.count_if(F.col("event_type") == "error").alias("erreurs"))
    with log.run("events") as run:
        listener = ledger.ProgressToLog(run, f"load-{run.id}")
        spark.streams.addListener(listener)
        try:
            written = stream.writeStream.queryName(listener.name).foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/{n}")).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
            written.awaitTermination()
            ledger.wait_for(lambda: listener.ended)
        finally:
            spark.streams.removeListener(listener)
    return log.runs().select("job", "status", "rows_read", F.get_json_object("stats", "$.lues.erreurs").cast("long").alias("erreurs"))


QUERIES["T11_progress_ledger"] = _progress
ORACLES["T11_progress_ledger"] = "SELECT 'events' AS job, 'success' AS status, count(*) AS rows_read, count(*) FILTER (WHERE event_type = 'error') AS erreurs FROM events"

_AT = datetime(2024, 1, 20)
_DUE = f"SELECT id, row_number() OVER (ORDER BY requested_at, id) AS nth FROM {{api_logs}} WHERE id % 9 > 0 AND requested_at <= TIMESTAMP '{_AT}' + INTERVAL 6 MINUTE"


@_reg.add("T3_claims", f"SELECT id, CASE WHEN nth BETWEEN 41 AND 80 THEN 'b' ELSE 'c' END AS claim FROM ({_DUE}) WHERE nth > 40 OR nth % 2 = 0")
def claimed(t: T) -> DataFrame:
    """Two workers claim forty deliveries each; the first settles every other of its own and is lost: a third gets what it left, with all else that is due."""
    rows = t("api_logs").select("id", F.coalesce("key_prefix", F.lit("tous")).alias("subscription_id"), F.when(F.col("id") % 9 > 0, "pending").otherwise("delivered").alias("status"), F.lit(0).alias("attempts"), F.col("requested_at").cast("timestamp").alias("next_attempt_at"))
    rows = rows.withColumns({"claim": F.lit(None).cast("string"), "last_status": F.lit(None).cast("int"), "last_error": F.lit(None).cast("string"), "delivered_at": F.lit(None).cast("timestamp")})
    spark = rows.sparkSession
    queue = VersionedTable(spark, f"{incremental.work_dir(spark)}/queue", ["id"])
    queue.replace(rows)
    first = claims.claim(queue, "a", _AT, limit=40)
    claims.claim(queue, "b", _AT + timedelta(minutes=3), limit=40)
    places = first.join(t.sql(_DUE), "id").filter("nth % 2 = 1")
    claims.settle(queue, "a", places.select("id", F.lit(200).alias("http"), F.lit(None).cast("string").alias("error")), _AT + timedelta(minutes=4))
    claims.claim(queue, "c", _AT + timedelta(minutes=6), limit=None)
    return queue.read().filter("claim IS NOT NULL").select("id", "claim")
