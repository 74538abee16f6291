"""Streams over the league's logs, each with the batch result it must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.operators import coverage, matches
from leaguespark.plans.league import EVENTS_NOW, League
from leaguespark.streaming import incremental, limits

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]


def _spark(t: T) -> SparkSession:
    return t("region").sparkSession


def _stream(name: str, sql: str, table: str):
    """A query that reads a driver table as a stream."""

    def keep(fn: Callable) -> Callable:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(incremental.source(spark, f"{sf_dir}/{table}.parquet"), incremental.work_dir(spark))

        QUERIES[name], ORACLES[name] = query, sql
        return fn

    return keep


@_stream("T1_incremental_latest", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1", "events")
def incremental_latest(stream: DataFrame, folder: str) -> DataFrame:
    return incremental.latest(stream, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"], folder)


@_stream("T4_idempotent_ingestion", "SELECT DISTINCT lang, sha256(coalesce(text, '')) AS hash FROM documents", "documents")
def idempotent_ingestion(stream: DataFrame, folder: str) -> DataFrame:
    rows = stream.select("lang", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("hash"))
    return incremental.ingest(rows, ["lang", "hash"], folder)


@_stream("T4_late_events", """
    WITH e AS (SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS jour FROM events)
    SELECT user_id, event_type, jour FROM e GROUP BY ALL""", "events")
def late_events(stream: DataFrame, folder: str) -> DataFrame:
    """Each user's kinds of events by day, once; the state forgets days that are 60 days old."""
    rows = stream.select("user_id", "event_type", F.col("ts").cast("date").alias("jour")).withColumn("quand", F.col("jour").cast("timestamp"))
    return incremental.ingest(rows, ["user_id", "event_type", "jour"], folder, "quand").drop("quand")


@_stream("T11_progress", "SELECT count(*) AS lues, count(*) FILTER (WHERE event_type = 'error') AS erreurs, max(event_id) AS derniere FROM events", "events")
def progress(stream: DataFrame, folder: str) -> DataFrame:
    """Counters of a load, taken while it runs, as a ledger row."""
    seen = stream.agg(F.count(F.lit(1)).alias("lues"), F.count_if(F.col("event_type") == "error").alias("erreurs"), F.max("event_id").alias("derniere"))
    incremental.run(seen, folder, lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/out"), "complete")
    return stream.sparkSession.read.parquet(f"{folder}/out")


_SHEETS = "SELECT match_id AS id, CAST(sum(CASE WHEN cote = 'dom' THEN but_count ELSE 0 END) AS BIGINT) AS s_dom, CAST(sum(CASE WHEN cote = 'ext' THEN but_count ELSE 0 END) AS BIGINT) AS s_ext FROM {compositions} GROUP BY match_id"


@_reg.add("T5_late_scores", f"SELECT m.id, CASE WHEN (m.score_dom IS NULL OR m.score_ext IS NULL) AND s.id IS NOT NULL THEN s.s_dom ELSE m.score_dom END AS score_dom, CASE WHEN (m.score_dom IS NULL OR m.score_ext IS NULL) AND s.id IS NOT NULL THEN s.s_ext ELSE m.score_ext END AS score_ext FROM {{matchs}} m LEFT JOIN ({_SHEETS}) s ON s.id = m.id")
def late_scores(t: T) -> DataFrame:
    """Sheets arrive as a stream of files, twice; the second time changes nothing."""
    spark = _spark(t)
    folder = incremental.work_dir(spark)
    for i in range(2):
        t.sql(_SHEETS).write.parquet(f"{folder}/in/{i}")
    stream = spark.readStream.schema(t.sql(_SHEETS).schema).option("maxFilesPerTrigger", 16).parquet(f"{folder}/in/*")
    return incremental.fill_scores(stream, t("matchs").select("id", "score_dom", "score_ext"), folder)


_LIMIT, _SECONDS = 3, 6 * 3600
_REQUESTS = "SELECT id, coalesce(key_prefix, 'ip') AS cle, requested_at FROM {api_logs}"


@_reg.add("T6_first_request_windows", f"""
    WITH RECURSIVE r AS ({_REQUESTS}), w(cle, debut) AS (SELECT cle, min(requested_at) FROM r GROUP BY cle UNION ALL SELECT n.cle, n.debut FROM (SELECT w.cle, min(r.requested_at) AS debut FROM w JOIN r ON r.cle = w.cle AND r.requested_at > w.debut + INTERVAL {_SECONDS} SECOND GROUP BY w.cle, w.debut) n),
    placed AS (SELECT r.id, r.cle, max(w.debut) AS debut, r.requested_at FROM r JOIN w ON w.cle = r.cle AND w.debut <= r.requested_at GROUP BY r.id, r.cle, r.requested_at)
    SELECT id, cle, row_number() OVER (PARTITION BY cle, debut ORDER BY requested_at, id) AS place, row_number() OVER (PARTITION BY cle, debut ORDER BY requested_at, id) > {_LIMIT} AS limited FROM placed""".replace("WITH RECURSIVE r AS", "WITH r AS"))  # fmt: skip
def first_request_windows(t: T) -> DataFrame:
    return limits.rate_limit(t.sql(_REQUESTS), "cle", "requested_at", _LIMIT, _SECONDS).select("id", "cle", "place", "limited")


ORACLES["T6_first_request_windows"] = ORACLES["T6_first_request_windows"].replace("WITH ", "WITH RECURSIVE ", 1)


@_reg.add("T7_cooldowns", """
    SELECT id, blocks, CASE WHEN status <> 200 THEN requested_at + to_seconds(CAST(least(blocks * 60, 300) AS INTEGER)) END AS pause_until FROM (
      SELECT id, status, requested_at, CAST(sum(CASE WHEN status <> 200 THEN 1 ELSE 0 END) OVER (PARTITION BY domaine, suite ORDER BY requested_at ROWS UNBOUNDED PRECEDING) AS BIGINT) AS blocks FROM (
        SELECT id, status, requested_at, coalesce(key_prefix, 'ip') AS domaine, sum(CASE WHEN status <> 200 THEN 0 ELSE 1 END) OVER (PARTITION BY coalesce(key_prefix, 'ip') ORDER BY requested_at ROWS UNBOUNDED PRECEDING) AS suite FROM {api_logs}))""")  # fmt: skip
def cooldowns(t: T) -> DataFrame:
    rows = t("api_logs").select("id", "status", "requested_at", F.coalesce("key_prefix", F.lit("ip")).alias("domaine"))
    return limits.cooldowns(rows, "domaine", "requested_at", F.col("status") != 200, 60, 300).select("id", "blocks", "pause_until")


_QUEUE = f"SELECT id, coalesce(key_prefix, 'tous') AS subscription_id, CASE WHEN id % 9 = 0 THEN 'delivered' ELSE 'pending' END AS status, CAST(id % 7 AS INTEGER) AS attempts, requested_at AS next_attempt_at, status AS http, 27 AS failures FROM {{api_logs}}"
_AT = "TIMESTAMP '2024-01-20 00:00:00'"


@_reg.add("T3_delivery_round", f"""
    SELECT id, subscription_id, CASE WHEN NOT due THEN status WHEN http BETWEEN 200 AND 299 THEN 'delivered' WHEN attempts < 6 THEN 'pending' ELSE 'failed' END AS status, attempts + CASE WHEN due THEN 1 ELSE 0 END AS attempts,
           CASE WHEN due AND NOT http BETWEEN 200 AND 299 AND attempts < 6 THEN {_AT} + to_seconds(CAST([60, 300, 1800, 7200, 21600, 86400][attempts + 1] AS INTEGER)) ELSE next_attempt_at END AS next_attempt_at
    FROM (SELECT *, status = 'pending' AND next_attempt_at <= {_AT} AS due FROM ({_QUEUE}))""")  # fmt: skip
def delivery_round(t: T) -> DataFrame:
    return _round(t)[0]


def _round(t: T) -> tuple[DataFrame, DataFrame]:
    rows = t.sql(_QUEUE)
    return incremental.attempt(rows.drop("http"), rows.select("id", "http"), F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))


@_reg.add("T3_subscriptions", f"SELECT subscription_id, CASE WHEN ok > 0 THEN 0 ELSE 27 + ko END AS failures, CASE WHEN ok > 0 THEN 0 ELSE 27 + ko END < 30 AS active FROM (SELECT subscription_id, count(*) FILTER (WHERE due AND http BETWEEN 200 AND 299) AS ok, count(*) FILTER (WHERE due AND NOT http BETWEEN 200 AND 299) AS ko FROM (SELECT *, status = 'pending' AND next_attempt_at <= {_AT} AS due FROM ({_QUEUE})) GROUP BY subscription_id)")
def subscriptions(t: T) -> DataFrame:
    return _round(t)[1]


@_reg.add("T8_orphans", f"SELECT job, count(*) FILTER (WHERE status = 'running' AND started_at < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 12 HOUR) AS orphelines FROM {{runs}} GROUP BY job")
def orphans(t: T) -> DataFrame:


    now = datetime.fromisoformat(EVENTS_NOW)
    reaped = coverage.reap_orphans(t("runs"), now, 12)
    return reaped.groupBy("job").agg(F.count_if((F.col("status") == "failed") & (F.col("finished_at") == F.lit(now))).alias("orphelines"))


_SUBSCRIPTIONS = "SELECT CAST(r_regionkey AS BIGINT) AS subscription_id, r_regionkey <> 3 AS actif, CASE WHEN r_regionkey > 1 THEN CAST(r_regionkey * 700 + 65 AS STRING) END AS club_id FROM {region}"


@_reg.add("T2_deliveries", f"""
    WITH s AS ({_SUBSCRIPTIONS}), e AS (SELECT id AS match_id, CASE statut WHEN 'forfait' THEN 'match.forfait' ELSE 'match.resultat' END AS kind, equipe_dom_id, equipe_ext_id FROM {{matchs}} WHERE statut IN ('joue', 'forfait') AND date_heure >= TIMESTAMP '2000-01-01')
    SELECT e.match_id, e.kind, s.subscription_id FROM e JOIN s ON s.actif AND (s.club_id IS NULL OR s.club_id IN (SELECT ext_structure_id FROM {{equipes}} q WHERE q.id IN (e.equipe_dom_id, e.equipe_ext_id)))""")  # fmt: skip
def deliveries(t: T) -> DataFrame:
    """Events of matches that were not played at the turn of the year, to all or to a club's subscribers."""
    new = t("matchs")
    old = new.withColumn("statut", F.when(F.year("date_heure") >= 2000, "a_jouer").otherwise(F.col("statut")))
    clubs = t("equipes").filter("ext_structure_id IS NOT NULL").select(F.col("id").alias("equipe_id"), F.col("ext_structure_id").alias("club_id"))
    events = matches.match_events(old, new)
    return matches.deliveries(events, t.sql(_SUBSCRIPTIONS), clubs).select("match_id", "kind", "subscription_id")
