"""Coverage, freshness and gaps between what is announced and what is held."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def round_coverage(announced: DataFrame, matches: DataFrame, now: datetime, pending_hours: int = 6) -> DataFrame:
    """(poule, journee, en_base) of the rounds that have begun.

    announced: poule, journee, date_debut; matches: poule, journee, statut, date_heure.  A round is held when
    none of its matches is still to be played though its time is past.
    """
    begun = announced.filter(F.col("date_debut") <= F.lit(now.date())).select("poule", "journee")
    pending = (F.col("statut") == "a_jouer") & (F.col("date_heure") < F.lit(now) - F.expr(f"INTERVAL {pending_hours} HOURS"))
    held = matches.filter("journee IS NOT NULL").groupBy("poule", "journee").agg(F.bool_or(F.coalesce(pending, F.lit(False))).alias("pending")).filter("NOT pending")
    return begun.join(held.select("poule", "journee", F.lit(True).alias("held")), ["poule", "journee"], "left").select("poule", "journee", F.coalesce("held", F.lit(False)).alias("en_base"))


def coverage_totals(rounds: DataFrame) -> DataFrame:
    return rounds.agg(
        F.count(F.lit(1)).alias("journees_site"), F.count_if("en_base").alias("journees_en_base"), F.countDistinct("poule").alias("poules_site"),
        F.countDistinct(F.when(~F.col("en_base"), F.col("poule"))).alias("poules_incompletes"),
    )


def rounds_to_fetch(rounds: DataFrame, mode: str, today: datetime, fetched: int | None = None, recent_days: int = 7, complete: DataFrame | None = None, refresh_days: int = 0) -> DataFrame:
    """Rounds (numero, date_debut, date_fin as dates) to read in one of four modes."""
    if mode == "courante":
        return rounds.limit(0)
    day = F.lit(today.date())
    rows = rounds if fetched is None else rounds.filter(F.col("numero") != fetched)
    future = F.coalesce(F.col("date_debut") > day, F.lit(False))
    if mode == "manquantes":
        rows = rows.filter("date_debut IS NOT NULL")
        if complete is not None:
            near = F.coalesce(future & (F.col("date_debut") <= F.date_add(day, refresh_days)), F.lit(False))
            rows = rows.join(complete.select("numero", F.lit(True).alias("done")), "numero", "left").filter(F.col("done").isNull() | near).drop("done")
        return rows
    rows = rows.filter(~future)
    if mode == "recent":
        rows = rows.filter(F.coalesce("date_fin", "date_debut") >= F.date_sub(day, recent_days))
    return rows


def hourly(rows: DataFrame, time: str, start: datetime, end: datetime, aggregates: list[Column]) -> DataFrame:
    """Aggregates by hour with empty hours filled in; hours are aligned, so the join is one on equality."""
    per_hour = rows.filter((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end))).groupBy(F.date_trunc("hour", time).alias("hour")).agg(*aggregates)
    last = F.lit(end) - F.expr("INTERVAL 1 HOUR")
    hours = rows.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), last, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    return hours.join(per_hour, "hour", "left")


def freshness(last: DataFrame, now: datetime, limits: dict[str, int]) -> DataFrame:
    """(dataset, age_hours, verdict) from (dataset, last_success); limits in hours."""
    limit = F.lit(None).cast("int")
    for name, hours in limits.items():
        limit = F.when(F.col("dataset") == name, hours).otherwise(limit)
    age = (F.unix_timestamp(F.lit(now)) - F.unix_timestamp("last_success")) / 3600
    verdict = F.when(F.col("last_success").isNull(), "unknown").when(age > limit, "stale").otherwise("ok")
    return last.select("dataset", F.round(age, 2).alias("age_hours"), verdict.alias("verdict"))


def worst(verdicts: DataFrame) -> DataFrame:
    order = F.array(F.lit("ok"), F.lit("unknown"), F.lit("stale"))
    return verdicts.agg(F.max_by("verdict", F.array_position(order, F.col("verdict"))).alias("verdict"))


def problems(runs: DataFrame, now: datetime, season: str, stale_hours: int = 36) -> DataFrame:
    """(job, problem) of each job's latest run: failed, partial, wrong season, empty success, stale."""
    latest = runs.groupBy("job").agg(F.max_by(F.struct("status", "saison", "pages", "finished_at"), "started_at").alias("r"))
    age = (F.unix_timestamp(F.lit(now)) - F.unix_timestamp("r.finished_at")) / 3600
    rules = F.array(
        F.when(F.col("r.status") == "failed", "last run failed"), F.when(F.col("r.status") == "partial", "last run partial"),
        F.when(F.col("r.saison") != season, "wrong season"), F.when((F.col("r.status") == "success") & (F.col("r.pages") == 0), "success without pages"),
        F.when(age > stale_hours, "stale"),
    )
    return latest.select("job", F.explode(F.filter(rules, lambda m: m.isNotNull())).alias("problem"))


def reap_orphans(runs: DataFrame, now: datetime, hours: int) -> DataFrame:
    """Runs still open after too long are failed."""
    old = (F.col("status") == "running") & (F.col("started_at") < F.lit(now) - F.expr(f"INTERVAL {hours} HOURS"))
    return runs.withColumn("finished_at", F.when(old, F.lit(now)).otherwise(F.col("finished_at"))).withColumn("status", F.when(old, "failed").otherwise(F.col("status")))


def tally(runs: DataFrame, key: str) -> DataFrame:
    """Counts of each state by key, and the worst of them in words."""
    counts = runs.groupBy(key).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "partial", "failed", "running")])
    # The words of the verdict.
    verdict = F.when(F.col("failed") > 0, "en échec").when(F.col("running") > 0, "en cours").when(F.col("partial") > 0, "dégradé").otherwise("sain")
    return counts.withColumn("verdict", verdict)
