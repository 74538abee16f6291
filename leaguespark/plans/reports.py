"""Reports over the league: traffic, pipeline, freshness, coverage, missing scores, problems and the status board."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.functions import text
from leaguespark.operators import coverage, quantiles, snapshot
from leaguespark.plans.league import EVENTS_NOW, NOW, SEASON, League

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]
_NOW, _EVENTS_NOW = datetime.fromisoformat(NOW), datetime.fromisoformat(EVENTS_NOW)

# Traffic.
_WINDOW = "requested_at >= TIMESTAMP '2024-01-28' AND requested_at < TIMESTAMP '2024-01-31'"


@_reg.add("D21_traffic_hours", f"""
    SELECT strftime(h.hour, '%Y-%m-%d %H') AS heure, coalesce(n.n, 0) AS n, coalesce(n.erreurs, 0) AS erreurs, coalesce(n.cles, 0) AS cles FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS hour) h
    LEFT JOIN (SELECT date_trunc('hour', requested_at) AS hour, count(*) AS n, count(*) FILTER (WHERE status >= 500) AS erreurs, count(DISTINCT key_prefix) AS cles FROM {{api_logs}} WHERE {_WINDOW} GROUP BY 1) n ON n.hour = h.hour""")  # fmt: skip
def traffic_hours(t: T) -> DataFrame:
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") >= 500).alias("erreurs"), F.countDistinct("key_prefix").alias("cles")]
    found = coverage.hourly(t("api_logs"), "requested_at", datetime(2024, 1, 28), datetime(2024, 1, 31), counts)
    return found.select(F.date_format("hour", "yyyy-MM-dd HH").alias("heure"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "erreurs", "cles")])


@_reg.add("D21_traffic_routes", f"SELECT regexp_replace(path, '/[0-9]+', '/:id', 'g') AS route, count(*) AS n, round(avg(duration_ms), 2) AS moyenne, quantile_disc(duration_ms, 0.95) AS p95 FROM {{api_logs}} WHERE {_WINDOW} GROUP BY 1 ORDER BY n DESC, route LIMIT 15")
def traffic_routes(t: T) -> DataFrame:
    rows = t("api_logs").filter(_WINDOW.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    rows = rows.select(text.template_route(F.col("path")).alias("route"), "duration_ms")
    found = rows.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("duration_ms"), 2).alias("moyenne"))
    places = quantiles.percentile_disc(rows, "route", "duration_ms", 0.95).select(F.col("route").alias("p_route"), F.col("duration_ms").cast("long").alias("p95"))
    found = found.join(places, F.col("route") == F.col("p_route"), "left").drop("p_route")
    return found.orderBy(F.col("n").desc(), "route").limit(15)


@_reg.add("J13_hour_ranges", f"SELECT date_trunc('hour', requested_at) AS heure, key_prefix, count(*) AS n FROM {{api_logs}} WHERE {_WINDOW} GROUP BY 1, 2")
def hour_ranges(t: T) -> DataFrame:
    """A range join with aligned hours is an equality on the truncated time."""
    rows = t("api_logs").filter(_WINDOW.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
    return rows.groupBy(F.date_trunc("hour", "requested_at").alias("heure"), "key_prefix").agg(F.count(F.lit(1)).alias("n"))


@_reg.add("D22_pipeline_snapshot", f"SELECT job, count(*) AS executions, count(*) FILTER (WHERE status = 'running') AS ouvertes, max(finished_at) FILTER (WHERE status = 'success') AS dernier_succes, arg_max(status, id) AS dernier_statut, round(CAST(count(*) FILTER (WHERE status = 'success') AS DOUBLE) / count(*), 4) AS part FROM {{runs}} GROUP BY job")
def pipeline_snapshot(t: T) -> DataFrame:
    done = F.col("status") == "success"
    return t("runs").groupBy("job").agg(
        F.count(F.lit(1)).alias("executions"), F.count_if(F.col("status") == "running").alias("ouvertes"), F.max(F.when(done, F.col("finished_at"))).alias("dernier_succes"),
        F.max_by("status", "id").alias("dernier_statut"), F.round(F.count_if(done) / F.count(F.lit(1)), 4).alias("part"),
    )


_LIMITS = {"view": 1, "click": 36, "purchase": 216, "signup": 2}
_LAST = "SELECT job AS dataset, CAST(max(finished_at) FILTER (WHERE status = 'success') AS TIMESTAMP) AS last_success FROM {runs} GROUP BY job"


@_reg.add("D23_freshness", f"SELECT dataset, round(CAST(floor(epoch(TIMESTAMP '{EVENTS_NOW}') - floor(epoch(last_success))) AS DOUBLE) / 3600, 2) AS age_hours, CASE WHEN last_success IS NULL THEN 'unknown' WHEN (floor(epoch(TIMESTAMP '{EVENTS_NOW}')) - floor(epoch(last_success))) / 3600 > CASE dataset {' '.join(f'WHEN {chr(39)}{d}{chr(39)} THEN {h}' for d, h in _LIMITS.items())} END THEN 'stale' ELSE 'ok' END AS verdict FROM ({_LAST})")
def freshness(t: T) -> DataFrame:
    return coverage.freshness(t.sql(_LAST), _EVENTS_NOW, _LIMITS)


_ROUNDS = "SELECT poule_id AS poule, journee, CAST(min(date_heure) AS DATE) AS date_debut FROM {matchs} WHERE journee IS NOT NULL GROUP BY poule_id, journee"
_HELD = f"""rounds AS ({_ROUNDS}), held AS (SELECT poule_id AS poule, journee FROM {{matchs}} WHERE journee IS NOT NULL GROUP BY poule_id, journee HAVING NOT bool_or(statut = 'a_jouer' AND date_heure < TIMESTAMP '{NOW}' - INTERVAL 6 HOUR)),
    covered AS (SELECT r.poule, r.journee, h.poule IS NOT NULL AS en_base FROM rounds r LEFT JOIN held h ON h.poule = r.poule AND h.journee = r.journee WHERE r.date_debut <= DATE '2000-06-15')"""


def _coverage(t: T) -> DataFrame:
    rows = t("matchs").select(F.col("poule_id").alias("poule"), "journee", "statut", "date_heure")
    return coverage.round_coverage(t.sql(_ROUNDS), rows, _NOW)


@_reg.add("D24_round_coverage", f"WITH {_HELD} SELECT poule, journee, en_base FROM covered")
def round_coverage(t: T) -> DataFrame:
    return _coverage(t)


@_reg.add("D24_coverage_totals", f"WITH {_HELD} SELECT count(*) AS journees_site, count(*) FILTER (WHERE en_base) AS journees_en_base, count(DISTINCT poule) AS poules_site, count(DISTINCT poule) FILTER (WHERE NOT en_base) AS poules_incompletes FROM covered")
def coverage_totals(t: T) -> DataFrame:
    return coverage.coverage_totals(_coverage(t))


_NUMBERED = "SELECT poule_id AS poule, journee AS numero, CAST(min(date_heure) AS DATE) AS date_debut, CAST(max(date_heure) AS DATE) AS date_fin FROM {matchs} WHERE journee IS NOT NULL GROUP BY poule_id, journee"
_FETCH = {"all": "date_debut <= DATE '2000-06-15'", "recent": "date_debut <= DATE '2000-06-15' AND date_fin >= DATE '2000-05-16'", "manquantes": "date_debut IS NOT NULL AND (numero > 11 OR (date_debut > DATE '2000-06-15' AND date_debut <= DATE '2000-06-29'))"}


@_reg.add("D25_rounds_to_fetch", " UNION ALL ".join(f"SELECT '{mode}' AS mode, poule, numero FROM ({_NUMBERED}) WHERE {cond}" for mode, cond in _FETCH.items()))
def rounds_to_fetch(t: T) -> DataFrame:
    rounds = t.sql(_NUMBERED)
    complete = rounds.filter("numero <= 11").select("numero").distinct()
    found = None
    for mode in ("courante", *_FETCH):
        own = coverage.rounds_to_fetch(rounds, mode, _NOW, recent_days=30, complete=complete if mode == "manquantes" else None, refresh_days=14).select(F.lit(mode).alias("mode"), "poule", "numero")
        found = own if found is None else found.unionByName(own)
    return found


_same = _reg.same
_same("D26_section_coverage", "SELECT co.niveau AS section, count(DISTINCT co.id) AS competitions, count(DISTINCT m.id) AS matchs, count(DISTINCT co.id) FILTER (WHERE m.id IS NULL) AS vides FROM {competitions} co LEFT JOIN {phases} ph ON ph.competition_id = co.id LEFT JOIN {poules} po ON po.phase_id = ph.id LEFT JOIN {matchs} m ON m.poule_id = po.id AND m.statut = 'forfait' GROUP BY co.niveau")
_same("D27_missing_scores", f"""
    SELECT cause, count(*) AS n, min(date_heure) AS premier FROM (
      SELECT m.date_heure, CASE WHEN h.part IS NULL OR h.part < 0.1 THEN 'poule en panne' WHEN m.fdm_code IS NULL THEN 'sans feuille' WHEN EXISTS (SELECT 1 FROM {{compositions}} c WHERE c.match_id = m.id) THEN 'feuille lue' ELSE 'reel' END AS cause
      FROM {{matchs}} m JOIN (SELECT poule_id, CAST(count(*) FILTER (WHERE statut = 'joue') AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS part FROM {{matchs}} GROUP BY poule_id) h ON h.poule_id = m.poule_id
      WHERE m.statut = 'a_jouer' AND m.date_heure < TIMESTAMP '{NOW}' - INTERVAL 2 DAY) t GROUP BY cause""")
_same("D28_active_poules_cost", "SELECT co.niveau, count(DISTINCT m.poule_id) AS poules, count(*) AS matchs, round(count(DISTINCT m.poule_id) * (0.5 + 0.13) / 60, 3) AS minutes FROM {matchs} m JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id WHERE m.date_heure >= TIMESTAMP '1999-03-01' AND m.date_heure < TIMESTAMP '1999-03-08' GROUP BY co.niveau".replace("(0.5 + 0.13)", "CAST(0.63 AS DOUBLE)"))
_same("D38_last_catch_up", "SELECT job, id, pages FROM (SELECT job, id, pages, row_number() OVER (PARTITION BY job ORDER BY started_at DESC, id DESC) AS nth FROM {runs} WHERE CAST(get_json_object(stats, '$.k') AS BIGINT) > 50 AND finished_at IS NOT NULL) x WHERE nth = 1",
      "SELECT job, id, pages FROM (SELECT job, id, pages, row_number() OVER (PARTITION BY job ORDER BY started_at DESC, id DESC) AS nth FROM {runs} WHERE CAST(json_extract_string(stats, '$.k') AS BIGINT) > 50 AND finished_at IS NOT NULL) x WHERE nth = 1")
_same("D39_activity", "SELECT count(*) AS requetes, count(*) FILTER (WHERE status = 200) AS reussies, count(DISTINCT key_prefix) AS cles, count(*) FILTER (WHERE path LIKE '/v1/purchases/%') AS achats FROM {api_logs} WHERE requested_at >= TIMESTAMP '2024-01-30' AND requested_at < TIMESTAMP '2024-01-31'")


@_reg.add("D40_problems", f"""
    WITH l AS (SELECT job, arg_max(status, started_at) AS status, arg_max(saison, started_at) AS saison, arg_max(pages, started_at) AS pages, max_by(coalesce(finished_at, TIMESTAMP '1900-01-01'), started_at) AS finished_at FROM {{runs}} GROUP BY job)
    SELECT job, 'last run failed' AS problem FROM l WHERE status = 'failed' UNION ALL SELECT job, 'last run partial' FROM l WHERE status = 'partial' UNION ALL SELECT job, 'wrong season' FROM l WHERE saison <> '{SEASON}'
    UNION ALL SELECT job, 'success without pages' FROM l WHERE status = 'success' AND pages = 0 UNION ALL SELECT job, 'stale' FROM l WHERE finished_at > TIMESTAMP '1900-01-01' AND (floor(epoch(TIMESTAMP '{EVENTS_NOW}')) - floor(epoch(finished_at))) / 3600.0 > 1""")  # fmt: skip
def problems(t: T) -> DataFrame:
    return coverage.problems(t("runs"), _EVENTS_NOW, SEASON, stale_hours=1)


@_reg.add("A21_verdicts", "SELECT job, CASE WHEN failed > 0 THEN 'en échec' WHEN running > 0 THEN 'en cours' WHEN partial > 0 THEN 'dégradé' ELSE 'sain' END AS verdict, success, partial, failed, running FROM (SELECT job, count(*) FILTER (WHERE status = 'success') AS success, count(*) FILTER (WHERE status = 'partial') AS partial, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'running') AS running FROM {runs} WHERE pages > 4 AND started_at >= TIMESTAMP '2024-01-29' GROUP BY job)")
def verdicts(t: T) -> DataFrame:
    return coverage.tally(t("runs").filter("pages > 4 AND started_at >= TIMESTAMP_NTZ '2024-01-29'"), "job")


@_reg.add("D41_status_board", f"""
    SELECT r.job, r.dernier, r.total, r.cles, date_diff('day', CAST(r.dernier AS DATE), DATE '2024-01-31') > 7 AS inactif, l.status AS dernier_statut, round(100.0 * p.faites / r.total, 2) AS avancement
    FROM (SELECT job, count(*) AS total, count(DISTINCT pages) AS cles, max(started_at) AS dernier FROM {{runs}} GROUP BY job) r JOIN (SELECT job, arg_max(status, id) AS status FROM {{runs}} GROUP BY job) l ON l.job = r.job JOIN (SELECT job, CAST(count(finished_at) AS DOUBLE) AS faites FROM {{runs}} GROUP BY job) p ON p.job = r.job""")  # fmt: skip
def status_board(t: T) -> DataFrame:
    runs = t("runs")
    volume = runs.groupBy("job").agg(F.count(F.lit(1)).alias("total"), F.countDistinct("pages").alias("cles"), F.max("started_at").alias("dernier"), F.count("finished_at").alias("faites"))
    latest = snapshot.latest_by_key(runs.select("job", "id", F.col("status").alias("dernier_statut")), ["job"], [F.col("id").desc()]).drop("id")
    idle = F.date_diff(F.lit("2024-01-31").cast("date"), F.col("dernier").cast("date")) > 7
    return volume.join(latest, "job").select("job", "dernier", "total", "cles", idle.alias("inactif"), "dernier_statut", F.round(100.0 * F.col("faites") / F.col("total"), 2).alias("avancement"))


# Analyst queries: documented questions to the tables.
_same("D37_unplayed_by_competition", "SELECT co.nom, count(*) AS total, count(*) FILTER (WHERE m.statut = 'a_jouer') AS a_jouer, round(100.0 * CAST(count(*) FILTER (WHERE m.statut = 'a_jouer') AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS part FROM {matchs} m JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id GROUP BY co.nom HAVING count(*) > 10")
_same("D37_teams_without_club", "SELECT e.id, e.nom FROM {equipes} e LEFT JOIN {clubs} c ON c.id_ffhb = coalesce(e.ext_structure_id, e.porteur_ext_structure_id) WHERE c.id_ffhb IS NULL")
_same("D37_top_scorers", "SELECT j.numero_licence, CAST(sum(c.but_count) AS BIGINT) AS buts, count(*) AS matchs FROM {compositions} c JOIN {joueurs} j ON j.id = c.joueur_id GROUP BY j.numero_licence ORDER BY buts DESC, j.numero_licence LIMIT 30")
_same("D37_biggest_wins", "SELECT m.id, ed.nom AS dom, ee.nom AS ext, m.score_dom - m.score_ext AS ecart FROM {matchs} m JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id WHERE m.statut = 'joue' ORDER BY abs(m.score_dom - m.score_ext) DESC, m.id LIMIT 25")
_same("D37_shared_names", "SELECT nom, count(*) AS n, count(DISTINCT ext_structure_id) AS structures FROM {equipes} GROUP BY nom HAVING count(*) > 1")
_same("D37_referees_by_month", "SELECT a.nom_complet, date_trunc('month', m.date_heure) AS mois, count(*) AS n FROM {officiels} o JOIN {arbitres} a ON a.id = o.arbitre_id JOIN {matchs} m ON m.id = o.match_id WHERE o.role = 'arbitre1' GROUP BY a.nom_complet, date_trunc('month', m.date_heure)")
_CRAWL = "SELECT co.niveau, co.id_ffhb, count(DISTINCT ph.id) AS phases, count(po.id) AS poules, count(po.id) FILTER (WHERE {vide}) AS poules_vides FROM {{competitions}} co JOIN {{phases}} ph ON ph.competition_id = co.id LEFT JOIN {{poules}} po ON po.phase_id = ph.id {more} GROUP BY co.niveau, co.id_ffhb"
_same("D44_competition_crawl", _CRAWL.format(vide="p.poule_id IS NULL", more="LEFT JOIN (SELECT DISTINCT poule_id FROM {matchs}) p ON p.poule_id = po.id"), _CRAWL.format(vide="po.id NOT IN (SELECT DISTINCT poule_id FROM {matchs})", more=""))
_same("D45_club_crawls", "SELECT id_ffhb, coalesce(max(CASE WHEN source = 'detail' THEN nom END), max(nom)) AS nom, max(email) AS email, count(*) AS captures FROM (SELECT 'liste' AS source, id_ffhb, upper(nom) AS nom, CAST(NULL AS STRING) AS email FROM {clubs} UNION ALL SELECT 'detail', id_ffhb, nom, email FROM {clubs} WHERE ligue_id <> 2) c GROUP BY id_ffhb")


@_reg.add("S25_catalog", "SELECT 'matchs' AS vue, 14 AS colonnes UNION ALL SELECT 'clubs', 8 UNION ALL SELECT 'runs', 8")
def catalog(t: T) -> DataFrame:
    """Columns of views as the session knows them."""
    return t("region").sparkSession.createDataFrame([(name, len(t(name).columns)) for name in ("matchs", "clubs", "runs")], "vue string, colonnes int")
