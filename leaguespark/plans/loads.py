"""Loads and merges over the league: upserts, ledgers, matches, sheets, standings, referees and equipment."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.operators import coverage, loads, merge
from leaguespark.plans.league import EVENTS_NOW, League

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]


def _upsert_sql(old: str, new: str, keys: list[str], overwrite: list[str], coalesce: list[str] = ()) -> str:
    """The oracle of ``merge.merge``: a full join, column by column."""
    value = {c: f"CASE WHEN n.is_new IS NULL THEN o.{c} ELSE n.{c} END" for c in overwrite} | {c: f"coalesce(n.{c}, o.{c})" for c in coalesce}
    changed = " OR ".join(f"({v}) IS DISTINCT FROM o.{c}" for c, v in value.items())
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    ids = ", ".join(f"coalesce(o.{k}, n.{k}) AS {k}" for k in keys)
    return f"""SELECT {ids}, {', '.join(f'{v} AS {c}' for c, v in value.items())}, CASE WHEN o.is_old IS NULL THEN 'inserted' WHEN n.is_new IS NULL THEN 'kept' WHEN {changed} THEN 'updated' ELSE 'noop' END AS outcome
        FROM (SELECT *, true AS is_old FROM ({old})) o FULL OUTER JOIN (SELECT *, true AS is_new FROM ({new})) n ON {on}"""


_OLD_STANDINGS = "SELECT poule_id, equipe_id, points + CAST(poule_id % 2 AS BIGINT) AS points, joues FROM {classements} WHERE capture_date < TIMESTAMP '2000-01-01'"
_NEW_STANDINGS = "SELECT poule_id, equipe_id, points, joues FROM {classements} WHERE joues > 0 AND points > 1"


@_reg.add("K2_overwrite_all", _upsert_sql(_OLD_STANDINGS, _NEW_STANDINGS, ["poule_id", "equipe_id"], ["points", "joues"]))
def overwrite_all(t: T) -> DataFrame:
    return merge.merge(t.sql(_OLD_STANDINGS), t.sql(_NEW_STANDINGS), ["poule_id", "equipe_id"], overwrite=["points", "joues"])


@_reg.add("K6_outcome_counters", f"SELECT outcome, count(*) AS n FROM ({_upsert_sql(_OLD_STANDINGS, _NEW_STANDINGS, ['poule_id', 'equipe_id'], ['points', 'joues'])}) WHERE outcome <> 'kept' GROUP BY outcome")
def outcome_counters(t: T) -> DataFrame:
    return merge.outcomes(overwrite_all(t))


_OLD_PHASES = "SELECT id_ffhb, CASE WHEN id % 3 = 0 THEN lower(nom) ELSE nom END AS nom, competition_id FROM {phases} WHERE nom <> 'NATION_4'"
_NEW_PHASES = "SELECT id_ffhb, nom, competition_id FROM {phases} WHERE nom <> 'NATION_9'"


@_reg.add("K4_plain_upsert", _upsert_sql(_OLD_PHASES, _NEW_PHASES, ["id_ffhb"], ["nom", "competition_id"]))
def plain_upsert(t: T) -> DataFrame:
    return merge.merge(t.sql(_OLD_PHASES), t.sql(_NEW_PHASES), ["id_ffhb"], overwrite=["nom", "competition_id"])


_OLD_SCORES = "SELECT id, CASE WHEN statut = 'joue' AND journee IS NULL THEN NULL ELSE score_dom END AS score_dom, statut FROM {matchs} WHERE date_heure < TIMESTAMP '2000-06-01'"
_NEW_SCORES = "SELECT id, CASE WHEN fdm_code IS NULL THEN NULL ELSE score_dom END AS score_dom, statut FROM {matchs}"


@_reg.add("K3_merged_rows", _upsert_sql(_OLD_SCORES, _NEW_SCORES, ["id"], ["statut"], ["score_dom"]))
def merged_rows(t: T) -> DataFrame:
    return merge.merge(t.sql(_OLD_SCORES), t.sql(_NEW_SCORES), ["id"], overwrite=["statut"], coalesce=["score_dom"])


@_reg.add("K8_batch_upsert", _upsert_sql(_OLD_SCORES, _NEW_SCORES, ["id"], ["score_dom", "statut"]))
def batch_upsert(t: T) -> DataFrame:
    """A batch of any size is one write."""
    return merge.merge(t.sql(_OLD_SCORES), t.sql(_NEW_SCORES), ["id"], overwrite=["score_dom", "statut"])


_OLD_GYMS = "SELECT equipement_id, adresse, CASE WHEN ville = 'ASIA' THEN NULL ELSE ville END AS ville FROM {equipements}"


@_reg.add("K7_conditional_upsert", f"SELECT n.equipement_id, n.adresse, n.ville FROM {{equipements}} n LEFT JOIN ({_OLD_GYMS}) o ON o.equipement_id = n.equipement_id WHERE (n.adresse, n.ville) IS DISTINCT FROM (o.adresse, o.ville) OR o.equipement_id IS NULL")
def conditional_upsert(t: T) -> DataFrame:
    old = t.sql(_OLD_GYMS)
    merged = merge.merge(old, t("equipements").select("equipement_id", "adresse", "ville"), ["equipement_id"], overwrite=["adresse", "ville"])
    return merged.filter("outcome IN ('inserted', 'updated')").drop("outcome")


@_reg.add("K18_fetch_state", f"SELECT coalesce(o.path, n.path) AS path, CAST(coalesce(o.attempts, 0) + CASE WHEN n.path IS NULL THEN 0 ELSE 1 END AS BIGINT) AS attempts FROM (SELECT path, count(*) AS attempts FROM {{api_logs}} WHERE status = 404 AND requested_at < TIMESTAMP '2024-01-20' GROUP BY path) o FULL OUTER JOIN (SELECT DISTINCT path FROM {{api_logs}} WHERE status = 404 AND requested_at >= TIMESTAMP '2024-01-20') n ON n.path = o.path")
def fetch_state(t: T) -> DataFrame:
    missing = t("api_logs").filter("status = 404")
    old = missing.filter("requested_at < TIMESTAMP_NTZ '2024-01-20'").groupBy("path").agg(F.count(F.lit(1)).alias("attempts"))
    new = missing.filter("requested_at >= TIMESTAMP_NTZ '2024-01-20'").select("path").distinct()
    return merge.merge(old, new, ["path"], increments={"attempts": 1}).drop("outcome")


_OLD_ROUNDS = "SELECT poule_id, journee, CAST(min(date_heure) AS DATE) AS debut FROM {matchs} WHERE journee IS NOT NULL AND statut = 'joue' GROUP BY poule_id, journee"
_NEW_ROUNDS = "SELECT poule_id, journee, CAST(max(date_heure) AS DATE) AS debut FROM {matchs} WHERE journee IS NOT NULL AND statut <> 'forfait' GROUP BY poule_id, journee"


@_reg.add("K19_announced_rounds", _upsert_sql(_OLD_ROUNDS, _NEW_ROUNDS, ["poule_id", "journee"], ["debut"]))
def announced_rounds(t: T) -> DataFrame:
    return merge.merge(t.sql(_OLD_ROUNDS), t.sql(_NEW_ROUNDS), ["poule_id", "journee"], overwrite=["debut"])


_OVERRIDES = "SELECT id_ffhb, 1 AS rang FROM {equipes} WHERE logo IS NOT NULL"


@_reg.add("K20_overrides", "SELECT e.id_ffhb, CASE WHEN e.porteur_ext_structure_id IS NOT NULL THEN 2 ELSE 1 END AS rang FROM {equipes} e WHERE (e.logo IS NOT NULL OR e.porteur_ext_structure_id IS NOT NULL) AND NOT (e.nom ILIKE 'ENT %')")
def overrides(t: T) -> DataFrame:
    """Upserted for carried teams, then deleted for ententes."""
    set_ = t("equipes").filter("porteur_ext_structure_id IS NOT NULL").select("id_ffhb", F.lit(2).alias("rang"))
    gone = t("equipes").filter("nom ILIKE 'ENT %'").select("id_ffhb")
    return merge.merge(t.sql(_OVERRIDES), set_, ["id_ffhb"], overwrite=["rang"]).drop("outcome").join(gone, "id_ffhb", "left_anti")


_OLD_SECTIONS = "SELECT DISTINCT niveau AS section, CAST(NULL AS BOOLEAN) AS lue FROM {competitions} WHERE niveau <> 'national'"
_NEW_SECTIONS = "SELECT niveau AS section, count(*) > 1 AS lue FROM {competitions} GROUP BY niveau"


@_reg.add("K23_section_journal", _upsert_sql(_OLD_SECTIONS, _NEW_SECTIONS, ["section"], ["lue"]))
def section_journal(t: T) -> DataFrame:
    return merge.merge(t.sql(_OLD_SECTIONS), t.sql(_NEW_SECTIONS), ["section"], overwrite=["lue"])


@_reg.add("K17_reaped_runs", f"SELECT id, CASE WHEN old_ THEN 'failed' ELSE status END AS status, CASE WHEN old_ THEN TIMESTAMP '{EVENTS_NOW}' ELSE finished_at END AS finished_at FROM (SELECT *, status = 'running' AND started_at < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 6 HOUR AS old_ FROM {{runs}})")
def reaped_runs(t: T) -> DataFrame:
    return coverage.reap_orphans(t("runs"), datetime.fromisoformat(EVENTS_NOW), 6).select("id", "status", "finished_at")


_reg.same("K10_score_if_absent", "SELECT m.id, CASE WHEN m.score_dom IS NULL OR m.score_ext IS NULL THEN s.d ELSE m.score_dom END AS score_dom, CASE WHEN m.score_dom IS NULL OR m.score_ext IS NULL THEN s.e ELSE m.score_ext END AS score_ext FROM {matchs} m JOIN (SELECT match_id, CAST(sum(CASE WHEN cote = 'dom' THEN but_count ELSE 0 END) AS BIGINT) AS d, CAST(sum(CASE WHEN cote = 'ext' THEN but_count ELSE 0 END) AS BIGINT) AS e FROM {compositions} GROUP BY match_id) s ON s.match_id = m.id")
_reg.same("K13_run_ledger", "SELECT job, saison, count(*) AS executions, count(*) FILTER (WHERE finished_at IS NULL) AS ouvertes, CAST(sum(CASE WHEN status = 'success' THEN pages ELSE 0 END) AS BIGINT) AS pages, max(started_at) FILTER (WHERE status = 'success') AS point_de_reprise FROM {runs} GROUP BY job, saison")
_reg.same("K22_api_response", "SELECT poule_id, '{{\"data\":[' || array_join(sort_array(collect_list(id)), ',') || '],\"meta\":{{\"total\":' || CAST(count(*) AS STRING) || '}}}}' AS reponse FROM {matchs} GROUP BY poule_id",
          "SELECT poule_id, concat(chr(123), '\"data\":[', string_agg(CAST(id AS VARCHAR), ',' ORDER BY id), '],\"meta\":', chr(123), '\"total\":', CAST(count(*) AS VARCHAR), chr(125), chr(125)) AS reponse FROM {matchs} GROUP BY poule_id")
_KEYS = f"SELECT key_prefix, min(requested_at) AS cree, max(requested_at) AS vu, count(*) FILTER (WHERE status >= 500) AS erreurs FROM {{api_logs}} WHERE key_prefix IS NOT NULL GROUP BY key_prefix"
_reg.same("K24_api_keys", f"SELECT key_prefix, cree, vu, erreurs <= 60 AS actif FROM ({_KEYS})")
_reg.same("P19_active_keys", f"SELECT key_prefix FROM ({_KEYS}) WHERE erreurs <= 60 AND cree + INTERVAL 90 DAY > TIMESTAMP '{EVENTS_NOW}'")
_reg.same("K25_deliveries", "SELECT l.key_prefix AS abonnement, l.id AS livraison, l.status, n.nth FROM {api_logs} l JOIN (SELECT id, row_number() OVER (PARTITION BY key_prefix ORDER BY requested_at DESC, id DESC) AS nth FROM {api_logs} WHERE key_prefix IS NOT NULL) n ON n.id = l.id WHERE n.nth <= 50".replace("n.nth FROM {api_logs} l", "CAST(n.nth AS BIGINT) AS rang FROM {api_logs} l"))
_reg.same("K27_cron_ledger", "SELECT job, id, status, CASE WHEN status = 'running' THEN 'ouvert' WHEN status = 'success' THEN 'fini' ELSE 'erreur' END AS etat, coalesce(date_trunc('minute', finished_at), date_trunc('minute', started_at)) AS a FROM {runs}")
_reg.same("K28_heartbeats", f"SELECT id, job, CASE WHEN status = 'running' AND coalesce(finished_at, started_at + INTERVAL 5 MINUTE) < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 1 DAY THEN 'perdu' WHEN status = 'running' THEN 'vivant' ELSE status END AS etat FROM {{runs}}")

# Matches from captures: an early one without scores, and the newest.
_CAPTURED = "SELECT id, id_ffhb_match, CASE WHEN id % 83 = 0 THEN NULL ELSE id_ffhb_match END AS rencontre, CASE WHEN id % 29 = 0 THEN 'PO?' ELSE 'PO' || CAST(poule_id AS STRING) END AS poule, CAST(equipe_dom_id AS STRING) AS dom, CASE WHEN id % 31 = 0 THEN CAST(equipe_dom_id AS STRING) ELSE CAST(equipe_ext_id AS STRING) END AS ext, CASE WHEN id % 7 = 0 THEN NULL ELSE date_heure END AS quand, CASE WHEN id % 7 = 0 AND id % 2 = 1 THEN NULL ELSE CAST(date_heure AS DATE) END AS debut, score_dom, score_ext, CASE WHEN id % 2 = 0 THEN journee END AS journee, equipement_id, fdm_code FROM {matchs}"
_OLD_MATCHES = "SELECT id_ffhb_match, poule_id, CAST(equipe_dom_id AS BIGINT) AS equipe_dom_id, CAST(equipe_ext_id AS BIGINT) AS equipe_ext_id, date_heure, false AS date_a_confirmer, false AS heure_estimee, CAST(score_dom AS INTEGER) AS score_dom, CAST(score_ext AS INTEGER) AS score_ext, statut, CAST(NULL AS STRING) AS forfait_equipe, journee, equipement_id, fdm_code FROM {matchs} WHERE date_heure < TIMESTAMP '1999-01-01' AND statut <> 'forfait'"


def _captures(t: T) -> DataFrame:
    rows = t.sql(_CAPTURED)
    payload = lambda score: F.to_json(F.struct(
        F.col("rencontre").alias("ext_rencontre_id"), F.col("poule").alias("ext_poule_id"), F.col("dom").alias("ext_equipe_dom_id"), F.col("ext").alias("ext_equipe_ext_id"),
        F.date_format("quand", "yyyy-MM-dd'T'HH:mm:ss").alias("date_heure"), F.date_format("debut", "yyyy-MM-dd").alias("journee_date_debut"),
        F.when(score, F.col("score_dom").cast("string")).alias("score_dom"), F.when(score, F.concat(F.col("score_ext").cast("string"), F.lit(" pts"))).alias("score_ext"), "journee", "equipement_id", "fdm_code",
    ))
    versions = [rows.select(F.col("id"), F.col("id_ffhb_match").alias("natural_key"), payload(F.lit(bool(v))).alias("payload"), F.lit(f"2025-10-0{v + 1} 00:00:00").cast("timestamp").alias("scraped_at")) for v in (0, 1)]
    return versions[0].unionByName(versions[1])


def _load(t: T) -> loads.Load:
    teams = t("equipes").select("id_ffhb", F.col("id").cast("long").alias("id"))
    old = t.sql(_OLD_MATCHES).withColumn("date_heure", F.col("date_heure").cast("timestamp"))
    return loads.load_matches(_captures(t), t("poules").select("id_ffhb", "id"), teams, old)


_RESOLVED = f"""captured AS ({_CAPTURED}), valid AS (SELECT * FROM captured WHERE rencontre IS NOT NULL AND dom IS NOT NULL AND ext IS NOT NULL AND (quand IS NOT NULL OR debut IS NOT NULL)),
    resolved AS (SELECT v.*, po.id AS poule_id, ed.id AS equipe_dom_id, ee.id AS equipe_ext_id, CASE WHEN po.id IS NULL THEN 'poule inconnue' WHEN ed.id IS NULL THEN 'equipe domicile inconnue' WHEN ee.id IS NULL THEN 'equipe exterieure inconnue' WHEN ed.id = ee.id THEN 'meme equipe' END AS warning
      FROM valid v LEFT JOIN {{poules}} po ON po.id_ffhb = v.poule LEFT JOIN {{equipes}} ed ON ed.id_ffhb = v.dom LEFT JOIN {{equipes}} ee ON ee.id_ffhb = v.ext)"""
_NEW_MATCHES = """SELECT rencontre AS id_ffhb_match, poule_id, equipe_dom_id, equipe_ext_id, coalesce(quand, CAST(debut AS TIMESTAMP)) AS date_heure, quand IS NULL AS date_a_confirmer, quand IS NULL AS heure_estimee, CAST(score_dom AS INTEGER) AS score_dom, CAST(score_ext AS INTEGER) AS score_ext,
    CASE WHEN score_dom IN (10, 20) AND score_ext IS NULL THEN 'forfait' WHEN score_dom IS NOT NULL AND score_ext IS NOT NULL THEN 'joue' ELSE 'a_jouer' END AS statut, CASE WHEN score_dom IN (10, 20) AND score_ext IS NULL THEN 'ext' END AS forfait_equipe, journee, equipement_id, fdm_code FROM resolved WHERE warning IS NULL"""
_MERGED = _upsert_sql(_OLD_MATCHES, _NEW_MATCHES, ["id_ffhb_match"], ["poule_id", "equipe_dom_id", "equipe_ext_id", "date_heure", "date_a_confirmer", "heure_estimee", "statut", "forfait_equipe", "journee"], ["score_dom", "score_ext", "equipement_id", "fdm_code"])


@_reg.add("D31_match_load", f"WITH {_RESOLVED} {_MERGED}")
def match_load(t: T) -> DataFrame:
    return _load(t).rows


@_reg.add("K12_warnings", f"WITH {_RESOLVED} SELECT id_ffhb_match AS natural_key, warning FROM resolved WHERE warning IS NOT NULL")
def warnings(t: T) -> DataFrame:
    return _load(t).warnings


@_reg.add("D31_match_report", f"WITH {_RESOLVED} SELECT outcome, count(*) AS n FROM (SELECT outcome FROM ({_MERGED}) WHERE outcome <> 'kept' UNION ALL SELECT 'warned' FROM resolved WHERE warning IS NOT NULL UNION ALL SELECT 'rejected' FROM captured WHERE NOT (rencontre IS NOT NULL AND dom IS NOT NULL AND ext IS NOT NULL AND (quand IS NOT NULL OR debut IS NOT NULL))) GROUP BY outcome")
def match_report(t: T) -> DataFrame:
    return _load(t).report()


_RAW_POULES = "SELECT id, id_ffhb, CASE WHEN id % 10 = 0 THEN '' ELSE nom END AS nom, CASE WHEN id % 7 = 0 THEN 'PH?' ELSE 'PH' || CAST(phase_id AS STRING) END AS phase FROM {poules}"
_OLD_POULES = "SELECT id_ffhb, lower(nom) AS nom, phase_id FROM {poules} WHERE phase_id < 12"


@_reg.add("D30_poule_load", _upsert_sql(_OLD_POULES, f"SELECT p.id_ffhb, p.nom, ph.id AS phase_id FROM ({_RAW_POULES}) p JOIN {{phases}} ph ON ph.id_ffhb = p.phase WHERE p.nom <> ''", ["id_ffhb"], ["nom", "phase_id"]))
def poule_load(t: T) -> DataFrame:
    captures = t.sql(_RAW_POULES).select("id", F.col("id_ffhb").alias("natural_key"), F.to_json(F.struct("id_ffhb", "nom", F.col("phase").alias("ext_phase_id"))).alias("payload"), F.lit("2025-10-01").cast("timestamp").alias("scraped_at"))
    return loads.load_entity(captures, "id_ffhb STRING, nom STRING, ext_phase_id STRING", "id_ffhb", ["id_ffhb", "nom"], t.sql(_OLD_POULES), ["nom", "phase_id"], parent=("ext_phase_id", t("phases"), "phase_id")).rows


_SHEET_SCORES = "(SELECT match_id, CAST(sum(CASE WHEN cote = 'dom' THEN but_count ELSE 0 END) AS BIGINT) AS d, CAST(sum(CASE WHEN cote = 'ext' THEN but_count ELSE 0 END) AS BIGINT) AS e FROM {compositions} GROUP BY match_id)"


def _sheets(t: T) -> dict[str, DataFrame]:
    """Every match with a sheet code as one nested document; codes of cancelled matches are unknown to the table."""
    codes = t("matchs").filter("fdm_code IS NOT NULL").select(F.col("id").alias("match_id"), F.when(F.col("statut") == "forfait", F.concat("fdm_code", F.lit("X"))).otherwise(F.col("fdm_code")).alias("fdm_code"))
    line = F.struct("numero_maillot", "cote", F.col("joueur_id").cast("string").alias("numero_licence"), F.col("but_count").alias("buts"))
    lineups = t("compositions").groupBy("match_id").agg(F.sort_array(F.collect_list(line)).alias("compositions"), F.sum(F.when(F.col("cote") == "dom", F.col("but_count")).otherwise(0)).alias("score_recevant"), F.sum(F.when(F.col("cote") == "ext", F.col("but_count")).otherwise(0)).alias("score_visiteur"))
    acts = t("actions").groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("ordre", "cote", F.col("ordre").alias("numero_maillot"), "type_action"))).alias("actions"))
    return loads.sheets(codes.join(lineups, "match_id").join(acts, "match_id").drop("match_id"), t("matchs"))


@_reg.add("D32_sheet_scores", f"SELECT m.id AS match_id, CASE WHEN m.score_dom IS NULL OR m.score_ext IS NULL THEN s.d ELSE m.score_dom END AS score_dom, CASE WHEN m.score_dom IS NULL OR m.score_ext IS NULL THEN s.e ELSE m.score_ext END AS score_ext, CASE WHEN m.score_dom IS NULL OR m.score_ext IS NULL THEN 'joue' ELSE m.statut END AS statut FROM {{matchs}} m JOIN {_SHEET_SCORES} s ON s.match_id = m.id WHERE m.fdm_code IS NOT NULL AND m.statut <> 'forfait'")
def sheet_scores(t: T) -> DataFrame:
    return _sheets(t)["scores"]


@_reg.add("D32_sheet_actions", """
    SELECT a.match_id, a.ordre, a.cote, a.type_action, CAST(c.joueur_id AS VARCHAR) AS numero_licence FROM {actions} a JOIN {matchs} m ON m.id = a.match_id AND m.fdm_code IS NOT NULL AND m.statut <> 'forfait'
    LEFT JOIN (SELECT match_id, cote, numero_maillot, arg_max(joueur_id, CAST(joueur_id AS VARCHAR)) AS joueur_id FROM {compositions} WHERE numero_maillot IS NOT NULL GROUP BY match_id, cote, numero_maillot) c ON c.match_id = a.match_id AND c.cote = a.cote AND c.numero_maillot = a.ordre
    WHERE EXISTS (SELECT 1 FROM {compositions} x WHERE x.match_id = a.match_id)""")  # fmt: skip
def sheet_actions(t: T) -> DataFrame:
    return _sheets(t)["actions"]


_RAW_STANDINGS = "SELECT CASE WHEN equipe_id % 19 = 0 THEN 'PO?' ELSE 'PO' || CAST(poule_id AS STRING) END AS ext_poule_id, CASE WHEN equipe_id % 17 = 0 THEN '?' ELSE CAST(equipe_id AS STRING) END AS ext_equipe_id, points, joues FROM {classements}"


@_reg.add("D33_standings_load", f"SELECT po.id AS poule_id, e.id AS equipe_id, count(*) AS n, CAST(sum(r.points) AS BIGINT) AS points FROM ({_RAW_STANDINGS}) r JOIN {{poules}} po ON po.id_ffhb = r.ext_poule_id LEFT JOIN {{equipes}} e ON e.id_ffhb = r.ext_equipe_id GROUP BY po.id, e.id")
def standings_load(t: T) -> DataFrame:
    rows, _ = loads.standings(t.sql(_RAW_STANDINGS), t("poules"), t("equipes"))
    return rows.groupBy("poule_id", "equipe_id").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("points"))


_REFEREED = "SELECT m.id, m.id_ffhb_match, 'A' || CAST(m.poule_id AS STRING) AS arbitre1_id, 'nom ' || CAST(m.poule_id AS STRING) AS arbitre1_nom, CASE WHEN m.id % 3 > 0 THEN 'A' || CAST(m.equipe_dom_id % 70 AS STRING) END AS arbitre2_id, 'second ' || CAST(m.equipe_dom_id % 70 AS STRING) AS arbitre2_nom FROM {matchs} m"
_PEOPLE = f"(SELECT arbitre_id, min(nom) AS nom FROM (SELECT arbitre1_id AS arbitre_id, arbitre1_nom AS nom FROM ({_REFEREED}) UNION ALL SELECT arbitre2_id, arbitre2_nom FROM ({_REFEREED})) WHERE arbitre_id IS NOT NULL GROUP BY arbitre_id)"


@_reg.add("D34_referees", f"SELECT arbitre_id, nom FROM {_PEOPLE}")
def referee_load(t: T) -> DataFrame:
    return loads.referees(t.sql(_REFEREED))


@_reg.add("D34_officials", f"SELECT DISTINCT r.id AS match_id, r.role, r.arbitre_id FROM (SELECT id, 'arbitre1' AS role, arbitre1_id AS arbitre_id FROM ({_REFEREED}) UNION ALL SELECT id, 'arbitre2', arbitre2_id FROM ({_REFEREED})) r WHERE r.arbitre_id IS NOT NULL")
def official_load(t: T) -> DataFrame:
    rows = t.sql(_REFEREED)
    return loads.officials(rows, t("matchs"), loads.referees(rows))


_VISITS = "SELECT m.equipement_id, s.adresse || ' ' || s.code_postal || ' ' || s.ville AS adresse FROM {matchs} m JOIN {salles} s ON s.id = m.equipe_dom_id % 25 WHERE m.equipement_id IS NOT NULL"


@_reg.add("D35_equipment_refresh", f"""WITH best AS (SELECT equipement_id, adresse FROM (SELECT equipement_id, adresse, row_number() OVER (PARTITION BY equipement_id ORDER BY count(*) DESC, adresse) AS nth FROM ({_VISITS}) GROUP BY equipement_id, adresse) WHERE nth = 1),
    n AS (SELECT equipement_id, adresse, nullif(regexp_extract(adresse, '\\b([0-9]{{5}})\\b', 1), '') AS code_postal, nullif(regexp_extract(adresse, '\\b[0-9]{{5}}\\s+(.+)$', 1), '') AS ville FROM best)
    """.replace("{{5}}", "{5}") + _upsert_sql("SELECT equipement_id, adresse, code_postal, ville FROM {equipements}", "SELECT * FROM n", ["equipement_id"], ["adresse", "code_postal", "ville"]).replace(") n ON", ") n ON"))  # fmt: skip
def equipment_refresh(t: T) -> DataFrame:
    return loads.refresh_equipment(t.sql(_VISITS), t("equipements").select("equipement_id", "adresse", "code_postal", "ville"))


@_reg.add("D36_pipeline_order", "SELECT unnest(['poules', 'equipes', 'matchs']) AS etape, unnest([0, 1, 2]) AS place")
def pipeline_order(t: T) -> DataFrame:
    chosen = loads.steps("phases", ["matchs", "equipes", "clubs", "poules"])
    return t("region").sparkSession.createDataFrame([(s, i) for i, s in enumerate(chosen)], "etape string, place int")
