"""Pages with nested children and indexed search over the league."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.operators import profiles
from leaguespark.operators.search import TrigramIndex
from leaguespark.plans.domain import _GRAMS
from leaguespark.plans.league import SEASON, League
from leaguespark.streaming import incremental

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]


def _joined(array: str, entry: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(array, entry), ",")


def _text(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])


_PLAYED = """
    SELECT c.joueur_id, c.match_id, c.equipe_id, c.but_count, m.id_ffhb_match, m.date_heure, m.statut, m.forfait_equipe, m.score_dom, m.score_ext, m.equipe_dom_id, m.equipe_ext_id, m.poule_id, ed.nom AS dom, ee.nom AS ext, ej.nom AS own
    FROM {compositions} c JOIN {matchs} m ON m.id = c.match_id JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id JOIN {equipes} ej ON ej.id = c.equipe_id"""


@_reg.add("D11_player_pages", f"""
    WITH h AS (SELECT *, row_number() OVER (PARTITION BY joueur_id ORDER BY date_heure DESC, match_id DESC) AS nth FROM ({_PLAYED}))
    SELECT j.numero_licence, j.nom, coalesce(s.buts, 0) AS total_buts, coalesce(s.n, 0) AS total_matchs, coalesce(l.historique, '') AS historique
    FROM {{joueurs}} j LEFT JOIN (SELECT joueur_id, CAST(sum(but_count) AS BIGINT) AS buts, count(DISTINCT match_id) AS n FROM {{compositions}} GROUP BY joueur_id) s ON s.joueur_id = j.id
    LEFT JOIN (SELECT joueur_id, string_agg(id_ffhb_match || '|' || own || '|' || dom || '|' || ext || '|' || coalesce(CAST(score_dom AS VARCHAR), '-') || '|' || CAST(but_count AS VARCHAR), ',' ORDER BY nth) AS historique FROM h WHERE nth <= 10 GROUP BY joueur_id) l ON l.joueur_id = j.id""")
def player_pages(t: T) -> DataFrame:
    entry = lambda x: _text(x["id_ffhb_match"], x["equipe_joueur_nom"], x["equipe_dom_nom"], x["equipe_ext_nom"], x["score_dom"], x["buts"])
    dealt = t.dealt()
    return profiles.player_pages(dealt, parts=dealt.parts).select("numero_licence", "nom", "total_buts", "total_matchs", _joined("historique", entry).alias("historique"))


@_reg.add("D11_player_matches", f"""
    SELECT j.numero_licence, p.match_id, p.statut, CASE WHEN p.forfait_equipe IS NULL THEN NULL WHEN (p.forfait_equipe = 'dom') = (p.equipe_dom_id = p.equipe_id) THEN 'equipe' ELSE 'adversaire' END AS forfait, p.own AS equipe_nom,
           CASE WHEN p.equipe_dom_id = p.equipe_id THEN p.ext ELSE p.dom END AS adversaire_nom, CASE WHEN p.equipe_dom_id = p.equipe_id THEN p.score_dom ELSE p.score_ext END AS score_equipe, p.but_count AS buts, 'PO' || CAST(p.poule_id AS VARCHAR) AS poule_id_ffhb
    FROM ({_PLAYED}) p JOIN {{joueurs}} j ON j.id = p.joueur_id""")
def player_matches(t: T) -> DataFrame:
    return profiles.player_matches(t).select("numero_licence", "match_id", "statut", "forfait", "equipe_nom", "adversaire_nom", "score_equipe", "buts", "poule_id_ffhb")


@_reg.add("D12_referee_pages", "SELECT a.id_ffhb, a.nom_complet, a.niveau, (SELECT count(*) FROM {officiels} o WHERE o.arbitre_id = a.id) AS nb_matchs FROM {arbitres} a")
def referee_pages(t: T) -> DataFrame:
    return profiles.referee_pages(t).select("id_ffhb", "nom_complet", "niveau", "nb_matchs")


@_reg.add("D12_referee_matches", """
    SELECT a.id_ffhb AS arbitre_id_ffhb, m.id AS match_id, o.role, m.date_heure, ed.nom AS equipe_dom_nom, ee.id_ffhb AS equipe_ext_id_ffhb, po.id_ffhb AS poule_id_ffhb, c.nom AS competition_nom
    FROM {officiels} o JOIN {arbitres} a ON a.id = o.arbitre_id JOIN {matchs} m ON m.id = o.match_id JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id
    JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} c ON c.id = ph.competition_id""")
def referee_matches(t: T) -> DataFrame:
    return profiles.referee_matches(t).select("arbitre_id_ffhb", "match_id", "role", "date_heure", "equipe_dom_nom", "equipe_ext_id_ffhb", "poule_id_ffhb", "competition_nom")


@_reg.add("D13_competition_pages", """
    SELECT c.id_ffhb, c.nom, coalesce(string_agg(ph.nom || '[' || coalesce(po.poules, '') || ']', ',' ORDER BY ph.nom, ph.id_ffhb), '') AS phases
    FROM {competitions} c LEFT JOIN {phases} ph ON ph.competition_id = c.id LEFT JOIN (SELECT phase_id, string_agg(id_ffhb, ',' ORDER BY nom, id_ffhb) AS poules FROM {poules} GROUP BY phase_id) po ON po.phase_id = ph.id GROUP BY c.id_ffhb, c.nom""")
def competition_pages(t: T) -> DataFrame:
    inner = lambda p: F.array_join(F.transform(p["poules"], lambda x: x["id_ffhb"]), ",")
    return profiles.competition_pages(t).select("id_ffhb", "nom", _joined("phases", lambda p: F.concat(p["nom"], F.lit("["), inner(p), F.lit("]"))).alias("phases"))


@_reg.add("D13_poule_pages", """
    SELECT po.id_ffhb AS poule_id_ffhb, ph.nom AS phase_nom, c.nom AS competition_nom, coalesce(s.lignes, '') AS classement FROM {poules} po JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} c ON c.id = ph.competition_id
    LEFT JOIN (SELECT poule_id, string_agg(CAST(nth AS VARCHAR) || '|' || id_ffhb || '|' || CAST(points AS VARCHAR), ',' ORDER BY nth) AS lignes FROM (
      SELECT k.poule_id, e.id_ffhb, k.points, row_number() OVER (PARTITION BY k.poule_id ORDER BY k.points DESC, k.buts_pour - k.buts_contre DESC, k.equipe_id) AS nth FROM {classements} k JOIN {equipes} e ON e.id = k.equipe_id) GROUP BY poule_id) s ON s.poule_id = po.id""")
def poule_pages(t: T) -> DataFrame:
    return profiles.poule_pages(t).select("poule_id_ffhb", "phase_nom", "competition_nom", _joined("classement", lambda x: _text(x["position"], x["equipe_id_ffhb"], x["points"])).alias("classement"))


@_reg.add("D17_halls", "SELECT id_ffhb, nom, adresse, code_postal FROM {salles} UNION ALL SELECT equipement_id, nom, adresse, code_postal FROM {equipements} WHERE equipement_id NOT IN (SELECT id_ffhb FROM {salles})")
def halls(t: T) -> DataFrame:
    return profiles.halls(t).select("id_ffhb", "nom", "adresse", "code_postal")


@_reg.add("D17_hall_match_rows", """
    SELECT h.id_ffhb AS lieu, m.id, m.statut, m.date_heure, ed.nom AS equipe_dom_nom, ee.nom AS equipe_ext_nom, c.nom AS competition_nom
    FROM (SELECT id_ffhb, id, NULL AS equipement_id FROM {salles} UNION ALL SELECT equipement_id, NULL, equipement_id FROM {equipements}) h JOIN {matchs} m ON m.salle_id = h.id OR m.equipement_id = h.equipement_id
    JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} c ON c.id = ph.competition_id""")
def hall_matches(t: T) -> DataFrame:
    return profiles.hall_matches(t).select("lieu", "id", "statut", "date_heure", "equipe_dom_nom", "equipe_ext_nom", "competition_nom")


@_reg.add("D18_club_pages", "SELECT c.id_ffhb, c.code_ffhb, c.nom, c.email, s.id_ffhb AS salle_id_ffhb, s.adresse AS salle_adresse FROM {clubs} c LEFT JOIN {salles} s ON s.id = c.salle_principale_id")
def club_pages(t: T) -> DataFrame:
    return profiles.club_pages(t).select("id_ffhb", "code_ffhb", "nom", "email", F.col("salle_principale.id_ffhb").alias("salle_id_ffhb"), F.col("salle_principale.adresse").alias("salle_adresse"))


@_reg.add("D19_team_pages", f"""
    SELECT e.id_ffhb, e.nom, c.code_ffhb AS club, coalesce(x.liste, '') AS engagements FROM {{equipes}} e LEFT JOIN {{clubs}} c ON c.id_ffhb = e.ext_structure_id
    LEFT JOIN (SELECT g.id_ffhb, string_agg(po.id_ffhb || '|' || ph.nom || '|' || co.nom || '|' || co.niveau, ',' ORDER BY co.nom, ph.nom, po.nom, po.id_ffhb) AS liste FROM (SELECT DISTINCT id_ffhb, poule_id FROM {{engagements}}) g
      JOIN {{poules}} po ON po.id = g.poule_id JOIN {{phases}} ph ON ph.id = po.phase_id JOIN {{competitions}} co ON co.id = ph.competition_id GROUP BY g.id_ffhb) x ON x.id_ffhb = e.id_ffhb WHERE e.saison_code = '{SEASON}'""")
def team_pages(t: T) -> DataFrame:
    entry = lambda x: _text(x["poule_id_ffhb"], x["phase_nom"], x["competition_nom"], x["niveau"])
    return profiles.team_pages(t, SEASON).select("id_ffhb", "nom", F.col("club.code_ffhb").alias("club"), _joined("engagements", entry).alias("engagements"))


@_reg.add("D19_team_matches", f"""
    SELECT e.id_ffhb AS equipe_id_ffhb, CASE WHEN m.equipe_dom_id = e.id THEN 'dom' ELSE 'ext' END AS cote, m.id, m.statut, m.date_heure, ed.nom AS equipe_dom_nom, ee.nom AS equipe_ext_nom, c.nom AS competition_nom
    FROM {{equipes}} e JOIN {{matchs}} m ON m.equipe_dom_id = e.id OR m.equipe_ext_id = e.id JOIN {{equipes}} ed ON ed.id = m.equipe_dom_id JOIN {{equipes}} ee ON ee.id = m.equipe_ext_id
    JOIN {{poules}} po ON po.id = m.poule_id JOIN {{phases}} ph ON ph.id = po.phase_id JOIN {{competitions}} c ON c.id = ph.competition_id WHERE e.saison_code = '{SEASON}'""")
def team_matches(t: T) -> DataFrame:
    return profiles.team_matches(t, SEASON).select("equipe_id_ffhb", "cote", "id", "statut", "date_heure", "equipe_dom_nom", "equipe_ext_nom", "competition_nom")


@_reg.add("D19_team_rosters", f"SELECT e.id_ffhb AS equipe_id_ffhb, j.numero_licence, j.nom, j.prenom, count(DISTINCT c.match_id) AS matchs, CAST(coalesce(sum(c.but_count), 0) AS BIGINT) AS buts FROM {{compositions}} c JOIN {{equipes}} e ON e.id = c.equipe_id JOIN {{joueurs}} j ON j.id = c.joueur_id WHERE e.saison_code = '{SEASON}' GROUP BY ALL")
def team_rosters(t: T) -> DataFrame:
    return profiles.team_rosters(t, SEASON)


# Search over an index.
_QUERIES = "SELECT 'c' || id_ffhb AS qid, nom AS q FROM {competitions} UNION ALL SELECT 's' || id_ffhb, nom FROM {salles}"


@_reg.add("F12_index_search", f"""
    WITH q AS (SELECT qid, list_distinct({_GRAMS.format('q')}) AS q FROM ({_QUERIES})), names AS (SELECT nom, {_GRAMS.format('nom')} AS g FROM (SELECT DISTINCT nom FROM {{equipes}})),
    pairs AS (SELECT * FROM q, names WHERE len(list_intersect(q, g)) > 0.6 * len(q)), runs AS (SELECT qid, q, nom, g, i, unnest(generate_series(i, len(g))) AS j FROM (SELECT *, unnest(generate_series(1, len(g))) AS i FROM pairs)),
    cut AS (SELECT qid, q, nom, list_distinct(list_slice(g, i, j)) AS r FROM runs), scored AS (SELECT qid, nom, max(len(list_intersect(q, r)) / (len(q) + len(r) - len(list_intersect(q, r)))) AS score FROM cut GROUP BY qid, nom)
    SELECT s.qid, e.id, e.nom, round(s.score, 6) AS score FROM scored s JOIN {{equipes}} e ON e.nom = s.nom WHERE s.score > 0.6""")
def index_search(t: T) -> DataFrame:
    """Every competition's and every hall's name looked up among all teams' names."""
    names = t("equipes").select("id", "nom")
    index = TrigramIndex(names, f"{incremental.work_dir(names.sparkSession)}/index")
    return index.search(t.sql(_QUERIES)).withColumn("score", F.round("score", 6))
