"""Pages of the league: clubs and their teams, matches, players, referees, competitions, halls and search."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.functions import similarity
from leaguespark.operators import matches, snapshot, teams
from leaguespark.plans import scalars
from leaguespark.plans.league import SEASON, League

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]

# Linked teams.
_ENT = "(s.nom ILIKE '%ENTENTE%' OR s.nom ILIKE 'ENT %' OR s.nom ILIKE '% ENT %')"
_LINKS = f"""
    s AS (SELECT * FROM {{equipes}} WHERE saison_code = '{SEASON}'),
    aligned AS (SELECT DISTINCT c.equipe_id, c.joueur_id, substr(j.numero_licence, 1, 7) AS code FROM {{compositions}} c JOIN {{joueurs}} j ON j.id = c.joueur_id),
    per_code AS (SELECT equipe_id, code, count(*) AS n FROM aligned GROUP BY equipe_id, code),
    per_team AS (SELECT equipe_id, count(DISTINCT code) AS n FROM aligned GROUP BY equipe_id),
    words AS (SELECT id_ffhb, '(?i)\\b(' || array_to_string(list_distinct(list_filter(regexp_split_to_array(lower(nom), '[^a-z0-9]+'), lambda w: length(w) >= 4 AND NOT regexp_full_match(w, '[0-9]+'))), '|') || ')\\b' AS motif FROM {{clubs}}),
    signals AS (
      SELECT c.id_ffhb AS club_id, s.id, 'licence' AS methode, 3 AS rang, 1 AS ordre FROM {{clubs}} c JOIN per_code p ON p.code = c.code_ffhb AND p.n >= 3 JOIN s ON s.id = p.equipe_id
      UNION ALL SELECT c.id_ffhb, s.id, 'structure', 3, 2 FROM {{clubs}} c JOIN s ON s.ext_structure_id = c.id_ffhb
      UNION ALL SELECT c.id_ffhb, s.id, 'nom_exact', 3, 3 FROM {{clubs}} c JOIN s ON s.nom = c.nom
      UNION ALL SELECT c.id_ffhb, s.id, 'nom_reserve', 2, 4 FROM {{clubs}} c JOIN s ON s.nom ILIKE c.nom || ' %'
      UNION ALL SELECT w.id_ffhb, s.id, 'nom_entente', 1, 5 FROM words w JOIN s ON {_ENT} AND regexp_matches(s.nom, w.motif)),
    best AS (SELECT club_id, id, max(rang) AS rang, arg_min(methode, ordre - 10 * rang) AS methode, bool_or(methode = 'nom_exact') AS is_principal FROM signals GROUP BY club_id, id),
    links AS (
      SELECT b.club_id, b.id AS equipe_id, s.id_ffhb, s.nom, b.methode, CASE b.rang WHEN 3 THEN 'haute' WHEN 2 THEN 'moyenne' ELSE 'basse' END AS confiance, b.is_principal, {_ENT} OR coalesce(p.n, 0) >= 2 AS is_entente
      FROM best b JOIN s ON s.id = b.id LEFT JOIN per_team p ON p.equipe_id = b.id)"""


def _linked(t: T, **options) -> DataFrame:
    return teams.linked_teams(t("clubs"), t("equipes"), t("compositions").select("equipe_id", "joueur_id"), t("joueurs"), SEASON, **options)


@_reg.add("D1_linked_teams", f"WITH {_LINKS} SELECT club_id, equipe_id, nom, methode, confiance, is_principal, is_entente FROM links")
def linked_teams(t: T) -> DataFrame:
    return _linked(t)


@_reg.add("U1_scored_signals", f"WITH {_LINKS} SELECT methode, confiance, count(*) AS n FROM links WHERE confiance <> 'basse' GROUP BY methode, confiance")
def scored_signals(t: T) -> DataFrame:
    return _linked(t, min_confidence="moyenne").groupBy("methode", "confiance").agg(F.count(F.lit(1)).alias("n"))


_reg.same("P10_ilike_reserve", "SELECT c.id_ffhb AS club, e.id FROM {clubs} c JOIN {equipes} e ON split_part(e.nom, ' ', 1) = split_part(c.nom, ' ', 1) AND e.nom ILIKE c.nom || ' %'")
_reg.same("P11_whole_word", "SELECT id, nom FROM {equipes} WHERE nom RLIKE '(?i)\\\\b(building|machinery)\\\\b'", "SELECT id, nom FROM {equipes} WHERE regexp_matches(nom, '(?i)\\b(building|machinery)\\b')")

# Groups of registrations.
_ENGAGED = "eng AS (SELECT id_ffhb, competition, phase, niveau, row_number() OVER (PARTITION BY id_ffhb ORDER BY competition, poule_id) AS ordre FROM {engagements})"
_of = lambda sql, column: sql.replace("libelle", column)
_RANK = scalars._ORACLE_RANK.format("nom")
_GROUPED = f"""
    {_ENGAGED},
    over_ AS (SELECT id_ffhb, CASE WHEN id % 40 = 0 THEN 3 END AS rang, id % 60 = 0 AS exclu FROM {{equipes}} WHERE id % 20 = 0),
    base AS (SELECT e.ext_structure_id AS club_id, e.id_ffhb, e.nom, CASE WHEN g.id_ffhb IS NULL THEN '' ELSE g.competition || ' ' || g.phase END AS txt, g.niveau, g.id_ffhb IS NOT NULL AS engage, o.rang AS o_rang
             FROM {{equipes}} e LEFT JOIN (SELECT * FROM eng WHERE ordre = 1) g ON g.id_ffhb = e.id_ffhb LEFT JOIN over_ o ON o.id_ffhb = e.id_ffhb
             WHERE e.ext_structure_id IS NOT NULL AND e.saison_code = '{SEASON}' AND NOT coalesce(o.exclu, false)),
    c1 AS (SELECT *, {_of(scalars._ORACLE_CATEGORY, 'txt')} AS ct, {_of(scalars._ORACLE_CATEGORY, 'nom')} AS cn, {_of(scalars._ORACLE_SEX, 'txt')} AS st, {_of(scalars._ORACLE_SEX, 'nom')} AS sn,
             regexp_matches(upper(strip_accents(nom)), '\\b(ENT|ENTENTE|CONV|CONVENTION)\\b') AS entente, coalesce(o_rang, {_RANK}) AS explicite, upper(strip_accents(txt)) AS up FROM base),
    c2 AS (SELECT *, CASE ct WHEN 'Autre' THEN cn ELSE ct END AS categorie, CASE st WHEN 'mixte' THEN sn ELSE st END AS sexe,
             CASE WHEN engage THEN CASE WHEN regexp_matches(up, 'DEPARTEMENT|\\bDEPT?\\b') THEN 2 WHEN regexp_matches(up, 'REGION|\\bREG\\b|HONNEUR|EXCELLENCE|NATIONAL') THEN 1 WHEN niveau = 'departemental' THEN 2 ELSE 1 END END AS palier FROM c1),
    c3 AS (SELECT *, categorie = 'Seniors' AND explicite IS NULL AND palier IS NOT NULL AS ouvert FROM c2),
    c4 AS (SELECT c3.*, coalesce(explicite, CASE WHEN ouvert AND count(DISTINCT CASE WHEN ouvert THEN palier END) OVER (PARTITION BY club_id, sexe, entente) > 1 THEN palier END, 1) AS rang FROM c3),
    grouped AS (SELECT *, categorie || '|' || sexe || '|' || CAST(rang AS VARCHAR) || '|' || CASE WHEN entente THEN 'entente' ELSE 'club' END AS cle FROM c4)"""


def _engaged(t: T) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("id_ffhb").orderBy("competition", "poule_id"))
    return t("engagements").withColumn("ordre", order).select("id_ffhb", "ordre", "competition", "phase", "niveau")


def _classified(t: T) -> DataFrame:
    rows = t("equipes").filter(f"ext_structure_id IS NOT NULL AND saison_code = '{SEASON}'").select(F.col("ext_structure_id").alias("club_id"), "id_ffhb", "nom")
    nothing = F.lit(None)
    overrides = t("equipes").filter("id % 20 = 0").select("id_ffhb", nothing.cast("string").alias("categorie"), nothing.cast("string").alias("sexe"), F.when(F.col("id") % 40 == 0, 3).alias("rang"), nothing.cast("boolean").alias("entente"), (F.col("id") % 60 == 0).alias("exclu"))
    return teams.classified(rows, _engaged(t), overrides, ["club_id"])


@_reg.add("D3_team_groups", f"""WITH {_GROUPED}, c AS (SELECT g.club_id, g.cle, count(DISTINCT e.competition) AS n FROM grouped g JOIN eng e ON e.id_ffhb = g.id_ffhb GROUP BY g.club_id, g.cle)
    SELECT g.club_id, g.cle, count(*) AS inscriptions, string_agg(g.id_ffhb, ',' ORDER BY g.id_ffhb) AS equipes, coalesce(max(c.n), 0) AS competitions FROM grouped g LEFT JOIN c ON c.club_id = g.club_id AND c.cle = g.cle GROUP BY g.club_id, g.cle""")  # fmt: skip
def team_groups(t: T) -> DataFrame:
    found = teams.groups(_classified(t), _engaged(t), ["club_id"])
    return found.select("club_id", "cle", F.size("equipes").cast("long").alias("inscriptions"), F.array_join("equipes", ",").alias("equipes"), F.size(F.coalesce("competitions", F.array().cast("array<string>"))).cast("long").alias("competitions"))


@_reg.add("L6_domain_order", f"""WITH {_GROUPED} SELECT club_id, cle, CAST(row_number() OVER (PARTITION BY club_id ORDER BY list_position(['Seniors', '-20', '-19', '-18', '-17', '-15', '-13', '-11', '-9', '-7', 'Loisir', 'Autre'], categorie), list_position(['M', 'F', 'mixte'], sexe), rang, entente) AS INTEGER) AS place
    FROM (SELECT DISTINCT club_id, cle, categorie, sexe, rang, entente FROM grouped)""")  # fmt: skip
def domain_order(t: T) -> DataFrame:
    found = teams.groups(_classified(t), _engaged(t), ["club_id"])
    return found.select("club_id", "cle", F.row_number().over(Window.partitionBy("club_id").orderBy("position")).alias("place"))


@_reg.add("D6_group_keys", f"WITH {_GROUPED} SELECT club_id, id_ffhb, cle FROM grouped")
def group_keys(t: T) -> DataFrame:
    return _classified(t).select("club_id", "id_ffhb", "cle")


_INHERITED = f"""{_LINKS}, {_GROUPED},
    keyed AS (SELECT l.*, coalesce(g.cle, 'hors club') AS cle FROM links l LEFT JOIN grouped g ON g.id_ffhb = l.id_ffhb),
    inherited AS (SELECT club_id, equipe_id, id_ffhb, nom, cle, is_entente, CASE WHEN confiance = 'basse' AND sure THEN 'groupe' ELSE methode END AS methode, CASE WHEN confiance = 'basse' AND sure THEN 'moyenne' ELSE confiance END AS confiance
      FROM (SELECT *, bool_or(confiance = 'haute') OVER (PARTITION BY club_id, cle) AS sure FROM keyed))"""


def _inherited(t: T) -> DataFrame:
    names = t("equipes").select(F.col("id").alias("equipe_id"), "id_ffhb")
    keys = _classified(t).select("id_ffhb", "cle")
    rows = _linked(t).join(names, "equipe_id").join(keys, "id_ffhb", "left").withColumn("cle", F.coalesce("cle", F.lit("hors club")))
    return teams.inherit_links(rows, ["club_id"])


@_reg.add("D4_inherited_links", f"WITH {_INHERITED} SELECT club_id, equipe_id, cle, methode, confiance FROM inherited")
def inherited_links(t: T) -> DataFrame:
    return _inherited(t).select("club_id", "equipe_id", "cle", "methode", "confiance")


@_reg.add("D5_teams_with_partners", f"""WITH {_INHERITED} SELECT i.club_id, i.id_ffhb, i.nom, i.confiance, e.logo, coalesce(n.engagements, 0) AS engagements FROM inherited i JOIN {{equipes}} e ON e.id = i.equipe_id
    LEFT JOIN (SELECT id_ffhb, count(*) AS engagements FROM eng GROUP BY id_ffhb) n ON n.id_ffhb = i.id_ffhb WHERE i.confiance <> 'basse'""")  # fmt: skip
def teams_with_partners(t: T) -> DataFrame:
    engaged = t("engagements").groupBy("id_ffhb").agg(F.count(F.lit(1)).alias("engagements"))
    logos = t("equipes").select(F.col("id").alias("equipe_id"), "logo")
    rows = _inherited(t).filter("confiance <> 'basse'").join(logos, "equipe_id").join(engaged, "id_ffhb", "left")
    return rows.select("club_id", "id_ffhb", "nom", "confiance", "logo", F.coalesce("engagements", F.lit(0)).alias("engagements"))


@_reg.add("J22_one_plan_for_client_joins", f"WITH {_LINKS} SELECT l.club_id, count(*) AS equipes, count(e.logo) AS logos, CAST(sum(coalesce(n.n, 0)) AS BIGINT) AS engagements FROM links l JOIN {{equipes}} e ON e.id = l.equipe_id LEFT JOIN (SELECT id_ffhb, count(*) AS n FROM {{engagements}} GROUP BY id_ffhb) n ON n.id_ffhb = l.id_ffhb GROUP BY l.club_id")
def client_joins(t: T) -> DataFrame:
    engaged = t("engagements").groupBy("id_ffhb").agg(F.count(F.lit(1)).alias("n"))
    rows = _linked(t).join(t("equipes").select(F.col("id").alias("equipe_id"), "id_ffhb", "logo"), "equipe_id").join(engaged, "id_ffhb", "left")
    return rows.groupBy("club_id").agg(F.count(F.lit(1)).alias("equipes"), F.count("logo").alias("logos"), F.sum(F.coalesce("n", F.lit(0))).alias("engagements"))


@_reg.add("D2_club_calendar", f"""WITH {_LINKS}, cal AS (SELECT l.club_id, m.id AS match_id, m.date_heure, max(CASE WHEN l.equipe_id = m.equipe_dom_id THEN 1 ELSE 0 END) = 1 AS club_recevant, coalesce(max(CASE WHEN l.equipe_id = m.equipe_dom_id THEN l.nom END), max(CASE WHEN l.equipe_id = m.equipe_ext_id THEN l.nom END)) AS equipe
      FROM links l JOIN (SELECT id, date_heure, equipe_dom_id, equipe_ext_id, equipe_dom_id AS equipe_id FROM {{matchs}} UNION SELECT id, date_heure, equipe_dom_id, equipe_ext_id, equipe_ext_id FROM {{matchs}}) m ON m.equipe_id = l.equipe_id
      WHERE l.confiance = 'haute' GROUP BY l.club_id, m.id, m.date_heure)
    SELECT club_id, match_id, club_recevant, equipe FROM cal""")  # fmt: skip
def club_calendar(t: T) -> DataFrame:
    return teams.calendar(_linked(t, min_confidence="haute"), t("matchs"))


@_reg.add("D29_club_scope", f"WITH {_LINKS} SELECT l.club_id, count(DISTINCT l.equipe_id) AS equipes, count(DISTINCT m.poule_id) AS poules, count(DISTINCT m.fdm_code) AS feuilles FROM links l LEFT JOIN (SELECT poule_id, fdm_code, equipe_dom_id AS e FROM {{matchs}} UNION ALL SELECT poule_id, fdm_code, equipe_ext_id FROM {{matchs}}) m ON m.e = l.equipe_id WHERE l.confiance = 'haute' GROUP BY l.club_id")
def club_scope(t: T) -> DataFrame:
    sides = t("matchs").select("poule_id", "fdm_code", F.explode(F.array("equipe_dom_id", "equipe_ext_id")).alias("equipe_id"))
    rows = _linked(t, min_confidence="haute").join(sides, "equipe_id", "left")
    return rows.groupBy("club_id").agg(F.countDistinct("equipe_id").alias("equipes"), F.countDistinct("poule_id").alias("poules"), F.countDistinct("fdm_code").alias("feuilles"))


@_reg.add("D7_club_players", f"""WITH {_GROUPED}, a AS (SELECT substr(j.numero_licence, 1, 7) AS code, c.joueur_id, c.match_id, c.but_count, e.id_ffhb FROM {{compositions}} c JOIN {{joueurs}} j ON j.id = c.joueur_id JOIN {{equipes}} e ON e.id = c.equipe_id)
    SELECT cl.id_ffhb AS club_id, a.joueur_id, count(DISTINCT a.match_id) AS matchs, CAST(sum(a.but_count) AS BIGINT) AS buts, count(DISTINCT g.cle) AS groupes FROM a JOIN {{clubs}} cl ON cl.code_ffhb = a.code LEFT JOIN grouped g ON g.id_ffhb = a.id_ffhb GROUP BY cl.id_ffhb, a.joueur_id""")  # fmt: skip
def club_players(t: T) -> DataFrame:
    played = t("compositions").join(t("joueurs").select(F.col("id").alias("joueur_id"), F.substring("numero_licence", 1, 7).alias("code_ffhb")), "joueur_id")
    played = played.join(t("equipes").select(F.col("id").alias("equipe_id"), F.col("id_ffhb").alias("team")), "equipe_id").join(t("clubs").select(F.col("id_ffhb").alias("club_id"), "code_ffhb"), "code_ffhb")
    played = played.join(_classified(t).select(F.col("id_ffhb").alias("team"), "cle"), "team", "left")
    return played.groupBy("club_id", "joueur_id").agg(F.countDistinct("match_id").alias("matchs"), F.sum("but_count").alias("buts"), F.countDistinct("cle").alias("groupes"))


@_reg.add("D8_club_standings", """
    SELECT club_id, equipe_id, poule_id, points, difference FROM (SELECT e.ext_structure_id AS club_id, c.equipe_id, c.poule_id, c.points, c.buts_pour - c.buts_contre AS difference, row_number() OVER (PARTITION BY c.equipe_id ORDER BY c.capture_date DESC, c.poule_id) AS nth
      FROM {classements} c JOIN {equipes} e ON e.id = c.equipe_id WHERE e.ext_structure_id IS NOT NULL) WHERE nth = 1""")  # fmt: skip
def club_standings(t: T) -> DataFrame:
    rows = t("classements").join(t("equipes").filter("ext_structure_id IS NOT NULL").select(F.col("id").alias("equipe_id"), F.col("ext_structure_id").alias("club_id")), "equipe_id")
    latest = snapshot.latest_by_key(rows, ["equipe_id"], [F.col("capture_date").desc_nulls_last(), F.col("poule_id").asc()])
    return latest.select("club_id", "equipe_id", "poule_id", "points", (F.col("buts_pour") - F.col("buts_contre")).alias("difference"))


@_reg.add("D43_groups_with_overrides", f"WITH {_GROUPED} SELECT g.club_id, g.cle, count(*) AS inscriptions, count(o.id_ffhb) AS corrigees FROM grouped g LEFT JOIN over_ o ON o.id_ffhb = g.id_ffhb GROUP BY g.club_id, g.cle")
def groups_with_overrides(t: T) -> DataFrame:
    overridden = t("equipes").filter("id % 20 = 0").select("id_ffhb", F.lit(1).alias("o"))
    return _classified(t).join(overridden, "id_ffhb", "left").groupBy("club_id", "cle").agg(F.count(F.lit(1)).alias("inscriptions"), F.count("o").alias("corrigees"))


# Matches.
_STAR = """{matchs} m JOIN {equipes} ed ON ed.id = m.equipe_dom_id JOIN {equipes} ee ON ee.id = m.equipe_ext_id JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} co ON co.id = ph.competition_id
    LEFT JOIN {clubs} cd ON cd.id_ffhb = coalesce(ed.ext_structure_id, ed.porteur_ext_structure_id) LEFT JOIN {clubs} ce ON ce.id_ffhb = coalesce(ee.ext_structure_id, ee.porteur_ext_structure_id)
    LEFT JOIN {salles} sa ON sa.id = m.salle_id LEFT JOIN {salles} sp ON sp.id = cd.salle_principale_id LEFT JOIN {equipements} eq ON eq.equipement_id = m.equipement_id"""
_HALL = "coalesce(sa.nom, eq.nom, sp.nom) AS salle_nom, coalesce(sa.ville, eq.ville, sp.ville) AS salle_ville, (sa.id IS NULL AND eq.equipement_id IS NULL AND sp.id IS NOT NULL) AS salle_approx"
_RELATIONS = ("matchs", "equipes", "poules", "phases", "competitions", "clubs", "salles", "equipements")


def _star(t: T) -> DataFrame:
    return matches.star({name: t(name) for name in _RELATIONS})


def _listed(t: T, **wanted) -> DataFrame:
    return matches.listed({name: t(name) for name in _RELATIONS}, **wanted)


_LIST = ["id", "date_heure", "equipe_dom", "equipe_ext", "club_dom", "club_ext", "competition", "salle_nom", "salle_approx"]


@_reg.add("D9_match_list", f"SELECT m.id, m.date_heure, ed.nom AS equipe_dom, ee.nom AS equipe_ext, cd.nom AS club_dom, ce.nom AS club_ext, co.nom AS competition, {_HALL.replace('coalesce(sa.ville, eq.ville, sp.ville) AS salle_ville, ', '')} FROM {_STAR} WHERE co.id_ffhb = 'C1' AND m.statut = 'joue' AND m.date_heure >= TIMESTAMP '1996-01-01' ORDER BY m.date_heure DESC, m.id DESC LIMIT 20 OFFSET 20")
def match_list(t: T) -> DataFrame:
    rows = _listed(t, competition="C1", statut="joue", date_from=datetime(1996, 1, 1))
    return matches.page(matches.match_rows(rows), [F.col("date_heure").desc_nulls_last(), F.col("id").desc()], 20, 20).select(*_LIST)


@_reg.add("P1_ten_filters", f"SELECT m.id FROM {_STAR} WHERE m.journee <= 22 AND m.statut = 'joue' AND m.date_heure <= TIMESTAMP '2001-01-01' AND (cd.id_ffhb = '365' OR ce.id_ffhb = '365') AND co.saison_code = '{SEASON}'")
def ten_filters(t: T) -> DataFrame:
    return _listed(t, statut="joue", club="365", saison=SEASON, date_to=datetime(2001, 1, 1)).filter(F.col("m.journee") <= 22).select(F.col("m.id").alias("id"))


@_reg.add("P2_either_role_of_club", f"SELECT m.id FROM {_STAR} WHERE ed.id_ffhb = '12' OR ee.id_ffhb = '12'")
def either_role(t: T) -> DataFrame:
    return matches.of_team(t("matchs"), t("equipes"), "12").join(_star(t).select(F.col("m.id").alias("id")), "id", "left_semi").select("id")


@_reg.add("P6_hall_chain", f"SELECT m.id, {_HALL} FROM {_STAR}")
def hall_chain(t: T) -> DataFrame:
    halls = matches.hall()
    return _star(t).select(F.col("m.id").alias("id"), *[halls[c].alias(c) for c in ("salle_nom", "salle_ville", "salle_approx")])


@_reg.add("P7_viewpoint", "SELECT c.joueur_id, c.match_id, CASE WHEN c.cote = 'dom' THEN m.score_dom ELSE m.score_ext END AS pour, CASE WHEN c.cote = 'dom' THEN m.score_ext ELSE m.score_dom END AS contre FROM {compositions} c JOIN {matchs} m ON m.id = c.match_id")
def viewpoint(t: T) -> DataFrame:
    rows = t("compositions").select("joueur_id", "match_id", "cote").join(t("matchs").select(F.col("id").alias("match_id"), "score_dom", "score_ext"), "match_id")
    side = F.col("cote")
    return rows.select("joueur_id", "match_id", matches.viewpoint(side, F.col("score_dom"), F.col("score_ext")).alias("pour"), matches.viewpoint(side, F.col("score_ext"), F.col("score_dom")).alias("contre"))


@_reg.add("P9_distinct_from", "SELECT id FROM {matchs} WHERE score_ext IS DISTINCT FROM score_dom AND (salle_id IS DISTINCT FROM 3 OR equipement_id IS DISTINCT FROM 'E1')")
def distinct_from(t: T) -> DataFrame:
    rows = t("matchs")
    same = F.struct(F.col("salle_id").alias("a"), F.col("equipement_id").alias("b")).eqNullSafe(F.struct(F.lit(3).alias("a"), F.lit("E1").alias("b")))
    return rows.filter(~F.col("score_ext").eqNullSafe(F.col("score_dom")) & ~same).select("id")


@_reg.add("P15_optional_predicate", "SELECT id FROM {matchs} WHERE journee = 4")
def optional_predicate(t: T) -> DataFrame:
    return _star_free(t, journee=4, statut=None)


def _star_free(t: T, **wanted) -> DataFrame:
    """Matches under those conditions that are set."""
    rows = t("matchs")
    for column, value in wanted.items():
        rows = rows if value is None else rows.filter(F.col(column) == value)
    return rows.select("id")


@_reg.add("P16_existence", "SELECT 'PO1' AS poule, EXISTS (SELECT 1 FROM {poules} WHERE id_ffhb = 'PO1') AS existe UNION ALL SELECT 'PO-1', EXISTS (SELECT 1 FROM {poules} WHERE id_ffhb = 'PO-1')")
def existence(t: T) -> DataFrame:
    return matches.existing(t("poules"), "id_ffhb", ["PO1", "PO-1"]).select(F.col("value").alias("poule"), "existe")


@_reg.add("L7_page_parameters", "SELECT id FROM {matchs} ORDER BY date_heure DESC, id DESC LIMIT 100 OFFSET 7")
def page_parameters(t: T) -> DataFrame:
    return matches.page(t("matchs"), [F.col("date_heure").desc_nulls_last(), F.col("id").desc()], 100, 7).select("id")


@_reg.add("D10_match_detail", f"""
    SELECT m.id, ed.nom AS equipe_dom, ee.nom AS equipe_ext, coalesce(c.texte, '') AS compositions, coalesce(a.texte, '') AS actions, coalesce(o.texte, '') AS officiels FROM {_STAR}
    LEFT JOIN (SELECT match_id, string_agg(cote || coalesce(CAST(numero_maillot AS VARCHAR), '?') || ':' || CAST(joueur_id AS VARCHAR), ',' ORDER BY cote, numero_maillot NULLS LAST, joueur_id) AS texte FROM {{compositions}} GROUP BY match_id) c ON c.match_id = m.id
    LEFT JOIN (SELECT match_id, string_agg(CAST(ordre AS VARCHAR) || type_action, ',' ORDER BY ordre) AS texte FROM {{actions}} GROUP BY match_id) a ON a.match_id = m.id
    LEFT JOIN (SELECT match_id, string_agg(role || ':' || CAST(arbitre_id AS VARCHAR), ',' ORDER BY role, arbitre_id) AS texte FROM {{officiels}} GROUP BY match_id) o ON o.match_id = m.id""")  # fmt: skip
def match_detail(t: T) -> DataFrame:
    lineups = t("compositions").select("match_id", "cote", "numero_maillot", F.col("joueur_id").alias("joueur"), F.col("but_count").alias("buts"))
    actions = t("actions").select("match_id", "ordre", "periode", F.col("type_action").alias("type"))
    officials = t("officiels").select("match_id", "role", F.col("arbitre_id").alias("nom"))
    found = matches.detail(_star(t), lineups, actions, officials)
    text = lambda name, part: F.coalesce(F.array_join(F.transform(name, part), ","), F.lit("")).alias(name)
    return found.select(
        "id", "equipe_dom", "equipe_ext",
        text("compositions", lambda x: F.concat(x["cote"], F.coalesce(x["numero_maillot"].cast("string"), F.lit("?")), F.lit(":"), x["joueur"].cast("string"))),
        text("actions", lambda x: F.concat(x["ordre"].cast("string"), x["type"])), text("officiels", lambda x: F.concat(x["role"], F.lit(":"), x["nom"].cast("string"))),
    )


# Players, referees, competitions, halls, reference lists.
_same = _reg.same
@_reg.add("D11_player_detail", """
    SELECT j.id, j.numero_licence, coalesce(s.matchs, 0) AS matchs, coalesce(s.buts, 0) AS buts, d.match_id AS dernier_match FROM {joueurs} j
    LEFT JOIN (SELECT joueur_id, count(DISTINCT match_id) AS matchs, CAST(sum(but_count) AS BIGINT) AS buts FROM {compositions} GROUP BY joueur_id) s ON s.joueur_id = j.id
    LEFT JOIN (SELECT joueur_id, match_id FROM (SELECT c.joueur_id, c.match_id, row_number() OVER (PARTITION BY c.joueur_id ORDER BY m.date_heure DESC, m.id DESC) AS nth FROM {compositions} c JOIN {matchs} m ON m.id = c.match_id) x WHERE nth = 1) d ON d.joueur_id = j.id""")
def player_detail(t: T) -> DataFrame:
    """One pass over the line-ups, each with its match's date: all of a player comes from one grouping of rows that are dealt once, without windows."""
    t = t.dealt()
    dates = t("matchs").groupBy(F.col("id").alias("match_id")).agg(F.max("date_heure").alias("date_heure"))
    lines = t("compositions").select("joueur_id", "match_id", "but_count").join(dates, "match_id").repartition(t.parts, "joueur_id")
    played = lines.groupBy("joueur_id", "match_id").agg(F.sum("but_count").alias("buts"), F.max("date_heure").alias("date_heure"))
    totals = played.groupBy("joueur_id").agg(F.count("match_id").alias("matchs"), F.sum("buts").alias("buts"), F.max(F.struct("date_heure", "match_id")).alias("dernier"))
    rows = t("joueurs").join(totals, F.col("id") == F.col("joueur_id"), "left")
    return rows.select("id", "numero_licence", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matchs", "buts")], F.col("dernier.match_id").alias("dernier_match"))


_same("D12_referees", """
    SELECT a.id_ffhb, a.nom_complet, (SELECT count(*) FROM {officiels} o WHERE o.arbitre_id = a.id) AS matchs, (SELECT count(*) FROM {officiels} o WHERE o.arbitre_id = a.id AND o.role = 'arbitre1') AS principal FROM {arbitres} a""")
_same("D13_competitions", """
    SELECT co.id_ffhb, co.nom, count(DISTINCT ph.id) AS phases, count(po.id) AS poules, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS matchs FROM {competitions} co LEFT JOIN {phases} ph ON ph.competition_id = co.id LEFT JOIN {poules} po ON po.phase_id = ph.id
    LEFT JOIN (SELECT poule_id, count(*) AS n FROM {matchs} GROUP BY poule_id) n ON n.poule_id = po.id GROUP BY co.id_ffhb, co.nom""")
_same("J5_optional_child", "SELECT ph.id_ffhb AS phase, array_join(sort_array(collect_list(po.id_ffhb)), ',') AS poules FROM {phases} ph LEFT JOIN {poules} po ON po.phase_id = ph.id GROUP BY ph.id_ffhb",
      "SELECT ph.id_ffhb AS phase, coalesce(string_agg(po.id_ffhb, ',' ORDER BY po.id_ffhb), '') AS poules FROM {phases} ph LEFT JOIN {poules} po ON po.phase_id = ph.id GROUP BY ph.id_ffhb")
_same("D14_poule_standing", """
    SELECT c.poule_id, CAST(row_number() OVER (PARTITION BY c.poule_id ORDER BY c.points DESC, c.buts_pour - c.buts_contre DESC, c.equipe_id) AS INTEGER) AS position, e.nom, c.points, c.joues FROM {classements} c JOIN {equipes} e ON e.id = c.equipe_id""")
_same("D15_poule_stats", """
    SELECT s.poule_id, s.joueur_id, s.match_count, s.total_buts FROM {stats_joueurs} s JOIN (SELECT poule_id, max(capture_date) AS derniere FROM {stats_joueurs} GROUP BY poule_id) d ON d.poule_id = s.poule_id AND d.derniere = s.capture_date""")
_HALL_MATCHES = """
    SELECT h.id_ffhb, h.nom, count(m.id) AS matchs, min(m.date_heure) AS premier FROM (SELECT id_ffhb, nom, id, CAST(NULL AS STRING) AS equipement_id FROM {salles} UNION ALL SELECT equipement_id, nom, NULL, equipement_id FROM {equipements}) h
    LEFT JOIN (SELECT id, date_heure, salle_id, CASE WHEN salle_id IS NULL THEN equipement_id END AS equipement_id FROM {matchs}) m ON m.salle_id = h.id OR m.equipement_id = h.equipement_id GROUP BY h.id_ffhb, h.nom"""
# Each kind of place meets its matches by equality, and they are counted before the join.
_same("D17_hall_matches", """
    SELECT s.id_ffhb, s.nom, coalesce(n.n, 0) AS matchs, n.premier FROM {salles} s LEFT JOIN (SELECT salle_id, count(*) AS n, min(date_heure) AS premier FROM {matchs} WHERE salle_id IS NOT NULL GROUP BY salle_id) n ON n.salle_id = s.id
    UNION ALL
    SELECT e.equipement_id, e.nom, coalesce(n.n, 0), n.premier FROM {equipements} e LEFT JOIN (SELECT equipement_id, count(*) AS n, min(date_heure) AS premier FROM {matchs} WHERE salle_id IS NULL GROUP BY equipement_id) n ON n.equipement_id = e.equipement_id""", _HALL_MATCHES)
_same("D18_clubs", "SELECT c.id_ffhb, c.nom, c.code_ffhb, n.equipes FROM {clubs} c LEFT JOIN (SELECT ext_structure_id, count(*) AS equipes FROM {equipes} GROUP BY ext_structure_id) n ON n.ext_structure_id = c.id_ffhb WHERE c.id_ffhb = '365' OR c.code_ffhb = '0000466' OR c.nom ILIKE '%machinery%'")
_same("D19_team_detail", """
    SELECT e.id_ffhb, e.nom, c.nom AS club, coalesce(h.n, 0) AS domicile, coalesce(a.n, 0) AS exterieur, coalesce(j.n, 0) AS joueurs FROM {equipes} e LEFT JOIN {clubs} c ON c.id_ffhb = coalesce(e.ext_structure_id, e.porteur_ext_structure_id)
    LEFT JOIN (SELECT equipe_dom_id, count(*) AS n FROM {matchs} GROUP BY equipe_dom_id) h ON h.equipe_dom_id = e.id LEFT JOIN (SELECT equipe_ext_id, count(*) AS n FROM {matchs} GROUP BY equipe_ext_id) a ON a.equipe_ext_id = e.id
    LEFT JOIN (SELECT equipe_id, count(DISTINCT joueur_id) AS n FROM {compositions} GROUP BY equipe_id) j ON j.equipe_id = e.id""")
_same("D20_reference_lists", "SELECT 'saison' AS liste, saison_code AS code, saison_code AS nom FROM {saisons} UNION ALL SELECT 'ligue', CAST(r_regionkey AS STRING), r_name FROM {region} UNION ALL SELECT 'departement', CAST(n_nationkey AS STRING), n_name FROM {nation}")

# Search.
_GRAMS = "flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"


def similar_sql(query: str, rows: str) -> str:
    """Word similarity by all runs of trigrams, over rows (type, id, nom)."""
    q, g = _GRAMS.format(f"'{query}'"), _GRAMS.format("nom")
    return f"""WITH q AS (SELECT list_distinct({q}) AS q), names AS (SELECT nom, {g} AS g FROM (SELECT DISTINCT nom FROM ({rows}))),
      runs AS (SELECT nom, g, i, unnest(generate_series(i, len(g))) AS j FROM (SELECT nom, g, unnest(generate_series(1, len(g))) AS i FROM names)),
      cut AS (SELECT nom, list_distinct(list_slice(g, i, j)) AS r FROM runs), scored AS (SELECT nom, max(len(list_intersect(q, r)) / (len(q) + len(r) - len(list_intersect(q, r)))) AS score FROM cut, q GROUP BY nom)
      SELECT x.type, x.id, x.nom, round(s.score, 6) AS score FROM ({rows}) x JOIN scored s ON s.nom = x.nom WHERE s.score > 0.6"""


PARTS = "SELECT 'part' AS type, CAST(p_partkey AS STRING) AS id, p_name AS nom FROM {part}"
_ENTITIES = f"SELECT 'club' AS type, id_ffhb AS id, nom FROM {{clubs}} UNION ALL SELECT 'equipe', id_ffhb, nom FROM {{equipes}} WHERE saison_code = '{SEASON}' UNION ALL SELECT 'competition', id_ffhb, nom FROM {{competitions}} UNION ALL SELECT 'joueur', numero_licence, nom FROM {{joueurs}} UNION ALL SELECT 'salle', id_ffhb, nom FROM {{salles}}"


def _search(t: T, query: str, rows: str) -> DataFrame:
    """Names are scored once each; those that hold too few of the query's trigrams can't pass and are not scored."""
    near = t.sql(rows).filter(similarity.may_match(F.lit(query), F.col("nom")))
    # The score is of an aggregate's result, so no filter on it moves below the grouping or to the other side of the join.
    scored = near.groupBy("nom").agg(F.max("nom").alias("text")).withColumn("score", similarity.word_similarity(F.lit(query), F.col("text")))
    return near.join(scored.filter(F.col("score") > similarity.THRESHOLD), "nom").select("type", "id", "nom", F.round("score", 6).alias("score"))


@_reg.add("F12_trigram_search", similar_sql("smal ring", PARTS))
def trigram_search(t: T) -> DataFrame:
    return _search(t, "smal ring", PARTS)


@_reg.add("D16_search", similar_sql("nation machinery", _ENTITIES))
def search(t: T) -> DataFrame:
    return _search(t, "nation machinery", _ENTITIES)


