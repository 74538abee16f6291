"""Pages of one player, referee, competition, poule, hall, club or team with what belongs to them, nested.

``t`` gives the league's tables by name.  Every page is made for all ids at once, or for
those of ``only`` (a column condition over the page's own table), which is applied before
anything is joined.  Lists inside a page are bounded where the page shows a bounded list
(the last ten matches), and hold one entity's own rows otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

T = Callable[[str], DataFrame]
#: Matches in a player's page.
HISTORY = 10


def _picked(rows: DataFrame, only: Column | None) -> DataFrame:
    return rows if only is None else rows.filter(only)


def _list(rows: DataFrame, key: str, order: list[str], fields: list[str], name: str) -> DataFrame:
    """(key, name): the rows of each key as an array of structs in order."""
    entry = F.struct(*order, F.struct(*fields).alias("x"))
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["x"]).alias(name))


def _empty(name: str) -> Column:
    return F.coalesce(name, F.array())


def _named(t: T, side: str) -> DataFrame:
    return t("equipes").select(F.col("id").alias(f"equipe_{side}_id"), F.col("nom").alias(f"equipe_{side}_nom"), F.col("id_ffhb").alias(f"equipe_{side}_id_ffhb"))


def _of_competition(t: T) -> DataFrame:
    """(poule_id, poule_id_ffhb, poule_nom, phase_id_ffhb, phase_nom, competition_id_ffhb, competition_nom, niveau)."""
    phases = t("phases").select(F.col("id").alias("phase_id"), F.col("id_ffhb").alias("phase_id_ffhb"), F.col("nom").alias("phase_nom"), "competition_id")
    comps = t("competitions").select(F.col("id").alias("competition_id"), F.col("id_ffhb").alias("competition_id_ffhb"), F.col("nom").alias("competition_nom"), "niveau")
    poules = t("poules").select(F.col("id").alias("poule_id"), F.col("id_ffhb").alias("poule_id_ffhb"), F.col("nom").alias("poule_nom"), "phase_id")
    return poules.join(phases, "phase_id").join(comps, "competition_id").drop("phase_id", "competition_id")


def matches(t: T, rows: DataFrame | None = None) -> DataFrame:
    """Matches of two known teams with the teams' names, the poule and the competition."""
    m = t("matchs") if rows is None else rows
    return m.join(_named(t, "dom"), "equipe_dom_id").join(_named(t, "ext"), "equipe_ext_id").join(_of_competition(t), "poule_id")


# Players.
def player_matches(t: T, only: Column | None = None) -> DataFrame:
    """The matches of players, seen from the player's team: numero_licence, id_ffhb_match, date_heure, statut, forfait, equipe_nom, adversaire_nom, score_equipe, score_adversaire, buts, poule and competition."""
    own = _picked(t("joueurs"), only).select(F.col("id").alias("joueur_id"), "numero_licence")
    lines = t("compositions").join(own, "joueur_id").select("numero_licence", "match_id", "equipe_id", F.col("but_count").alias("buts"))
    team = t("equipes").select(F.col("id").alias("equipe_id"), F.col("nom").alias("equipe_nom"))
    rows = lines.join(matches(t).withColumnRenamed("id", "match_id"), "match_id").join(team, "equipe_id")
    home = F.col("equipe_dom_id") == F.col("equipe_id")
    forfeit = F.when(F.col("forfait_equipe").isNotNull(), F.when((F.col("forfait_equipe") == "dom") == home, "equipe").otherwise("adversaire"))
    side = lambda a, b: F.when(home, F.col(a)).otherwise(F.col(b))
    return rows.select(
        "numero_licence", "match_id", "id_ffhb_match", "date_heure", "statut", forfeit.alias("forfait"), "equipe_nom", side("equipe_ext_nom", "equipe_dom_nom").alias("adversaire_nom"),
        side("score_dom", "score_ext").alias("score_equipe"), side("score_ext", "score_dom").alias("score_adversaire"), "buts", "poule_id_ffhb", "competition_nom",
    )


def player_pages(t: T, only: Column | None = None, parts: int | None = None) -> DataFrame:
    """Players with their totals (over all line-ups) and ``historique``, the last HISTORY matches, newest first; a line-up's team is the one of its side (``cote``).

    Line-ups are dealt by player once, to ``parts`` tasks if given.
    """
    players, lines = _picked(t("joueurs"), only), t("compositions")
    if only is not None:
        lines = lines.join(players.select(F.col("id").alias("joueur_id")), "joueur_id", "left_semi")
    totals = lines.groupBy("joueur_id").agg(F.sum("but_count").alias("total_buts"), F.countDistinct("match_id").alias("total_matchs"))
    # Teams are looked up a match at a time: line-ups, which are many more, never travel by team.
    names = lambda side: _named(t, side).drop(f"equipe_{side}_id_ffhb")
    known = t("matchs").select(F.col("id").alias("match_id"), "date_heure", "equipe_dom_id", "equipe_ext_id", "score_dom", "score_ext", "id_ffhb_match")
    known = known.join(names("dom"), "equipe_dom_id").join(names("ext"), "equipe_ext_id").drop("equipe_dom_id", "equipe_ext_id")
    dated = lines.select("joueur_id", "match_id", "cote", "but_count").join(known, "match_id")
    dated = dated.repartition(parts, "joueur_id") if parts else dated
    newest = Window.partitionBy("joueur_id").orderBy(F.desc_nulls_last("date_heure"), F.desc("match_id"))
    last = dated.withColumn("rang", F.row_number().over(newest)).filter(F.col("rang") <= HISTORY)
    last = last.withColumn("equipe_joueur_nom", F.when(F.col("cote") == "dom", F.col("equipe_dom_nom")).otherwise(F.col("equipe_ext_nom")))
    history = _list(last, "joueur_id", ["rang"], ["id_ffhb_match", "date_heure", "equipe_dom_nom", "equipe_ext_nom", "score_dom", "score_ext", "equipe_joueur_nom", F.col("but_count").alias("buts")], "historique")
    joined = players.join(totals, F.col("id") == F.col("joueur_id"), "left").drop("joueur_id").join(history, F.col("id") == F.col("joueur_id"), "left").drop("joueur_id")
    return joined.withColumns({"total_buts": F.coalesce("total_buts", F.lit(0)), "total_matchs": F.coalesce("total_matchs", F.lit(0)), "historique": _empty("historique")})


# Referees.
def referee_pages(t: T, only: Column | None = None) -> DataFrame:
    """Referees with nb_matchs."""
    own = _picked(t("arbitres"), only)
    n = t("officiels").groupBy(F.col("arbitre_id").alias("id")).agg(F.count(F.lit(1)).alias("nb_matchs"))
    return own.join(n, "id", "left").withColumn("nb_matchs", F.coalesce("nb_matchs", F.lit(0)))


def referee_matches(t: T, only: Column | None = None) -> DataFrame:
    """The matches of referees with their role."""
    own = _picked(t("arbitres"), only).select(F.col("id").alias("arbitre_id"), F.col("id_ffhb").alias("arbitre_id_ffhb"))
    rows = t("officiels").join(own, "arbitre_id").join(matches(t).withColumnRenamed("id", "match_id"), "match_id")
    return rows.select("arbitre_id_ffhb", "match_id", "id_ffhb_match", "date_heure", "role", "equipe_dom_id_ffhb", "equipe_dom_nom", "equipe_ext_id_ffhb", "equipe_ext_nom", "poule_id_ffhb", "competition_nom")


# Competitions and poules.
def competition_pages(t: T, only: Column | None = None) -> DataFrame:
    """Competitions with ``phases`` by name, each with its ``poules`` by name."""
    comps = _picked(t("competitions"), only)
    poules = _list(t("poules"), "phase_id", ["nom", "id_ffhb"], ["id_ffhb", "nom"], "poules")
    phases = t("phases").join(comps.select(F.col("id").alias("competition_id")), "competition_id", "left_semi").join(poules, F.col("id") == F.col("phase_id"), "left")
    nested = _list(phases.withColumn("poules", _empty("poules")), "competition_id", ["nom", "id_ffhb"], ["id_ffhb", "nom", "poules"], "phases")
    return comps.join(nested, F.col("id") == F.col("competition_id"), "left").drop("competition_id").withColumn("phases", _empty("phases"))


def poule_pages(t: T, only: Column | None = None) -> DataFrame:
    """Poules with their phase, their competition and ``classement``, the newest standing in order."""
    poules = _picked(t("poules"), only).select(F.col("id").alias("poule_id"), "saison_code")
    newest = Window.partitionBy("poule_id", "equipe_id").orderBy(F.desc("capture_date"))
    rows = t("classements").withColumn("nth", F.row_number().over(newest)).filter("nth = 1").join(t("equipes").select(F.col("id").alias("equipe_id"), F.col("id_ffhb").alias("equipe_id_ffhb"), F.col("nom").alias("equipe_nom")), "equipe_id")
    place = F.row_number().over(Window.partitionBy("poule_id").orderBy(F.desc("points"), F.desc(F.col("buts_pour") - F.col("buts_contre")), "equipe_id"))
    lines = _list(rows.withColumn("position", place), "poule_id", ["position"], ["position", "equipe_id_ffhb", "equipe_nom", "points", "joues"], "classement")
    return poules.join(_of_competition(t), "poule_id").join(lines, "poule_id", "left").withColumn("classement", _empty("classement"))


# Halls.
def halls(t: T) -> DataFrame:
    """(id_ffhb, nom, adresse, code_postal, ville, salle_id, equipement_id): halls of clubs, and the places of matches whose id no hall has."""
    own = t("salles").select("id_ffhb", "nom", "adresse", "code_postal", "ville", F.col("id").alias("salle_id"), F.lit(None).cast("string").alias("equipement_id"))
    places = t("equipements").select(F.col("equipement_id").alias("id_ffhb"), "nom", "adresse", "code_postal", "ville", F.lit(None).cast("long").alias("salle_id"), "equipement_id")
    return own.unionByName(places.join(own.select("id_ffhb"), "id_ffhb", "left_anti"))


def hall_matches(t: T, only: Column | None = None) -> DataFrame:
    """The matches of halls, by the hall's id or by the place's: two joins on equality."""
    own = _picked(halls(t), only)
    by = lambda c: matches(t, t("matchs").join(own.filter(F.col(c).isNotNull()).select(F.col(c), F.col("id_ffhb").alias("lieu")), c))
    fields = ["lieu", "id", "id_ffhb_match", "date_heure", "statut", "equipe_dom_nom", "equipe_ext_nom", "score_dom", "score_ext", "competition_nom"]
    return by("salle_id").select(fields).unionByName(by("equipement_id").select(fields))


# Clubs and teams.
def club_pages(t: T, only: Column | None = None) -> DataFrame:
    """Clubs with ``salle_principale``, a struct or null."""
    hall = t("salles").select(F.col("id").alias("salle_principale_id"), F.struct("id_ffhb", "nom", "adresse", "code_postal", "ville").alias("salle_principale"))
    return _picked(t("clubs"), only).join(hall, "salle_principale_id", "left").drop("salle_principale_id")


def team_pages(t: T, season: str, only: Column | None = None) -> DataFrame:
    """Teams of a season with ``club`` (a struct or null) and ``engagements``, their poules by competition, phase and poule."""
    own = _picked(t("equipes").filter(F.col("saison_code") == season), only).select("id", "id_ffhb", "nom", "saison_code", "ext_structure_id")
    club = t("clubs").select(F.col("id_ffhb").alias("ext_structure_id"), F.struct("id_ffhb", "code_ffhb", "nom").alias("club"))
    plays = t("engagements").select("id_ffhb", "poule_id").join(own.select("id_ffhb"), "id_ffhb", "left_semi").distinct().join(_of_competition(t), "poule_id")
    listed = _list(plays, "id_ffhb", ["competition_nom", "phase_nom", "poule_nom", "poule_id_ffhb"], ["poule_id_ffhb", "poule_nom", "phase_nom", "competition_id_ffhb", "competition_nom", "niveau"], "engagements")
    return own.join(club, "ext_structure_id", "left").join(listed, "id_ffhb", "left").withColumn("engagements", _empty("engagements")).drop("ext_structure_id")


def team_matches(t: T, season: str, only: Column | None = None) -> DataFrame:
    """The matches of a season's teams, at home and away: two joins on equality; a match of two of the teams is a row of each."""
    own = _picked(t("equipes").filter(F.col("saison_code") == season), only)
    by = lambda side: t("matchs").join(own.select(F.col("id").alias(f"equipe_{side}_id"), F.col("id_ffhb").alias("equipe_id_ffhb")), f"equipe_{side}_id").withColumn("cote", F.lit(side))
    both = by("dom").unionByName(by("ext").filter("equipe_dom_id <> equipe_ext_id"))
    return matches(t, both).select("equipe_id_ffhb", "cote", "id", "id_ffhb_match", "date_heure", "statut", "equipe_dom_nom", "equipe_ext_nom", "score_dom", "score_ext", "journee", "competition_nom")


def team_rosters(t: T, season: str, only: Column | None = None) -> DataFrame:
    """Who played for a season's teams: numero_licence, nom, prenom, matchs and buts."""
    own = _picked(t("equipes").filter(F.col("saison_code") == season), only).select(F.col("id").alias("equipe_id"), F.col("id_ffhb").alias("equipe_id_ffhb"))
    sums = t("compositions").join(own, "equipe_id").groupBy("equipe_id_ffhb", "joueur_id").agg(F.countDistinct("match_id").alias("matchs"), F.coalesce(F.sum("but_count"), F.lit(0)).alias("buts"))
    return sums.join(t("joueurs").select(F.col("id").alias("joueur_id"), "numero_licence", "nom", "prenom"), "joueur_id").drop("joueur_id")
