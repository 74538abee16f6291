"""The seven structure loads over the league, from captures that are written from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.operators import entities, pipeline
from leaguespark.plans.league import League
from leaguespark.streaming import incremental

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]

#: Payloads by step: the natural key and the fields; some lack a needed field, some name a parent that nobody knows.
_PAYLOADS = {
    "salles": "SELECT id_ffhb AS natural_key, id_ffhb, CASE WHEN id % 9 = 8 THEN ' ' ELSE nom END AS nom, '  ' || adresse AS adresse, code_postal, ville, CASE WHEN id % 5 = 4 THEN 'ZZ' ELSE CAST(id AS STRING) END AS departement_code FROM {salles}",
    "clubs": "SELECT id_ffhb AS natural_key, CASE WHEN departement_id % 11 = 10 THEN 'x' || id_ffhb ELSE id_ffhb END AS id_ffhb, nom, ville, CAST(departement_id AS STRING) AS departement_code, CASE WHEN salle_principale_id IS NOT NULL THEN 'S' || CAST(salle_principale_id AS STRING) END AS salle_principale_id_ffhb, email, CASE WHEN departement_id % 2 = 0 THEN CAST(departement_id AS STRING) END AS nb_licence_senior_h, '3' AS nb_licence_jeunes_f FROM {clubs}",
    "competitions": "SELECT id_ffhb AS natural_key, id_ffhb AS ext_competition_id, nom, CASE WHEN id = 4 THEN 'mondial' ELSE niveau END AS niveau, CASE WHEN id % 2 = 0 THEN 'F' END AS sexe, '1' AS afficher_stats_joueurs FROM {competitions}",
    "phases": "SELECT id_ffhb AS natural_key, id_ffhb AS ext_phase_id, 'C' || CAST(competition_id AS STRING) AS ext_competition_id, nom FROM {phases}",
    "poules": "SELECT id_ffhb AS natural_key, id_ffhb AS ext_poule_id, CASE WHEN id % 7 = 6 THEN 'PH?' ELSE 'PH' || CAST(phase_id AS STRING) END AS ext_phase_id, CASE WHEN id % 10 = 9 THEN '' ELSE nom END AS nom FROM {poules}",
    "equipes": "SELECT id_ffhb AS natural_key, id_ffhb AS ext_equipe_id, nom, ext_structure_id, logo, CAST(id % 50 AS STRING) AS structure_id FROM {equipes}",
    "engagements": "SELECT e.id_ffhb || '-' || po.id_ffhb AS natural_key, e.id_ffhb AS ext_equipe_id, po.id_ffhb AS ext_poule_id FROM (SELECT DISTINCT id_ffhb, poule_id FROM {engagements}) e JOIN {poules} po ON po.id = e.poule_id",
}


def captures(t: T, name: str) -> DataFrame:
    """Two captures of each key, the first one with another name."""
    rows = t.sql(_PAYLOADS[name])
    fields = [c for c in rows.columns if c != "natural_key"]
    payload = F.to_json(F.struct(*fields))
    early = F.replace(payload, F.lit('"nom":"'), F.lit('"nom":"OLD '))
    return rows.select("natural_key", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("id"), p.alias("payload"), F.lit(f"2025-10-0{i} 00:00:00").cast("timestamp").alias("scraped_at")) for i, p in ((1, early), (2, payload))])).alias("c")).select("natural_key", "c.*")


def _departments(t: T) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_regionkey").cast("string").alias("ligue"))


def _pipeline(t: T) -> pipeline.Pipeline:
    spark = t("region").sparkSession
    return pipeline.Pipeline(spark, incremental.work_dir(spark), lambda name: captures(t, name), {"departements": _departments(t)})


def _loaded(t: T, upto: str) -> pipeline.Pipeline:
    """The steps up to one, stopped half way and resumed."""
    made = _pipeline(t)
    names = [s.name for s in pipeline.ordered(pipeline.STEPS)]
    names = names[: names.index(upto) + 1]
    made.run("c1", only=names[: len(names) // 2] or names)
    made.run("c1", only=names)
    return made


_TITLE = "array_to_string(list_transform(string_split({0}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
_SALLES = f"SELECT id_ffhb, {_TITLE.format('nom')} AS nom, trim(adresse) AS adresse, code_postal, {_TITLE.format('ville')} AS ville, CASE WHEN departement_code <> 'ZZ' THEN departement_code END AS departement_code FROM ({_PAYLOADS['salles']}) WHERE trim(nom) <> ''"
_CLUBS = f"""SELECT c.id_ffhb, {_TITLE.format('c.nom')} AS nom, c.departement_code, CAST(n.n_regionkey AS VARCHAR) AS ligue, s.id_ffhb AS salle_principale_id_ffhb, c.email, CAST(coalesce(CAST(c.nb_licence_senior_h AS INTEGER), 0) + 3 AS INTEGER) AS effectif_estime
    FROM ({_PAYLOADS['clubs']}) c JOIN {{nation}} n ON CAST(n.n_nationkey AS VARCHAR) = c.departement_code LEFT JOIN ({_SALLES}) s ON s.id_ffhb = c.salle_principale_id_ffhb WHERE regexp_full_match(c.id_ffhb, '[0-9]+')"""
_COMPETITIONS = f"SELECT ext_competition_id AS id_ffhb, nom, niveau, sexe, true AS afficher_stats_joueurs FROM ({_PAYLOADS['competitions']}) WHERE niveau <> 'mondial'"
_PHASES = f"SELECT p.ext_phase_id AS id_ffhb, p.nom, p.ext_competition_id AS competition_id_ffhb FROM ({_PAYLOADS['phases']}) p JOIN ({_COMPETITIONS}) c ON c.id_ffhb = p.ext_competition_id"
_POULES = f"SELECT p.ext_poule_id AS id_ffhb, p.nom, p.ext_phase_id AS phase_id_ffhb FROM ({_PAYLOADS['poules']}) p JOIN ({_PHASES}) h ON h.id_ffhb = p.ext_phase_id WHERE p.nom <> ''"
_EQUIPES = f"""WITH e AS (SELECT p.ext_equipe_id AS id_ffhb, trim(p.nom) AS nom, c.id_ffhb AS club_id_ffhb, p.ext_structure_id, p.structure_id AS structure_interne_id FROM ({_PAYLOADS['equipes']}) p LEFT JOIN ({_CLUBS}) c ON c.id_ffhb = p.ext_structure_id),
    most AS (SELECT structure_interne_id, ext_structure_id AS porteur FROM e WHERE ext_structure_id IS NOT NULL GROUP BY structure_interne_id, ext_structure_id QUALIFY row_number() OVER (PARTITION BY structure_interne_id ORDER BY count(*) DESC, ext_structure_id) = 1)
    SELECT e.*, CASE WHEN ext_structure_id IS NULL THEN porteur END AS porteur_ext_structure_id FROM e LEFT JOIN most USING (structure_interne_id)"""
_ENGAGEMENTS = f"SELECT g.ext_equipe_id AS equipe_id_ffhb, g.ext_poule_id AS poule_id_ffhb FROM ({_PAYLOADS['engagements']}) g JOIN ({_POULES}) p ON p.id_ffhb = g.ext_poule_id"


def _plain(t: T, name: str) -> DataFrame:
    """One load, and those it needs, as one plan: nothing is stored."""
    step = next(s for s in pipeline.STEPS if s.name == name)
    found = step.load(captures(t, name), lambda other: _departments(t) if other == "departements" else _plain(t, other))
    rows = found.new.select(*found.columns)
    if not found.after:
        return rows
    return _with(rows, found)


def _with(rows: DataFrame, found: entities.Prepared) -> DataFrame:
    """Rows with what the second merge changes."""
    late = found.after(rows).select(*[F.col(k).alias(f"__{k}") for k in found.keys], *[F.col(c).alias(f"__{c}") for c in found.after_overwrite])
    joined = rows.join(late, [F.col(k) == F.col(f"__{k}") for k in found.keys], "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c) for c in found.after_overwrite}).select(*rows.columns)


def _entity(query: str, name: str, sql: str, columns: list[str]) -> None:
    def rows(t: T) -> DataFrame:
        return _plain(t, name).select(*columns)

    _reg.add(query, sql)(rows)


_entity("D30_halls", "salles", _SALLES, ["id_ffhb", "nom", "adresse", "code_postal", "ville", "departement_code"])
_entity("D30_clubs", "clubs", _CLUBS, ["id_ffhb", "nom", "departement_code", "ligue", "salle_principale_id_ffhb", "email", "effectif_estime"])
_entity("D30_competitions", "competitions", _COMPETITIONS, ["id_ffhb", "nom", "niveau", "sexe", "afficher_stats_joueurs"])
_entity("D30_phases", "phases", _PHASES, ["id_ffhb", "nom", "competition_id_ffhb"])
_entity("D30_poules", "poules", _POULES, ["id_ffhb", "nom", "phase_id_ffhb"])
_entity("D30_teams", "equipes", _EQUIPES, ["id_ffhb", "nom", "club_id_ffhb", "ext_structure_id", "structure_interne_id", "porteur_ext_structure_id"])
_entity("D30_engagements", "engagements", _ENGAGEMENTS, ["equipe_id_ffhb", "poule_id_ffhb"])


@_reg.add("D36_resumed_pipeline", " UNION ALL ".join(f"SELECT '{step}' AS step, 'inserted' AS outcome, count(*) AS n FROM ({sql})" for step, sql in (("salles", _SALLES), ("clubs", _CLUBS), ("competitions", _COMPETITIONS), ("phases", _PHASES), ("poules", _POULES), ("equipes", _EQUIPES), ("engagements", _ENGAGEMENTS)))
    + f" UNION ALL SELECT 'salles', 'rejected', count(*) FROM ({_PAYLOADS['salles']}) WHERE trim(nom) = '' HAVING count(*) > 0 UNION ALL SELECT 'equipes', 'warned', count(*) FROM ({_EQUIPES}) WHERE club_id_ffhb IS NULL HAVING count(*) > 0")
def resumed_pipeline(t: T) -> DataFrame:
    """All seven loads, stopped half way and resumed; a second campaign finds nothing to change."""
    made = _loaded(t, "engagements")
    rows = made.report("c1")
    return rows.filter("outcome = 'inserted' OR step = 'salles' AND outcome = 'rejected' OR step = 'equipes' AND outcome = 'warned'")
