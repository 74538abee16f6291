"""Loads from captures into tables: the latest capture of each key, parsed, checked, resolved, merged and reported."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.functions import classify, coerce, dates
from leaguespark.operators import merge, snapshot


@dataclass
class Load:
    """What a load gives: merged ``rows`` (with their outcome), ``warnings`` (key, warning) and ``rejects`` (key, payload, reasons)."""

    rows: DataFrame
    warnings: DataFrame
    rejects: DataFrame

    def report(self) -> DataFrame:
        """(outcome, n): inserted, updated, noop, warned and rejected rows."""
        warned = self.warnings.select(F.lit("warned").alias("outcome"))
        rejected = self.rejects.select(F.lit("rejected").alias("outcome"))
        rows = self.rows.filter("outcome <> 'kept'").select("outcome")
        return rows.unionByName(warned).unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def newest(captures: DataFrame) -> DataFrame:
    """The newest capture of each key; captures: id, natural_key, payload, scraped_at."""
    return snapshot.latest_by_key(captures, ["natural_key"], [F.col("scraped_at").desc_nulls_last(), F.col("id").desc()])


def latest_payloads(captures: DataFrame, schema: str, since: Column | None = None) -> DataFrame:
    """(natural_key, payload, p): the newest capture of each key, parsed; captures: id, natural_key, payload, scraped_at."""
    rows = captures if since is None else captures.filter(F.col("scraped_at") >= since)
    return newest(rows).select("natural_key", "payload", F.from_json("payload", schema).alias("p"))


MATCH = """ext_rencontre_id STRING, ext_poule_id STRING, ext_equipe_dom_id STRING, ext_equipe_ext_id STRING, date_heure STRING, journee_date_debut STRING,
    score_dom STRING, score_ext STRING, forfait_dom BOOLEAN, forfait_ext BOOLEAN, journee INT, equipement_id STRING, fdm_code STRING"""


def load_matches(captures: DataFrame, poules: DataFrame, teams: DataFrame, old: DataFrame, since: Column | None = None) -> Load:
    """Matches by their external id: unknown poules and teams, and teams that meet themselves, are warned of and left out.

    poules, teams: id, id_ffhb; old: the columns of the result.  Scores, equipment and sheet code are kept
    where a capture has none; status, date and round are overwritten.
    """
    found = latest_payloads(captures, MATCH, since)
    rules = {
        "rencontre": F.col("p.ext_rencontre_id").isNotNull(), "equipes": F.col("p.ext_equipe_dom_id").isNotNull() & F.col("p.ext_equipe_ext_id").isNotNull(),
        "date": F.col("p.date_heure").isNotNull() | F.col("p.journee_date_debut").isNotNull(),
    }
    valid, rejects = merge.split_valid(found, rules)
    rows = valid.select("natural_key", "p.*")
    for name, table, key in (("poule_id", poules, "ext_poule_id"), ("equipe_dom_id", teams, "ext_equipe_dom_id"), ("equipe_ext_id", teams, "ext_equipe_ext_id")):
        rows = rows.join(table.select(F.col("id_ffhb").alias(f"k_{name}"), F.col("id").alias(name)), F.col(key) == F.col(f"k_{name}"), "left").drop(f"k_{name}")
    warning = (
        F.when(F.col("poule_id").isNull(), "poule inconnue").when(F.col("equipe_dom_id").isNull(), "equipe domicile inconnue")
        .when(F.col("equipe_ext_id").isNull(), "equipe exterieure inconnue").when(F.col("equipe_dom_id") == F.col("equipe_ext_id"), "meme equipe")
    )
    rows = rows.withColumn("warning", warning)
    home, away = coerce.prefix_int(F.col("score_dom")), coerce.prefix_int(F.col("score_ext"))
    marks = home, away, F.coalesce("forfait_dom", F.lit(False)), F.coalesce("forfait_ext", F.lit(False))
    when = dates.match_date(F.try_to_timestamp("date_heure"), F.col("journee_date_debut"))
    new = rows.filter("warning IS NULL").select(
        F.col("ext_rencontre_id").alias("id_ffhb_match"), "poule_id", "equipe_dom_id", "equipe_ext_id", when["date_heure"].alias("date_heure"), when["date_a_confirmer"].alias("date_a_confirmer"),
        F.coalesce(dates.time_is_estimated(F.col("date_heure")), F.lit(True)).alias("heure_estimee"), home.alias("score_dom"), away.alias("score_ext"),
        classify.match_status(*marks).alias("statut"), classify.forfeit_side(*marks).alias("forfait_equipe"), "journee", "equipement_id", "fdm_code",
    )
    merged = merge.merge(
        old, new, ["id_ffhb_match"], overwrite=["poule_id", "equipe_dom_id", "equipe_ext_id", "date_heure", "date_a_confirmer", "heure_estimee", "statut", "forfait_equipe", "journee"],
        coalesce=["score_dom", "score_ext", "equipement_id", "fdm_code"],
    )
    return Load(merged, rows.filter("warning IS NOT NULL").select("natural_key", "warning"), rejects.select("natural_key", "payload", F.array_join("reasons", ",").alias("reasons")))


def load_entity(captures: DataFrame, schema: str, key: str, required: list[str], old: DataFrame, overwrite: list[str], coalesce: list[str] = (), parent: tuple[str, DataFrame, str] | None = None) -> Load:
    """Clubs, halls, competitions, phases, poules, teams: required fields, one optional parent by its external id, then an upsert.

    parent: (field of the payload, table of id and id_ffhb, column that takes the parent's id).
    """
    found = latest_payloads(captures, schema)
    valid, rejects = merge.split_valid(found, {c: F.col(f"p.{c}").isNotNull() & (F.trim(f"p.{c}") != "") for c in required})
    rows = valid.select("natural_key", "p.*")
    warnings = rows.select("natural_key", F.lit(None).cast("string").alias("warning")).limit(0)
    if parent:
        field, table, name = parent
        rows = rows.join(table.select(F.col("id_ffhb").alias("k"), F.col("id").alias(name)), F.col(field) == F.col("k"), "left").drop("k")
        warnings = rows.filter(F.col(name).isNull()).select("natural_key", F.concat(F.lit(f"{field} inconnu : "), F.coalesce(field, F.lit("?"))).alias("warning"))
        rows = rows.filter(F.col(name).isNotNull())
    merged = merge.merge(old, rows.select(key, *overwrite, *coalesce), [key], overwrite=overwrite, coalesce=coalesce)
    return Load(merged, warnings, rejects.select("natural_key", "payload", F.array_join("reasons", ",").alias("reasons")))


def standings(captures: DataFrame, poules: DataFrame, teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, warnings): a row of an unknown poule is left out, one of an unknown team stays without team; both are warned of."""
    rows = captures.join(poules.select(F.col("id_ffhb").alias("pk"), F.col("id").alias("poule_id")), F.col("ext_poule_id") == F.col("pk"), "left").drop("pk")
    rows = rows.join(teams.select(F.col("id_ffhb").alias("ek"), F.col("id").alias("equipe_id")), F.col("ext_equipe_id") == F.col("ek"), "left").drop("ek")
    warning = F.when(F.col("poule_id").isNull(), "poule inconnue").when(F.col("equipe_id").isNull(), "equipe inconnue")
    rows = rows.withColumn("warning", warning)
    return rows.filter("poule_id IS NOT NULL").drop("warning"), rows.filter("warning IS NOT NULL").select("ext_poule_id", "ext_equipe_id", "warning")


def referees(payloads: DataFrame) -> DataFrame:
    """(arbitre_id, nom): distinct referees of both roles; of several names the smallest."""
    pairs = F.explode(F.array(*[F.struct(F.col(f"arbitre{i}_id").alias("arbitre_id"), F.col(f"arbitre{i}_nom").alias("nom")) for i in (1, 2)]))
    return payloads.select(pairs.alias("a")).select("a.*").filter("arbitre_id IS NOT NULL").groupBy("arbitre_id").agg(F.min("nom").alias("nom"))


def officials(payloads: DataFrame, matchs: DataFrame, known: DataFrame) -> DataFrame:
    """(match_id, role, arbitre_id): referee columns as rows, for known matches and referees, each once."""
    long = payloads.select("id_ffhb_match", F.expr("stack(2, 'arbitre1', arbitre1_id, 'arbitre2', arbitre2_id) AS (role, arbitre_id)")).filter("arbitre_id IS NOT NULL")
    rows = long.join(matchs.select("id_ffhb_match", F.col("id").alias("match_id")), "id_ffhb_match").join(known.select("arbitre_id"), "arbitre_id", "left_semi")
    return rows.select("match_id", "role", "arbitre_id").distinct()


def sheets(documents: DataFrame, matchs: DataFrame) -> dict[str, DataFrame]:
    """The cascade of match sheets: scores, players, line-ups, actions and warnings.

    documents: fdm_code, score_recevant, score_visiteur, compositions (array of cote, numero_licence, numero_maillot,
    buts), actions (array of ordre, cote, numero_maillot, type_action); matchs: id, fdm_code, score_dom, score_ext,
    statut.  A sheet's score fills an absent one and never overwrites; of repeated players, line-ups and actions of
    a sheet the last one counts; an unknown shirt gives an action without player.
    """
    joined = documents.join(matchs.select(F.col("id").alias("match_id"), F.col("fdm_code").alias("m_code"), "score_dom", "score_ext", "statut"), F.col("fdm_code") == F.col("m_code"), "left")
    known = joined.filter("match_id IS NOT NULL")
    absent = F.col("score_dom").isNull() | F.col("score_ext").isNull()
    fills = absent & F.col("score_recevant").isNotNull() & F.col("score_visiteur").isNotNull()
    scores = known.select("match_id", *[F.when(fills, F.col(n)).otherwise(F.col(o)).alias(o) for n, o in (("score_recevant", "score_dom"), ("score_visiteur", "score_ext"))], F.when(fills, "joue").otherwise(F.col("statut")).alias("statut"))
    lines = known.select("match_id", F.posexplode("compositions").alias("at", "__x")).select("match_id", "at", "__x.*").filter("numero_licence IS NOT NULL")
    lineups = lines.groupBy("match_id", "numero_licence").agg(F.max_by(F.struct("cote", "numero_maillot", "buts"), "at").alias("__x")).select("match_id", "numero_licence", "__x.*")
    shirts = lines.filter("numero_maillot IS NOT NULL").groupBy("match_id", "cote", "numero_maillot").agg(F.max_by("numero_licence", "at").alias("numero_licence"))
    acts = known.select("match_id", F.posexplode("actions").alias("at", "__x")).select("match_id", "at", "__x.*")
    acts = acts.groupBy("match_id", "ordre").agg(F.max_by(F.struct("cote", "numero_maillot", "type_action"), "at").alias("__x")).select("match_id", "ordre", "__x.*")
    return {
        "scores": scores, "players": lineups.select("numero_licence").distinct(), "lineups": lineups,
        "actions": acts.join(shirts, ["match_id", "cote", "numero_maillot"], "left").select("match_id", "ordre", "cote", "type_action", "numero_licence"),
        "warnings": joined.filter("match_id IS NULL").select("fdm_code", F.lit("match inconnu").alias("warning")),
    }


def refresh_equipment(visits: DataFrame, old: DataFrame) -> DataFrame:
    """Halls by their most frequent address (``rue 12345 VILLE``): equipement_id, adresse, code_postal, ville, outcome; rewritten only where they differ.

    visits: equipement_id, adresse; old: the columns of the result.
    """
    best = merge.most_frequent(visits, ["equipement_id"], "adresse").drop("n")
    code = F.nullif(F.regexp_extract("adresse", r"\b([0-9]{5})\b", 1), F.lit(""))
    town = F.nullif(F.regexp_extract("adresse", r"\b[0-9]{5}\s+(.+)$", 1), F.lit(""))
    new = best.select("equipement_id", "adresse", code.alias("code_postal"), town.alias("ville"))
    return merge.merge(old, new, ["equipement_id"], overwrite=["adresse", "code_postal", "ville"])


#: The steps of the whole load, in order.
PIPELINE = ("clubs", "salles", "competitions", "phases", "poules", "equipes", "engagements", "arbitres", "matchs", "match_officiels", "equipements", "classements", "stats_joueurs", "feuilles_match")


def steps(start: str | None = None, only: list[str] | None = None) -> list[str]:
    """The steps to run: from one on, or some, always in their order."""
    unknown = {*([start] if start else []), *(only or [])} - set(PIPELINE)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    rest = PIPELINE[PIPELINE.index(start) :] if start else PIPELINE
    return [s for s in rest if not only or s in only]
