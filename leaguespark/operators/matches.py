"""The match list: a star join around matches, its filters and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Subscriptions to all that are sent to the tasks as one array; more are joined by SALTS * SALTS keys.
MOST_TO_ALL = 100_000
SALTS = 16


def star(tables: dict[str, DataFrame]) -> DataFrame:
    """Matches with both teams, poule, phase and competition (inner), clubs by structure or carrier, halls and equipment (left).

    ``tables``: matchs, equipes, poules, phases, competitions, clubs, salles, equipements.  Spark broadcasts
    the dimensions that are small; none is forced.
    """
    t = {name: df.alias(name) for name, df in tables.items()}
    out = t["matchs"].alias("m")
    for role, fk in (("ed", "equipe_dom_id"), ("ee", "equipe_ext_id")):
        out = out.join(tables["equipes"].alias(role), F.col(f"m.{fk}") == F.col(f"{role}.id"))
    out = out.join(tables["poules"].alias("po"), F.col("m.poule_id") == F.col("po.id"))
    out = out.join(tables["phases"].alias("ph"), F.col("po.phase_id") == F.col("ph.id"))
    out = out.join(tables["competitions"].alias("co"), F.col("ph.competition_id") == F.col("co.id"))
    for role, team in (("cd", "ed"), ("ce", "ee")):
        key = F.coalesce(F.col(f"{team}.ext_structure_id"), F.col(f"{team}.porteur_ext_structure_id"))
        out = out.join(tables["clubs"].alias(role), key == F.col(f"{role}.id_ffhb"), "left")
    out = out.join(tables["salles"].alias("sa"), F.col("m.salle_id") == F.col("sa.id"), "left")
    out = out.join(tables["salles"].alias("sp"), F.col("cd.salle_principale_id") == F.col("sp.id"), "left")
    return out.join(tables["equipements"].alias("eq"), F.col("m.equipement_id") == F.col("eq.equipement_id"), "left")


def hall() -> dict[str, Column]:
    """Hall columns from the match's hall, its equipment, else the home club's hall (``salle_approx``)."""
    pick = lambda c: F.coalesce(F.col(f"sa.{c}"), F.col(f"eq.{c}"), F.col(f"sp.{c}"))
    approx = F.col("sa.id").isNull() & F.col("eq.equipement_id").isNull() & F.col("sp.id").isNotNull()
    return {"salle_nom": pick("nom"), "salle_ville": pick("ville"), "salle_adresse": pick("adresse"), "salle_approx": approx}


def match_filter(**wanted) -> Column:
    """A conjunction of those of the ten filters that are set."""
    cond = F.lit(True)
    simple = {"poule": "po.id_ffhb", "competition": "co.id_ffhb", "journee": "m.journee", "statut": "m.statut", "saison": "co.saison_code", "salle": "sa.id_ffhb"}
    for name, column in simple.items():
        if wanted.get(name) is not None:
            cond = cond & (F.col(column) == wanted[name])
    for name, columns in (("equipe", ("ed.id_ffhb", "ee.id_ffhb")), ("club", ("cd.id_ffhb", "ce.id_ffhb"))):
        if wanted.get(name) is not None:
            cond = cond & ((F.col(columns[0]) == wanted[name]) | (F.col(columns[1]) == wanted[name]))
    if wanted.get("date_from") is not None:
        cond = cond & (F.col("m.date_heure") >= F.lit(wanted["date_from"]))
    if wanted.get("date_to") is not None:
        cond = cond & (F.col("m.date_heure") <= F.lit(wanted["date_to"]))
    return cond


def of_teams(matchs: DataFrame, ids: DataFrame) -> DataFrame:
    """The matches of some teams (t_id) in either role, each once: two joins on equality, the second over what the first left."""
    home = matchs.join(ids, F.col("equipe_dom_id") == F.col("t_id"), "left_semi")
    away = matchs.join(ids, F.col("equipe_dom_id") == F.col("t_id"), "left_anti").join(ids, F.col("equipe_ext_id") == F.col("t_id"), "left_semi")
    return home.unionByName(away)


def narrowed(tables: dict[str, DataFrame], **wanted) -> dict[str, DataFrame]:
    """The star's tables with those of ``match_filter``'s filters that can be applied before anything is joined: all but the hall.

    A team or a club becomes the ids of its teams, by which matches are filtered in either role.
    """
    out, m = dict(tables), tables["matchs"]
    for name in ("journee", "statut"):
        if wanted.get(name) is not None:
            m = m.filter(F.col(name) == wanted[name])
    if wanted.get("date_from") is not None:
        m = m.filter(F.col("date_heure") >= F.lit(wanted["date_from"]))
    if wanted.get("date_to") is not None:
        m = m.filter(F.col("date_heure") <= F.lit(wanted["date_to"]))
    for name, table, column in (("poule", "poules", "id_ffhb"), ("competition", "competitions", "id_ffhb"), ("saison", "competitions", "saison_code")):
        if wanted.get(name) is not None:
            out[table] = out[table].filter(F.col(column) == wanted[name])
    teams = tables["equipes"]
    if wanted.get("equipe") is not None:
        m = of_teams(m, teams.filter(F.col("id_ffhb") == wanted["equipe"]).select(F.col("id").alias("t_id")))
    if wanted.get("club") is not None:
        clubs = tables["clubs"].filter(F.col("id_ffhb") == wanted["club"]).select(F.col("id_ffhb").alias("c_id"))
        m = of_teams(m, teams.join(clubs, F.coalesce("ext_structure_id", "porteur_ext_structure_id") == F.col("c_id"), "left_semi").select(F.col("id").alias("t_id")))
    return out | {"matchs": m}


def listed(tables: dict[str, DataFrame], **wanted) -> DataFrame:
    """The star under filters, which reach the tables before the joins."""
    return star(narrowed(tables, **wanted)).filter(match_filter(salle=wanted.get("salle")))


def match_rows(joined: DataFrame) -> DataFrame:
    return joined.select(
        F.col("m.id").alias("id"), F.col("m.date_heure"), F.col("m.journee"), F.col("m.statut"), F.col("m.score_dom"), F.col("m.score_ext"),
        F.col("ed.nom").alias("equipe_dom"), F.col("ee.nom").alias("equipe_ext"), F.col("cd.nom").alias("club_dom"), F.col("ce.nom").alias("club_ext"),
        F.col("po.nom").alias("poule"), F.col("co.nom").alias("competition"), *[c.alias(n) for n, c in hall().items()],
    )


def page(rows: DataFrame, order: list[Column], limit: int = 20, offset: int = 0) -> DataFrame:
    """One page of a totally ordered list; only offset + limit rows of each task are kept."""
    if not 1 <= limit <= 100 or offset < 0:
        raise ValueError("limit is 1 to 100, offset at least 0")
    return rows.orderBy(*order).offset(offset).limit(limit)


def of_team(matchs: DataFrame, equipes: DataFrame, team: str) -> DataFrame:
    """The matches of a team in either role: each role is filtered by itself, so the team's id reaches both sides of the union."""
    ids = equipes.filter(F.col("id_ffhb") == team).select(F.col("id").alias("t_id"))
    roles = [matchs.join(ids, F.col(fk) == F.col("t_id"), "left_semi") for fk in ("equipe_dom_id", "equipe_ext_id")]
    return roles[0].unionByName(roles[1]).dropDuplicates(["id"])


def existing(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """(value, existe) for each of some values."""
    wanted = rows.sparkSession.createDataFrame([(v,) for v in values], "value string")
    found = rows.filter(F.col(column).isin(*values)).select(F.col(column).alias("value"), F.lit(True).alias("found")).distinct()
    return wanted.join(found, "value", "left").select("value", F.coalesce("found", F.lit(False)).alias("existe"))


def viewpoint(own: Column, home: Column, away: Column) -> Column:
    """A score seen from one side."""
    return F.when(own == "dom", home).otherwise(away)


def detail(joined: DataFrame, lineups: DataFrame, actions: DataFrame, officials: DataFrame) -> DataFrame:
    """Matches with nested line-ups (by side and shirt), actions (in order) and officials (by role)."""

    def nested(rows: DataFrame, name: str, order: list[str], columns: list[str]) -> DataFrame:
        first = [x for i, c in enumerate(order) for x in (F.col(c).isNull().alias(f"null_{i}"), F.col(c).alias(f"order_{i}"))]
        sort = F.struct(*first, *[F.col(c).alias(f"value_{c}") for c in columns])
        return rows.groupBy("match_id").agg(F.transform(F.sort_array(F.collect_list(sort)), lambda x: F.struct(*[x[f"value_{c}"].alias(c) for c in columns])).alias(name))

    out = match_rows(joined)
    parts = (
        nested(lineups, "compositions", ["cote", "numero_maillot"], ["cote", "numero_maillot", "joueur", "buts"]),
        nested(actions, "actions", ["ordre"], ["ordre", "periode", "type"]),
        nested(officials, "officiels", ["role"], ["role", "nom"]),
    )
    for part in parts:
        out = out.join(part, out["id"] == part["match_id"], "left").drop("match_id")
    return out


def match_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """Events of matches whose result or state changed to played or forfeited."""
    before = old.select("id", F.struct("statut", "score_dom", "score_ext").alias("was"))
    now = new.select("id", "equipe_dom_id", "equipe_ext_id", F.struct("statut", "score_dom", "score_ext").alias("is"))
    changed = now.join(before, "id", "left").filter(F.col("is.statut").isin("joue", "forfait") & ~F.col("is").eqNullSafe(F.col("was")))
    kind = F.when(F.col("is.statut") == "forfait", "match.forfait").otherwise("match.resultat")
    return changed.select(F.col("id").alias("match_id"), kind.alias("kind"), "equipe_dom_id", "equipe_ext_id", F.to_json(F.struct(F.col("id"), F.col("is.*"))).alias("payload"))


def _to_all(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Every event with every subscription; the events stay where they are, or are dealt evenly where the subscriptions are many."""
    if subscriptions.limit(MOST_TO_ALL + 1).count() <= MOST_TO_ALL:
        array = subscriptions.agg(F.collect_list(F.struct("subscription_id")).alias("subscribers"))
        return events.crossJoin(F.broadcast(array)).select("match_id", "kind", F.inline("subscribers"))
    own = lambda *cols: F.pmod(F.xxhash64(*cols), F.lit(SALTS))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    left = events.withColumn("i", own("match_id", "kind")).withColumn("j", every)
    right = subscriptions.withColumn("j", own("subscription_id")).withColumn("i", every)
    return left.join(right, ["i", "j"]).select("match_id", "kind", "subscription_id")


def deliveries(events: DataFrame, subscriptions: DataFrame, clubs_of_team: DataFrame) -> DataFrame:
    """One delivery for each event and active subscription: to all, or to a club that plays."""
    active = subscriptions.filter("actif")
    for_all = active.filter("club_id IS NULL").select("subscription_id")
    teams = events.select("match_id", "kind", F.explode(F.array("equipe_dom_id", "equipe_ext_id")).alias("equipe_id"))
    clubs = teams.join(clubs_of_team, "equipe_id").select("match_id", "kind", "club_id").distinct()
    by_club = clubs.join(active.filter("club_id IS NOT NULL"), "club_id").select("match_id", "kind", "subscription_id")
    everywhere = _to_all(events.select("match_id", "kind"), for_all)
    return everywhere.unionByName(by_club).distinct()


#: Seconds before the second and each later attempt of a delivery, and failures in a row that switch a subscription off.
RETRIES = (60, 300, 1800, 7200, 21600, 86400)
MAX_FAILURES = 30


def next_delivery(status: Column, attempts: Column, ok: Column, ladder: tuple[int, ...] = RETRIES) -> Column:
    """(status, wait in seconds) of a delivery after an attempt: done, retried by a ladder, at last failed."""
    waits = F.array(*[F.lit(s) for s in ladder])
    retried = (status == "pending") & ~ok & (attempts < len(ladder))
    after = F.when(status != "pending", status).when(ok, "delivered").when(retried, "pending").otherwise("failed")
    return F.struct(after.alias("status"), F.when(retried, F.get(waits, attempts)).alias("wait"))
