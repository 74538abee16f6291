"""Teams of a club: linking by five signals, grouping of registrations, inheritance of links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.functions import classify
from leaguespark.functions.text import distinctive_tokens, whole_word_pattern

MIN_PLAYERS = 3
#: Signals with their rank and their priority among equals.
SIGNALS = {"licence": (3, 1), "structure": (3, 2), "nom_exact": (3, 3), "nom_reserve": (2, 4), "nom_entente": (1, 5)}


def linked_teams(clubs: DataFrame, teams: DataFrame, lineups: DataFrame, players: DataFrame, season: str, ententes: bool = True, min_confidence: str | None = None) -> DataFrame:
    """(club_id, equipe_id, nom, methode, confiance, is_principal, is_entente) for all given clubs at once.

    clubs: id_ffhb, code_ffhb, nom; teams: id, nom, saison_code, ext_structure_id;
    lineups: equipe_id, joueur_id; players: id, numero_licence.
    """
    seasonal = teams.filter(F.col("saison_code") == season)
    club = clubs.select(F.col("id_ffhb").alias("club_id"), F.col("code_ffhb").alias("code"), F.col("nom").alias("club_nom"))
    prefix = F.substring("numero_licence", 1, 7)
    fielded = lineups.join(players.select(F.col("id").alias("joueur_id"), prefix.alias("code")), "joueur_id").select("equipe_id", "joueur_id", "code").distinct()
    per_code = fielded.groupBy("equipe_id", "code").agg(F.count(F.lit(1)).alias("n_players"))
    per_team = fielded.groupBy("equipe_id").agg(F.countDistinct("code").alias("n_clubs"))

    def signal(rows: DataFrame, method: str) -> DataFrame:
        return rows.select("club_id", "id", F.lit(method).alias("method"))

    by_licence = club.join(per_code.filter(F.col("n_players") >= MIN_PLAYERS), "code").join(seasonal, F.col("equipe_id") == F.col("id"))
    by_structure = club.join(seasonal, F.col("ext_structure_id") == F.col("club_id"))
    by_name = club.join(seasonal, F.col("nom") == F.col("club_nom"))
    by_prefix = _begins_with(club, seasonal)
    # Ententes that share a word: joined on the word, then tested as the whole-word pattern.
    tokens = club.withColumn("tokens", distinctive_tokens(F.col("club_nom"))).withColumn("pattern", whole_word_pattern(F.col("tokens"))).withColumn("w", F.explode("tokens"))
    words = seasonal.filter(classify.is_entente_by_name(F.col("nom"))).withColumn("w", F.explode(F.array_distinct(F.split(F.lower("nom"), r"[^\p{L}\p{N}_]+"))))
    by_entente = tokens.join(words, "w").filter(F.expr("nom RLIKE pattern")).select("club_id", "id").distinct()
    signals = signal(by_licence, "licence")
    for rows, method in ((by_structure, "structure"), (by_name, "nom_exact"), (by_prefix, "nom_reserve"), (by_entente, "nom_entente")):
        signals = signals.unionByName(signal(rows, method))
    ranked = signals.withColumn("rank", _pick({m: r for m, (r, _) in SIGNALS.items()})).withColumn("priority", _pick({m: p for m, (_, p) in SIGNALS.items()}))
    best = ranked.groupBy("club_id", "id").agg(
        F.max("rank").alias("rank"), F.min_by("method", F.struct(-F.col("rank"), F.col("priority"))).alias("methode"), F.bool_or(F.col("method") == "nom_exact").alias("is_principal")
    )
    named = best.join(seasonal.select("id", "nom"), "id").join(per_team.withColumnRenamed("equipe_id", "id"), "id", "left")
    is_entente = classify.is_entente_by_name(F.col("nom")) | (F.coalesce("n_clubs", F.lit(0)) >= 2)
    out = named.select("club_id", F.col("id").alias("equipe_id"), "nom", "methode", classify.confidence(F.col("rank")).alias("confiance"), "is_principal", is_entente.alias("is_entente"), "rank")
    if not ententes:
        out = out.filter("NOT is_entente")
    if min_confidence:
        out = out.filter(F.col("rank") >= classify.confidence_rank(F.lit(min_confidence)))
    return out.drop("rank")


def _begins_with(club: DataFrame, teams: DataFrame) -> DataFrame:
    """(club_id, id): team names ILIKE the club's name, a space and anything, by joins on equality.

    ``_`` in a club's name stands for any character.  The few different places of such characters (masks) are
    put over the beginnings of team names that end before a space and have the mask's length; ``%`` and a backslash
    are rare, and their names meet the teams by their letters before it.
    """
    name = F.lower("club_nom")
    mask = F.array_join(F.filter(F.sequence(F.lit(1), F.length(name)), lambda i: F.substring(name, i, F.lit(1)) == "_"), ",")
    odd = F.col("club_nom").rlike(r"[%\\]")
    plain = club.filter(~odd & (name != "")).select("club_id", name.alias("name"), F.length(name).alias("length"), mask.alias("mask"))
    starts = teams.select("id", F.explode(F.expr("transform(filter(sequence(1, length(nom)), i -> substring(nom, i, 1) = ' '), i -> lower(left(nom, i - 1)))")).alias("start"))
    masks = plain.select("length", "mask").distinct()
    masked = starts.withColumn("length", F.length("start")).join(masks, "length").withColumn("name", F.expr("array_join(transform(split(start, ''), (c, i) -> CASE WHEN array_contains(split(mask, ','), cast(i + 1 AS string)) THEN '_' ELSE c END), '')"))
    found = masked.join(plain, ["length", "mask", "name"]).select("club_id", "id")
    letters = lambda c, n: F.when(F.length(c) >= 3, F.substring(F.lower(c), 1, n))
    before = F.regexp_extract("club_nom", r"^[^%_\\]*", 0)
    rare = club.filter(odd).withColumn("w", F.coalesce(letters(before, 3), F.lit("")))
    rest = rare.join(teams.withColumn("w", F.explode(F.array(letters(F.col("nom"), 3), F.lit("")))), "w").filter(F.expr("nom ILIKE concat(club_nom, ' %')"))
    return found.unionByName(rest.select("club_id", "id")).distinct()


def _pick(values: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for method, value in values.items():
        out = F.when(F.col("method") == method, value).otherwise(out)
    return out


def classified(teams: DataFrame, engagements: DataFrame, overrides: DataFrame, by: list[str]) -> DataFrame:
    """Registrations with category, sex, rank, entente and group key.

    teams: ``by`` columns, id_ffhb, nom; engagements: id_ffhb, ordre, competition, phase, niveau; overrides:
    id_ffhb, categorie, sexe, rang, entente, exclu.  The first engagement speaks before the team's name, an
    override before both.  Seniors without a stated rank are told apart by tier only where their sex and
    entente span two tiers within ``by``.
    """
    first = engagements.groupBy("id_ffhb").agg(F.min_by(F.struct("competition", "phase", "niveau"), "ordre").alias("e"))
    o = overrides.select("id_ffhb", F.struct("categorie", "sexe", "rang", "entente", "exclu").alias("o"))
    rows = teams.join(first, "id_ffhb", "left").join(o, "id_ffhb", "left").filter(~F.coalesce("o.exclu", F.lit(False)))
    text = F.when(F.col("e").isNotNull(), F.concat_ws(" ", F.coalesce("e.competition", F.lit("")), F.coalesce("e.phase", F.lit("")))).otherwise("")
    by_text, by_name = classify.category(text), classify.category(F.col("nom"))
    sex_text = classify.sex(text)
    rows = rows.withColumns({
        "categorie": F.coalesce(F.col("o.categorie"), F.when(by_text == "Autre", by_name).otherwise(by_text)),
        "sexe": F.coalesce(F.col("o.sexe"), F.when(sex_text == "mixte", classify.sex(F.col("nom"))).otherwise(sex_text)),
        "explicite": F.coalesce(F.col("o.rang"), classify.explicit_rank(F.col("nom"))),
        "entente": F.coalesce(F.col("o.entente"), classify.is_entente(F.col("nom"))),
        "tier": F.when(F.col("e").isNotNull(), classify.tier(text, F.col("e.niveau"))),
    })
    open_rank = (F.col("categorie") == "Seniors") & F.col("explicite").isNull() & F.col("tier").isNotNull()
    bucket = Window.partitionBy(*by, "sexe", "entente")
    spans = F.size(F.collect_set(F.when(open_rank, F.col("tier"))).over(bucket)) > 1  # two tiers at most
    rang = F.coalesce(F.col("explicite"), F.when(open_rank & spans, F.col("tier")), F.lit(1))
    rows = rows.withColumn("rang", rang)
    key = F.concat_ws("|", "categorie", "sexe", F.col("rang").cast("string"), F.when(F.col("entente"), "entente").otherwise("club"))
    return rows.withColumn("cle", key).select(*teams.columns, "categorie", "sexe", "rang", "entente", "cle")


def groups(rows: DataFrame, engagements: DataFrame, by: list[str]) -> DataFrame:
    """One row a real team: key, label, registrations and distinct competitions, with a sort column ``position``."""
    position = F.struct(
        F.array_position(F.array(*map(F.lit, classify.CATEGORY_ORDER)), F.col("categorie")).alias("c"),
        F.array_position(F.array(*map(F.lit, classify.SEX_ORDER)), F.col("sexe")).alias("s"), F.col("rang").alias("r"), F.col("entente").alias("e"),
    )
    competitions = rows.join(engagements, "id_ffhb").groupBy(*by, "cle").agg(F.sort_array(F.collect_set("competition")).alias("competitions"))
    teams = rows.groupBy(*by, "cle", "categorie", "sexe", "rang", "entente").agg(F.sort_array(F.collect_list("id_ffhb")).alias("equipes"))
    label = classify.group_label(F.col("categorie"), F.col("sexe"), F.col("rang"), F.col("entente"))
    return teams.join(competitions, [*by, "cle"], "left").withColumn("libelle", label).withColumn("position", position)


def inherit_links(rows: DataFrame, by: list[str]) -> DataFrame:
    """In a group with a sure link, weak links become (groupe, moyenne); rows: by, cle, methode, confiance."""
    sure = F.max((F.col("confiance") == "haute").cast("int")).over(Window.partitionBy(*by, "cle")) == 1
    weak = sure & (F.col("confiance") == "basse")
    return rows.withColumn("methode", F.when(weak, "groupe").otherwise(F.col("methode"))).withColumn("confiance", F.when(weak, "moyenne").otherwise(F.col("confiance")))


def calendar(links: DataFrame, matchs: DataFrame) -> DataFrame:
    """(club_id, match_id, club_recevant, equipe): the matches of each club's linked teams; the home team speaks for the club where both are linked.

    links: club_id, equipe_id, nom; matchs: id, equipe_dom_id, equipe_ext_id.
    """
    sides = matchs.select(F.col("id").alias("match_id"), F.explode(F.array(F.struct(F.col("equipe_dom_id").alias("equipe_id"), F.lit(True).alias("home")), F.struct(F.col("equipe_ext_id").alias("equipe_id"), F.lit(False).alias("home")))).alias("s"))
    rows = sides.select("match_id", "s.equipe_id", "s.home").join(links.select("club_id", "equipe_id", "nom"), "equipe_id")
    return rows.groupBy("club_id", "match_id").agg(F.bool_or("home").alias("club_recevant"), F.max_by("nom", F.struct("home", "nom")).alias("equipe"))
