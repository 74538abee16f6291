"""Classifiers of team and competition names, and of match states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaguespark.functions.text import strip_upper

#: Age classes, order of categories and sexes, and the winner's scores of a forfeit.
AGES = ("7", "9", "11", "13", "15", "17", "18", "19", "20")
CATEGORY_ORDER = ("Seniors", "-20", "-19", "-18", "-17", "-15", "-13", "-11", "-9", "-7", "Loisir", "Autre")
SEX_ORDER = ("M", "F", "mixte")
FORFEIT_SCORES = (10, 20)
#: The expressions of the classifiers.
_AGE = r"(?:^|[^A-Z0-9])(?:-|MOINS(?: DE)?|U|M)\s*(\d{1,2})(?!\d)"
_SENIORS = r"SENIOR|\bSM\b|\bSF\b|HONNEUR|EXCELLENCE|PRE.?NATIONAL|PRE.?REGION|NATIONAL|DIVISION|BUTAGAZ|STARLIGUE|PROLIGUE|COUPE DE FRANCE|\+ ?16"
_WOMEN = r"FEMININ|\bFEM\b|\bSF\b|\bF\b|(?:-|U|M)\s?\d{1,2}\s?F\b|BUTAGAZ"
_MEN = r"MASCULIN|\bMASC\b|\bSM\b|\bM\b|(?:-|U|M)\s?\d{1,2}\s?M\b|STARLIGUE|PROLIGUE"
_ENTENTE = r"\b(?:ENT|ENTENTE|CONV|CONVENTION)\b"
_LOCAL = r"DEPARTEMENT|\bDEPT?\b"
_REGIONAL = r"REGION|\bREG\b|HONNEUR|EXCELLENCE|NATIONAL|BUTAGAZ|STARLIGUE|PROLIGUE"


def category(label: Column) -> Column:
    name = strip_upper(label)
    age = F.regexp_extract(name, _AGE, 1)
    return F.when(age.try_cast("int").isin(*map(int, AGES)), F.concat(F.lit("-"), age)).when(name.rlike("LOISIR"), "Loisir").when(name.rlike(_SENIORS), "Seniors").otherwise("Autre")


def sex(label: Column) -> Column:
    name = strip_upper(label)
    return F.when(name.rlike(_WOMEN), "F").when(name.rlike(_MEN), "M").otherwise("mixte")


def explicit_rank(team: Column) -> Column:
    """The rank a team name states: a final digit, or a letter in parentheses; else null."""
    name = F.trim(strip_upper(team))
    letter = F.regexp_extract(name, r"\(([A-F])\)\s*$", 1)
    return F.when(letter != "", F.ascii(letter) - 64).otherwise(F.regexp_extract(name, r"(?:\s|^)([1-9])\s*$", 1).try_cast("int"))


def rank(team: Column) -> Column:
    return F.coalesce(explicit_rank(team), F.lit(1))


def tier(competition: Column, level: Column) -> Column:
    """1 regional or above, 2 departmental, null if unknown; the text outweighs the level."""
    name = strip_upper(competition)
    return F.when(name.rlike(_LOCAL), 2).when(name.rlike(_REGIONAL), 1).when(level == "departemental", 2).when(level.isin("regional", "national"), 1)


def is_entente(team: Column) -> Column:
    return strip_upper(team).rlike(_ENTENTE)


def is_entente_by_name(team: Column) -> Column:
    """The narrower test of link resolution: no conventions, plain spaces around ENT."""
    return team.ilike("%ENTENTE%") | team.ilike("ENT %") | team.ilike("% ENT %")


def group_label(category: Column, sex: Column, rank: Column, entente: Column) -> Column:
    # The wording of labels.
    base = F.when(category == "Autre", category).otherwise(F.concat_ws(" ", category, sex))
    nth = F.when(rank > 1, F.concat(F.lit(" (équipe "), rank.cast("string"), F.lit(")"))).otherwise("")
    return F.concat(base, nth, F.when(entente, " — entente").otherwise(""))


def forfeit_side(home: Column, away: Column, home_mark: Column, away_mark: Column) -> Column:
    """dom or ext: an explicit mark, else a lone winner's score of a forfeit."""
    return (
        F.when(home_mark, "dom").when(away_mark, "ext")
        .when(home.isin(*FORFEIT_SCORES) & away.isNull(), "ext")
        .when(away.isin(*FORFEIT_SCORES) & home.isNull(), "dom")
    )


def match_status(home: Column, away: Column, home_mark: Column, away_mark: Column) -> Column:
    side = forfeit_side(home, away, home_mark, away_mark)
    return F.when(side.isNotNull(), "forfait").when(home.isNotNull() & away.isNotNull(), "joue").otherwise("a_jouer")


#: The words for confidence.
def confidence(rank: Column) -> Column:
    return F.when(rank >= 3, "haute").when(rank == 2, "moyenne").otherwise("basse")


def confidence_rank(confidence: Column) -> Column:
    return F.when(confidence == "haute", 3).when(confidence == "moyenne", 2).when(confidence == "basse", 1)
