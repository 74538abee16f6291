"""Loads of clubs, halls, competitions, phases, poules, teams and engagements from captures.

A load reads the newest capture of each key, rejects payloads of another form, cleans
texts, finds parents by their external ids among the tables loaded before, and says how
its rows are merged.  ``read`` gives the tables as they are.  External ids are the keys;
a column ``..._id_ffhb`` names a parent that is known.

Defined cases: a row whose needed parent is unknown is left out and warned of; one whose
optional parent is unknown stays without it, warned of; a null in a coalesced column keeps
what is stored; captures of one key count once, the newest one (ties: the larger id);
an empty or missing parent table knows nobody.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.functions import coerce, text
from leaguespark.operators import merge
from leaguespark.operators.loads import latest_payloads

Read = Callable[[str], DataFrame]


@dataclass
class Prepared:
    """New rows and how they are merged by ``keys``; ``after`` gives a second merge's rows from the merged table."""

    new: DataFrame
    keys: list[str]
    overwrite: list[str]
    coalesce: list[str]
    warnings: DataFrame
    rejects: DataFrame
    after: Callable[[DataFrame], DataFrame] | None = None
    after_overwrite: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.overwrite, *self.coalesce]

    def merged(self, old: DataFrame) -> DataFrame:
        """All rows after the merge, with their outcome."""
        return merge.merge(old.select(*self.columns), self.new, self.keys, overwrite=self.overwrite, coalesce=self.coalesce)

    def report(self, old: DataFrame) -> DataFrame:
        """(outcome, n): inserted, updated, noop, warned and rejected rows."""
        rest = [rows.select(F.lit(name).alias("outcome")) for name, rows in (("warned", self.warnings), ("rejected", self.rejects))]
        rows = self.merged(old).filter("outcome <> 'kept'").select("outcome").unionByName(rest[0]).unionByName(rest[1])
        return rows.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _read(captures: DataFrame, fields: str, **needed: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(natural_key and the fields of valid payloads, rejects); ``needed`` tests fields, which must not be null."""
    found = latest_payloads(captures, ", ".join(f"{name} STRING" for name in fields.split()))
    valid, bad = merge.split_valid(found, {name: test(F.col(f"p.{name}")) for name, test in needed.items()})
    return valid.select("natural_key", "p.*"), bad.select("natural_key", "payload", F.array_join("reasons", ",").alias("reasons"))


def _given(c: Column) -> Column:
    return F.trim(c) != ""


def _known(rows: DataFrame, column: str, parents: DataFrame, key: str = "id_ffhb") -> DataFrame:
    """Rows with ``known_<column>``, whether the parent that the column names exists."""
    there = parents.select(F.col(key).alias("__k")).distinct().withColumn("__there", F.lit(True))
    return rows.join(there, F.col(column) == F.col("__k"), "left").withColumn(f"known_{column}", F.coalesce("__there", F.lit(False))).drop("__k", "__there")


def _warned(rows: DataFrame, message: Column) -> DataFrame:
    return rows.select("natural_key", message.alias("warning")).filter("warning IS NOT NULL")


def _missing(column: str, what: str) -> Column:
    return F.when(F.col(column).isNotNull() & ~F.col(f"known_{column}"), F.concat(F.lit(f"{what} "), F.col(column), F.lit(" introuvable")))


def halls(captures: DataFrame, read: Read) -> Prepared:
    rows, bad = _read(captures, "id_ffhb nom adresse code_postal ville departement_code", id_ffhb=_given, nom=_given)
    rows = _known(rows, "departement_code", read("departements"), "code")
    new = rows.select("id_ffhb", text.title_case(F.col("nom")).alias("nom"), text.normalize(F.col("adresse")).alias("adresse"), "code_postal", text.title_case(F.col("ville")).alias("ville"), F.when(F.col("known_departement_code"), F.col("departement_code")).alias("departement_code"))
    return Prepared(new, ["id_ffhb"], ["nom", "adresse", "code_postal", "ville", "departement_code"], [], _warned(rows, _missing("departement_code", "dept")), bad)


_LICENCES = ("nb_licence_senior_h", "nb_licence_senior_f", "nb_licence_jeunes_h", "nb_licence_jeunes_f")
_KEPT = ("slug", "telephone", "email", "site_web", "adresse_correspondance", "register_link", "logo_club")


def clubs(captures: DataFrame, read: Read) -> Prepared:
    """Departments give the region; the main hall is a hall that is known; the size is the sum of the licences that are known."""
    rows, bad = _read(captures, f"id_ffhb nom ville departement_code salle_principale_id_ffhb {' '.join(_KEPT)} {' '.join(_LICENCES)}", id_ffhb=lambda c: c.rlike(r"^\d+$"), nom=_given)
    rows = _known(_known(rows, "departement_code", read("departements"), "code"), "salle_principale_id_ffhb", read("salles"))
    regions = read("departements").select(F.col("code").alias("__code"), F.col("ligue").alias("ligue")).dropDuplicates(["__code"])
    rows = rows.join(regions, F.col("departement_code") == F.col("__code"), "left")
    counts = [F.col(c).try_cast("int") for c in _LICENCES]
    known = lambda c: F.when(F.col(f"known_{c}"), F.col(c)).alias(c)
    new = rows.select(
        "id_ffhb", text.title_case(F.col("nom")).alias("nom"), text.title_case(F.col("ville")).alias("ville"), known("departement_code"), "ligue", known("salle_principale_id_ffhb"), *_KEPT,
        *[c.alias(name) for c, name in zip(counts, _LICENCES, strict=True)], coerce.sum_known(*counts).alias("effectif_estime"),
    )
    warnings = _warned(rows, _missing("departement_code", "dept")).unionByName(_warned(rows, _missing("salle_principale_id_ffhb", "salle")))
    return Prepared(new, ["id_ffhb"], ["nom", "ville", "departement_code", "ligue"], ["salle_principale_id_ffhb", *_KEPT, *_LICENCES, "effectif_estime"], warnings, bad)


def competitions(captures: DataFrame, read: Read) -> Prepared:
    levels = ("national", "regional", "departemental")
    rows, bad = _read(captures, "ext_competition_id nom niveau sexe code ext_structure_id detail_url afficher_stats_joueurs", ext_competition_id=_given, nom=_given, niveau=lambda c: c.isin(*levels))
    kept = ["sexe", "code", "ext_structure_id", "detail_url"]
    new = rows.select(F.col("ext_competition_id").alias("id_ffhb"), "nom", "niveau", *kept, coerce.loose_bool(F.col("afficher_stats_joueurs")).alias("afficher_stats_joueurs"))
    return Prepared(new, ["id_ffhb"], ["nom", "niveau"], [*kept, "afficher_stats_joueurs"], _warned(rows, F.lit(None).cast("string")), bad)


def _child(captures: DataFrame, own: str, parent: str, parents: DataFrame, what: str, column: str) -> Prepared:
    rows, bad = _read(captures, f"{own} {parent} nom", **{own: _given, parent: _given, "nom": _given})
    rows = _known(rows, parent, parents)
    new = rows.filter(F.col(f"known_{parent}")).select(F.col(own).alias("id_ffhb"), "nom", F.col(parent).alias(column))
    return Prepared(new, ["id_ffhb"], ["nom", column], [], _warned(rows, _missing(parent, what)), bad)


def phases(captures: DataFrame, read: Read) -> Prepared:
    return _child(captures, "ext_phase_id", "ext_competition_id", read("competitions"), "competition", "competition_id_ffhb")


def poules(captures: DataFrame, read: Read) -> Prepared:
    return _child(captures, "ext_poule_id", "ext_phase_id", read("phases"), "phase", "phase_id_ffhb")


def teams(captures: DataFrame, read: Read) -> Prepared:
    """A team without a known club stays, warned of.  Afterwards a team without an organisation takes the one that most teams of its inner structure have (ties: the smallest)."""
    rows, bad = _read(captures, "ext_equipe_id nom ext_structure_id logo structure_id", ext_equipe_id=_given, nom=_given)
    rows = _known(rows, "ext_structure_id", read("clubs"))
    new = rows.select(
        F.col("ext_equipe_id").alias("id_ffhb"), "nom", F.when(F.col("known_ext_structure_id"), F.col("ext_structure_id")).alias("club_id_ffhb"), "ext_structure_id", "logo",
        F.col("structure_id").alias("structure_interne_id"), F.lit(None).cast("string").alias("porteur_ext_structure_id"),
    )
    message = F.when(~F.col("known_ext_structure_id"), F.concat(F.lit("club non résolu : "), F.coalesce("ext_structure_id", F.lit("absent"))))

    def carriers(merged: DataFrame) -> DataFrame:
        named = merged.filter("structure_interne_id IS NOT NULL AND ext_structure_id IS NOT NULL")
        most = merge.most_frequent(named, ["structure_interne_id"], "ext_structure_id").select(F.col("structure_interne_id").alias("__s"), F.col("ext_structure_id").alias("__p"))
        alone = merged.filter("ext_structure_id IS NULL").join(most, F.col("structure_interne_id") == F.col("__s"))
        return alone.filter(~F.col("porteur_ext_structure_id").eqNullSafe(F.col("__p"))).select("id_ffhb", F.col("__p").alias("porteur_ext_structure_id"))

    kept = ["club_id_ffhb", "ext_structure_id", "logo", "structure_interne_id", "porteur_ext_structure_id"]
    return Prepared(new, ["id_ffhb"], ["nom"], kept, _warned(rows, message), bad, carriers, ["porteur_ext_structure_id"])


def engagements(captures: DataFrame, read: Read) -> Prepared:
    """Teams in poules, both known: each once."""
    rows, bad = _read(captures, "ext_equipe_id ext_poule_id", ext_equipe_id=_given, ext_poule_id=_given)
    rows = _known(_known(rows, "ext_equipe_id", read("equipes")), "ext_poule_id", read("poules"))
    new = rows.filter("known_ext_equipe_id AND known_ext_poule_id").select(F.col("ext_equipe_id").alias("equipe_id_ffhb"), F.col("ext_poule_id").alias("poule_id_ffhb")).distinct()
    return Prepared(new, ["equipe_id_ffhb", "poule_id_ffhb"], [], [], _warned(rows, F.coalesce(_missing("ext_equipe_id", "equipe"), _missing("ext_poule_id", "poule"))), bad)
