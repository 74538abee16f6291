"""Merges that are stored: versioned tables written in the shared folder, changed by batches and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguespark.plans import loads
from leaguespark.plans.league import League
from leaguespark.sources.versions import VersionedTable
from leaguespark.streaming import incremental

_reg = League()
QUERIES, ORACLES = _reg.queries, _reg.oracles
T = Callable[[str], DataFrame]


def _table(old: DataFrame, keys: list[str]) -> VersionedTable:
    spark = old.sparkSession
    table = VersionedTable(spark, f"{incremental.work_dir(spark)}/table", keys)
    table.replace(old, token="old")
    return table


def _upsert(name: str, old: str, new: str, keys: list[str], overwrite: list[str], coalesce: list[str] = ()) -> None:
    """Two batches, the first of them sent twice, and what is stored then."""

    def query(t: T) -> DataFrame:
        table, rows = _table(t.sql(old), keys), t.sql(new)
        half = F.pmod(F.xxhash64(*keys), F.lit(2)) == 0
        for token, batch in (("1", rows.filter(half)), ("1", rows.filter(half)), ("2", rows.filter(~half))):
            table.merge(batch, token=token, overwrite=overwrite, coalesce=list(coalesce))
        return table.read()

    columns = ", ".join([*keys, *overwrite, *coalesce])
    _reg.add(name, f"SELECT {columns} FROM ({loads._upsert_sql(old, new, keys, overwrite, coalesce)})")(query)


_upsert("K2_stored_standings", loads._OLD_STANDINGS, loads._NEW_STANDINGS, ["poule_id", "equipe_id"], ["points", "joues"])
_upsert("K3_stored_matches", loads._OLD_SCORES, loads._NEW_SCORES, ["id"], ["statut"], ["score_dom"])
_upsert("K4_stored_phases", loads._OLD_PHASES, loads._NEW_PHASES, ["id_ffhb"], ["nom", "competition_id"])
_upsert("K19_stored_rounds", loads._OLD_ROUNDS, loads._NEW_ROUNDS, ["poule_id", "journee"], ["debut"])


@_reg.add("K5_stored_engagements", "SELECT DISTINCT id_ffhb, poule_id FROM {engagements}")
def engagements(t: T) -> DataFrame:
    """Inserted unless they are there; the table begins with some of them, and every batch overlaps the one before."""
    rows = t("engagements").select("id_ffhb", "poule_id")
    table = _table(rows.filter("poule_id % 3 = 0").distinct(), ["id_ffhb", "poule_id"])
    table.append(rows.filter("poule_id % 2 = 0"))
    table.append(rows)
    return table.read()


@_reg.add("K20_stored_overrides", "SELECT e.id_ffhb, CASE WHEN e.porteur_ext_structure_id IS NOT NULL THEN 2 ELSE 1 END AS rang FROM {equipes} e WHERE (e.logo IS NOT NULL OR e.porteur_ext_structure_id IS NOT NULL) AND NOT (e.nom ILIKE 'ENT %')")
def overrides(t: T) -> DataFrame:
    table = _table(t.sql(loads._OVERRIDES), ["id_ffhb"])
    table.merge(t("equipes").filter("porteur_ext_structure_id IS NOT NULL").select("id_ffhb", F.lit(2).alias("rang")), overwrite=["rang"])
    table.delete(t("equipes").filter("nom ILIKE 'ENT %'").select("id_ffhb"))
    return table.read()


@_reg.add("K21_stored_versions", "SELECT 'commandes' AS version, count(*) AS n FROM {orders} UNION ALL SELECT 'sans P', count(*) FROM {orders} WHERE o_orderstatus <> 'P'")
def versions(t: T) -> DataFrame:
    """The version before a deletion can still be read beside the one after it."""
    table = _table(t("orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"])
    table.delete(t("orders").filter("o_orderstatus = 'P'").select("o_orderkey"))
    count = lambda rows, name: rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("version"), "n")
    return count(table.read(0), "commandes").unionByName(count(table.read(), "sans P"))
