"""The driver tables read as a league, and the registration of queries over it.

Customers are team registrations, nations with a market segment are clubs, regions,
nations and suppliers are competitions, phases and poules, orders are matches, order
lines are line-ups and actions, parts are players, suppliers are referees too, and
events are access logs and runs.  A view is one SQL statement that Spark and the
oracle share; ``{name}`` stands for another view or a driver table.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leaguespark.plans.base import table

SEASON = "2025-2026"
#: Moments that stand for now, past the middle of the orders and after the events.
NOW = "2000-06-15 12:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"

#: Order lines of a task, where they are dealt by match.
LINES = 500_000

_CLUB_ID = "CAST(c_nationkey * 100 + ascii(c_mktsegment) AS STRING)"

VIEWS = {
    "clubs": f"""
        SELECT DISTINCT {_CLUB_ID} AS id_ffhb, lpad({_CLUB_ID}, 7, '0') AS code_ffhb, n_name || ' ' || c_mktsegment AS nom, n_name AS ville, n_regionkey AS ligue_id,
               n_nationkey AS departement_id, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey END AS salle_principale_id, lpad({_CLUB_ID}, 7, '0') || '@example.org' AS email
        FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey""",
    "salles": """
        SELECT n_nationkey AS id, 'S' || CAST(n_nationkey AS STRING) AS id_ffhb, n_name || ' HALL' AS nom, 'rue ' || n_name AS adresse,
               lpad(CAST(n_nationkey * 3701 AS STRING), 5, '0') AS code_postal, n_name AS ville FROM {nation}""",
    "equipements": """
        SELECT 'E' || CAST(r_regionkey AS STRING) AS equipement_id, r_name || ' GYM' AS nom, 'place ' || r_name AS adresse, lpad(CAST(r_regionkey * 11003 AS STRING), 5, '0') AS code_postal, r_name AS ville FROM {region}""",
    "equipes": f"""
        SELECT c_custkey AS id, CAST(c_custkey AS STRING) AS id_ffhb,
               CASE c_custkey % 5 WHEN 0 THEN n_name || ' ' || c_mktsegment WHEN 1 THEN n_name || ' ' || c_mktsegment || ' 2' WHEN 2 THEN 'ENT ' || n_name || ' / ' || c_mktsegment
                    WHEN 3 THEN n_name || ' ' || c_mktsegment || ' -15 F' ELSE c_name END AS nom,
               CASE WHEN c_custkey % 10 < 8 THEN '2025-2026' ELSE '2024-2025' END AS saison_code,
               CASE WHEN c_custkey % 4 > 0 THEN {_CLUB_ID} END AS ext_structure_id, CASE WHEN c_custkey % 8 = 0 THEN {_CLUB_ID} END AS porteur_ext_structure_id,
               CASE WHEN c_custkey % 3 = 0 THEN 'logo-' || CAST(c_custkey AS STRING) END AS logo
        FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey""",
    "competitions": """
        SELECT r_regionkey AS id, 'C' || CAST(r_regionkey AS STRING) AS id_ffhb, r_name || CASE r_regionkey % 3 WHEN 0 THEN ' HONNEUR MASCULIN' WHEN 1 THEN ' -15 FEMININ DEPT' ELSE ' LOISIR' END AS nom,
               CASE r_regionkey % 3 WHEN 0 THEN 'regional' WHEN 1 THEN 'departemental' ELSE 'national' END AS niveau, '2025-2026' AS saison_code FROM {region}""",
    "phases": """
        SELECT n_nationkey AS id, 'PH' || CAST(n_nationkey AS STRING) AS id_ffhb, n_regionkey AS competition_id, n_name AS nom, '2025-2026' AS saison_code FROM {nation}""",
    "poules": """
        SELECT s_suppkey AS id, 'PO' || CAST(s_suppkey AS STRING) AS id_ffhb, s_nationkey AS phase_id, s_name AS nom, '2025-2026' AS saison_code FROM {supplier}""",
    "matchs": """
        SELECT o_orderkey AS id, 'M' || CAST(o_orderkey AS STRING) AS id_ffhb_match, l.poule_id, o_custkey AS equipe_dom_id, l.away AS equipe_ext_id, o_orderdate + INTERVAL 20 HOUR AS date_heure,
               CASE o_orderstatus WHEN 'F' THEN 'joue' WHEN 'P' THEN 'forfait' ELSE 'a_jouer' END AS statut,
               CASE o_orderstatus WHEN 'F' THEN CAST(floor(o_totalprice) AS BIGINT) % 40 WHEN 'P' THEN 20 END AS score_dom,
               CASE WHEN o_orderstatus = 'F' THEN CAST(floor(l.price) AS BIGINT) % 40 END AS score_ext,
               CASE WHEN o_orderkey % 11 > 0 THEN CAST(o_orderkey % 22 + 1 AS INTEGER) END AS journee,
               CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 25 END AS salle_id, CASE WHEN o_orderkey % 3 = 1 THEN 'E' || CAST(o_orderkey % 5 AS STRING) END AS equipement_id,
               CASE WHEN o_orderkey % 2 = 0 THEN 'F' || CAST(o_orderkey AS STRING) END AS fdm_code, CASE WHEN o_orderstatus = 'P' THEN 'ext' END AS forfait_equipe
        FROM {orders} JOIN (SELECT l_orderkey, min(l_suppkey) AS poule_id, max(l_partkey) AS away, max(l_extendedprice) AS price FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o_orderkey""",
    "joueurs": """
        SELECT p_partkey AS id, lpad(CAST(p_partkey % 25 * 100 + CASE p_partkey % 7 WHEN 0 THEN 65 WHEN 1 THEN 66 WHEN 2 THEN 70 WHEN 3 THEN 72 ELSE 77 END AS STRING), 7, '0') || lpad(CAST(p_partkey AS STRING), 6, '0') AS numero_licence,
               p_name AS nom, p_type AS prenom FROM {part}""",
    "compositions": """
        SELECT x.match_id, x.joueur_id, CASE WHEN x.numero_maillot % 2 = 1 THEN m.equipe_dom_id ELSE m.equipe_ext_id END AS equipe_id, CASE WHEN x.numero_maillot % 2 = 1 THEN 'dom' ELSE 'ext' END AS cote,
               CASE WHEN x.numero_maillot < 7 THEN x.numero_maillot END AS numero_maillot, x.but_count
        FROM (SELECT l_orderkey AS match_id, l_partkey AS joueur_id, min(l_linenumber) AS numero_maillot, CAST(max(l_quantity) AS BIGINT) % 12 AS but_count FROM {lineitem} GROUP BY l_orderkey, l_partkey) x
        JOIN {matchs} m ON m.id = x.match_id""",
    "actions": """
        SELECT l_orderkey AS match_id, l_linenumber AS ordre, CASE WHEN l_linenumber <= 3 THEN 1 ELSE 2 END AS periode, CASE WHEN l_linenumber % 2 = 1 THEN 'dom' ELSE 'ext' END AS cote,
               max(l_returnflag) AS type_action, min(l_partkey) AS joueur_id FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "arbitres": "SELECT s_suppkey AS id, 'A' || CAST(s_suppkey AS STRING) AS id_ffhb, s_name AS nom_complet, s_nationkey AS niveau FROM {supplier}",
    "officiels": """
        SELECT DISTINCT l_orderkey AS match_id, l_suppkey AS arbitre_id, CASE WHEN l_linenumber = 1 THEN 'arbitre1' WHEN l_linenumber = 2 THEN 'arbitre2' ELSE 'delegue' END AS role FROM {lineitem}""",
    "classements": """
        SELECT poule_id, equipe_dom_id AS equipe_id, CAST(count(*) AS BIGINT) AS joues, CAST(sum(CASE WHEN score_dom > score_ext THEN 3 WHEN score_dom = score_ext THEN 2 ELSE 1 END) AS BIGINT) AS points,
               CAST(sum(coalesce(score_dom, 0)) AS BIGINT) AS buts_pour, CAST(sum(coalesce(score_ext, 0)) AS BIGINT) AS buts_contre, max(date_heure) AS capture_date
        FROM {matchs} GROUP BY poule_id, equipe_dom_id""",
    "stats_joueurs": """
        SELECT m.poule_id, c.joueur_id, max(c.equipe_id) AS equipe_id, CAST(count(*) AS BIGINT) AS match_count, CASE WHEN c.joueur_id % 9 > 0 THEN CAST(sum(c.but_count) AS BIGINT) END AS total_buts, CAST(max(m.date_heure) AS DATE) AS capture_date
        FROM {compositions} c JOIN {matchs} m ON m.id = c.match_id GROUP BY m.poule_id, c.joueur_id""",
    "engagements": """
        SELECT DISTINCT e.id_ffhb AS id_ffhb, m.poule_id AS poule_id, c.nom AS competition, ph.nom AS phase, c.niveau AS niveau
        FROM {matchs} m JOIN {equipes} e ON e.id = m.equipe_dom_id JOIN {poules} po ON po.id = m.poule_id JOIN {phases} ph ON ph.id = po.phase_id JOIN {competitions} c ON c.id = ph.competition_id""",
    "saisons": "SELECT * FROM (VALUES ('2024-2025', DATE '2024-07-01', DATE '2025-06-30'), ('2025-2026', DATE '2025-07-01', DATE '2026-06-30')) AS s(saison_code, date_debut, date_fin)",
    "api_logs": """
        SELECT event_id AS id, ts AS requested_at, '/v1/' || event_type || 's/' || CAST(user_id AS STRING) AS path, CASE WHEN event_type = 'error' THEN 500 WHEN event_id % 17 = 0 THEN 404 ELSE 200 END AS status,
               CAST(floor(value) AS BIGINT) AS duration_ms, CASE WHEN user_id % 5 > 0 THEN 'key' || CAST(user_id % 50 AS STRING) END AS key_prefix FROM {events}""",
    "runs": """
        SELECT event_id AS id, event_type AS job, ts AS started_at, CASE WHEN event_id % 6 <> 5 THEN ts + INTERVAL 30 MINUTE END AS finished_at,
               CASE event_id % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'partial' WHEN 5 THEN 'running' ELSE 'success' END AS status,
               CASE WHEN event_id % 4 = 0 THEN '2024-2025' ELSE '2025-2026' END AS saison, event_id % 7 AS pages, props AS stats FROM {events}""",
}

#: Driver tables, which views and queries may use as well.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _names(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{([a-z]\w*)\}", sql)))


def league(spark: SparkSession, sf_dir: str, given: dict[str, DataFrame] | None = None) -> Callable[[str], DataFrame]:
    """A function from names to DataFrames: views of the league, or driver tables; ``given`` ones take their place."""
    built = dict(given or {})

    def get(name: str) -> DataFrame:
        if name not in built:
            built[name] = run(VIEWS[name]) if name in VIEWS else table(spark, sf_dir, name)
        return built[name]

    def run(sql: str) -> DataFrame:
        return spark.sql(sql, **{name: get(name) for name in _names(sql)})

    def dealt() -> Callable[[str], DataFrame]:
        """The same league, its order lines dealt by match to ``parts`` tasks: views that group or join them by match shuffle them no more, and a task holds as much at any size."""
        lines = get("lineitem")
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // LINES))
        found = league(spark, sf_dir, {"lineitem": lines.repartition(parts, "l_orderkey")})
        found.parts = parts
        return found

    get.sql, get.dealt = run, dealt
    return get


def oracle(sql: str) -> str:
    """The statement with the views it needs in front, for the oracle."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in order:
            for other in _names(VIEWS[name]):
                need(other)
            order.append(name)

    for name in _names(sql):
        need(name)
    plain = lambda text: re.sub(r"\{([a-z]\w*)\}", r"\1", text)
    views = ", ".join(f"{name} AS ({plain(VIEWS[name])})" for name in order)
    text = plain(sql).strip()
    if not views:
        return text
    return f"WITH {views}, {text[4:].lstrip()}" if text.upper().startswith("WITH ") else f"WITH {views} {text}"


class League:
    """Collects queries over the league with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable:
        """Decorates a function of ``league``'s getter; ``sql`` is the oracle's statement."""

        def keep(fn: Callable) -> Callable:
            self.queries[name] = lambda spark, sf_dir: fn(league(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = oracle(sql)
            return fn

        return keep

    def same(self, name: str, sql: str, other: str | None = None) -> None:
        """A query that is one statement for both, or for Spark, with another one for the oracle."""
        self.add(name, other or sql)(lambda t: t.sql(sql))
