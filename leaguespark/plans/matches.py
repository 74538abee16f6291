"""Match-list queries: star joins, dynamic filters and pages.

The driver tables stand in for the league model: an order is a match, its
customer the home side, the supplier of its first line the away side, nations
are clubs and regions leagues.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.plans.base import Registry, table

_reg = Registry()
QUERIES, ORACLES = _reg.queries, _reg.oracles


@_reg.add(
    "D9_match_list_page",
    """
    SELECT o.o_orderkey AS match_id, c.c_name AS home, s.s_name AS away,
           nc.n_name AS home_nation, ns.n_name AS away_nation, rc.r_name AS league,
           o.o_orderstatus AS status, strftime(o.o_orderdate, '%Y-%m-%d') AS match_date
    FROM orders o
    JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey
    JOIN nation nc ON nc.n_nationkey = c.c_nationkey
    JOIN nation ns ON ns.n_nationkey = s.s_nationkey
    LEFT JOIN region rc ON rc.r_regionkey = nc.n_regionkey
    WHERE (nc.n_nationkey = 3 OR ns.n_nationkey = 3) AND o.o_orderstatus = 'F'
    ORDER BY o.o_orderdate DESC, o.o_orderkey DESC
    LIMIT 20 OFFSET 20
    """,
)
def match_list_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    home, away = t("nation").alias("nc"), t("nation").alias("ns")
    first = t("lineitem").filter("l_linenumber = 1").select("l_orderkey", "l_suppkey")
    return (
        t("orders").filter("o_orderstatus = 'F'")
        .join(first, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .join(home, F.col("nc.n_nationkey") == F.col("c_nationkey"))
        .join(away, F.col("ns.n_nationkey") == F.col("s_nationkey"))
        .join(t("region"), F.col("r_regionkey") == F.col("nc.n_regionkey"), "left")
        .filter((F.col("nc.n_nationkey") == 3) | (F.col("ns.n_nationkey") == 3))
        .orderBy(F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc_nulls_last())
        .offset(20).limit(20)
        .select(
            F.col("o_orderkey").alias("match_id"), F.col("c_name").alias("home"), F.col("s_name").alias("away"),
            F.col("nc.n_name").alias("home_nation"), F.col("ns.n_name").alias("away_nation"),
            F.col("r_name").alias("league"), F.col("o_orderstatus").alias("status"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("match_date"),
        )
    )
