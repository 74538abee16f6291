"""Joins, aggregates, windows, pages and set operations on the driver tables, as declarative SQL.

Each query is one statement that Spark and the oracle share unless their dialects
differ; Catalyst prunes columns, pushes filters down and picks the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.operators import quantiles
from leaguespark.plans.base import table

#: name -> (tables, Spark SQL, oracle SQL or None where it is the same)
_STATEMENTS: dict[str, tuple[str, str, str | None]] = {
    "P2_either_role": ("orders lineitem customer supplier", """
        SELECT o.o_orderkey FROM {orders} o LEFT SEMI JOIN (SELECT c_custkey FROM {customer} WHERE c_nationkey = 7) c ON c.c_custkey = o.o_custkey LEFT SEMI JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey
        UNION SELECT o.o_orderkey FROM {orders} o LEFT SEMI JOIN (SELECT l_orderkey FROM {lineitem} LEFT SEMI JOIN (SELECT s_suppkey FROM {supplier} WHERE s_nationkey = 7) s ON s.s_suppkey = l_suppkey) l ON l.l_orderkey = o.o_orderkey""", """
        SELECT DISTINCT o.o_orderkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN supplier s ON s.s_suppkey = l.l_suppkey WHERE c.c_nationkey = 7 OR s.s_nationkey = 7"""),
    "P5_half_open_range": ("orders", """
        SELECT o_orderkey, o_orderstatus FROM {orders} WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-07-01'""", None),
    "P8_causes": ("documents labels", """
        SELECT CASE WHEN d.text IS NULL THEN 'missing' WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 0 THEN 'poor' WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE 'unknown' END AS cause,
               count(*) AS n
        FROM {documents} d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM {labels} GROUP BY doc_id) l ON l.doc_id = d.doc_id GROUP BY 1""", None),
    "J1_star_join": ("lineitem orders customer supplier part nation region", """
        SELECT rc.r_name AS home_region, rs.r_name AS away_region, p.p_brand AS brand, count(*) AS n, round(sum(l.l_quantity), 2) AS quantity
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey JOIN {customer} c ON c.c_custkey = o.o_custkey JOIN {supplier} s ON s.s_suppkey = l.l_suppkey
        LEFT JOIN {part} p ON p.p_partkey = l.l_partkey LEFT JOIN {nation} nc ON nc.n_nationkey = c.c_nationkey LEFT JOIN {nation} ns ON ns.n_nationkey = s.s_nationkey
        LEFT JOIN {region} rc ON rc.r_regionkey = nc.n_regionkey LEFT JOIN {region} rs ON rs.r_regionkey = ns.n_regionkey GROUP BY 1, 2, 3""", None),
    "J3_expression_key": ("customer supplier nation", """
        SELECT c.c_custkey, n.n_name FROM {customer} c LEFT JOIN {supplier} s ON s.s_suppkey = c.c_custkey LEFT JOIN {nation} n ON n.n_nationkey = coalesce(s.s_nationkey, c.c_nationkey)""", None),
    "J6_zero_preserving": ("customer orders", """
        SELECT c.c_custkey, count(o.o_orderkey) AS n FROM {customer} c LEFT JOIN {orders} o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""", None),
    "J7_semi_join": ("orders lineitem", """
        SELECT o_orderkey FROM {orders} o WHERE EXISTS (SELECT 1 FROM {lineitem} l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""", None),
    "J9_anti_join_residual": ("part lineitem", """
        SELECT p_partkey FROM {part} p WHERE NOT EXISTS (SELECT 1 FROM {lineitem} l WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R' AND (l.l_discount > 0.08 OR l.l_quantity > p.p_size + 30))""", None),
    "J10_anti_join": ("customer orders", "SELECT c_custkey FROM {customer} WHERE NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'P')", None),
    "J16_fallback_lookup": ("events customer supplier", """
        SELECT e.event_id, coalesce(c.c_name, s.s_name) AS name FROM {events} e LEFT JOIN {customer} c ON c.c_custkey = e.user_id * 20 LEFT JOIN {supplier} s ON s.s_suppkey = e.user_id""", None),
    "J20_scalar_subquery": ("customer orders", """
        SELECT c_custkey, (SELECT count(*) FROM {orders} WHERE o_custkey = c_custkey) AS n FROM {customer}""", None),
    "J21_latest_capture": ("orders", "SELECT o_orderkey FROM {orders} WHERE o_orderdate = (SELECT max(o_orderdate) FROM {orders})", None),
    "A1_totals": ("events", "SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS types, round(coalesce(sum(value), 0), 4) AS total FROM {events} GROUP BY user_id", None),
    "A3_filtered_counts": ("lineitem", """
        SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(*) FILTER (WHERE l_returnflag = 'A') AS accepted, count(DISTINCT l_suppkey) FILTER (WHERE l_quantity > 25) AS large_suppliers
        FROM {lineitem} GROUP BY l_linestatus""", None),
    "A7_having_bool": ("lineitem", "SELECT l_orderkey, bool_or(l_discount > 0.05) AS cut FROM {lineitem} GROUP BY l_orderkey HAVING NOT bool_or(l_returnflag = 'R')", None),
    "A8_best_by_order": ("events", """
        SELECT user_id, min_by(event_type, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END * 100000000 + event_id) AS best FROM {events} GROUP BY user_id""", None),
    "A11_health_ratio": ("lineitem", "SELECT l_linestatus, round(CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0), 6) AS share FROM {lineitem} GROUP BY l_linestatus", None),
    "A15_two_level_union": ("orders events", """
        SELECT kind, max(day) AS last_day, count(*) AS days FROM (
          SELECT 'order' AS kind, CAST(o_orderdate AS DATE) AS day FROM {orders} UNION ALL SELECT 'event', CAST(ts AS DATE) FROM {events}) t GROUP BY kind""", None),
    "A17_having": ("lineitem", "SELECT l_partkey, count(*) AS n FROM {lineitem} GROUP BY l_partkey HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 5 AND sum(l_quantity) > 200", None),
    "A18_names_in_order": ("part", "SELECT p_brand, array_join(sort_array(collect_set(p_type)), ',') AS types FROM {part} GROUP BY p_brand",
                           "SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand"),
    "A19_coverage": ("documents", "SELECT lang, count(text) * 100 div count(*) AS percent FROM {documents} GROUP BY lang", "SELECT lang, CAST(count(text) * 100 // count(*) AS BIGINT) AS percent FROM documents GROUP BY lang"),
    "W1_row_number": ("orders", """
        SELECT o_custkey, o_orderkey, nth FROM (SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS BIGINT) AS nth FROM {orders}) t WHERE nth <= 2""", None),
    "W5_carry_forward": ("events", """
        SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END) IGNORE NULLS OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM {events}""",
        "SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events"),
    "L1_page": ("orders", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 40", None),
    "L4_top_k": ("lineitem", "SELECT l_suppkey, count(*) AS n FROM {lineitem} GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 15", None),
    "U2_union_distinct": ("customer supplier", "SELECT c_nationkey AS nation FROM {customer} UNION SELECT s_nationkey FROM {supplier}", None),
    "U3_typed_union": ("customer supplier part", """
        SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM {customer} UNION ALL SELECT 'supplier', s_suppkey, s_name FROM {supplier} UNION ALL SELECT 'part', p_partkey, p_name FROM {part}""", None),
    "U6_unpivot": ("lineitem", """
        SELECT kind, count(*) AS n, round(sum(amount), 4) AS total FROM (SELECT stack(2, 'discount', l_discount, 'tax', l_tax) AS (kind, amount) FROM {lineitem}) GROUP BY kind""",
        "SELECT kind, count(*) AS n, round(sum(amount), 4) AS total FROM (SELECT 'discount' AS kind, l_discount AS amount FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem) GROUP BY kind"),
    "F32_json_field": ("events", "SELECT event_type, sum(try_cast(get_json_object(props, '$.k') AS BIGINT)) AS total FROM {events} GROUP BY event_type",
                       "SELECT event_type, CAST(sum(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY event_type"),
    "T9_hourly_series": ("events", """
        SELECT date_format(h.hour, 'yyyy-MM-dd HH:mm') AS hour, coalesce(e.n, 0) AS n, coalesce(e.purchases, 0) AS purchases
        FROM (SELECT explode(sequence(timestamp '2024-01-01', timestamp '2024-01-31 23:00:00', interval 1 hour)) AS hour) h
        LEFT JOIN (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) AS n, count_if(event_type = 'purchase') AS purchases FROM {events} GROUP BY 1) e ON e.hour = h.hour""", """
        SELECT strftime(h.hour, '%Y-%m-%d %H:%M') AS hour, coalesce(e.n, 0) AS n, coalesce(e.purchases, 0) AS purchases
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS hour) h
        LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS purchases FROM events GROUP BY 1) e ON e.hour = h.hour"""),
}


def _query(tables: str, statement: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(statement, **{name: table(spark, sf_dir, name) for name in tables.split()})

    return run


def _plain(tables: str, statement: str) -> str:
    return statement.format(**{name: name for name in tables.split()})


def percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact 95th percentile and the mean by type, without a type's values in one task."""
    events = table(spark, sf_dir, "events").select("event_type", "value")
    mean = events.groupBy(F.col("event_type").alias("__type")).agg(F.round(F.avg("value"), 4).alias("mean"))
    return quantiles.percentile_disc(events, "event_type", "value", 0.95).withColumnRenamed("value", "p95").join(mean, F.col("event_type").eqNullSafe(F.col("__type"))).drop("__type")


QUERIES = {name: _query(tables, statement) for name, (tables, statement, _) in _STATEMENTS.items()}
ORACLES = {name: oracle or _plain(tables, statement) for name, (tables, statement, oracle) in _STATEMENTS.items()}
QUERIES["A5_percentile"] = percentile
ORACLES["A5_percentile"] = "SELECT event_type, percentile_disc(0.95) WITHIN GROUP (ORDER BY value) AS p95, round(avg(value), 4) AS mean FROM events GROUP BY event_type"
