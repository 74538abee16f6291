"""Scalar functions applied to the driver tables: text, dates, classifiers and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.functions import coerce, dates, similarity, text
from leaguespark.plans.base import Registry, table
from leaguespark.plans.domain import PARTS, similar_sql
from leaguespark.plans.league import oracle
from leaguespark.plans.scalars import TITLE_SQL

_reg = Registry()
QUERIES, ORACLES = _reg.queries, _reg.oracles


@_reg.add("F4_slug", r"SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug FROM part")
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@_reg.add("F2_title_case", oracle(f"SELECT p_partkey, {TITLE_SQL} AS title FROM (SELECT p_partkey, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS propre FROM {{part}})"))
def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.title_case(F.col("p_name")).alias("title"))


@_reg.add("F9_route_template", r"SELECT regexp_replace(url, '/[0-9]+', '/:id', 'g') AS route, count(*) AS n FROM pages GROUP BY 1")
def route_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(text.template_route(F.col("url")).alias("route")).agg(F.count(F.lit(1)).alias("n"))


@_reg.add("F16_season", """
    SELECT season, count(*) AS n FROM (SELECT CAST(y AS VARCHAR) || '-' || CAST(y + 1 AS VARCHAR) AS season FROM
      (SELECT year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders)) GROUP BY season
""")  # fmt: skip
def season(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(dates.season_of(F.col("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@_reg.add("F19_day", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.day(F.col("o_orderdate")).alias("day"))


@_reg.add("F24_prefix_int", r"SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(o_orderpriority, '^\s*([+-]?[0-9]+)', 1), '') AS INTEGER) AS priority FROM orders")
def prefix_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", coerce.prefix_int(F.col("o_orderpriority")).alias("priority"))


@_reg.add("F12_word_similarity", oracle(f"SELECT CAST(id AS BIGINT) AS p_partkey, nom AS p_name, score FROM ({similar_sql('smal ring', PARTS)})"))
def word_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name resembles a query, above the threshold; few names hold enough of its trigrams to be scored."""
    query = F.lit("smal ring")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name").filter(similarity.may_match(query, F.col("p_name")))
    return rows.withColumn("score", similarity.word_similarity(query, F.col("p_name"))).filter(F.col("score") > similarity.THRESHOLD).withColumn("score", F.round("score", 6))
