"""Queries whose order lines are dealt by match into tasks of a bounded number of lines."""

import math

import pytest

from leaguespark.plans import league
from leaguespark.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["D11_player_detail", "J18_shirt_to_player"])
def test_tasks_grow_in_number_and_not_in_size(spark, name, monkeypatch):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    monkeypatch.setattr(league, "LINES", 100)
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert dealt and all(f", {math.ceil(lines / 100)})" in x for x in dealt)
    # What is grouped or joined by match alone stays where its lines are.
    by_match = [x for x in plan.splitlines() if "Exchange hashpartitioning(match_id" in x]
    assert all(", cote#" in x for x in by_match) and "hashpartitioning(l_orderkey#" in plan
    assert not any("l_partkey" in x or "l_linenumber" in x for x in plan.splitlines() if "Exchange hashpartitioning(" in x)
    if name == "D11_player_detail":
        assert "Window" not in plan and not by_match


def test_line_ups_of_player_pages_never_travel_by_team(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["D11_player_pages"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_team = [x for x in plan.splitlines() if "Exchange hashpartitioning(equipe_" in x]
    # Matches and teams, for the home and for the away side.
    assert len(by_team) == 4 and not any("equipe_id#" in x for x in by_team)
