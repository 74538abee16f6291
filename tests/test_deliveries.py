import pytest

from leaguespark.operators import matches


@pytest.fixture
def tables(spark):
    events = spark.createDataFrame([(i, "match.resultat", i % 3, None if i == 4 else 3 + i % 2) for i in range(20)], "match_id long, kind string, equipe_dom_id long, equipe_ext_id long")
    subscriptions = spark.createDataFrame([(1, True, None), (2, False, None), (3, True, 10), (4, True, None), (5, True, 99), (None, True, None)], "subscription_id long, actif boolean, club_id long")
    clubs = spark.createDataFrame([(0, 10), (3, 10), (4, 11)], "equipe_id long, club_id long")
    return events, subscriptions, clubs


@pytest.mark.parametrize("most", [100_000, 2])
def test_deliveries_equal_brute_force(tables, monkeypatch, most):
    monkeypatch.setattr(matches, "MOST_TO_ALL", most, raising=False)
    events, subscriptions, clubs = tables
    of_team: dict = {}
    for team, club in clubs.collect():
        of_team.setdefault(team, set()).add(club)
    want = set()
    for e in events.collect():
        playing = of_team.get(e.equipe_dom_id, set()) | of_team.get(e.equipe_ext_id, set())
        want |= {(e.match_id, e.kind, s.subscription_id) for s in subscriptions.collect() if s.actif and (s.club_id is None or s.club_id in playing)}
    found = [tuple(r) for r in matches.deliveries(*tables).select("match_id", "kind", "subscription_id").collect()]
    assert len(found) == len(want) and set(found) == want


def test_events_are_not_joined_on_a_constant(spark, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = matches.deliveries(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastNestedLoopJoin" in plan and "[one#" not in plan
