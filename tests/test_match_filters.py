from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leaguespark.operators import matches


@pytest.fixture
def tables(spark):
    make = spark.createDataFrame
    teams = [(i, f"T{i}", f"team {i}", [None, "A", "B", "A", "Z"][i % 5], "B" if i == 5 else None) for i in range(8)]
    played = [(i, i % 8, (i * 3 + 1) % 9, i % 2, datetime(2026, 1, 1 + i % 20), ["joue", "a_jouer", None][i % 3], i % 4 or None, i % 3 or None, None, 1, 2) for i in range(60)]
    return {
        "equipes": make(teams, "id long, id_ffhb string, nom string, ext_structure_id string, porteur_ext_structure_id string"),
        "clubs": make([("A", "Club A", 1), ("B", "Club B", None)], "id_ffhb string, nom string, salle_principale_id int"),
        "poules": make([(0, "P0", "p0", 0), (1, "P1", "p1", 1)], "id long, id_ffhb string, nom string, phase_id int"), "phases": make([(0, 0), (1, 1)], "id int, competition_id int"),
        "competitions": make([(0, "C0", "c0", "S"), (1, "C1", "c1", "S2")], "id int, id_ffhb string, nom string, saison_code string"),
        "salles": make([(1, "S1", "hall", "V", "r"), (2, "S2", "hall 2", "V", "r")], "id int, id_ffhb string, nom string, ville string, adresse string"),
        "equipements": make([], "equipement_id string, nom string, ville string, adresse string"),
        "matchs": make(played, "id long, equipe_dom_id long, equipe_ext_id long, poule_id long, date_heure timestamp, statut string, journee int, salle_id int, equipement_id string, score_dom int, score_ext int"),
    }


CASES = [
    {}, {"equipe": "T3"}, {"club": "A"}, {"club": "B"}, {"club": "Z"}, {"club": "none"}, {"equipe": "T1", "club": "B"}, {"poule": "P1"}, {"competition": "C0", "statut": "joue"}, {"saison": "S2", "journee": 1}, {"salle": "S2"},
    {"date_from": datetime(2026, 1, 5), "date_to": datetime(2026, 1, 9), "club": "A", "salle": "S1"},
]


def test_filters_before_the_joins_give_what_filters_after_them_give(tables):
    whole = matches.star(tables)
    for wanted in CASES:
        ids = lambda rows: sorted(r.id for r in rows.select(F.col("m.id").alias("id")).collect())
        want = ids(whole.filter(matches.match_filter(**wanted)))
        assert ids(matches.listed(tables, **wanted)) == want, wanted
        assert bool(want) == (wanted.get("club") not in ("Z", "none")), wanted
