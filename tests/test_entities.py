import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leaguespark.operators import entities, pipeline
from leaguespark.operators.search import TrigramIndex
from leaguespark.functions import similarity


def captures(spark, *payloads):
    rows = [(i, str(p.pop("_key", i)), json.dumps(p), datetime(2026, 1, 1 + p.pop("_day", 0))) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "id long, natural_key string, payload string, scraped_at timestamp")


@pytest.fixture
def data(spark):
    """A small league with an unknown parent, a reject or an old capture in each table."""
    made = {
        "salles": [{"id_ffhb": "s1", "nom": "SALLE DU PARC", "adresse": " 1  rue ", "ville": "NANCY", "departement_code": "54"}, {"id_ffhb": "s2", "nom": "x", "departement_code": "99"}, {"id_ffhb": "", "nom": "y"}],
        "clubs": [{"id_ffhb": "1", "nom": "HBC DE LYON", "departement_code": "54", "salle_principale_id_ffhb": "s1", "nb_licence_senior_h": "3", "nb_licence_jeunes_f": "4", "email": "a@b.c"}, {"id_ffhb": "2", "nom": "b", "salle_principale_id_ffhb": "s9"}, {"id_ffhb": "x3", "nom": "c"}],
        "competitions": [{"ext_competition_id": "C1", "nom": "Coupe", "niveau": "national", "afficher_stats_joueurs": "0"}, {"ext_competition_id": "C2", "nom": "Z", "niveau": "mondial"}],
        "phases": [{"ext_phase_id": "PH1", "ext_competition_id": "C1", "nom": "P"}, {"ext_phase_id": "PH2", "ext_competition_id": "C2", "nom": "Q"}],
        "poules": [{"ext_poule_id": "PO1", "ext_phase_id": "PH1", "nom": "A", "_key": "k"}, {"ext_poule_id": "PO1", "ext_phase_id": "PH1", "nom": "older", "_key": "k"}, {"ext_poule_id": "PO2", "ext_phase_id": "PH2", "nom": "B"}],
        "equipes": [{"ext_equipe_id": f"E{i}", "nom": f"e{i}", "ext_structure_id": s, "structure_id": "in"} for i, s in enumerate(["1", "1", "2", None, "77"])],
        "engagements": [{"ext_equipe_id": e, "ext_poule_id": p} for e, p in (("E0", "PO1"), ("E0", "PO1"), ("E1", "PO9"), ("E9", "PO1"))],
    }
    made["poules"][0]["_day"] = 1
    tables = {name: captures(spark, *rows) for name, rows in made.items()}
    return tables, {"departements": spark.createDataFrame([("54", "GE")], "code string, ligue string")}


def contents(made):
    return {s.name: {tuple(r) for r in made.table(s.name).read().collect()} for s in pipeline.STEPS if made.table(s.name).exists()}


def test_all_seven_loads(spark, tmp_path, data):
    tables, given = data
    made = pipeline.Pipeline(spark, str(tmp_path), tables.get, given, buckets=2)
    assert set(made.run("c").values()) == {"done"}
    hall = {r.id_ffhb: r for r in made.read("salles").collect()}
    assert (hall["s1"].nom, hall["s1"].adresse, hall["s1"].departement_code, hall["s2"].departement_code) == ("Salle du Parc", "1 rue", "54", None)
    club = {r.id_ffhb: r for r in made.read("clubs").collect()}
    assert (club["1"].nom, club["1"].ligue, club["1"].salle_principale_id_ffhb, club["1"].effectif_estime) == ("Hbc de Lyon", "GE", "s1", 7)
    assert set(club) == {"1", "2"} and (club["2"].salle_principale_id_ffhb, club["2"].effectif_estime) == (None, None)
    assert [(r.id_ffhb, r.afficher_stats_joueurs) for r in made.read("competitions").collect()] == [("C1", False)]
    assert [tuple(r) for r in made.read("phases").collect()] == [("PH1", "P", "C1")] and [tuple(r) for r in made.read("poules").collect()] == [("PO1", "A", "PH1")]
    team = {r.id_ffhb: (r.club_id_ffhb, r.ext_structure_id, r.porteur_ext_structure_id) for r in made.read("equipes").collect()}
    assert team == {"E0": ("1", "1", None), "E1": ("1", "1", None), "E2": ("2", "2", None), "E3": (None, None, "1"), "E4": (None, "77", None)}
    assert [tuple(r) for r in made.table("engagements").read().collect()] == [("E0", "PO1")]
    warned = {(r.step, r.natural_key, r.warning) for r in made.messages("warnings").collect()}
    assert warned == {
        ("salles", "1", "dept 99 introuvable"), ("clubs", "1", "salle s9 introuvable"), ("phases", "1", "competition C2 introuvable"), ("poules", "2", "phase PH2 introuvable"), ("equipes", "3", "club non résolu : absent"),
        ("equipes", "4", "club non résolu : 77"), ("engagements", "2", "poule PO9 introuvable"), ("engagements", "3", "equipe E9 introuvable"),
    }
    assert {(r.step, r.reasons) for r in made.messages("rejects").collect()} == {("salles", "id_ffhb"), ("clubs", "id_ffhb"), ("competitions", "niveau")}
    assert {(r.step, r.outcome, r.n) for r in made.report("c").collect()} >= {("equipes", "inserted", 5), ("equipes", "warned", 2), ("salles", "rejected", 1)}
    # Again: nothing changes, and an absent value keeps what is stored.
    again = pipeline.Pipeline(spark, str(tmp_path), {**tables, "clubs": captures(spark, {"id_ffhb": "1", "nom": "HBC DE LYON", "departement_code": "54"})}.get, given, buckets=2)
    before = contents(made)
    assert set(again.run("d", only=["clubs", "equipes"]).values()) == {"done"} and contents(again) == before
    assert {(r.step, r.outcome) for r in again.report("d").collect()} == {("clubs", "noop"), ("equipes", "noop"), ("equipes", "warned")}


@pytest.mark.parametrize("stop", ["phases"])
def test_a_pipeline_that_is_lost_is_resumed(spark, tmp_path, data, stop, monkeypatch):
    """Lost after a step's commit and before the ledger has it: the resumed run ends with the tables of a run in one go."""
    tables, given = data
    whole = pipeline.Pipeline(spark, str(tmp_path / "whole"), tables.get, given, buckets=2)
    whole.run("c")
    made = pipeline.Pipeline(spark, str(tmp_path / "cut"), tables.get, given, buckets=2)
    merge, append = pipeline.VersionedTable.merge, pipeline.VersionedTable.append

    def lost(real):
        def call(self, *args, **how):
            version = real(self, *args, **how)
            if self.path.endswith(f"/{stop}"):
                raise KeyboardInterrupt
            return version

        return call

    with monkeypatch.context() as m:
        m.setattr(pipeline.VersionedTable, "merge", lost(merge))
        m.setattr(pipeline.VersionedTable, "append", lost(append))
        with pytest.raises(KeyboardInterrupt):
            made.run("c")
    assert {r.status for r in made.log.runs().filter(F.col("job") == stop).collect()} == {"partial"}
    what = made.run("c")
    names = [s.name for s in pipeline.ordered(pipeline.STEPS)]
    assert [what[n] for n in names] == ["skipped" if names.index(n) < names.index(stop) else "done" for n in names]
    assert contents(made) == contents(whole)
    assert {tuple(r) for r in made.report("c").collect()} == {tuple(r) for r in whole.report("c").collect()}


def test_a_step_takes_its_captures_once(spark, tmp_path, data):
    tables, given = data
    read = spark.sparkContext.accumulator(0)

    def seen(payload):
        read.add(1)
        return payload

    counted = tables["salles"].withColumn("payload", F.udf(seen, "string").asNondeterministic()("payload"))
    made = pipeline.Pipeline(spark, str(tmp_path), {"salles": counted}.get, given, buckets=2)
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    made.run("c", only=["salles"])
    assert read.value == tables["salles"].count() and made.read("salles").count() == 2
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_a_failed_step_blocks_what_needs_it(spark, tmp_path, data):
    tables, given = data
    made = pipeline.Pipeline(spark, str(tmp_path), lambda name: tables[name] if name != "phases" else tables[name].select("id"), given, buckets=2)
    what = made.run("c", keep_going=True)
    assert {n for n, w in what.items() if w == "failed"} == {"phases"} and {n for n, w in what.items() if w == "blocked"} == {"poules", "engagements"}
    with pytest.raises(Exception, match="natural_key|scraped_at|UNRESOLVED"):
        made.run("c")


def test_order():
    names = lambda *a, **k: [s.name for s in pipeline.ordered(*a, **k)]
    assert names(pipeline.STEPS) == ["salles", "clubs", "competitions", "phases", "poules", "equipes", "engagements"]
    assert names(pipeline.STEPS[::-1]).index("salles") < names(pipeline.STEPS[::-1]).index("clubs")
    assert names(pipeline.STEPS, start="poules") == ["poules", "equipes", "engagements"] and names(pipeline.STEPS, only=["equipes", "salles"]) == ["salles", "equipes"]
    with pytest.raises(ValueError, match="unknown"):
        pipeline.ordered(pipeline.STEPS, start="x")
    loop = (pipeline.Step("a", ("b",), entities.halls), pipeline.Step("b", ("a",), entities.halls))
    with pytest.raises(ValueError, match="need each other"):
        pipeline.ordered(loop)


def test_index_search_equals_all_pairs(spark, tmp_path):
    import random

    rnd = random.Random(6)
    words = ["handball", "hand", "club", "nancy", "nantes", "union", "sportive", "saint", "étienne", "metz", "ac", "b"]
    names = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4)))) for i in range(300)] + [(900, None), (901, ""), (902, "--"), (903, "club club club")]
    queries = [(i, " ".join(rnd.choice(words)[: rnd.randint(2, 9)] for _ in range(rnd.randint(1, 3)))) for i in range(40)] + [(900, None), (901, "!"), (902, "zzz"), (903, "club")]
    rows = spark.createDataFrame(names, "id long, nom string")
    asked = spark.createDataFrame(queries, "qid long, q string")
    score = similarity.word_similarity(F.col("q"), F.col("nom"))
    want = {(r.qid, r.id, round(r.s, 9)) for r in asked.crossJoin(rows).withColumn("s", score).filter("s > 0.6").collect()}
    index = TrigramIndex(rows, str(tmp_path / "index"))
    found = {(r.qid, r.id, round(r.score, 9)) for r in index.search(asked).collect()}
    assert found == want and len(found) > 500
    # Common trigrams are dealt over salts, many trigrams are joined: the same pairs.
    import leaguespark.operators.search as search

    search_common, search_pushed = search.COMMON, search.PUSHED
    try:
        search.COMMON, search.PUSHED = 5, 0
        assert {(r.qid, r.id, round(r.score, 9)) for r in index.search(asked).collect()} == want
    finally:
        search.COMMON, search.PUSHED = search_common, search_pushed
    # A few queries read the files of their rarest trigrams, and meet few names.
    one = asked.filter("qid = 903")
    assert "In(gram" in index.candidates(one)._jdf.queryExecution().toString() or "EqualTo(gram" in index.candidates(one)._jdf.queryExecution().toString()
    best = index.best(asked, 3).collect()
    assert max(r.rank for r in best) == 3 and {r.qid for r in best} == {q for q, _, _ in want}
    assert index.search(asked.limit(0)).count() == 0


def test_equal_names_are_scored_once(spark, tmp_path):
    """The score is taken of each pair of texts above a grouping, and reaches every id of the name."""
    rows = spark.createDataFrame([(i, "NATION MACHINERY" if i % 2 else "NATION MACHINERY 2") for i in range(200)], "id long, nom string")
    asked = spark.createDataFrame([(1, "nation machinery"), (2, "nation machinery"), (3, "zzz")], "qid long, q string")
    found = TrigramIndex(rows, str(tmp_path / "index")).search(asked)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(plan) if "array_max" in line)
    assert "Aggregate" in plan[last + 1]
    assert found.count() == 400 and {round(r.score, 6) for r in found.collect()} == {1.0}
