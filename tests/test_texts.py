from leaguespark.plans.registry import QUERIES

#: Names and their title case by the rules of titleCaseFr.
NAMES = {
    "jean dupont": "Jean Dupont",
    "jean de la fontaine": "Jean de la Fontaine",
    "LES AMIS DU SPORT ET DES JEUX": "Les Amis du Sport et des Jeux",
    "alice d'arc": "Alice d'Arc",
    "L'ÎLE-D'YEU": "l'Île-d'yeu",
    "qu'elle aujourd'hui 'abc abc'": "qu'Elle Aujourd'hui 'abc Abc'",
    "jean-pierre DUPONT": "Jean-Pierre Dupont",
    "hbc trifouilly-sur-mer": "Hbc Trifouilly-Sur-Mer",
    "  saint   - denis\u200b ": "Saint - Denis",
    "": "",
    None: None,
}


def test_title_case_keeps_every_name(spark, tmp_path):
    rows = list(enumerate(NAMES))
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    found = {r.p_partkey: r.title for r in QUERIES["F2_title_case"](spark, str(tmp_path)).collect()}
    assert found == {i: NAMES[name] for i, name in rows}


def test_search_scores_names_above_their_grouping(spark):
    from leaguespark.plans.registry import QUERIES

    plan = QUERIES["D16_search"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    last = max(i for i, line in enumerate(plan) if "array_max" in line)
    assert "Aggregate" in plan[last + 1]
