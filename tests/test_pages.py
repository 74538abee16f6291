import json

import pytest
from pyspark.sql import functions as F

from leaguespark.sources import markup, pages

URL = "https://league.example.org/poule-7/"


def part(name, data, tag="page-component"):
    """A component with JSON in a single-quoted attribute."""
    return f"<{tag} name='{name}' attributes='{json.dumps(data, ensure_ascii=False).replace('&', '&amp;').replace(chr(39), '&apos;')}'></{tag}>"


@pytest.fixture
def poule(spark):
    return lambda *htmls: spark.createDataFrame([(URL, "P7", h) for h in htmls], "url string, ext_poule_id string, html string")


def test_tags_follow_the_rules_of_html():
    page = """<!-- <a href="no"> --><A HREF=bare data-x>1</a><a class='x > y' href = 'it&#39;s &eacute;&#xE9;&copy=1 &copy;'/><script>var a = "<a href='no'>";</SCRIPT ><title><a href="no"></title>
        <a href="first" href="second"><a href="a>b" =odd><p title="&lt;&quot;&amp;amp;"><a href="unclosed"""
    found = [(t, {k: markup.decode(v) for k, v in own.items()}) for t, own in markup.tags(page)]
    assert found == [
        ("a", {"href": "bare", "data-x": ""}), ("a", {"class": "x > y", "href": "it's éé&copy=1 ©"}), ("script", {}), ("title", {}), ("a", {"href": "first"}), ("a", {"href": "a>b", "=odd": ""}), ("p", {"title": '<"&amp;'}),
    ]
    assert list(markup.tags(None)) == list(markup.tags("")) == list(markup.tags("<")) == []


def test_components(spark):
    rows = ["<x-y name=a attributes='{\"k\": \"1 > 0\"}'>", '<x-y attributes="{&quot;k&quot;: 1}" NAME="a"></x-y><x-y name="a" attributes="later">', '<x-y name="a"><x-y name="a" attributes="later">', "<p name=a attributes=x>", None]
    found = spark.createDataFrame([(i, h) for i, h in enumerate(rows)], "i int, html string").select(pages.component(F.col("html"), "a").alias("v"), markup.components(F.col("html"), "p")["a"].alias("p")).collect()
    assert [tuple(r) for r in found] == [('{"k": "1 > 0"}', None), ('{"k": 1}', None), (None, None), (None, "x"), (None, None)]


def test_slugs_in_single_quotes(spark):
    features = [{"properties": {"url": u}} for u in ("https://a.example.org/clubs/b-2/", "http://a.example.org/clubs/a-1", "https://a.example.org/clubs/b-2", "https://a.example.org/other/x/", "https://a.example.org/clubs/Bad/", None)] + [{}]
    rows = spark.createDataFrame([(part("home-hero", {"geojson": {"features": features}}),), (part("home-hero", {"geojson": []}),), ("<page-component name='home-hero' attributes='{broken'>",), ("",)], "html string")
    assert [r.slug for r in pages.slugs(rows).collect()] == ["a-1", "b-2"]


def club(acf, title="Club L'Étoile"):
    return part("single-club---home-hero-club", {"post": {"post_title": title, "post_name": "letoile", "acf": acf}})


def test_club_documents(spark):
    gyms = [{"name_gym": " Salle É ", "zipcode_gym": "20100", "city_gym": "Ville", "latitude_gym": "41.9", "longitude_gym": 8.7}, {"name_gym": "second"}]
    htmls = {
        "ok": club({"id_club": "12", "zipcode_club": "97110", "address_club": "1 rue", "address_club_2": "club l'étoile", "url_club": "HTTP://", "email_club": "a.b@c.fr", "gyms_club": gyms, "nb_licence_senior_h_club": "30"}),
        "no_hall": club({"id_club": "13", "gyms_club": "none", "latitude_club": ""}), "bad_hall": club({"id_club": "14", "gyms_club": [{"name_gym": "x", "zipcode_gym": "1"}]}),
        "bad": club({"id_club": "A1", "email_club": "nobody", "url_club": "c.org", "longitude_club": "east", "nb_licence_jeunes_f_club": "1.5"}), "no_id": club({"id_club": " "}), "no_name": club({"id_club": "15"}, " "), "none": "<html></html>",
    }
    rows = spark.createDataFrame([(f"https://c.example.org/{k}", h) for k, h in htmls.items()], "url string, html string")
    found = pages.club_documents(rows)
    clubs = {r.id_ffhb: r for r in found["clubs"].collect()}
    assert set(clubs) == {"12", "13", "14"}
    ok = clubs["12"]
    assert (ok.nom, ok.slug, ok.departement_code, ok.adresse, ok.site_web, ok.email, ok.nb_licence_senior_h, ok.latitude) == ("Club L'Étoile", "letoile", "971", "1 rue", None, "a.b@c.fr", 30, None)
    assert ok.salle.asDict() == {"id_ffhb": "salle-e-20100-ville", "nom": "Salle É", "adresse": None, "code_postal": "20100", "ville": "Ville", "departement_code": "2A", "latitude": 41.9, "longitude": 8.7}
    assert clubs["13"].salle is None and clubs["13"].latitude == 0.0 and clubs["14"].salle is None
    assert [(r.id_ffhb, r.fields) for r in found["rejets"].collect()] == [("A1", ["id_ffhb", "email", "site_web", "longitude", "nb_licence_jeunes_f"])]


def test_competition_list(spark):
    listed = [
        {"ext_competitionId": "1", "libelle": " Coupe d'Été ", "type": "COUPE_DE_FRANCE", "genre": "FEMININ", "afficherStatsJoueurs": "1"}, {"ext_competitionId": "1", "libelle": "again", "type": "REGIONAL"},
        {"ext_competitionId": "2", "libelle": "B", "type": "NEW_ONE", "genre": "?", "afficherStatsJoueurs": ""}, {"ext_competitionId": "3", "libelle": "C", "type": "DEPARTEMENTAL", "afficherStatsJoueurs": "0", "code": "K"}, {"libelle": "no id", "type": "X"}, {"ext_competitionId": "4", "type": "X"},
    ]
    html = part("competitions---competition-main-menu", {"competitions": listed, "available_types": ["NATIONAL", "INTER_LIGUES", None], "structures": [{"ext_structureId": "S1", "libelle": "L"}, {"libelle": "x"}]})
    rows = spark.createDataFrame([("u", html), ("v", "<p>")], "url string, html string")
    found = {r.ext_competition_id: r for r in pages.competition_documents(rows, "https://l.example.org/s/").collect()}
    assert {k: (r.nom, r.niveau, r.sexe, r.code, r.afficher_stats_joueurs) for k, r in found.items()} == {"1": ("Coupe d'Été", "national", "F", None, True), "2": ("B", "national", None, None, None), "3": ("C", "departemental", None, "K", False)}
    assert found["1"].detail_url == "https://l.example.org/s/coupe-de-france/coupe-d-ete-1/"
    assert {r.segment for r in pages.sections(rows).collect()} == {"national", "inter-ligues"} and [r.libelle for r in pages.structures(rows).collect()] == ["L"]


def test_competition_detail(spark):
    selector = {"phases": [{"id": "1", "ext_phaseId": "PH1", "libelle": "A"}, {"id": "2", "libelle": "no id"}], "poules": [{"id": "10", "ext_pouleId": "P1", "phaseId": "1", "libelle": "x"}, {"id": "11", "ext_pouleId": "P2", "phaseId": "2", "libelle": "y"}]}
    teams = [{"ext_equipeId": "E1", "libelle": " T ", "pouleId": "10", "logo": "l"}, {"ext_equipeId": "E1", "libelle": "again", "pouleId": "11"}, {"ext_equipeId": "E2", "libelle": "U", "pouleId": "99"}, {"libelle": "no id", "pouleId": "10"}]
    calendar = part(pages.SELECTOR, selector) + part(pages.CALENDAR, {"equipes": teams})
    fallback = part(pages.SELECTOR, {**selector, "equipe_options": teams}) + part(pages.CALENDAR, {"equipes": []})
    for html in (calendar, fallback):
        found = pages.competition_detail(spark.createDataFrame([("u", html), ("v", None)], "url string, html string"))
        assert [tuple(r) for r in found["phases"].collect()] == [("u", "PH1", "A")] and [tuple(r) for r in found["poules"].collect()] == [("P1", "PH1", "x")]
        assert [tuple(r) for r in found["equipes"].collect()] == [("E1", "T", None, "l", None)]
        assert sorted(tuple(r) for r in found["engagements"].collect()) == [("E1", "P1"), ("E1", "P2")]


def met(**more):
    return {"ext_rencontreId": "R1", "extPouleId": "P7", "equipe1Id": "1", "equipe2Id": "2", "date": "2025-10-04T18:00:00Z", "equipe1Score": "33", "equipe2Score": None, "journeeNumero": "2", **more}


def test_match_list(poule):
    options = [{"id": "1", "ext_equipeId": "E1", "libelle": "Un"}, {"id": "2", "ext_equipeId": "E2", "libelle": " "}, {"id": "3", "ext_equipeId": "E1", "libelle": "Un bis"}, {"id": "4"}]
    rounds = json.dumps([{"journee_numero": "2", "date_debut": "2025-10-04"}, {"journee_numero": 3, "date_debut": "bad"}, {"journee_numero": "x"}])
    listed = [
        met(), met(ext_rencontreId="R2", extPouleId="other"), met(ext_rencontreId="R3", equipe2Id="9"), met(ext_rencontreId="R4", equipe2Id="3"), met(ext_rencontreId="R5", equipe1Score=" fo", equipe2Score="20"), met(ext_rencontreId="R6", date="soon"),
        met(ext_rencontreId="R7", date=None, journeeNumero="9"), met(ext_rencontreId="R8", journeeNumero=None), met(ext_rencontreId=None), met(ext_rencontreId="R9", journeeNumero="3"), met(ext_rencontreId="R10", date="2025-10-04 18:00:00"),
    ]
    html = part(pages.SELECTOR, {"equipe_options": options, "poules": [{"ext_pouleId": "P7", "journees": rounds}]}) + part(pages.MATCHES, {"rencontres": listed})
    found = pages.match_list(poule(html, part(pages.SELECTOR, {"equipe_options": options}), part(pages.MATCHES, {"rencontres": listed}), None))
    matches = {r.ext_rencontre_id: r for r in found["matchs"].collect()}
    assert {k: (r.date_heure, r.journee_date_debut, r.score_dom, r.score_ext, r.forfait_dom) for k, r in matches.items()} == {
        "R1": ("2025-10-04T18:00:00Z", "2025-10-04", 33, None, False), "R5": ("2025-10-04T18:00:00Z", "2025-10-04", None, 20, True), "R6": (None, "2025-10-04", 33, None, False),
    }
    assert {(r.ext_rencontre_id, *r.fields) for r in found["rejets"].collect()} == {("R7", "date_heure"), ("R8", "journee"), (None, "ext_rencontre_id"), ("R9", "journee_date_debut"), ("R10", "date_heure")}
    assert sorted((r.numero, r.date_debut) for r in found["journees"].collect()) == [(2, "2025-10-04"), (3, "bad")]
    assert [tuple(r)[:2] for r in found["equipes"].collect()] == [("E1", "Un")] and found["engagements"].count() == 2


def line(**more):
    return {"ext_classementId": "C1", "equipeId": "1", "place": "1", "point": 10, "joue": "5", "gagne": "3", "nul": "1", "perdu": "1", "butPlus": "100", "butMoins": "80", **more}


def test_ranking(poule):
    selector = part(pages.SELECTOR, {"equipe_options": [{"id": "1", "ext_equipeId": "old"}, {"id": "1", "ext_equipeId": "1000001"}]})
    listed = [line(dernieresRencontres="1;-1;0"), line(ext_classementId="C2", equipeId="GHOST"), line(ext_classementId="C3", equipeId=None), line(ext_classementId="C4", nul="-", butMoins=""), line(ext_classementId="")]
    rows = poule(selector + part(pages.RANKING, {"classements": listed}), selector, selector + part(pages.RANKING, {"classements": []}), part(pages.RANKING, {"classements": listed}), "<html></html>")
    found = pages.ranking(rows)
    assert [tuple(r) for r in found["lignes"].collect()] == [("C1", "P7", "1000001", 1, 10, 5, 3, 1, 1, 100, 80, "1;-1;0", URL)]
    assert {(r.ext_classement_id, *r.fields) for r in found["rejets"].collect()} == {("C4", "nuls", "buts_contre"), ("", "ext_classement_id")}


def test_player_statistics(poule):
    selector = part(pages.SELECTOR, {"equipe_options": [{"ext_equipeId": "E1", "libelle": " A "}, {"ext_equipeId": "E2", "libelle": "B"}, {"ext_equipeId": "E3", "libelle": "B"}]})
    person = lambda **more: {"individuId": "I1", "nom": "N", "prenom": "P", "equipeLibelle": "A", "matchCount": "4", "totalButs": 12, "totalArrets": "0", **more}
    data = part(pages.STATISTICS, {"rowsData": [person(), person(individuId="I2", equipeLibelle="B "), person(individuId="I3", equipeLibelle="?"), person(individuId="I4", nom=""), person(individuId="I5", totalButs=None), person(individuId="I6", totalArrets="-1")]})
    missing = part(pages.HEADER, {"is404": True})
    found = pages.player_statistics(poule(selector + data, missing + selector + data, selector, None))
    assert sorted((r.individu_id, r.ext_equipe_id, r.total_buts) for r in found["lignes"].collect()) == [("I1", "E1", 12), ("I2", "E3", 12), ("I3", None, 12)]
    assert {(r.individu_id, *r.fields) for r in found["rejets"].collect()} == {("I4", "nom"), ("I5", "total_buts"), ("I6", "total_arrets")}


def test_components_are_scanned_once_above_a_grouping(spark):
    rows = spark.range(100).select(F.lit(URL).alias("url"), F.concat(F.lit(part(pages.CLUB, {"post": {"post_title": "A", "acf": {"id_club": "1"}}})), F.lit("")).alias("html"), (F.col("id") % 2).alias("n")).distinct().drop("n")
    for found in pages.club_documents(rows).values():
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Aggregate")


def test_pages_of_the_league_are_as_large_as_a_poule(spark, monkeypatch):
    from leaguespark.plans import captured
    from leaguespark.plans.league import league

    t = league(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(pages, "competition_detail", lambda rows: rows)
    named = F.size(F.regexp_extract_all("html", F.lit("ext_pouleId"), F.lit(0)))
    found = captured._detail(t).agg(F.count(F.lit(1)), F.max(named)).first()
    assert tuple(found) == (t("poules").count(), 1)


def test_pages_of_a_poule_hold_one_list(spark):
    from leaguespark.plans import captured
    from leaguespark.plans.league import league

    t = league(spark, "/root/testdata/sf0.001")
    for kind, name in (("matches", pages.MATCHES), ("ranking", pages.RANKING), ("statistics", pages.STATISTICS)):
        held = [F.max(F.col("html").contains(n).cast("int")) for n in (pages.MATCHES, pages.RANKING, pages.STATISTICS)]
        assert tuple(captured._poule_pages(t, kind).agg(*held).first()) == tuple(int(n == name) for n in (pages.MATCHES, pages.RANKING, pages.STATISTICS))
