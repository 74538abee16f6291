import pytest
from pyspark.sql import functions as F

from leaguespark.sources import sheets

OLD = """Feuille de match
Organisateur LIGUE DU NORD (5600000) Code Renc VAGP
Compétition 56-03 CHAMPIONNAT HONNEUR
56-HONNEUR MASC POULE 3 Groupe M56000202G
Initiale J18 du 28/03/26 au 29/03/26
DATE: samedi 25/04/2026 20:30 Journée / Date
SALLE: 5655 - OMNISPORT DU PARC
1 rue du parc 57000 VILLE

ETAIN RAYON / A.S. SARRE  23 37
Club Recevant
X 95 MACEL dylan 5655011101499 A 1 1 2
Club Visiteur
1 GARDE jean 5657027100001 B 0 0 0 9
DETAIL SCORE
REC VIS REC VIS
10 17 23 37
Statut Match :JOUE
Chronométreur LODOVICI enzo 5655011101546
SECRÉTAIRE LE GOFF-ÉLIE Anne 1234567890
Juge Arbitre 1 ATAMNA emma 5655011101777
Juge Arbitre 1 ATAMNA again 5655011101778
Responsable de Salle TOUT Jean
Juge Délégué MARTIN Paul 1111111111111"""
NEW = """Organisateur COMITE 57
Competition 57-01 COUPE
POULE UNIQUE
Groupe M57
Date samedi 03/10/2026 21:00 Journée J4 Salle OMNISPORTS
2 place du stade
LES UNS / LES AUTRES 30 30"""


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([("OLD", OLD), ("NEW", NEW), ("NONE", "no teams here\nA / B 3"), ("BARE", " A / B 1 2"), ("NULL", None), ("EMPTY", "")], "fdm_code string, text string")


def test_headers_of_both_layouts(texts):
    found = {r.fdm_code: tuple(r[c] for c in sheets.HEADER_FIELDS) for r in sheets.header(texts).collect()}
    assert found == {
        "OLD": ("LIGUE DU NORD", "5600000", "CHAMPIONNAT HONNEUR", "M56000202G", "56-HONNEUR MASC POULE 3", "ETAIN RAYON", "A.S. SARRE", "samedi 25/04/2026 20:30", "J18 du 28/03/26 au 29/03/26", "OMNISPORT DU PARC", "1 rue du parc 57000 VILLE", 23, 37, 10, 17, "JOUE"),
        "NEW": (None, None, "COUPE", "M57", "POULE UNIQUE", "LES UNS", "LES AUTRES", "samedi 03/10/2026 21:00", "J4", "OMNISPORTS", "2 place du stade", 30, 30, None, None, None),
        "BARE": (None, None, None, None, None, "A", "B", "", None, None, None, 1, 2, None, None, None),
    }


def test_officials_by_label(texts):
    found = [tuple(r)[1:] for r in sheets.officials(texts).orderBy("ordre").collect()]
    assert found == [
        (0, "juge_arbitre_1", "neutre", "ATAMNA", "emma", "5655011101777"), (1, "juge_delegue", "neutre", "MARTIN", "Paul", "1111111111111"), (2, "chronometreur", "neutre", "LODOVICI", "enzo", "5655011101546"),
        (3, "secretaire", "neutre", "LE GOFF-ÉLIE", "Anne", "1234567890"), (4, "delegue", "neutre", "MARTIN", "Paul", "1111111111111"),
    ]


def test_documents(spark, texts):
    play = "PERIODE 1\n02:41 00 - 00\t\nBut JR N°07 NOM p\n31:00 1 - 0 Temps Mort d'Equipe Visiteur"
    pages = texts.withColumn("page", F.lit(1)).unionByName(spark.createDataFrame([("OLD", play, 2), ("ALONE", play, 2)], "fdm_code string, text string, page int"))
    cells = spark.createDataFrame([("OLD", "5655011101499", {"buts": "4", "7m": "2/3"})], "fdm_code string, numero_licence string, cells map<string,string>")
    found = {r.fdm_code: r for r in sheets.documents(pages, cells).collect()}
    assert set(found) == {"OLD", "NEW"}  # a sheet needs teams and a date
    old = found["OLD"]
    assert [(p.nom, p.capitaine, p.buts, p.sept_metres_reussis, p.sept_metres_tentes) for p in old.composition_recevant] == [("MACEL", True, 4, 2, 3)]
    assert [(p.nom, p.gardien, p.arrets) for p in old.composition_visiteur] == [("GARDE", True, 9)]
    assert [(a.ordre, a.type_action, a.description_brute) for a in old.actions] == [(0, "but", "But JR N°07 NOM p"), (1, "temps_mort_visiteur", "Temps Mort d'Equipe Visiteur")]
    assert len(old.officiels) == 5 and (found["NEW"].composition_recevant, found["NEW"].actions, found["NEW"].officiels) == ([], [], [])


def test_sheets_are_cut_once_and_not_dealt_out(spark):
    sheet = spark.createDataFrame([("F1", "A / B 1 2\nDATE: samedi Journée\nPERIODE 2\n01:00 1 - 0\t\nBut JR N°07 N\n02:00 1 - 1 x")], "fdm_code string, text string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert plan(sheets.header(sheet).filter("date_heure_str <> ''")).count("Contains(") <= 6
    assert not any(word in plan(found) for found in (sheets.actions(sheet), sheets.sections(sheet)) for word in ("Window", "Sort"))
    assert [(a.ordre, a.periode, a.temps_seconds, a.description_brute) for a in sheets.actions(sheet).collect()] == [(0, 2, 60, "But JR N°07 N"), (1, 2, 120, "x")]
