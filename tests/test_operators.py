"""Nulls, ties, repeated and empty rows of the operators and functions, on fixtures of the domain."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leaguespark.functions import classify, dates, similarity, text
from leaguespark.operators import coverage, loads, matches, merge, quantiles, snapshot, teams
from leaguespark.sources import pages, sheets
from leaguespark.streaming import incremental, limits


def values(spark, column, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r.y for r in rows.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_classifiers(spark):
    labels = ["C59 - MOINS DE 11 F DEPT H4", "57-14 CHAMPIONNAT", "57-08 -17MASCULINS", "U09 M", "PRÉ-NATIONAL", "LOISIR", "", None]
    assert values(spark, classify.category, labels) == ["-11", "Autre", "-17", "-09", "Seniors", "Loisir", "Autre", "Autre"]
    assert values(spark, classify.rank, ["JDA DIJON HB (C)", "HBC 2", "CLUB", "CLUB 12"]) == [3, 2, 1, 1]
    assert values(spark, classify.is_entente, ["CENTRE HANDBALL", "ENT A / B", "CONV. X"]) == [False, True, True]
    scores = spark.createDataFrame([(33, 18, None, None), (20, 0, None, None), (None, 20, True, None), (10, None, None, True), (None, 20, None, None), (10, None, None, None), (None, None, None, None), (7, None, None, None)], "d int, e int, fd boolean, fe boolean")
    marks = [F.col(c) for c in ("d", "e", "fd", "fe")]
    assert [tuple(r) for r in scores.select(classify.match_status(*marks), classify.forfeit_side(*marks)).collect()] == [("joue", None), ("joue", None), ("forfait", "dom"), ("forfait", "ext"), ("forfait", "dom"), ("forfait", "ext"), ("a_jouer", None), ("a_jouer", None)]


def test_text_and_dates(spark):
    assert values(spark, text.normalize, ["école ​ x  y ", "", None]) == ["école x y", "", None]
    assert values(spark, text.strip_upper, ["Ÿves Čech", "é", None]) == ["YVES CECH", "E", None]
    assert values(spark, lambda x: F.array_join(text.distinctive_tokens(x), ","), ["Étoile Sportive Vénissieux", "CLUB HANDBALL", ""]) == ["venissieux", "", ""]
    assert values(spark, text.department, ["57000", "97400", "20100", "20200", "5", None]) == ["57", "974", "2A", "2B", None, None]
    assert values(spark, text.is_private_ip, ["10.0.0.1", "8.8.8.8", "fe80::1", "2a02::1", "x", "172.32.0.1"]) == [True, False, True, False, True, False]
    assert values(spark, dates.canonical_season, ["25-26", "2025-2027", "2025/2026", None]) == ["2025-2026", None, "2025-2026", None]
    written = values(spark, dates.parse_date_time, ["15/03/2026 18:30", "15/03/2026", "garbage", None])
    assert [(w.value, w.heure_estimee) if w else None for w in written] == [(datetime(2026, 3, 15, 18, 30), False), (datetime(2026, 3, 15), True), None, None]
    assert dates.weekend_window(datetime(2026, 3, 11, 5)) == (datetime(2026, 3, 14), datetime(2026, 3, 16))
    assert dates.resolve_window(datetime(2026, 1, 1)) is None
    with pytest.raises(ValueError):
        dates.resolve_window(datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 1, 1))
    assert values(spark, lambda x: F.round(similarity.word_similarity(F.lit("word"), x), 2), ["two words", "", None]) == [0.8, 0.0, None]


def test_append_merge_and_retention(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "id int, v string, w string")
    new = spark.createDataFrame([(1, "a", None), (2, None, None), (4, "d", "z")], "id int, v string, w string")
    merged = merge.merge(old, new, ["id"], overwrite=["v"], coalesce=["w"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a", None, "noop"), (2, None, "x", "updated"), (3, "c", "y", "kept"), (4, "d", "z", "inserted")]
    assert {r.outcome for r in merge.merge(merged.drop("outcome"), new.filter("id <> 2"), ["id"], overwrite=["v"], coalesce=["w"]).collect()} == {"noop", "kept"}  # a second run changes nothing
    assert merge.merge(old.limit(0), new, ["id"], overwrite=["v"]).filter("outcome = 'inserted'").count() == 3
    tied = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (None, 1, "c")], "k int, at int, v string")
    assert {(r.k, r.v) for r in snapshot.latest_by_key(tied, ["k"], [F.col("at").desc(), F.col("v").desc()]).collect()} == {(1, "b"), (None, "c")}
    assert tuple(snapshot.append_outcome(tied.limit(0), tied.select("k", "at"), ["k", "at"]).first()) == (2, 1)
    assert merge.most_frequent(tied, ["k"], "v").filter("k = 1").first().v == "a"


def test_percentiles_without_a_group_in_one_place(spark):
    rows = [("a", float(i % 97)) for i in range(5000)] + [("b", 1.0), ("b", None), ("c", 2.0), ("c", 3.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = {r.k: r.v for r in df.groupBy("k").agg(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY v)").alias("v")).collect()}
    assert {r.k: r.v for r in quantiles.percentile_disc(df, "k", "v", 0.95).collect()} == want
    assert quantiles.percentile_disc(df.limit(0), "k", "v", 0.5).count() == 0


def test_groups_of_registrations(spark):
    given = [("2134380", "BOUZONVILLE HANDBALL", "57-14 -11 MASCULINS"), ("2183373", "BOUZONVILLE HANDBALL", "57-28 COUPE ECHO'SPORT  -11 M"), ("2166247", "ENT BOUZONVILLE / BOULAY", "57-08 -17MASCULINS"), ("2164679", "ENT BOUZONVILLE / BOULAY -13 M 1", "57-12 -13 MASCULINS"), ("9", "CLUB X", None)]
    regs = spark.createDataFrame([("c", i, n) for i, n, _ in given], "club_id string, id_ffhb string, nom string")
    engaged = spark.createDataFrame([(i, 1, c, None, None) for i, _, c in given if c], "id_ffhb string, ordre int, competition string, phase string, niveau string")
    none = spark.createDataFrame([], "id_ffhb string, categorie string, sexe string, rang int, entente boolean, exclu boolean")
    keys = {r.id_ffhb: r.cle for r in teams.classified(regs, engaged, none, ["club_id"]).collect()}
    assert keys == {"2134380": "-11|M|1|club", "2183373": "-11|M|1|club", "2166247": "-17|M|1|entente", "2164679": "-13|M|1|entente", "9": "Autre|mixte|1|club"}
    out = spark.createDataFrame([("9", None, None, None, None, True), ("2134380", None, "F", 2, None, None)], none.schema)
    keys = {r.id_ffhb: r.cle for r in teams.classified(regs, engaged, out, ["club_id"]).collect()}
    assert "9" not in keys and keys["2134380"] == "-11|F|2|club"


def test_round_coverage_and_modes(spark):
    now = datetime(2026, 3, 31, 12)
    announced = spark.createDataFrame([("P", n, datetime(2026, m, d).date()) for n, m, d in ((1, 3, 1), (2, 3, 11), (3, 3, 21), (4, 4, 10))], "poule string, journee int, date_debut date")
    played = spark.createDataFrame([("P", 1, "joue", datetime(2026, 3, 1)), ("P", 3, "a_jouer", datetime(2026, 3, 21)), ("P", None, "joue", None)], "poule string, journee int, statut string, date_heure timestamp")
    rounds = coverage.round_coverage(announced, played, now)
    assert {r.journee: r.en_base for r in rounds.collect()} == {1: True, 2: False, 3: False}
    assert tuple(coverage.coverage_totals(rounds).first()) == (3, 1, 1, 1)
    assert coverage.round_coverage(announced.limit(0), played, now).count() == 0


def test_match_load(spark):
    names = "ext_rencontre_id ext_poule_id ext_equipe_dom_id ext_equipe_ext_id date_heure score_dom score_ext journee fdm_code".split()
    made = lambda **x: F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in x.items()]))
    base = dict(zip(names, ["R1", "PO1", "D", "E", "2025-09-03T20:00:00+02:00", "28", "25 pts", 1, "F1"], strict=True))
    cases = [("R1", base), ("R1", {**base, "score_dom": None}), ("R2", {**base, "ext_rencontre_id": "R2", "ext_poule_id": "?"}), ("R3", {**base, "ext_rencontre_id": "R3", "ext_equipe_ext_id": "D"}), ("R4", {**base, "ext_rencontre_id": None}), ("R5", {**base, "ext_rencontre_id": "R5", "date_heure": "2025-09-03T00:00:00+02:00"})]
    captures = None
    for i, (key, payload) in enumerate(cases):
        row = spark.range(1).select(F.lit(i).alias("id"), F.lit(key).alias("natural_key"), made(**{k: v for k, v in payload.items() if v is not None}).alias("payload"), F.lit(datetime(2025, 10, 5 if i == 0 else 1)).alias("scraped_at"))
        captures = row if captures is None else captures.unionByName(row)
    ids = lambda *pairs: spark.createDataFrame(list(pairs), "id_ffhb string, id long")
    schema = "id_ffhb_match string, poule_id long, equipe_dom_id long, equipe_ext_id long, date_heure timestamp, date_a_confirmer boolean, heure_estimee boolean, score_dom int, score_ext int, statut string, forfait_equipe string, journee int, equipement_id string, fdm_code string"
    empty = spark.createDataFrame([], schema)
    load = lambda old: loads.load_matches(captures, ids(("PO1", 1)), ids(("D", 7), ("E", 8)), old)
    found = load(empty)
    rows = {r.id_ffhb_match: r for r in found.rows.collect()}
    assert set(rows) == {"R1", "R5"} and (rows["R1"].score_dom, rows["R1"].score_ext, rows["R1"].statut, rows["R1"].heure_estimee) == (28, 25, "joue", False) and rows["R5"].heure_estimee
    assert {(r.natural_key, r.warning) for r in found.warnings.collect()} == {("R2", "poule inconnue"), ("R3", "meme equipe")}
    assert [(r.natural_key, r.reasons) for r in found.rejects.collect()] == [("R4", "rencontre")]
    assert {r.outcome for r in load(found.rows.drop("outcome")).rows.collect()} == {"noop"}  # run again
    assert load(empty).report().count() == 3


def test_sources(spark):
    assert pages.component(F.lit(""), "x") is not None
    rows = spark.createDataFrame([("u", '<tr class="club-row" data-id="1"><td class="nom"> A &amp; B </td><td class="dept">2A</td></tr><tr class="club-row"><td class="nom">no id</td></tr>'), ("v", None), ("w", "<p>")], "url string, html string")
    assert [tuple(r) for r in pages.club_table(rows).collect()] == [("u", "1", "A & B", None, "2A")]
    broken = spark.createDataFrame([("u", '<c name="home-hero" attributes="{no json"></c>'), ("v", None)], "url string, html string")
    assert pages.slugs(broken).count() == 0 and pages.competition_detail(broken)["poules"].count() == 0
    play = spark.createDataFrame([("F", "PERIODE 1\n02:41 00 - 00\t\nBut JR N°07 NOM p\nx\nPERIODE 2\n31:00 1 - 0 Temps Mort d'Equipe Visiteur\n32:00 1 - 1"), ("G", None)], "fdm_code string, text string")
    assert [(r.ordre, r.periode, r.temps_seconds, r.type_action, r.cote, r.numero_maillot) for r in sheets.actions(play).orderBy("ordre").collect()] == [(0, 1, 161, "but", "recevant", 7), (1, 2, 1860, "temps_mort_visiteur", "visiteur", None)]


def test_rate_limit_of_batch_and_stream(spark, tmp_path):
    times = [0, 30, 60, 61, 62, 200, 200]
    rows = spark.createDataFrame([(i, k, datetime(2026, 1, 1, 0, s // 60, s % 60)) for k in ("a", None) for i, s in enumerate(times)], "id int, k string, at timestamp")
    found = {(r.k, r.id): (r.place, r.limited) for r in limits.rate_limit(rows, "k", "at", 2, 60).collect()}
    want = [(1, False), (2, False), (3, True), (1, False), (2, False), (1, False), (2, False)]
    assert all(found[k, i] == w for k in ("a", None) for i, w in enumerate(want))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = limits.rate_limit_stream(incremental.source(spark, str(tmp_path / "in")), "k", "at", 2, 60)
    incremental.run(stream, str(tmp_path / "s"), lambda batch, n: batch.write.mode("append").parquet(str(tmp_path / "out")))
    assert sorted(r.place for r in spark.read.parquet(str(tmp_path / "out")).filter("key = 'a'").collect()) == sorted(p for p, _ in want)


def test_delivery_ladder(spark):
    rows = spark.createDataFrame([(1, "pending", 0, True), (2, "pending", 0, False), (3, "pending", 6, False), (4, "delivered", 1, False)], "id int, status string, attempts int, ok boolean")
    step = matches.next_delivery(F.col("status"), F.col("attempts"), F.col("ok"))
    assert [tuple(r.s) for r in rows.select("id", step.alias("s")).orderBy("id").collect()] == [("delivered", None), ("pending", 60), ("failed", None), ("delivered", None)]


def test_sheet_pages(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "AB.txt").write_bytes("un\n\fdeux é".encode())
    (tmp_path / "sub" / "C.D.txt").write_bytes(b"")
    (tmp_path / "E.pdf").write_bytes(b"x")
    assert sorted(tuple(r) for r in sheets.read_pages(spark, str(tmp_path)).collect()) == [("AB", 1, "un\n"), ("AB", 2, "deux é")]
    made = spark.createDataFrame([("/x/N.txt", None), ("C.D.txt", b"")], "path string, content binary")
    assert [tuple(r) for r in sheets.text_pages(made).collect()] == [("C.D", 1, "")]


def test_player_lines_and_cells(spark):
    lineup = "Club Recevant\nX 95 MACEL dylan 5655011101499 A 1 1 2\n87 MEYER tom - MEYER-MATTA 5657027100665 A 8 9\n23 GROSSE thomas 5657027100959 X 3\nsans numero\nClub Visiteur\n1 jean 5657027100001 B 1 2 3 4 X 1 X\n"
    rows = spark.createDataFrame([("F", lineup), ("G", None), ("H", "")], "fdm_code string, text string")
    shown = ("section", "nom", "prenom", "type_licence", "numero_maillot", "capitaine", "gardien", "buts", "sept_metres_reussis", "sept_metres_tentes", "tirs", "arrets", "avertissement", "exclusions_2min", "disqualifie")
    found = [tuple(r[c] for c in shown) for r in sheets.players(rows).orderBy("at").collect()]
    assert found == [
        ("recevant", "MACEL", "dylan", "A", 95, True, False, 1, 1, None, 2, None, False, None, False),
        ("recevant", "MEYER", "tom - MEYER-MATTA", "A", 87, False, False, 8, None, None, 9, None, False, None, False),
        ("recevant", "GROSSE", "thomas", None, 23, False, False, None, None, None, None, None, True, 3, False),
        ("visiteur", "?", "jean", "B", 1, False, True, 1, 2, None, 3, 4, True, 1, True),
    ]
    # Headings of two tables; the row below the second takes the second's, two fragments meet under "7m", and JFL keeps its own.
    parts = [("Buts", 300.0, 700.0), ("7m", 330.0, 700.0), ("Buts", 100.0, 500.0), ("7m", 130.0, 500.5), ("Av.", 160.0, 500.0), ("JFL", 70.0, 500.0),
             ("5655011101499", 20.0, 450.0), ("4", 101.0, 451.0), ("2/3", 128.0, 450.0), ("9", 133.0, 450.0), ("X", 161.0, 449.0), ("1", 71.0, 450.0), ("8", 101.0, 430.0),
             ("5657027100665", 20.0, 400.0), ("5657027100959", 20.0, 900.0)]
    fragments = spark.createDataFrame([("F", i, s, x, y, 8.0) for i, (s, x, y) in enumerate(parts)], "fdm_code string, at int, str string, x double, y double, width double")
    cells = sheets.stat_cells(fragments)
    assert {r.numero_licence: r.cells for r in cells.collect()} == {"5655011101499": {"buts": "4", "7m": "2/3", "av": "X"}, "5657027100665": {}}
    placed = [(r.buts, r.sept_metres_reussis, r.sept_metres_tentes, r.tirs, r.avertissement) for r in sheets.players(rows, cells).orderBy("at").collect()]
    assert placed == [(4, 2, 3, None, True), (None, None, None, None, False), (None, None, None, None, True), (1, 2, None, 3, True)]
    assert sheets.documents(rows.limit(0).withColumn("page", F.lit(1)), cells).collect() == []


def test_byte_sizes_in_given_units(spark):
    sizes = [512, 1536, 5 * 1024**2, 3 * 1024**3, 2048 * 1024**4]
    assert values(spark, lambda x: text.byte_size(x.cast("double")), [str(n) for n in sizes]) == ["512 o", "1.5 Ko", "5.0 Mo", "3.0 Go", "2048 To"]
    assert values(spark, lambda x: text.byte_size(x.cast("double"), ("o", "Ko", "Mo")), [str(n) for n in sizes[:4]]) == ["512 o", "1.5 Ko", "5.0 Mo", "3072 Mo"]
