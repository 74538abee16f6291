"""Rows from web pages: components that carry JSON in an attribute, and plain tables.

Pages are rows of (url, html).  A page without the component, or with one that is
no JSON, gives no rows.  ``markup`` reads a page's components once; all that follows
is expressions over them, so pages are parsed where they lie.  Rows that a source's
schema doesn't accept are left out; functions that return several tables return them
as ``rejets`` with the names of the fields at fault.  JSON numbers count as their
digits where a text is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.functions import coerce, text
from leaguespark.sources import markup

#: Character references in table cells, the ampersand last.
_REFERENCES = (("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
#: Sections of competitions and their level; others are national.
LEVELS = {"NATIONAL": "national", "REGIONAL": "regional", "DEPARTEMENTAL": "departemental"}
#: Genders of competitions.
GENDERS = {"FEMININ": "F", "MASCULIN": "M", "MIXTE": "mixte"}
#: Names of the components.
HERO, CLUB, MENU = "home-hero", "single-club---home-hero-club", "competitions---competition-main-menu"
SELECTOR, CALENDAR, MATCHES = "competitions---poule-selector", "competitions---calendar-button", "competitions---rencontre-list"
RANKING, STATISTICS, HEADER = "competitions---classement", "competitions---stats-joueurs", "competitions---page-header"

_URL = r"^(?:https?://[^\s/?#]+|(?!https?:)[A-Za-z][A-Za-z0-9+.-]*:).*$"
_EMAIL = r"(?i)^(?!\.)(?!.*\.\.)[a-z0-9_'+.-]*[a-z0-9_+-]@(?:[a-z0-9][a-z0-9-]*\.)+[a-z]{2,}$"
_DEPARTMENT = r"^(?:\d{2,3}|2A|2B)$"
_MOMENT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})$"
_DAY = r"^\d{4}-\d{2}-\d{2}$"


def unescape(value: Column) -> Column:
    for reference, character in _REFERENCES:
        value = F.replace(value, F.lit(reference), F.lit(character))
    return value


def escape(value: Column) -> Column:
    return F.replace(F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def component(html: Column, name: str) -> Column:
    """The JSON text in the attribute ``attributes`` of the first component of a name; null without one."""
    return markup.components(html)[name]


def _parsed(pages: DataFrame, *keep: str, **schemas: tuple[str, str]) -> DataFrame:
    """The columns to keep and, for each name, the component's JSON by its schema."""
    found = pages.select(*keep, markup.components(F.col("html")).alias("__components"))
    return found.select(*keep, *[F.from_json(F.col("__components")[name], schema).alias(alias) for alias, (name, schema) in schemas.items()])


def checked(rows: DataFrame, **tests: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all tests, and the others with ``fields``, the names of the tests they fail; a test that is null fails."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests.items()]), lambda x: x.isNotNull())
    rows = rows.withColumn("fields", failed)
    return rows.filter(F.size("fields") == 0).drop("fields"), rows.filter(F.size("fields") > 0)


def _given(value: Column) -> Column:
    return F.coalesce(value != "", F.lit(False))


def _fits(value: Column, pattern: str) -> Column:
    """An optional text: null, or of the pattern's form."""
    return value.isNull() | value.rlike(pattern)


def _tidy(value: Column) -> Column:
    return F.nullif(F.regexp_replace(value, rf"^{text.SPACES}|{text.SPACES}$", ""), F.lit(""))


def _number(value: Column) -> Column:
    """A number as a text: the empty one is zero, anything else that is no number is NaN."""
    return F.when(F.trim(value) == "", F.lit(0.0)).when(value.isNotNull(), F.coalesce(F.trim(value).try_cast("double"), F.lit(float("nan"))))


def _cell(row: Column, name: str) -> Column:
    inner = F.regexp_extract(row, rf"""(?s)<td[^>]*class=["']{name}["'][^>]*>(.*?)</td>""", 1)
    return F.nullif(text.clean(unescape(F.regexp_replace(inner, "<[^>]*>", ""))), F.lit(""))


def club_table(pages: DataFrame) -> DataFrame:
    """(url, id_ffhb, nom, ville, departement_code) of the rows of class club-row that have an id and a name."""
    rows = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(r"""(?s)(<tr[^>]*class=["']club-row["'].*?</tr>)"""), F.lit(1))).alias("row"))
    own = F.nullif(F.regexp_extract("row", r"""^<tr[^>]*\bdata-id(?:-ffhb)?=["']([^"']*)["']""", 1), F.lit(""))
    found = rows.select("url", F.coalesce(F.trim(own), _cell(F.col("row"), "id")).alias("id_ffhb"), *[_cell(F.col("row"), c).alias(n) for c, n in (("nom", "nom"), ("ville", "ville"), ("dept", "departement_code"))])
    return found.filter("id_ffhb IS NOT NULL AND nom IS NOT NULL")


def slugs(pages: DataFrame, name: str = HERO) -> DataFrame:
    """(slug): distinct last parts of the club addresses of a page's geo features, sorted."""
    found = _parsed(pages, data=(name, "geojson STRUCT<features: ARRAY<STRUCT<properties: STRUCT<url: STRING>>>>"))
    urls = found.select(F.explode("data.geojson.features").alias("f")).select(F.col("f.properties.url").alias("u"))
    return urls.select(F.nullif(F.regexp_extract("u", "^https?://[^/]+/clubs/([a-z0-9-]+)/?$", 1), F.lit("")).alias("slug")).filter("slug IS NOT NULL").distinct().orderBy("slug")


_GYM = "name_gym adress_gym zipcode_gym city_gym latitude_gym longitude_gym"
_ACF = "id_club city_club zipcode_club address_club address_club_2 url_club tel_club email_club latitude_club longitude_club register_link logo_club nb_licence_senior_h_club nb_licence_senior_f_club nb_licence_jeunes_h_club nb_licence_jeunes_f_club"
_LICENCES = ("senior_h", "senior_f", "jeunes_h", "jeunes_f")


def club_documents(pages: DataFrame, name: str = CLUB) -> dict[str, DataFrame]:
    """``clubs`` with all their fields and ``salle``, the first hall as a struct or null, and ``rejets``, clubs of another form."""
    fields = lambda names: ", ".join(f"{n}: STRING" for n in names.split())
    schema = f"post STRUCT<post_title: STRING, post_name: STRING, acf: STRUCT<{fields(_ACF)}, gyms_club: ARRAY<STRUCT<{fields(_GYM)}>>>>"
    rows = _parsed(pages, "url", data=(name, schema)).select("url", F.col("data.post.post_title").alias("title"), F.col("data.post.post_name").alias("slug"), F.col("data.post.acf").alias("acf")).filter("acf IS NOT NULL")
    own = lambda c: _tidy(F.col(f"acf.{c}"))
    gym = F.get("acf.gyms_club", F.lit(0))
    hall_name, code, town = _tidy(gym["name_gym"]), _tidy(gym["zipcode_gym"]), _tidy(gym["city_gym"])
    place = [_number(gym[c]) for c in ("latitude_gym", "longitude_gym")]
    hall_id = text.slug(F.concat_ws("-", hall_name, F.coalesce(code, F.lit("")), F.coalesce(town, F.lit(""))), 80)
    hall = F.struct(hall_id.alias("id_ffhb"), hall_name.alias("nom"), _tidy(gym["adress_gym"]).alias("adresse"), code.alias("code_postal"), town.alias("ville"), text.department(code).alias("departement_code"), place[0].alias("latitude"), place[1].alias("longitude"))
    sound = hall_name.isNotNull() & (hall_id != "") & _fits(code, r"^\d{5}$") & _fits(text.department(code), _DEPARTMENT) & ~F.coalesce(F.isnan(place[0]) | F.isnan(place[1]), F.lit(False))
    first, second = own("address_club"), own("address_club_2")
    second = F.when(F.lower(second) != F.lower(_tidy(F.col("title"))), second)
    site = own("url_club")
    found = rows.select(
        "url", own("id_club").alias("id_ffhb"), _tidy(F.col("title")).alias("nom"), _tidy(F.col("slug")).alias("slug"), own("city_club").alias("ville"), text.department(own("zipcode_club")).alias("departement_code"),
        F.nullif(F.concat_ws(" ", first, second), F.lit("")).alias("adresse"), F.when(F.lower(site) != "http://", site).alias("site_web"), own("tel_club").alias("telephone"), own("email_club").alias("email"),
        _number(F.col("acf.latitude_club")).alias("latitude"), _number(F.col("acf.longitude_club")).alias("longitude"), own("register_link").alias("register_link"), own("logo_club").alias("logo_club"),
        *[_number(F.col(f"acf.nb_licence_{k}_club")).alias(f"nb_licence_{k}") for k in _LICENCES], F.when(sound, hall).alias("salle"),
    ).filter("id_ffhb IS NOT NULL AND nom IS NOT NULL")
    count = lambda c: F.col(c).isNull() | ((F.col(c) >= 0) & (F.col(c) == F.floor(c)) & ~F.isnan(c))
    good, bad = checked(
        found, id_ffhb=F.col("id_ffhb").rlike(r"^\d+$"), departement_code=_fits(F.col("departement_code"), _DEPARTMENT), email=_fits(F.col("email"), _EMAIL), site_web=_fits(F.col("site_web"), _URL),
        register_link=_fits(F.col("register_link"), _URL), source_url=F.col("url").rlike(_URL), latitude=F.col("latitude").isNull() | ~F.isnan("latitude"), longitude=F.col("longitude").isNull() | ~F.isnan("longitude"),
        **{f"nb_licence_{k}": count(f"nb_licence_{k}") for k in _LICENCES},
    )
    return {"clubs": good.withColumns({f"nb_licence_{k}": F.col(f"nb_licence_{k}").cast("int") for k in _LICENCES}), "rejets": bad}


def club_details(pages: DataFrame, name: str = CLUB) -> DataFrame:
    """(id_ffhb, nom, ville, departement_code, adresse, site_web, salle) of the accepted clubs."""
    found = club_documents(pages, name)["clubs"]
    return found.select("id_ffhb", "nom", "ville", "departement_code", "adresse", "site_web", "salle")


def sections(pages: DataFrame, name: str = MENU) -> DataFrame:
    """(type, segment): announced sections and their part of the address."""
    rows = _parsed(pages, data=(name, "available_types ARRAY<STRING>"))
    return rows.select(F.explode("data.available_types").alias("type")).filter("type IS NOT NULL").distinct().select("type", segment(F.col("type")).alias("segment"))


def segment(kind: Column) -> Column:
    return F.replace(F.lower(kind), F.lit("_"), F.lit("-"))


def structures(pages: DataFrame, name: str = MENU) -> DataFrame:
    """(url, ext_structure_id, libelle, sigle, code, type): the organisations that a menu lists."""
    rows = _parsed(pages, "url", data=(name, "structures ARRAY<STRUCT<ext_structureId: STRING, libelle: STRING, sigle: STRING, code: STRING, type: STRING>>"))
    found = rows.select("url", F.explode("data.structures").alias("s")).select("url", F.col("s.ext_structureId").alias("ext_structure_id"), _tidy(F.col("s.libelle")).alias("libelle"), "s.sigle", "s.code", "s.type")
    return found.filter("ext_structure_id <> '' AND libelle IS NOT NULL")


def competition_documents(pages: DataFrame, base: str = "https://league.example.org/competitions/saison-1/", name: str = MENU) -> DataFrame:
    """(url, ext_competition_id, nom, niveau, sexe, code, ext_structure_id, detail_url, afficher_stats_joueurs): the first of each id on a page; unknown types are national."""
    schema = "competitions ARRAY<STRUCT<ext_competitionId: STRING, libelle: STRING, type: STRING, genre: STRING, code: STRING, structureId: STRING, afficherStatsJoueurs: STRING>>"
    rows = _parsed(pages, "url", data=(name, schema)).select("url", F.posexplode("data.competitions").alias("at", "c")).select("url", "at", "c.*").withColumn("libelle", _tidy(F.col("libelle")))
    rows = rows.filter("ext_competitionId <> '' AND libelle IS NOT NULL AND type <> ''")
    kept = [c for c in rows.columns if c not in ("url", "ext_competitionId", "at")]
    # Pages list an id once or a few times; the first entry is kept by partial aggregation.
    first = rows.groupBy("url", F.col("ext_competitionId").alias("ext_competition_id")).agg(F.min_by(F.struct(*kept), "at").alias("c")).select("url", "ext_competition_id", "c.*")
    chosen = lambda column, values: F.coalesce(*[F.when(F.col(column) == k, F.lit(v)) for k, v in values.items()])
    shown = F.when(F.col("afficherStatsJoueurs") != "", F.lower("afficherStatsJoueurs").isin("1", "true"))
    address = F.concat(F.lit(base), segment(F.col("type")), F.lit("/"), text.slug(F.col("libelle")), F.lit("-"), F.col("ext_competition_id"), F.lit("/"))
    return first.select(
        "url", "ext_competition_id", F.col("libelle").alias("nom"), F.coalesce(chosen("type", LEVELS), F.lit("national")).alias("niveau"), chosen("genre", GENDERS).alias("sexe"), "code",
        F.col("structureId").alias("ext_structure_id"), address.alias("detail_url"), shown.alias("afficher_stats_joueurs"),
    )


def competitions(pages: DataFrame, name: str = MENU) -> DataFrame:
    """(url, ext_competition_id, nom, niveau, slug): the first of each id on a page; unknown types are national."""
    found = competition_documents(pages, name=name)
    return found.select("url", "ext_competition_id", "nom", "niveau", text.slug(F.col("nom")).alias("slug"))


_TEAM = "STRUCT<id: STRING, ext_equipeId: STRING, libelle: STRING, pouleId: STRING, ext_structureId: STRING, structureId: STRING, logo: STRING>"
_SELECTOR = f"""phases ARRAY<STRUCT<id: STRING, ext_phaseId: STRING, libelle: STRING>>, poules ARRAY<STRUCT<id: STRING, ext_pouleId: STRING, phaseId: STRING, libelle: STRING, journees: STRING>>,
    equipe_options ARRAY<{_TEAM}>, selected_poule STRUCT<journees: STRING>"""


def _teams(rows: DataFrame) -> DataFrame:
    """(url, at, ext_equipe_id, nom, ...) of rows (..., at, t); teams without an outer id are left out."""
    others = [c for c in rows.columns if c != "t"]
    found = rows.select(*others, F.col("t.id").alias("id"), F.col("t.pouleId").alias("poule"), F.col("t.ext_equipeId").alias("ext_equipe_id"), _tidy(F.col("t.libelle")).alias("nom"), F.col("t.ext_structureId").alias("ext_structure_id"), F.col("t.logo").alias("logo"), F.col("t.structureId").alias("structure_id"))
    return found.filter("ext_equipe_id <> ''")


def _first_teams(teams: DataFrame) -> DataFrame:
    """(ext_equipe_id, nom, ext_structure_id, logo, structure_id): each team as its first page names it."""
    fields = ("nom", "ext_structure_id", "logo", "structure_id")
    return teams.filter("nom IS NOT NULL").groupBy("ext_equipe_id").agg(F.min_by(F.struct(*fields), F.struct("url", "at")).alias("t")).select("ext_equipe_id", "t.*")


def competition_detail(pages: DataFrame, selector: str = SELECTOR, calendar: str = CALENDAR) -> dict[str, DataFrame]:
    """phases, poules, equipes and engagements of competition pages; inner ids are translated on their page, teams come from the calendar or else from the selector."""
    rows = _parsed(pages, "url", s=(selector, _SELECTOR), c=(calendar, f"equipes ARRAY<{_TEAM}>")).filter("s IS NOT NULL")
    phases = rows.select("url", F.explode("s.phases").alias("p")).select("url", F.col("p.id").alias("phase"), F.col("p.ext_phaseId").alias("ext_phase_id"), _tidy(F.col("p.libelle")).alias("nom")).filter("phase <> '' AND ext_phase_id <> '' AND nom IS NOT NULL")
    inner = rows.select("url", F.explode("s.poules").alias("p")).select("url", F.col("p.id").alias("poule"), F.col("p.ext_pouleId").alias("ext_poule_id"), F.col("p.phaseId").alias("phase"), _tidy(F.col("p.libelle")).alias("nom"))
    inner = inner.filter("poule <> '' AND ext_poule_id <> '' AND phase <> '' AND nom IS NOT NULL")
    poules = inner.join(phases.select("url", "phase", "ext_phase_id"), ["url", "phase"])
    source = F.when(F.size("c.equipes") > 0, F.col("c.equipes")).otherwise(F.col("s.equipe_options"))
    teams = _teams(rows.select("url", F.posexplode(source).alias("at", "t"))).filter("nom IS NOT NULL").join(inner.select("url", "poule", "ext_poule_id"), ["url", "poule"])
    return {"phases": phases.select("url", "ext_phase_id", "nom"), "poules": poules.select("ext_poule_id", "ext_phase_id", "nom"), "equipes": _first_teams(teams), "engagements": teams.select("ext_equipe_id", "ext_poule_id").distinct()}


def _last_wins(pairs: Column) -> Column:
    """A map of (key, value) structs in which a repeated key has its last value."""
    keys = F.transform(pairs, lambda p: p["key"])
    later = lambda i: F.array_contains(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), F.get(keys, i))
    return F.map_from_entries(F.when(F.size(F.array_distinct(keys)) == F.size(keys), pairs).otherwise(F.filter(pairs, lambda p, i: ~later(i))))


def _outer_ids(options: Column) -> Column:
    """Inner to outer ids of a page's teams."""
    return _last_wins(F.transform(F.filter(options, lambda o: (o["id"] != "") & (o["ext_equipeId"] != "")), lambda o: F.struct(o["id"].alias("key"), o["ext_equipeId"].alias("value"))))


def _rounds(field: Column) -> Column:
    """array<struct<numero, date_debut, date_fin>> of a list of rounds, which may be JSON within JSON."""
    listed = F.from_json(field, "ARRAY<STRUCT<journee_numero: STRING, date_debut: STRING, date_fin: STRING>>")
    rounds = F.transform(listed, lambda j: F.struct(F.when(j["journee_numero"].rlike(r"^\d+$"), j["journee_numero"].try_cast("int")).alias("numero"), j["date_debut"].alias("date_debut"), j["date_fin"].alias("date_fin")))
    return F.filter(rounds, lambda j: j["numero"].isNotNull())


def match_list(pages: DataFrame, selector: str = SELECTOR, matches: str = MATCHES) -> dict[str, DataFrame]:
    """matchs, rejets, equipes, engagements and journees of poule pages (url, ext_poule_id, html).

    Matches of another poule, of unknown teams or of a team with itself are left out; ``FO`` instead of a score marks
    a forfeit.  A match without an id, without a round or without any date (its own or its round's) is rejected.
    """
    of = "ext_rencontreId extPouleId equipe1Id equipe2Id date equipe1Score equipe2Score equipe1ScoreMT equipe2ScoreMT journeeNumero equipementId fdmCode arbitre1Id arbitre1 arbitre2Id arbitre2"
    rows = _parsed(pages, "url", "ext_poule_id", s=(selector, _SELECTOR), r=(matches, f"rencontres ARRAY<STRUCT<{', '.join(f'{n}: STRING' for n in of.split())}>>")).filter("s IS NOT NULL")
    same = F.get(F.filter("s.poules", lambda p: p["ext_pouleId"] == F.col("ext_poule_id")), F.lit(0))["journees"]
    rows = rows.select("url", "ext_poule_id", F.col("s.equipe_options").alias("options"), F.col("r.rencontres").alias("listed"), _rounds(F.coalesce(F.nullif(F.col("s.selected_poule.journees"), F.lit("")), same)).alias("rounds"))
    options = _teams(rows.select("url", "ext_poule_id", F.posexplode("options").alias("at", "t")))
    journees = rows.select("ext_poule_id", F.explode("rounds").alias("j")).select("ext_poule_id", "j.*")
    # The inner ids of a page's own teams, as a map beside its matches: no join.
    own = F.filter("listed", lambda r: r["extPouleId"] == F.col("ext_poule_id"))
    round_of = lambda r: F.get(F.filter("rounds", lambda j: j["numero"] == F.trim(r["journeeNumero"]).try_cast("int")), F.lit(0))
    paired = coerce.let(_outer_ids(F.col("options")), lambda ids: F.transform(own, lambda r: F.struct(r.alias("m"), F.try_element_at(ids, r["equipe1Id"]).alias("dom"), F.try_element_at(ids, r["equipe2Id"]).alias("ext"), round_of(r).alias("j"))))
    found = rows.select("url", "ext_poule_id", F.explode(paired).alias("p")).select("url", "ext_poule_id", "p.m", "p.dom", "p.ext", "p.j").filter("dom <> ext")
    forfeit = lambda c: F.coalesce(F.upper(F.trim(c)) == "FO", F.lit(False))
    moment = _tidy(F.col("m.date"))
    matchs = found.select(
        F.col("m.ext_rencontreId").alias("ext_rencontre_id"), "ext_poule_id", F.col("dom").alias("ext_equipe_dom_id"), F.col("ext").alias("ext_equipe_ext_id"), F.when(moment.try_cast("timestamp").isNotNull(), moment).alias("date_heure"),
        F.col("j.date_debut").alias("journee_date_debut"), F.col("j.date_fin").alias("journee_date_fin"), coerce.prefix_int(F.col("m.equipe1Score")).alias("score_dom"), coerce.prefix_int(F.col("m.equipe2Score")).alias("score_ext"),
        coerce.prefix_int(F.col("m.equipe1ScoreMT")).alias("score_mt_dom"), coerce.prefix_int(F.col("m.equipe2ScoreMT")).alias("score_mt_ext"), forfeit(F.col("m.equipe1Score")).alias("forfait_dom"), forfeit(F.col("m.equipe2Score")).alias("forfait_ext"),
        F.trim("m.journeeNumero").try_cast("int").alias("journee"), F.col("m.equipementId").alias("equipement_id"), F.col("m.fdmCode").alias("fdm_code"), F.col("m.arbitre1Id").alias("arbitre1_id"), F.col("m.arbitre1").alias("arbitre1_nom"),
        F.col("m.arbitre2Id").alias("arbitre2_id"), F.col("m.arbitre2").alias("arbitre2_nom"), F.col("url").alias("source_url"),
    )
    good, bad = checked(
        matchs, ext_rencontre_id=_given(F.col("ext_rencontre_id")), date_heure=_fits(F.col("date_heure"), _MOMENT) & (F.col("date_heure").isNotNull() | _given(F.col("journee_date_debut"))),
        journee_date_debut=_fits(F.col("journee_date_debut"), _DAY), journee_date_fin=_fits(F.col("journee_date_fin"), _DAY), journee=F.col("journee") > 0, source_url=F.col("source_url").rlike(_URL),
    )
    return {"matchs": good, "rejets": bad, "journees": journees, "equipes": _first_teams(options), "engagements": options.select("ext_equipe_id", "ext_poule_id").distinct()}


#: A ranking's fields and their columns.
_RANKING = {"position": "place", "points": "point", "joues": "joue", "gagnes": "gagne", "nuls": "nul", "perdus": "perdu", "buts_pour": "butPlus", "buts_contre": "butMoins"}


def ranking(pages: DataFrame, selector: str = SELECTOR, name: str = RANKING) -> dict[str, DataFrame]:
    """lignes and rejets of the rankings of poule pages (url, ext_poule_id, html).

    A line's team is found by its inner id among the page's teams; lines of unknown teams are left out.  All eight
    numbers and the line's id are needed: a line without one is rejected.
    """
    fields = ", ".join(f"{c}: STRING" for c in ("ext_classementId", "equipeId", "dernieresRencontres", *_RANKING.values()))
    rows = _parsed(pages, "url", "ext_poule_id", s=(selector, _SELECTOR), c=(name, f"classements ARRAY<STRUCT<{fields}>>")).filter("s IS NOT NULL")
    placed = coerce.let(_outer_ids(F.col("s.equipe_options")), lambda ids: F.transform("c.classements", lambda c: F.struct(c.alias("c"), F.try_element_at(ids, c["equipeId"]).alias("team"))))
    found = rows.select("url", "ext_poule_id", F.explode(placed).alias("p")).filter("p.team IS NOT NULL")
    lines = found.select(
        F.col("p.c.ext_classementId").alias("ext_classement_id"), "ext_poule_id", F.col("p.team").alias("ext_equipe_id"), *[coerce.prefix_int(F.col(f"p.c.{c}")).alias(n) for n, c in _RANKING.items()],
        F.col("p.c.dernieresRencontres").alias("dernieres_rencontres"), F.col("url").alias("source_url"),
    )
    good, bad = checked(lines, ext_classement_id=_given(F.col("ext_classement_id")), ext_poule_id=_given(F.col("ext_poule_id")), **{n: F.col(n).isNotNull() for n in _RANKING}, source_url=F.col("source_url").rlike(_URL))
    return {"lignes": good, "rejets": bad}


def table_rows(pages: DataFrame, name: str = STATISTICS, selector: str = SELECTOR, header: str = HEADER) -> DataFrame:
    """(ext_poule_id, ext_equipe_id, row): the rowsData of a component as JSON objects, with the team found by its label; pages marked as missing give none."""
    rows = _parsed(pages, "ext_poule_id", h=(header, "is404 BOOLEAN"), s=(selector, _SELECTOR), d=(name, "rowsData ARRAY<STRING>")).filter("NOT coalesce(h.is404, false)")
    known = F.filter(F.coalesce("s.equipe_options", F.array().cast(f"array<{_TEAM}>")), lambda o: (F.trim(o["libelle"]) != "") & (o["ext_equipeId"] != ""))
    labels = _last_wins(F.transform(known, lambda o: F.struct(F.trim(o["libelle"]).alias("key"), o["ext_equipeId"].alias("value"))))
    team = lambda ids, row: F.try_element_at(ids, F.trim(F.get_json_object(row, "$.equipeLibelle")))
    placed = coerce.let(labels, lambda ids: F.transform("d.rowsData", lambda row: F.struct(team(ids, row).alias("ext_equipe_id"), row.alias("row"))))
    return rows.select("ext_poule_id", F.explode(placed).alias("p")).select("ext_poule_id", "p.ext_equipe_id", "p.row")


def player_statistics(pages: DataFrame, name: str = STATISTICS, selector: str = SELECTOR, header: str = HEADER) -> dict[str, DataFrame]:
    """lignes and rejets of the player statistics of poule pages: all texts are needed, and three whole numbers that aren't negative."""
    texts = {"individu_id": "individuId", "nom": "nom", "prenom": "prenom", "equipe_libelle": "equipeLibelle"}
    numbers = {"match_count": "matchCount", "total_buts": "totalButs", "total_arrets": "totalArrets"}
    rows = table_rows(pages, name, selector, header).withColumn("r", F.from_json("row", ", ".join(f"{c} STRING" for c in (*texts.values(), *numbers.values()))))
    lines = rows.select("ext_poule_id", *[F.col(f"r.{c}").alias(n) for n, c in texts.items()], "ext_equipe_id", *[coerce.prefix_int(F.col(f"r.{c}")).alias(n) for n, c in numbers.items()])
    good, bad = checked(lines, **{n: _given(F.col(n)) for n in texts}, **{n: F.col(n) >= 0 for n in numbers})
    return {"lignes": good, "rejets": bad}
