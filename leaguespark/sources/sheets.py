"""Match sheets from their extracted text: header, officials, columns of positioned fragments and play by play."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.functions import coerce, dates, text

#: What an action's word means.
ACTIONS = (
    ("(?i)^But$", "but"), ("(?i)^Tir$", "tir"), ("(?i)^Arr[eê]t$", "arret"), ("(?i)^Avertissement$", "avertissement"),
    (r"(?i)^2MN$|2\s*Minutes?", "exclusion_2min"), ("(?i)Disqualification", "disqualification"), ("(?i)Commotion", "protocole_commotion"),
)
#: Forms of a clock line and of who acted.
_CLOCK = r"^(\d{1,2}:\d{2})\s+(\d+)\s*-\s*(\d+)(.*)$"
#: What is trimmed from lines; ``_SPACES`` are those of ``text.SPACES``.
_BLANKS = " \t\n\x0b\f\r"
_SPACES = _BLANKS + "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_ACTOR = r"^(.+?)\s+(J|O)([RV])(?:\s+N°(\d+))?\s+(.+)$"


def text_pages(files: DataFrame) -> DataFrame:
    """(fdm_code, page, text): the pages of extracted texts (path, content), cut at form feeds and counted from 1.

    The code is the file's name without its ending; an empty text is one empty page, a null one none.
    """
    code = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    return files.select(code.alias("fdm_code"), F.posexplode(F.split(F.decode("content", "UTF-8"), "\f")).alias("page", "text")).withColumn("page", F.col("page") + 1)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The text pages of all ``.txt`` files below a folder; Spark reads no empty files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(path)
    return text_pages(found.select("path", "content"))


def _numbered(page: Column) -> Column:
    """array<struct<at, line>>: the trimmed lines of a text with their numbers from 0, without empty ones."""
    trimmed = F.transform(F.split(page, "\n"), lambda line, at: F.struct(at.alias("at"), F.btrim(line, F.lit(_BLANKS)).alias("line")))
    return F.filter(trimmed, lambda x: x["line"] != "")


def lines(sheets: DataFrame) -> DataFrame:
    """(fdm_code, at, line): trimmed lines of (fdm_code, text), without empty ones."""
    return sheets.select("fdm_code", F.inline(_numbered(F.col("text"))))


def _once(rows: DataFrame, kept: list[str], **values: Column) -> DataFrame:
    """The kept columns and the values, which are computed once a row: filters and projections on a generator's rows stay above it."""
    return rows.select(*kept, F.inline(F.array(F.struct(*[value.alias(name) for name, value in values.items()]))))


def _page_lines(page: Column) -> Column:
    trimmed = F.transform(F.split(page, "\n"), lambda line: F.btrim(line, F.lit(_SPACES)))
    return F.filter(trimmed, lambda line: line != "")


def _first(lines_: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(lines_, test), F.lit(0))


def _place(lines_: Column, test: Callable[[Column], Column]) -> Column:
    """The number of the first line that fits, from 0; null without one."""
    return F.nullif(F.array_position(F.transform(lines_, test), F.lit(True)), F.lit(0)).cast("int") - 1


#: Forms of the header's lines.
_ORGANISER = r"Organisateur\s+(.+?)\s*\((\d+)\)"
_COMPETITION = r"^Comp[eé]tition\s+\S+\s+"
_GROUP = r"^(.+?)\s+Groupe\s+(.+)$"
_TEAMS = r"^(.+?)\s*/\s*(.+?)\s+(\d+)\s+(\d+)\s*$"
_DATE_LINE = r"^DATE:|^Date\s+\S+\s+\d{2}/\d{2}/\d{4}"
_DATE = r"^(?:DATE:|Date)\s*(.+?)(?:\s+Journ[eé]e|$)"
_ROUND = r"J\d+\s+du\s+[\d/]+\s+au\s+[\d/]+"
_HALL = r"SALLE:\s*(.+?)(?:\n|$)"
_STATUS = r"Statut Match\s*:\s*(\w+)"
_SCORES = r"^\d+\s+\d+(\s+\d+)*$"

HEADER_FIELDS = (
    "organisateur", "organisateur_code", "competition_libelle", "groupe", "poule_libelle", "equipe_recevant_libelle", "equipe_visiteur_libelle", "date_heure_str", "journee_libelle",
    "salle_libelle", "salle_adresse", "score_recevant", "score_visiteur", "score_mi_temps_recevant", "score_mi_temps_visiteur", "statut_match",
)


def header(sheets: DataFrame, **more: Column) -> DataFrame:
    """(fdm_code, HEADER_FIELDS, more of the text) from first pages (fdm_code, text); sheets without the line of teams and score are left out.

    Lines are addressed by what they start with and by their neighbours.  Two layouts are read: one with ``DATE:`` and
    ``SALLE:`` lines, one that has the date, the round and the hall in one line and the group in a line below the
    poule's.  A field that a sheet lacks is null, a missing date the empty text.
    """
    rows = _once(sheets, ["fdm_code", "text"], l=_page_lines(F.col("text")))
    l, page = F.col("l"), F.col("text")
    organiser = _first(l, lambda x: x.startswith("Organisateur"))
    competition = _first(l, lambda x: x.startswith("Compétition") | x.startswith("Competition"))
    group = _first(l, lambda x: x.contains("Groupe") & ~x.contains("Code Renc") & ~x.startswith("Organisateur") & ~x.startswith("Compétition"))
    rows = _once(rows, ["fdm_code", "text", "l"], teams=_first(l, lambda x: x.contains(" / ") & x.rlike(r"\d+\s+\d+\s*$"))).filter(F.col("teams").rlike(_TEAMS))
    detail = F.when(page.contains("DETAIL"), F.substring(page, F.instr(page, "DETAIL"), F.length(page)))
    rows = _once(
        rows, ["fdm_code", "text", "l", "teams"], organiser=organiser, competition=competition, group=group, group_at=_place(l, lambda x: x.rlike(r"^Groupe\s+\S+")),
        date_at=_place(l, lambda x: x.rlike(_DATE_LINE)), hall_at=_place(l, lambda x: x.contains("SALLE:")),
        scores=_first(_page_lines(detail), lambda x: x.rlike(_SCORES)),
    ).withColumn("date", F.get("l", "date_at"))
    found = lambda column, pattern, i=1: F.trim(text.first_group(F.col(column), pattern, i))
    line = lambda at: F.get("l", F.col(at))
    hall = F.trim(text.first_group(page, _HALL))
    own_hall = found("date", r"\sSalle\s+(.+)$")
    address = F.when(F.col("hall_at") + 1 < F.size("l"), F.get("l", F.col("hall_at") + 1)).when(own_hall.isNotNull(), F.get("l", F.col("date_at") + 1))
    scores = F.split("scores", r"\s+")
    return rows.select(
        "fdm_code", found("organiser", _ORGANISER).alias("organisateur"), found("organiser", _ORGANISER, 2).alias("organisateur_code"), F.trim(F.regexp_replace("competition", _COMPETITION, "")).alias("competition_libelle"),
        F.coalesce(found("group", _GROUP, 2), F.trim(F.regexp_replace(line("group_at"), r"^Groupe\s+", ""))).alias("groupe"), F.coalesce(found("group", _GROUP), F.when(F.col("group_at") > 0, F.get("l", F.col("group_at") - 1))).alias("poule_libelle"),
        found("teams", _TEAMS).alias("equipe_recevant_libelle"), found("teams", _TEAMS, 2).alias("equipe_visiteur_libelle"), F.coalesce(found("date", _DATE), F.lit("")).alias("date_heure_str"),
        F.coalesce(F.nullif(F.regexp_extract("text", f"({_ROUND})", 1), F.lit("")), text.first_group(F.col("date"), r"Journ[eé]e\s+(J\d+)")).alias("journee_libelle"),
        F.coalesce(F.trim(F.regexp_replace(hall, r"^\d+\s*-\s*", "")), own_hall).alias("salle_libelle"), address.alias("salle_adresse"), found("teams", _TEAMS, 3).try_cast("int").alias("score_recevant"), found("teams", _TEAMS, 4).try_cast("int").alias("score_visiteur"),
        F.get(scores, F.lit(0)).try_cast("int").alias("score_mi_temps_recevant"), F.get(scores, F.lit(1)).try_cast("int").alias("score_mi_temps_visiteur"), text.first_group(page, _STATUS).alias("statut_match"),
        *[value.alias(name) for name, value in more.items()],
    )


#: Labels of the table's officials, in this order, and their roles.
OFFICIALS = (
    ("Juge Arbitre 1", "juge_arbitre_1"), ("Juge Arbitre 2", "juge_arbitre_2"), ("Juge Délégué", "juge_delegue"), ("Délégué Officiel", "delegue_officiel"), ("Tuteur de Table", "tuteur_table"),
    ("Responsable de Salle", "responsable_salle"), ("Responsable de", "responsable_salle"), ("Resp. de salle", "responsable_salle"), ("Juge accomp.", "accompagnateur"), ("Chronométreur", "chronometreur"),
    ("Secrétaire", "secretaire"), ("Accompagnateur", "accompagnateur"), ("Délégué", "delegue"), ("Speaker", "speaker"), ("Juge", "juge"),
)
#: A person behind a label: names in capitals, a first name, a licence.
_PERSON = r"\s+((?:[A-ZÀ-ÖØ-Ý][A-ZÀ-ÖØ-Ý'\-]+\s+)+)([A-Za-zÀ-ÿ][a-zA-ZÀ-ÿ'\-]*)\s+(\d{10,13})"


def _officials_behind(page: Column, label: str, role: str) -> Column:
    pattern = f"(?iu:{label.replace('.', '[.]')}){_PERSON}"
    part = lambda hit, i: F.regexp_replace(F.regexp_extract(hit, pattern, i), r"\s+$", "")
    person = lambda hit: F.struct(F.lit(role).alias("role"), F.lit("neutre").alias("cote"), part(hit, 1).alias("nom"), part(hit, 2).alias("prenom"), part(hit, 3).alias("numero_licence"))
    return F.transform(F.coalesce(F.regexp_extract_all(page, F.lit(pattern), F.lit(0)), F.array().cast("array<string>")), person)


def officials_of(page: Column) -> Column:
    """array<struct<role, cote, nom, prenom, numero_licence>> of a first page, by label and then place; each (role, nom) counts once, the first time."""
    # Letters are folded as the expressions' flags do it; an expression only runs over pages that hold its label.
    fold = lambda x: F.lower(F.upper(F.translate(x, "\u0130", "I")))
    none = F.array().cast("array<struct<role:string,cote:string,nom:string,prenom:string,numero_licence:string>>")
    behind = lambda folded: F.concat(*[F.when(folded.contains(label.lower()), _officials_behind(page, label, role)).otherwise(none) for label, role in OFFICIALS])
    listed = coerce.let(fold(page), behind)
    new = lambda people, x, i: ~F.exists(F.slice(people, F.lit(1), i), lambda y: (y["role"] == x["role"]) & (y["nom"] == x["nom"]))
    return coerce.let(listed, lambda people: F.filter(people, lambda x, i: new(people, x, i)))


def officials(sheets: DataFrame) -> DataFrame:
    """(fdm_code, ordre, role, cote, nom, prenom, numero_licence): the table's officials from first pages (fdm_code, text)."""
    return sheets.select("fdm_code", F.posexplode(officials_of(F.col("text"))).alias("ordre", "o")).select("fdm_code", "ordre", "o.*")


def nearest_columns(fragments: DataFrame, headers: DataFrame) -> DataFrame:
    """(page, fragment, column): each fragment (page, fragment, x) with the header (page, column, center) nearest to it; ties to the left.

    A page has a few headers, which go to its fragments as one array.
    """
    own = headers.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("center", "column"))).alias("columns"))
    distance = lambda h: F.struct(F.abs(h["center"] - F.col("x")).alias("d"), h["center"].alias("c"), h["column"].alias("column"))
    return fragments.join(own, "page").select("page", "fragment", F.array_min(F.transform("columns", distance))["column"].alias("column"))


def _kind(word: Column) -> Column:
    out = F.lit("autre")
    for pattern, kind in reversed(ACTIONS):
        out = F.when(word.rlike(pattern), kind).otherwise(out)
    return out


def actions(sheets: DataFrame) -> DataFrame:
    """(fdm_code, ordre, periode, temps_seconds, score_recevant, score_visiteur, type_action, cote, numero_maillot, acteur_role, description_brute).

    The period is carried on from its heading; where a clock line has no description, the next line is it.
    """
    rows = _once(sheets, ["fdm_code"], l=F.transform(_numbered(F.col("text")), lambda x: x["line"]))
    l = F.col("l")
    # A cast that fails costs an exception, so only what has matched is cast.
    heading = lambda line: F.nullif(F.regexp_extract(line, r"(?i)^PERIODE\s+([1-4])$", 1), F.lit("")).cast("int")
    marks = F.filter(F.transform(l, lambda line, i: F.struct(i.alias("at"), heading(line).alias("periode"))), lambda m: m["periode"].isNotNull())
    own = lambda line: F.when(line.rlike(_CLOCK), F.trim(F.regexp_replace(F.regexp_extract(line, _CLOCK, 4), r"^\s+", "")))
    # A sheet is one row, so its lines see their neighbours without being dealt out and sorted.
    rows = _once(rows, ["fdm_code", "l"], marks=marks, own=F.transform(l, own))
    period = lambda i: F.coalesce(F.try_element_at(F.filter("marks", lambda m: m["at"] <= i), F.lit(-1))["periode"], F.lit(1))
    # A line that the one before took as its description is no clock line of its own.
    taken = lambda i: (i > 0) & (F.get("own", i - 1) == "")
    told = F.transform("own", lambda x, i: F.when(x.isNotNull() & ~F.coalesce(taken(i), F.lit(False)), F.struct(F.get("l", i).alias("line"), period(i).alias("periode"), F.coalesce(F.nullif(x, F.lit("")), F.get("l", i + 1)).alias("d"))))
    rows = rows.select("fdm_code", F.posexplode(F.filter(told, lambda x: x["d"] != "")).alias("ordre", "a")).select("fdm_code", "ordre", "a.*")
    said = lambda i: F.nullif(F.regexp_extract("d", _ACTOR, i), F.lit(""))
    rows = _once(rows, rows.columns, home=F.col("d").rlike("(?i)Temps Mort.*Recevant"), away=F.col("d").rlike("(?i)Temps Mort.*Visiteur"), word=F.trim(said(1)), who=said(2), team=said(3), shirt=said(4))
    pause = lambda side: F.col({"Recevant": "home", "Visiteur": "away"}[side])
    actor = lambda i: F.col(("word", "who", "team", "shirt")[i - 1])
    part = lambda i: F.regexp_extract("line", _CLOCK, i)
    side = F.when(pause("Recevant") | (~pause("Visiteur") & (actor(3) == "R")), "recevant").when(pause("Visiteur") | (actor(3) == "V"), "visiteur")
    kind = F.when(pause("Recevant"), "temps_mort_recevant").when(pause("Visiteur"), "temps_mort_visiteur").when(actor(1).isNull(), "autre").otherwise(_kind(actor(1)))
    return rows.select(
        "fdm_code", "ordre", "periode", dates.seconds(part(1)).alias("temps_seconds"), part(2).try_cast("int").alias("score_recevant"), part(3).try_cast("int").alias("score_visiteur"),
        kind.alias("type_action"), side.alias("cote"), F.when(~pause("Recevant") & ~pause("Visiteur"), actor(4).try_cast("int")).alias("numero_maillot"),
        F.when(~pause("Recevant") & ~pause("Visiteur"), F.when(actor(2) == "J", "joueur").when(actor(2) == "O", "officiel")).alias("acteur_role"), F.col("d").alias("description_brute"),
    )


#: Lines of a section that are no player's.
_NO_PLAYER = r"^(Club |Capt|N°|Officiel|Kiné|Médecin)|^\d{7}\s*$|^Club$"


def sections(sheets: DataFrame) -> DataFrame:
    """(fdm_code, at, section, line): the lines of the home and the away line-up, without headings.

    A section starts at its first ``Club Recevant`` or ``Club Visiteur`` (or ``Club`` with the word on the next
    line) and ends at the other one or at ``DETAIL``.
    """
    rows = _once(sheets, ["fdm_code"], l=_numbered(F.col("text")))
    l = F.col("l")

    def mark(x: Column, i: Column) -> Column:
        line, found = x["line"], F.lit(None).cast("string")
        for word in ("recevant", "visiteur"):
            found = F.when(line.rlike(rf"(?i)club\s+{word}") | ((line == "Club") & (F.lower(F.get(l, i + 1)["line"]) == word)), word).otherwise(found)
        return F.struct(i.alias("i"), F.when(line.contains("DETAIL"), "").otherwise(found).alias("section"))

    rows = _once(rows, ["fdm_code", "l"], marks=F.filter(F.transform(l, mark), lambda m: m["section"].isNotNull()))
    section = lambda i: F.try_element_at(F.filter("marks", lambda m: m["i"] <= i), F.lit(-1))["section"]
    rows = rows.select("fdm_code", F.inline(F.transform(l, lambda x, i: F.struct(x["at"].alias("at"), section(i).alias("section"), x["line"].alias("line")))))
    inside = rows.filter("section <> '' AND lower(line) NOT IN ('recevant', 'visiteur')").filter(~F.col("line").rlike(_NO_PLAYER))
    return inside.select("fdm_code", "at", "section", "line")


#: Headings of the statistics columns; the last two are seen, so that their values go to no neighbour, and not used.
STAT_HEADERS = {"Buts": "buts", "7m": "7m", "Tirs": "tirs", "Arrets": "arrets", "Av.": "av", "2'": "2min", "Dis": "dis", "JFL": "ignore", "JIPES": "ignore"}
#: Forms of a player's line, of a licence and of the capitals at a name's start.
_PLAYER = r"^(\d+)\s+(.+?)\s+(\d{10,13})(?:\s+(?!X(?:\s|$))([A-Z]{1,3})(?=\s|$))?\s*(.*)$"
_LICENCE = r"^\d{10,13}$"
_CAPITALS = r"^((?:[A-ZÀ-ÖØ-Ý][A-ZÀ-ÖØ-Ý'\\-]*(?:\s+|$))*)(.*)$"


def stat_cells(fragments: DataFrame) -> DataFrame:
    """(fdm_code, numero_licence, cells): what stands under each heading in a licence's row, as a map, from (fdm_code, at, str, x, y, width).

    The headings of a licence are the lowest ones not below it; fragments of its row go to the heading with the
    nearest middle, the first one under a heading counts. Of a repeated licence the last row counts. Licences
    with no heading above are left out.
    """
    middle = lambda f: f["x"] + f["width"] / 2
    head = F.struct("at", "str", "x", "y", "width")
    headings = fragments.filter(F.col("str").isin(*STAT_HEADERS)).groupBy("fdm_code").agg(F.array_sort(F.collect_list(head)).alias("headings"))
    rows = fragments.filter(F.col("str").rlike(_LICENCE)).select("fdm_code", F.col("at").alias("row"), F.col("str").alias("numero_licence"), F.col("y").alias("row_y")).join(headings, "fdm_code")
    rows = rows.withColumn("headings", F.filter("headings", lambda h: h["y"] >= F.col("row_y"))).filter(F.size("headings") > 0)
    rows = rows.withColumn("lowest", F.array_min(F.transform("headings", lambda h: h["y"])))
    rows = rows.withColumn("headings", F.filter("headings", lambda h: F.abs(h["y"] - F.col("lowest")) < 2)).withColumn("left", F.array_min(F.transform("headings", lambda h: h["x"])) - 10)
    last = Window.partitionBy("fdm_code", "numero_licence").orderBy(F.desc("row"))
    rows = rows.withColumn("rank", F.row_number().over(last)).filter("rank = 1").drop("rank", "lowest")
    values = fragments.filter(~F.col("str").rlike(_LICENCE)).select("fdm_code", "at", "str", "x", "y", "width")
    near = (F.col("fdm_code") == F.col("of")) & (F.abs(F.col("y") - F.col("row_y")) < 3) & (F.col("x") >= F.col("left"))
    placed = rows.join(values.withColumnRenamed("fdm_code", "of"), near, "left")
    gap = lambda h: F.struct(F.abs(middle(h) - (F.col("x") + F.col("width") / 2)).alias("gap"), h["at"].alias("at"), h["str"].alias("name"))
    names = F.create_map(*[F.lit(x) for pair in STAT_HEADERS.items() for x in pair])
    placed = placed.withColumn("cell", names[F.array_min(F.transform("headings", gap))["name"]])
    first = placed.groupBy("fdm_code", "numero_licence", "cell").agg(F.min_by("str", "at").alias("value"))
    entry = F.when(F.col("value").isNotNull() & (F.col("cell") != "ignore"), F.struct("cell", "value"))
    return first.groupBy("fdm_code", "numero_licence").agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))


def _line_statistics(columns: Column) -> dict[str, Column]:
    """A player's statistics by the order of the line's tokens: numbers before the first X, then what follows it."""
    numbers = lambda tokens: F.filter(tokens, lambda c: c.rlike(r"^\d+$"))
    mark = F.array_position(columns, "X").cast("int")
    before = F.when(mark > 0, F.slice(columns, 1, F.greatest(mark - 1, F.lit(0)))).otherwise(columns)
    after = F.when(mark > 0, F.slice(columns, mark + 1, F.size(columns))).otherwise(F.array().cast("array<string>"))
    second = F.array_position(after, "X").cast("int")
    between = F.when(second > 0, F.slice(after, 1, F.greatest(second - 1, F.lit(0)))).otherwise(after)
    at = lambda i: F.get(numbers(before), F.lit(i)).try_cast("int")
    n = F.size(numbers(before))
    # "3/4" stands for seven-metre throws scored and tried; the last one counts.
    half = lambda i: F.filter(F.transform(F.filter(before, lambda c: c.contains("/")), lambda c: F.nullif(F.regexp_extract(c, r"^(\d*)[^/]*/(\d*)", i), F.lit("")).try_cast("int")), lambda v: v.isNotNull())
    return {
        "buts": at(0),
        "sept_metres_reussis": F.coalesce(F.try_element_at(half(1), F.lit(-1)), F.when(n >= 3, at(1))),
        "sept_metres_tentes": F.lit(None).cast("int"),
        "tirs": F.coalesce(F.try_element_at(half(2), F.lit(-1)), F.when(n == 2, at(1)).otherwise(at(2))),
        "arrets": at(3),
        "avertissement": mark > 0,
        "exclusions_2min": F.get(numbers(between), F.lit(0)).try_cast("int"),
        "disqualifie": second > 0,
    }


def _cell_statistics(cells: Column) -> dict[str, Column]:
    """A player's statistics by the cells under the headings."""
    number = lambda name: text.first_group(cells[name], r"^(\d+)$").try_cast("int")
    tried = cells["7m"].contains("/")
    half = lambda i: text.first_group(cells["7m"], r"^\s*(\d*)[^/]*/\s*(\d*)", i).try_cast("int")
    return {
        "buts": number("buts"),
        "sept_metres_reussis": F.when(tried, half(1)).otherwise(number("7m")),
        "sept_metres_tentes": F.when(tried, half(2)),
        "tirs": number("tirs"),
        "arrets": number("arrets"),
        "avertissement": F.coalesce(cells["av"] == "X", F.lit(False)),
        "exclusions_2min": number("2min"),
        "disqualifie": F.coalesce(cells["dis"] == "X", F.lit(False)),
    }


def players(sheets: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(fdm_code, section, at, numero_licence, nom, prenom, type_licence, numero_maillot, capitaine, gardien and the statistics).

    Lines of the line-ups that are no player's are left out. Statistics come from ``cells`` (as ``stat_cells`` gives
    them) where they hold the licence, else from the line's tokens. Capitals at the name's start are the family
    name; a part that is missing is ``?``. A keeper is who stopped a throw.
    """
    rows = sections(sheets).withColumn("capitaine", F.col("line").startswith("X ")).withColumn("line", F.trim(F.regexp_replace("line", r"^X ", "")))
    rows = rows.filter(F.col("line").rlike(_PLAYER))
    rows = _once(rows, ["fdm_code", "section", "at", "capitaine"], **{f"part{i}": F.regexp_extract("line", _PLAYER, i) for i in range(1, 6)})
    part = lambda i: F.col(f"part{i}")
    name = lambda i: F.coalesce(F.nullif(F.trim(F.regexp_replace(F.regexp_extract(part(2), _CAPITALS, i), r"\s+", " ")), F.lit("")), F.lit("?"))
    rows = rows.select(
        "fdm_code", "section", "at", part(3).alias("numero_licence"), name(1).alias("nom"), name(2).alias("prenom"), F.nullif(part(4), F.lit("")).alias("type_licence"),
        part(1).try_cast("int").alias("numero_maillot"), "capitaine", F.filter(F.split(part(5), r"\s+"), lambda c: c != "").alias("tokens"),
    )
    rows = _once(rows, [c for c in rows.columns if c != "tokens"], tokens=F.col("tokens"))
    found = _line_statistics(F.col("tokens"))
    if cells is not None:
        rows = rows.join(cells.select("fdm_code", "numero_licence", "cells"), ["fdm_code", "numero_licence"], "left")
        placed = _cell_statistics(F.col("cells"))
        found = {name: F.when(F.col("cells").isNotNull(), placed[name]).otherwise(value) for name, value in found.items()}
    keeper = (F.coalesce(found["arrets"], F.lit(0)) > 0).alias("gardien")
    kept = [c for c in rows.columns if c not in ("tokens", "cells")]
    return rows.select(*kept, keeper, *[value.alias(name) for name, value in found.items()])


def documents(pages: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """One nested row a sheet from its pages (fdm_code, page, text): the header, officiels, both line-ups and actions, each in order.

    The header, the officials and the line-ups stand on page 1, the actions on page 2.  Sheets without teams, or without
    a date, are no documents.  A line-up without players and a sheet without actions have empty lists.
    """
    first, second = (pages.filter(F.col("page") == n).select("fdm_code", "text") for n in (1, 2))
    valid = header(first, officiels=officials_of(F.col("text"))).filter("date_heure_str <> ''")
    named = players(first, cells)
    fields = [c for c in named.columns if c not in ("fdm_code", "at", "section")]
    side = lambda name: F.transform(F.array_sort(F.collect_list(F.when(F.col("section") == name, F.struct("at", F.struct(*fields).alias("p"))))), lambda x: x["p"]).alias(f"composition_{name}")
    lineups = named.groupBy("fdm_code").agg(side("recevant"), side("visiteur"))
    acts = actions(second)
    played = acts.groupBy("fdm_code").agg(F.array_sort(F.collect_list(F.struct(*[c for c in acts.columns if c != "fdm_code"]))).alias("actions"))
    found = valid.join(lineups, "fdm_code", "left").join(played, "fdm_code", "left")
    return found.withColumns({c: F.coalesce(c, F.array().cast(found.schema[c].dataType)) for c in ("composition_recevant", "composition_visiteur", "actions")})
