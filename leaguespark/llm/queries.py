"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguespark.llm import decontaminate, exact_dedup, langid, mixing, ngram_join, pii, prefix_trie, quality, rule_ledger, runs, secrets, toxicity, url_lists
from leaguespark.llm.common import crc_mod, read, stash


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = decontaminate.find_hits(docs, read(spark, sf_dir, "benchmark"))
    # Ranges are disjoint: starts and ends alternate, so n_hit is the alternating sum.
    n_hit = F.aggregate("__hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("sign")), lambda a, x: F.struct((a["n"] + x * a["sign"]).alias("n"), (-a["sign"]).alias("sign")), lambda a: a["n"])
    return hits.select("doc_id", F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("__item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("__item_ids", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


#: A small dated list, for the hosts of the driver's pages.
URL_ENTRIES = (
    ("gambling", "casino-win.example.com", True, "add", "2024-01-15 00:00:00"),
    ("gambling", "casino-win.example.com", True, "remove", "2024-04-01 00:00:00"),
    ("gambling", "casino-win.example.com", True, "add", "2024-07-10 12:00:00"),
    ("gambling", "free-bets.example.com", True, "add", "2024-03-01 00:00:00"),
    ("ads", "ads-track.example.com", True, "add", "2023-06-01 00:00:00"),
    ("ads", "ads-track.example.com", True, "add", "2024-02-01 00:00:00"),
    ("ads", "ads-track.example.com", True, "remove", "2024-11-01 00:00:00"),
    ("spam", "spam-farm.example.com", True, "add", "2024-05-05 05:05:00"),
    ("spam", "cheap-pills.example.com", True, "add", "2024-01-01 00:00:00"),
    ("spam", "cheap-pills.example.com", True, "remove", "2024-01-01 00:00:00"),
    ("spam", "cheap-pills.example.com", True, "add", "2024-08-20 00:00:00"),
    ("adult", "adult-x.example.net", True, "add", "2024-02-29 00:00:00"),
    ("outage", "example.net", True, "add", "2024-09-01 00:00:00"),
    ("outage", "example.net", True, "remove", "2024-09-08 00:00:00"),
    ("trusted", "tionsh.example.net", False, "add", "2024-09-03 00:00:00"),
    ("trusted", "tiontion.example.net", False, "add", "2024-01-01 00:00:00"),
    ("trusted", "tiontion.example.net", False, "remove", "2024-09-05 00:00:00"),
)

_ENTRIES_SQL = ", ".join(f"('{name}', '{host}', {blocks}, '{action}', TIMESTAMP '{at}')" for name, host, blocks, action, at in URL_ENTRIES)

OP2_SQL = rf"""
WITH entries(list, host, blocks, action, since) AS (VALUES {_ENTRIES_SQL}),
settled AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY list, host, blocks ORDER BY since, action) AS later FROM entries) WHERE later IS NULL OR later <> since),
turned AS (SELECT * FROM (SELECT *, lag(action) OVER (PARTITION BY list, host, blocks ORDER BY since) AS before FROM settled) WHERE before IS NULL OR before <> action),
valid AS (SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY list, host, blocks ORDER BY since) AS until FROM turned) WHERE action = 'add'),
captures AS (
  SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1), '\.+$', ''), '') AS host,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id * 7919 % 527040) AS fetched_at
  FROM pages),
active AS (
  SELECT c.page_id, v.list, v.blocks, length(v.host) AS reach FROM captures c
  JOIN valid v ON (c.host = v.host OR ends_with(c.host, '.' || v.host)) AND c.fetched_at >= v.since AND (v.until IS NULL OR c.fetched_at < v.until)),
judged AS (
  SELECT page_id, count(DISTINCT list) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         coalesce(max(reach) FILTER (blocks), 0) > coalesce(max(reach) FILTER (NOT blocks), 0) AS blocked
  FROM active GROUP BY page_id)
SELECT c.page_id, c.host, strftime(c.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, CAST(coalesce(j.n, 0) AS BIGINT) AS n_lists,
       coalesce(j.lists, '') AS lists, coalesce(j.blocked, false) AS blocked
FROM captures c LEFT JOIN judged j USING (page_id)
"""


def url_entries(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(URL_ENTRIES), "list string, host string, blocks boolean, action string, at string")
    return rows.withColumn("at", F.to_timestamp("at"))


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages carry no fetch time; one is derived from the page id, over the year 2024."""
    minutes = F.col("page_id") * 7919 % 527040
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.timestamp_add("MINUTE", minutes.cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("fetched_at"))
    judged = url_lists.judge(pages, url_entries(spark))
    return judged.select("page_id", F.col("__host").alias("host"), F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"), F.size("__active").cast("long").alias("n_lists"), F.array_join("__active", ",").alias("lists"), F.col("__blocked").alias("blocked"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    models = langid.fit(docs.filter(~held_out))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    found = langid.identify(rows, models)
    return found.select("doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"), F.col("__entropy").alias("cross_entropy"), F.col("__rejected").alias("rejected"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = F.col("__secrets")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda x: x["kind"].isin("assign", "access", "hex"))
    found = secrets.scan(docs).select("doc_id", "__secrets")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def _labels(spark: SparkSession, sf_dir: str, column: str) -> DataFrame:
    """(label_id, label) of the rows that may be learned from; a repeated id is one row."""
    rows = read(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0)
    return rows.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(column).alias("label"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = toxicity.with_keys(docs)
    model = toxicity.fit(keyed.select("doc_id", "__h1", "__h2").join(_labels(spark, sf_dir, "toxic"), F.col("doc_id") == F.col("label_id")), keyed)
    scored = toxicity.score(docs.withColumn("held_out", crc_mod("doc_id", 5) == 0), model)
    return scored.select("doc_id", "held_out", F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = stash(quality.with_statistics(docs.withColumn("held_out", crc_mod("doc_id", 5) == 0)))
    model = quality.fit(measured.join(_labels(spark, sf_dir, "quality"), F.col("doc_id") == F.col("label_id")))
    scored = quality.score(measured, model)
    return scored.select("doc_id", "held_out", F.col("__score").alias("score"), (F.col("__score") >= 0.3).cast("int").alias("predicted"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    likely = (F.size(F.filter("base", lambda x: x["likely"])) + F.size("added")).cast("long")
    spans = F.array_join(F.concat(F.transform("base", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), F.transform("added", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))), ",")
    return found.select("doc_id", *[count(kind) for kind in pii.BASE_KINDS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), spans.alias("spans"), likely.alias("n_likely"))


def _planted(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by a hash of their ids, with a period written into the words from some place on."""
    words = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.transform("w", lambda _, i: F.get(F.col("w"), at(i))), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(_planted(read(spark, sf_dir, "documents")))
    best = F.array_min(F.transform("__runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("__runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.withColumn("best", best)
    length, period = -F.col("best.length"), F.col("best.period")
    return rows.select("doc_id", F.size("__runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), period.alias("period"), F.floor(length * 1000 / period).alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("__collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    judged = rule_ledger.judge(rule_ledger.ledger(docs))
    named = [F.col(f"__{m}").alias(m if m == "word_chars" else f"n_{m}") for m in ("words", "word_chars", "symbols", "dup_lines", "repeat_words")]
    return judged.select("doc_id", *named, (F.col("__failed").bitwiseAND(rule_ledger.BASE) != 0).alias("base_failed"), F.col("__kept").alias("kept"), F.col("__failed").alias("failed_bits"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_url_lists": op2_url_lists,
    "op3_language_id": op3_language_id,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_ngram_join": op8_ngram_join,
    "op9_quality": op9_quality,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_rule_ledger": op12_rule_ledger,
    "op13_conversation_trie": op13_conversation_trie,
}

OP1_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
cut AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words FROM cut),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT d.doc_id, s.n, d.w, unnest(generate_series(1, len(d.w) - s.n + 1)) AS p FROM doc d, sizes s WHERE len(d.w) >= s.n),
found AS (SELECT DISTINCT q.doc_id, q.p, q.n, win.item_id FROM (SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS words FROM places) q JOIN win ON win.n = q.n AND win.words = q.words),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hit h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, CAST(count(*) OVER (PARTITION BY t) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

OP8_SQL = r"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
cut AS (SELECT doc_id, w, least(len(w), 5) AS n, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM doc WHERE len(w) > 0),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s FROM cut),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair p JOIN size a ON a.doc_id = p.x JOIN size b ON b.doc_id = p.y WHERE 100 * common >= 80 * (a.n + b.n - common)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM doc UNION SELECT r.a, e.y FROM reach r JOIN edge e ON e.x = r.b)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM doc d LEFT JOIN size s USING (doc_id) JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id, s.n
"""

def _digits(key: str, table: str) -> str:
    """DuckDB has no crc32: a recursive query that takes it bit by bit over the decimal key."""
    return f"""digits({key}, rest, k, c) AS (
  SELECT DISTINCT {key}, CAST({key} AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM {table}
  UNION ALL
  SELECT {key}, CASE WHEN k = 0 THEN substr(rest, 2) ELSE rest END, (k + 1) % 8,
         CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END
  FROM (SELECT *, CASE WHEN k = 0 THEN xor(c, CAST(ascii(rest) AS BIGINT)) ELSE c END AS v FROM digits WHERE rest <> '' OR k > 0)),
crcs AS (SELECT {key}, xor(c, CAST(4294967295 AS BIGINT)) AS crc FROM digits WHERE rest = '' AND k = 0)"""


OP11_SQL = rf"""
WITH RECURSIVE {_digits("doc_id", "documents")},
read AS (SELECT doc_id, crc % 10 = 0 AS planted, crc // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents JOIN crcs USING (doc_id)),
period AS (SELECT *, CASE WHEN planted AND len(w) > 0 THEN g % len(w) END AS a, len(w) AS n FROM read),
doc AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS w
  FROM period),
word AS (SELECT doc_id, n, unnest(generate_series(0, n - 1)) AS i, unnest(w) AS word FROM doc),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT doc_id, q, min(i) AS s, min(i) + count(*) + q AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(12, 2 * q)),
run AS (SELECT doc_id, s, e - s AS length, min(q) AS q FROM stretch GROUP BY doc_id, s, e),
best AS (SELECT doc_id, count(*) AS n_runs, arg_min([s, length, q], [-length, s, q]) AS b, string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s + q, s + length - 1)) AS i FROM run),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b[1] AS start, b[2] AS length, b[3] AS period, 1000 * b[2] // b[3] AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM doc d LEFT JOIN best USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
cut AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS words FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, words) AS n FROM cut) WHERE n > 1),
inside AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest(generate_series(0, 7)) AS k) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, length(regexp_replace(t, '[^!]', '', 'g')) AS shouts
  FROM d LEFT JOIN inside USING (doc_id)),
bits AS (
  SELECT *, CAST(n_words < 20 AS BIGINT) + 2 * CAST(100 * n_repeat_words > 30 * n_words AS BIGINT) + 4 * CAST(word_chars > 15 * n_words AS BIGINT) + 8 * CAST(5 * n_symbols > n_words AS BIGINT)
         + 16 * CAST(100 * n_dup_lines > 30 * n_lines AS BIGINT) + 32 * CAST(5 * shouts > n_words AS BIGINT) + 64 * CAST(2 * capitals > word_chars AS BIGINT) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed,
       failed & 43 = 0 AND bit_count(failed & 84) < 2 AS kept, failed AS failed_bits
FROM bits
"""

OP13_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS i, d, b
  FROM (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL)),
{_digits('conv_id', 't')},
heads AS (SELECT conv_id, crc % 9 AS h FROM crcs),
turns AS (
  SELECT x.conv_id, t.i, t.d, t.b FROM heads x JOIN t ON t.conv_id = x.conv_id - x.conv_id % 5 AND t.i <= x.h
  UNION ALL
  SELECT x.conv_id, t.i, t.d, t.b FROM heads x JOIN t ON t.conv_id = x.conv_id AND t.i > x.h),
rebuilt AS (SELECT x.conv_id, coalesce(list(u.d ORDER BY u.i) FILTER (u.d IS NOT NULL), []) AS path, coalesce(list(u.b ORDER BY u.i) FILTER (u.d IS NOT NULL), []) AS sizes FROM heads x LEFT JOIN turns u USING (conv_id) GROUP BY x.conv_id),
member AS (SELECT conv_id, path, sizes, unnest(generate_series(0, len(path))) AS depth FROM rebuilt),
node AS (
  SELECT path[:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(coalesce(sizes[depth], 0)) AS b,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends
  FROM member GROUP BY 1, 2),
family AS (SELECT prefix[:depth - 1] AS prefix, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN family USING (prefix)),
above AS (SELECT unnest(generate_series(0, depth)) AS up, * FROM full_node),
subtree AS (SELECT prefix[:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(CASE WHEN depth = 0 THEN 0 ELSE (n - 1) * b END) AS saved FROM above GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN subtree s USING (prefix) LEFT JOIN node p ON f.depth > 0 AND p.prefix = f.prefix[:f.depth - 1]
"""

#: SQL where it can express an operator; the others are tested against brute force or held-out labels.
ORACLES: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op2_url_lists": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op8_ngram_join": OP8_SQL, "op11_periodic_runs": OP11_SQL, "op12_rule_ledger": OP12_SQL, "op13_conversation_trie": OP13_SQL}
