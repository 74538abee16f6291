"""Exact deduplication by content, safe under any skew, with built-in functions only.

Texts are equal when they are identical after each run of ASCII white space has
become one space; a null text counts as empty.  Equal rows are combined in three
stages, each of which groups by digest *and* full text, so a digest collision
never merges two texts:

1. local: the map side of the first aggregation leaves one row per text and task;
2. salted: those rows meet by (digest, salt), the salt being taken from the map
   task, so that the rows of one huge group are dealt over ``SALTS`` tasks;
3. global: at most ``SALTS`` winners a text meet by digest.

The decision then goes back to the rows by digest alone, which carries no texts
through the shuffle.  Only rows whose digest stands for several texts (a
collision) are joined by text as well.  A group that holds more than one in
``HOT_GROUPS`` of the rows is joined by broadcast; by counting, there are at most
``HOT_GROUPS`` of them, which bounds what is broadcast at any size of the input.

Defined cases: the row with the smallest doc_id stays (ties: every row that has
this doc_id reports it as keep_id, and ``deduplicate`` keeps one of them); a null
doc_id sorts after all others and stays only where there is no other; empty and null texts
form one group; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguespark.llm.common import SPACE, packed, stash

SALTS = 8
HOT_GROUPS = 10_000
#: Rows to drop (48 bytes each) that are broadcast; more are joined by shuffle.
BROADCAST_LOSERS = 500_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{SPACE}]+", " ")


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _first() -> Column:
    """Orders rows by doc_id, null last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"))


def text_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """(digest, text, keep_id, group_size), one row for each different normalised text."""
    rows = docs.select(_first().alias("first"), normalised(F.col("text")).alias("text"))
    rows = rows.select("first", "text", digest(F.col("text")).alias("digest"), (F.spark_partition_id() % SALTS).alias("salt"))
    salted = rows.groupBy("digest", "salt", "text").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "text").agg(F.min("first").alias("first"), F.sum("n").alias("group_size")).select("digest", "text", F.col("first.id").alias("keep_id"), "group_size")


def exact_groups(docs: DataFrame, digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest.

    ``digest`` maps the normalised text to a binary column; a weaker one changes
    the speed, never the result.
    """
    groups = text_groups(docs, digest)
    # Several texts under one digest: told apart by their text from here on.
    by_digest = stash(
        groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    )
    total = by_digest.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    hot_size = max(1000, total // HOT_GROUPS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    single = by_digest.filter("texts = 1").select(F.col("digest").alias("g_digest"), "keep_id", "group_size")
    hot = single.filter(F.col("group_size") > hot_size)
    rest = single.filter(F.col("group_size") <= hot_size)
    collided = by_digest.filter("texts > 1").select(F.col("digest").alias("g_digest"))
    out = ["doc_id", "keep_id", "group_size", "digest"]

    if hot.isEmpty():
        joined = rows.select("doc_id", "digest").join(rest, F.col("digest") == F.col("g_digest")).select(out)
    else:
        narrow = rows.select("doc_id", "digest").join(F.broadcast(hot), F.col("digest") == F.col("g_digest"), "left")
        narrow = stash(narrow.select("doc_id", "digest", "keep_id", "group_size"))
        done = narrow.filter("group_size IS NOT NULL").select(out)
        left = narrow.filter("group_size IS NULL").select("doc_id", "digest")
        joined = done.unionByName(left.join(rest, F.col("digest") == F.col("g_digest")).select(out))
    if not collided.isEmpty():
        texts = groups.join(collided, F.col("digest") == F.col("g_digest"), "left_semi")
        texts = texts.select(F.col("digest").alias("g_digest"), F.col("text").alias("g_text"), "keep_id", "group_size")
        by_text = rows.join(texts, (F.col("digest") == F.col("g_digest")) & (F.col("text") == F.col("g_text")))
        joined = joined.unionByName(by_text.select(out))
    return joined.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names: one for each different normalised text.

    The decisions are narrow rows; the documents are read once more and pass by
    them without a shuffle, as long as at most ``BROADCAST_LOSERS`` rows go.
    """
    decided = stash(exact_groups(docs).select("doc_id", "kept", "digest"))
    losers = decided.filter("NOT kept").select(F.col("doc_id").alias("lost"), F.col("digest").alias("lost_digest")).distinct()
    repeated = decided.filter("kept").groupBy(F.col("doc_id").alias("twice"), F.col("digest").alias("twice_digest")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    few = losers.limit(BROADCAST_LOSERS + 1).count() <= BROADCAST_LOSERS
    rows = packed(docs, id=F.col("doc_id").cast("long"), digest=sha256_digest(normalised(F.col("text"))))
    kept = rows.join(F.broadcast(losers) if few else losers, F.col("id").eqNullSafe(F.col("lost")) & (F.col("digest") == F.col("lost_digest")), "left_anti")
    if not repeated.isEmpty():  # rows that repeat both id and text
        again = F.col("id").eqNullSafe(F.col("twice")) & (F.col("digest") == F.col("twice_digest"))
        kept = kept.join(repeated, again, "left_anti").unionByName(kept.join(repeated, again, "left_semi").dropDuplicates(["id", "digest"]))
    return kept.select("row.*")
