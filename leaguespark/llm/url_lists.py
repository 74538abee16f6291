"""URL filters by a temporal join with dated lists.

A list entry says that, from a moment on, a host (and all hosts below it) is on a
list or off it.  Entries become validity intervals [from, until), and a capture is
judged by the intervals that hold its fetch time, so that a later listing does not
reach back and a lifted one ends.

The hosts of the captures are reduced to distinct ones first, so a host with a
third of all captures is one row.  Each host is joined with the intervals of its
own and its parent names (an equality join for each name, no range scan), and
carries them as an array, sorted by start; captures are joined with these by host
and take the entries that are active at their fetch time.  The table of listed
hosts is broadcast up to ``BROADCAST_HOSTS`` rows and ``BROADCAST_BYTES`` bytes; a
larger one is joined by shuffle, salted, so that a hot host is dealt over ``SALTS``
tasks.  A host's array is as long as the list's own history of it and its parents.

An allowing list outweighs blocking lists on the same or a shorter host name.

Defined cases: null urls and urls without host are on no list; a null fetch time
is in no interval; entries without host, action or moment are ignored; of entries
of one moment, removal comes last; adding what is listed and removing what isn't
change nothing; hosts of entries are read in any case and with or without a final
dot; repeated captures are each answered; an empty list blocks nothing; other
columns are kept, whatever their names (but for __host, __active and __blocked,
which are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BROADCAST_HOSTS = 100_000
BROADCAST_BYTES = 64 << 20
SALTS = 16


def host_of(url: Column) -> Column:
    """The lower-cased host of a URL, without user, port and final dot; null if there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return host_name(found)


def host_name(host: Column) -> Column:
    """A host as it is compared: lower case, no final dot; null if nothing is left."""
    return F.nullif(F.regexp_replace(F.lower(host), r"\.+$", ""), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, host, blocks, valid_from, valid_until) from entries (list, host, blocks, action, at); open ends are null."""
    known = entries.withColumn("host", host_name(F.col("host"))).filter("host IS NOT NULL AND at IS NOT NULL AND action IN ('add', 'remove')")
    by = Window.partitionBy("list", "host", "blocks")
    order = by.orderBy("at", "action")
    # The last entry of a moment counts; of equal states in a row, the first.
    settled = known.withColumn("later", F.lead("at").over(order)).filter("later IS NULL OR later <> at")
    turned = settled.withColumn("before", F.lag("action").over(order)).filter("before IS NULL OR before <> action")
    closed = turned.withColumn("valid_until", F.lead("at").over(order)).filter("action = 'add'")
    return closed.select("list", "host", "blocks", F.col("at").alias("valid_from"), "valid_until")


def names_of(host: Column) -> Column:
    """The host and its parents: a.b.c gives a.b.c, b.c and c."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, -i, i), "."))


def listed_hosts(hosts: DataFrame, entries: DataFrame) -> DataFrame:
    """(__listed, __entries): the intervals of each host that has any, as an array."""
    valid = intervals(entries).withColumnRenamed("host", "e_name")
    names = hosts.filter("host IS NOT NULL").select("host").distinct().withColumn("name", F.explode(names_of(F.col("host"))))
    joined = names.join(valid, F.col("name") == F.col("e_name"))
    entry = F.struct("valid_from", "valid_until", "list", "blocks", F.length("name").alias("reach"))
    return joined.groupBy(F.col("host").alias("__listed")).agg(F.sort_array(F.collect_list(entry)).alias("__entries"))


def _small(listed: DataFrame) -> bool:
    """Whether listed hosts may be broadcast, by their number and their bytes."""
    row = listed.limit(BROADCAST_HOSTS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("__listed") + 80 * F.size("__entries")), F.lit(0))).first()
    return row[0] <= BROADCAST_HOSTS and row[1] <= BROADCAST_BYTES


def judge(captures: DataFrame, entries: DataFrame, at: str = "fetched_at", url: str = "url") -> DataFrame:
    """The captures' columns, and __host, __active (names of the active lists, sorted) and __blocked."""
    rows = captures.drop("__active", "__blocked").withColumn("__host", host_of(F.col(url)))
    listed = listed_hosts(rows.select(F.col("__host").alias("host")), entries)
    if _small(listed):
        joined = rows.join(F.broadcast(listed), F.col("__host") == F.col("__listed"), "left")
    else:
        salted = listed.withColumn("__entry_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64(url, at), F.lit(SALTS)).cast("int"))
        joined = rows.join(salted, (F.col("__host") == F.col("__listed")) & (F.col("__salt") == F.col("__entry_salt")), "left").drop("__salt", "__entry_salt")
    moment = F.col(at)
    active = F.filter(F.coalesce("__entries", F.array()), lambda e: (e["valid_from"] <= moment) & (e["valid_until"].isNull() | (moment < e["valid_until"])))
    reach = lambda blocks: F.coalesce(F.array_max(F.transform(F.filter("__now", lambda e: e["blocks"] == blocks), lambda e: e["reach"])), F.lit(0))
    judged = joined.withColumn("__now", active).withColumn("__active", F.array_sort(F.array_distinct(F.transform("__now", lambda e: e["list"])))).withColumn("__blocked", reach(True) > reach(False))
    return judged.drop("__listed", "__entries", "__now")


def keep_allowed(captures: DataFrame, entries: DataFrame, at: str = "fetched_at", url: str = "url") -> DataFrame:
    """The captures that no list blocked when they were fetched, unchanged."""
    return judge(captures, entries, at, url).filter("NOT __blocked").select(*captures.columns)
