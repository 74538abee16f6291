"""Mixing sources to target weights, with built-in functions only.

Each source gets a share of a budget of ``EPOCHS`` times all tokens, by weight,
but never more than ``CAP`` times its own tokens; what a stopped source leaves is
shared again by weight.  The rate of a source is its target over its tokens.  A
document is emitted floor(rate) times, and once more if a number in [0, 1) hashed
from its id, its source, its text and the seed is below the fraction of the rate.
Equal rows would share that number; they are counted, their fractions are added up,
and one coin decides about the rest of the sum.

Sources are aggregated before anything is shuffled, so a source with a third of
all rows is one row from each task.  Weights go round by the rank of the source
in code point order, null last; ranks are counted inside ranges of the sources
and added up, so no task holds them all.  The level at which sources stop is
found by aggregates alone (one number a round goes to the driver).

Defined cases: null text has size 0; a null source is a source; sources whose
size is 0 have target 0; rows are taken as they are, repeated ones and ones without
an id too; an empty table gives an empty result; a column ``copy`` of the documents is
replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from leaguespark.llm.common import count_words, packed, stash, unit_hash

WEIGHTS = (5, 2, 1)
EPOCHS = 1.5
CAP = 2.0
SEED = 20
#: Sources up to this number are broadcast to the documents (about 60 bytes each).
BROADCAST_SOURCES = 100_000
#: Keys of repeated rows up to this number are broadcast (about 40 bytes each).
BROADCAST_REPEATED = 100_000
#: Salts for the join with a larger table of sources.
SALTS = 16


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: float = EPOCHS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Ranges of sources, written once so that their bounds stay the same in both uses.
    ranged = stash(totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    ranked = ranged.withColumn("rank", F.row_number().over(inside) - 1).join(F.broadcast(offsets.select("part", "offset")), "part")
    turn = (F.col("rank") + F.col("offset")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    weighed = stash(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("most")))
    level = _level(weighed, epochs)
    return weighed.select("source", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def _level(weighed: DataFrame, epochs: float) -> float:
    """Tokens per unit of weight, such that the targets add up to the budget."""
    budget = (weighed.agg(F.sum("source_size")).first()[0] or 0) * epochs
    level, stopped = 0.0, -1
    while True:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        row = weighed.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if row[0] == stopped or not row[2]:
            return level
        stopped, level = row[0], (budget - row[1]) / row[2]


def copies(rate: Column, key: Column, equal: Column, number: Column) -> Column:
    """Copies of row ``number`` of ``equal`` rows with one key: floor(rate), and one more for as many of them as their fractions add up to.

    What is left of that sum below one is the probability of one more, by the key's coin.
    """
    whole = F.floor(rate)
    more = equal * (rate - whole)
    coin = (unit_hash(F.lit(SEED), key) < more - F.floor(more)).cast("long")
    return (whole + (number < F.floor(more) + coin).cast("long")).cast("long")


def row_key(docs: DataFrame) -> Column:
    """Rows with one key have the same id, source and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.xxhash64(F.col("doc_id").cast("long"), F.lit(0), F.col("source").cast("string"), F.lit(1), text)


def _numbered(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """Rows with ``equal``, how many rows of ``sized`` have their key, and ``number``, their place among these, from 0.

    Rows are counted inside the parts that the files gave and the counts are added up, so no task holds all rows of a key.
    """
    repeated = stash(sized.groupBy("key").agg(F.count(F.lit(1)).alias("equal")).filter("equal > 1").withColumnRenamed("key", "r_key"))
    alone = rows.withColumns({"equal": F.lit(1).cast("long"), "number": F.lit(0).cast("long")})
    if repeated.isEmpty():
        return alone
    few = repeated.limit(BROADCAST_REPEATED + 1).count() <= BROADCAST_REPEATED
    met = F.col("key") == F.col("r_key")
    found = F.broadcast(repeated) if few else repeated
    own = stash(rows.join(found, met).drop("r_key").withColumn("part", F.spark_partition_id()))
    before = Window.partitionBy("p_key").orderBy("p_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = own.groupBy(F.col("key").alias("p_key"), F.col("part").alias("p_part")).agg(F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("key", "part").orderBy("key")) - 1
    placed = own.withColumn("inside", inside).join(parts, (F.col("key") == F.col("p_key")) & (F.col("part") == F.col("p_part")))
    placed = placed.withColumn("number", F.col("offset") + F.col("inside")).select(*alone.columns)
    return rows.join(found, met, "left_anti").select(*rows.columns, F.lit(1).cast("long").alias("equal"), F.lit(0).cast("long").alias("number")).unionByName(placed)


def _with_targets(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows joined with their source's target; a larger table of sources meets salted rows, so that a hot source is dealt over tasks."""
    targets = targets.withColumnRenamed("source", "t_source")
    own = F.col("source").eqNullSafe(F.col("t_source"))
    if targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(targets), own)
    salted = targets.withColumn("t_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, own & (F.col("salt") == F.col("t_salt")))


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, key), written: it is needed several times, and the texts only once."""
    return stash(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), count_words(F.col("text")).alias("size"), row_key(docs).alias("key")))


def _rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)


def mix_plan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target and copies."""
    sized = _sized(docs)
    joined = _with_targets(_numbered(sized, sized), source_targets(sized.select("source", "size")))
    return joined.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", copies(_rate(), F.col("key"), F.col("equal"), F.col("number")).alias("copies"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, with a column ``copy`` counting from 0."""
    sized = _sized(docs)
    rows = packed(docs.drop("copy"), source=F.col("source").cast("string"), key=row_key(docs))
    joined = _with_targets(_numbered(rows, sized.select("key")), source_targets(sized.select("source", "size")))
    taken = joined.select("row", copies(_rate(), F.col("key"), F.col("equal"), F.col("number")).alias("n")).filter("n > 0")
    return taken.select("row.*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
